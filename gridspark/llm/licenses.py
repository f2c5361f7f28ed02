"""License scans: an exact set-similarity join of text blocks with notice templates.

Blocks of a template are all runs of words of its own length and a quarter more, over line ends as well, as sets of words; the whole
text is the block of a phrase. A block matches a template if it holds a share of ``threshold`` or more of the template's words, all
words that the template requires (those that name the license) and none that it excludes. Words that occur in templates are ordered by the
number of lines of the whole corpus that hold them, rarest first. A matching block then holds one of the first |T| - need + 1 words of
the template, so only the surroundings of these are looked at (prefix and positional filter), in texts that hold enough of its words at
all (length filter). There a window slides from template word to template word and counts are kept up. Phrases are templates that a text must
hold wholly, and are then looked up as consecutive words. Templates are a fixed list of a few hundred words, which
bounds everything that is broadcast or sent to the driver.
"""
from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import settle

THRESHOLD = 0.8
# fixed values: phrases whose words must stand consecutively, and their labels
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
# fixed values: opening sentences of public licenses and usual notices, their labels, and the words that a block must and must not hold
TEMPLATES = [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0", "apache", ""),
    ("Licensed under the Mozilla Public License, Version 2.0", "mpl-2.0", "mozilla", ""),
    ("Released under the MIT License", "mit", "mit", ""),
    ("Released under the BSD License", "bsd", "bsd", ""),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit", "permission granted", ""),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0", "gnu general public", "lesser affero"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl-3.0", "gnu general public", "lesser affero"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd", "redistribution", ""),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0", "mozilla", ""),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc", "permission granted", ""),
    ("This is free and unencumbered software released into the public domain", "unlicense", "domain", ""),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0", "commons attribution", "sharealike noncommercial noderivatives noderivs sa nc nd"),
]
#: lower-cases A-Z and makes every other ASCII character that is no digit or letter a blank
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))


def word_order(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """Place of each word of ``vocabulary`` by the number of lines of all documents that hold it, rarest first."""

    def rows(batches):
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for line in (t or b"").split(b"\n"):
                    counts.update(vocabulary.intersection(words_of(line)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    got = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(rows, "word binary, n long")
    total = {bytes(r.word): r.n for r in got.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (total.get(w, 0), w)))}


class Template(NamedTuple):
    """A notice as sets of words; ``width`` words make a block, ``need`` different ones of ``words`` a match."""

    words: frozenset[bytes]
    label: str
    required: frozenset[bytes]
    excluded: frozenset[bytes]
    width: int
    need: int
    heads: frozenset[bytes]


def prepared(templates, threshold: float, order: dict[bytes, int] | None = None) -> list[Template]:
    """Templates (text, label[, required, excluded]) with the sizes of their blocks; ``order`` gives the rarest words, of which a match holds one."""
    out = []
    for text, label, *rules in templates:
        listed = words_of(text.encode())
        words = frozenset(listed)
        need = math.ceil(threshold * len(words) - 1e-9)
        ranked = sorted(words, key=order.__getitem__) if order else []
        required, excluded = (frozenset(words_of(x.encode())) for x in (*rules, "", "")[:2])
        out.append(Template(words, label, required, excluded, len(listed) + len(listed) // 4, need, frozenset(ranked[: len(words) - need + 1])))
    return out


def matched_blocks(places: dict[bytes, list[int]], t: Template) -> tuple[int, int]:
    """Most different words of the template in a matching block, and the number of runs of overlapping matching blocks.

    ``places`` are the places of words in a text, ascending. Blocks begin at words of the template.
    """
    held = [w for w in t.words if w in places]
    if len(held) < t.need or not t.heads & places.keys() or not all(w in places for w in t.required):
        return 0, 0
    near = sorted(p for w in t.heads for p in places.get(w, ()))
    watched = t.words | t.required | t.excluded
    spots = sorted((p, w) for w in watched if w in places for p in places[w])
    best = runs = 0
    counts: Counter = Counter()
    different = end = at = 0
    until = -1  # first place behind the last matching block
    for i, (p, w) in enumerate(spots):
        while end < len(spots) and spots[end][0] < p + t.width:
            x = spots[end][1]
            counts[x] += 1
            different += counts[x] == 1 and x in t.words
            end += 1
        while at < len(near) and near[at] < p:
            at += 1
        if w in t.words and different >= t.need and at < len(near) and near[at] < p + t.width:
            if all(counts[x] for x in t.required) and not any(counts[x] for x in t.excluded):
                best = max(best, different)
                runs += p >= until
                until = p + t.width
        counts[w] -= 1
        different -= counts[w] == 0 and w in t.words
    return best, runs


def _scanned(docs: DataFrame, order: dict[bytes, int], templates: list[Template], phrase_heads: set[bytes], phrase_words: set[bytes], key: str, text: str) -> DataFrame:
    """Rows (doc_id, n_words, blocks, spots): matches of each template, and where phrase words stand in texts with the
    rarest word of a phrase."""
    kind = docs.schema[key].dataType.simpleString()
    vocabulary = set(order)
    heads = frozenset().union(*(t.heads for t in templates))
    block = pa.list_(pa.struct([("template", pa.int32()), ("held", pa.int32()), ("runs", pa.int64())]))
    spot = pa.list_(pa.struct([("word", pa.int32()), ("at", pa.list_(pa.int32()))]))

    def rows(batches):
        for batch in batches:
            counts, blocks, spots = [], [], []
            for value in batch.column(1):
                words = words_of(value.as_py() or b"")
                counts.append(len(words))
                held = vocabulary.intersection(words)
                mine, spoken = [], not phrase_heads.isdisjoint(held)
                places: dict[bytes, list[int]] = {}
                if spoken or not heads.isdisjoint(held):
                    for j, w in enumerate(words):
                        if w in vocabulary:
                            places.setdefault(w, []).append(j)
                    for i, t in enumerate(templates):
                        best, runs = matched_blocks(places, t)
                        if runs:
                            mine.append({"template": i, "held": best, "runs": runs})
                blocks.append(mine)
                spots.append([{"word": order[w], "at": p} for w, p in places.items() if w in phrase_words] if spoken else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(blocks, block), pa.array(spots, spot)], ["doc_id", "n_words", "blocks", "spots"])

    schema = f"doc_id {kind}, n_words long, blocks array<struct<template:int,held:int,runs:long>>, spots array<struct<word:int,at:array<int>>>"
    return _source(docs, key, text).mapInArrow(rows, schema)


def phrase_places(scanned: DataFrame, phrases: list[tuple[list[int], str]]) -> DataFrame:
    """Rows (row, label, places) of texts that hold all words of a phrase, with the starts of its consecutive places."""
    spark = scanned.sparkSession
    table = [(min(words), words[0], [{"i": i, "word": w} for i, w in enumerate(words) if i], label) for words, label in phrases]
    heads = F.broadcast(spark.createDataFrame(table, "rarest int, head int, rest array<struct<i:int,word:int>>, label string"))
    spots = scanned.where(F.size("spots") > 0).select("row", F.map_from_entries("spots").alias("at"))
    found = spots.select("row", "at", F.explode(F.map_keys("at")).alias("rarest")).join(heads, "rarest")
    held = F.map_contains_key("at", F.col("head")) & F.forall("rest", lambda x: F.map_contains_key(F.col("at"), x["word"]))

    def moved(x: Column) -> Column:
        return F.transform(F.element_at("at", x["word"]), lambda p: p - x["i"])

    places = F.aggregate("rest", F.element_at("at", F.col("head")), lambda acc, x: F.array_intersect(acc, moved(x)))
    return found.where(held).select("row", "label", places.alias("places")).where(F.size("places") > 0)


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks), one per row of ``docs``.

    ``n_base``, ``first_word`` and ``last_word`` count the places of phrases (starts in words from zero, null without a
    place), ``base_labels`` names them, ``labels`` adds those of matched templates, both distinct, sorted and
    joined by commas; ``score`` is the largest share of a template or phrase held and ``n_blocks`` the number of places where a
    template matches (overlapping blocks are one). Null and empty texts have no words. Repeated rows and null ids get a row each; an empty
    table gives none. Only key and text are read.
    """
    spoken = [(words_of(p.encode()), label) for p, label in phrases]
    phrase_words = {w for p, _ in spoken for w in p}
    plain = prepared(templates, threshold)
    order = word_order(docs, {w for t in plain for w in t.words | t.required | t.excluded} | phrase_words, text)
    sets = prepared(templates, threshold, order)
    phrase_heads = {min(p, key=order.__getitem__) for p, _ in spoken}
    scanned = _scanned(docs, order, sets, phrase_heads, phrase_words, key, text)
    scanned = settle(scanned.withColumn("row", F.monotonically_increasing_id()))  # written, so a row keeps its number
    named = F.broadcast(docs.sparkSession.createDataFrame([(i, t.label, len(t.words)) for i, t in enumerate(sets)], "template int, label string, size int"))
    hits = scanned.select("row", F.explode("blocks").alias("b")).select("row", "b.*").join(named, "template")
    matched = hits.groupBy("row").agg(F.collect_set("label").alias("more"), F.max(F.col("held") / F.col("size")).alias("share"), F.sum("runs").alias("n_blocks"))
    spoken_at = phrase_places(scanned, [([order[w] for w in p], label) for p, label in spoken]).groupBy("row").agg(
        F.sum(F.size("places")).alias("n_base"), F.min(F.array_min("places")).cast("long").alias("first_word"),
        F.max(F.array_max("places")).cast("long").alias("last_word"), F.collect_set("label").alias("base"))
    got = scanned.select("row", "doc_id", "n_words").join(matched, "row", "left").join(spoken_at, "row", "left")
    none = F.array().cast("array<string>")
    base, more = F.coalesce("base", none), F.coalesce("more", none)
    score = F.when(F.col("base").isNotNull(), F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return got.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                      F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
                      score.alias("score"), F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))


def sql() -> str:
    """The same scan as DuckDB SQL, without filters: every block of every template."""
    quote = lambda x: "'" + x + "'"
    lists = lambda ws: "[" + ", ".join(quote(w.decode()) for w in sorted(ws)) + "]::VARCHAR[]"
    in_order = lambda ws: "[" + ", ".join(quote(w.decode()) for w in ws) + "]"
    named = ", ".join(f"({i}, {lists(t.words)}, {quote(t.label)}, {lists(t.required)}, {lists(t.excluded)}, {t.width}, {t.need})" for i, t in enumerate(prepared(TEMPLATES, THRESHOLD)))
    spoken = ", ".join(f"({in_order(words_of(p.encode()))}, {quote(label)})" for p, label in PHRASES)
    words = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, doc_id, {words.format('text')} AS w FROM d),
t(id, words, label, required, excluded, width, need) AS (VALUES {named}), p(words, label) AS (VALUES {spoken}),
starts AS (
  SELECT row, label, unnest(list_filter(range(1, len(w) - len(words) + 2), lambda i: w[i:i + len(words) - 1] = words)) - 1 AS place
  FROM w, p WHERE list_has_all(w, words)),
base AS (SELECT row, count(*) AS n, min(place) AS first, max(place) AS last, list_distinct(list(label)) AS labels FROM starts GROUP BY row),
begun AS (
  SELECT row, w, t.*, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains(words, w[i]))) AS i
  FROM w, t WHERE len(list_intersect(w, words)) >= need AND list_has_all(w, required)),
blocks AS (SELECT row, id, label, i, width, words, required, excluded, need, list_distinct(w[i:i + width - 1]) AS block FROM begun),
hits AS (
  SELECT row, id, label, i, width, len(list_intersect(block, words)) / len(words) AS share FROM blocks
  WHERE len(list_intersect(block, words)) >= need AND list_has_all(block, required) AND NOT list_has_any(block, excluded)),
runs AS (SELECT *, CASE WHEN i < lag(i) OVER (PARTITION BY row, id ORDER BY i) + width THEN 0 ELSE 1 END AS run FROM hits),
more AS (SELECT row, list_distinct(list(label)) AS labels, max(share) AS share, CAST(sum(run) AS BIGINT) AS n FROM runs GROUP BY row)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
       CAST(base.first AS BIGINT) AS first_word, CAST(base.last AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
       CAST(CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(more.share, 0) END AS DOUBLE) AS score, CAST(coalesce(more.n, 0) AS BIGINT) AS n_blocks
FROM w LEFT JOIN base USING (row) LEFT JOIN more USING (row)
"""
