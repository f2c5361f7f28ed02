"""Surrogates for personal data, in DataFrame functions only.

Detected mentions become entities (kind, value): numbers without their layout, e-mails in lower case as host and mailbox, names word by word with
the gender of their title and their script. An entity's surrogate follows from a keyed digest of kind, value and attempt and
keeps kind and format. A check over the distinct entities of the whole corpus moves entities whose surrogate
is that of another, or is itself a value of the corpus, to the next attempt until all differ; after a few, surrogates grow longer. Texts are rewritten
in place with attempt zero; only entities with a later attempt, if there are any, are joined to their documents. The same entity
thus has one surrogate everywhere, and different entities have different ones.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import settle

# fixed values: titles that announce a name, by the gender they tell; abbreviations end in a full stop
TITLES = {
    "m": ["Mr\\.", "Mister", "Herr", "Señor", "Sr\\.", "Monsieur", "Господин", "Κύριος"],
    "f": ["Mrs\\.", "Ms\\.", "Miss", "Frau", "Señora", "Sra\\.", "Madame", "Mme\\.", "Госпожа", "Κυρία"],
    "n": ["Dr\\.", "Prof\\."],
}
# fixed values: syllables of invented names and their endings by gender, for each script
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fe", "ga", "ka", "la", "le", "li", "lo", "ma", "mi", "mo", "na", "ne", "ra", "re", "ro", "sa", "ta", "vi"],
    "cyrillic": ["ба", "бе", "бо", "ва", "ве", "во", "га", "да", "де", "ка", "ко", "ла", "ле", "ли", "ло", "ма", "ми", "на", "не", "ра", "ро", "са", "та", "ти"],
    "greek": ["βα", "βε", "γα", "γο", "δα", "δε", "ζα", "θε", "κα", "κο", "λα", "λε", "λι", "μα", "με", "μι", "να", "νε", "πα", "πο", "ρα", "ρο", "σα", "τα"],
}
ENDINGS = {
    "latin": {"m": ["rd", "ns", "rt", "ck"], "f": ["lia", "na", "ra", "tta"], "n": ["in", "en", "il", "is"]},
    "cyrillic": {"m": ["слав", "мир", "н", "й"], "f": ["ина", "ья", "лия", "на"], "n": ["ша", "ля", "ня", "ка"]},
    "greek": {"m": ["ος", "ης", "ας", "ων"], "f": ["ία", "νη", "ρα", "λη"], "n": ["ις", "ω", "υς", "ι"]},
}
_NAME = r"\p{Lu}[\p{L}'-]++"
_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
_SECRET = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: kinds and their patterns, in the order in which they are tried at a place. Each starts at a token's beginning and none
#: can run over a token again, so the search is linear in the text.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})",
    "secret": rf"(?<![A-Za-z]){_SECRET}[A-Za-z0-9+/_-]{{8,}}+",
    "cloud key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+?\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}[ -]\d{1,7})(?![\w-])",
    "name": rf"(?<![\p{{L}}])(?:{_TITLE}) {_NAME}(?: {_NAME}){{0,2}}",
}
ANY = r"(?<!\w)(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
#: attempts in the format of the value; later ones also grow, so that every set of entities has an assignment
SAME_FORMAT = 4
#: after so many attempts, one that settles no entity is an error (numbers of fixed length, of which nearly all are taken)
ATTEMPTS = 40


def _text(c: str) -> Column:
    return F.lit(c)


def kind_of(mention: Column) -> Column:
    """Kind of one mention: the first pattern that it matches as a whole."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        whole = pattern.replace(r"(?<![\w+])", "").replace(r"(?<![\w-])", "").replace(r"(?<![\w.])", "")
        kind = F.when(mention.rlike(rf"^(?:{whole})$"), F.lit(name)).otherwise(kind)
    return kind


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _gender(mention: Column) -> Column:
    got = F.lit("n")
    for gender, titles in TITLES.items():
        if gender != "n":
            got = F.when(mention.rlike(rf"^(?:{'|'.join(titles)}) "), F.lit(gender)).otherwise(got)
    return got


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), F.lit("cyrillic")).when(word.rlike(r"^\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))


def _name_words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, rf"^(?:{_TITLE}) ", ""), " ")


def entities_of(found: Column) -> Column:
    """Entities of a mention (text, kind): array of (kind, value). All but the last word of a name are given names; an e-mail
    is its host and a mailbox of that host."""
    mention, kind = found["text"], found["kind"]
    words = _name_words(mention)
    names = F.transform(words, lambda w, i: F.struct(
        F.when(i < F.size(words) - 1, F.concat(_text("given:"), _gender(mention), _text(":"), _script(w))).otherwise(F.concat(_text("family:"), _script(w))).alias("kind"), w.alias("value")))
    value = F.when(kind == "email", F.lower(mention)).when(kind == "phone", F.right(_digits(mention), F.lit(10))).when(kind.isin("card", "ssn"), _digits(mention)) \
        .when(kind == "secret", F.regexp_replace(mention, f"^{_SECRET}", "")).otherwise(mention)
    host = F.regexp_extract(value, "@(.*)$", 1)
    parts = F.array(F.struct(F.concat(_text("mailbox:"), host).alias("kind"), F.regexp_extract(value, "^(.*)@", 1).alias("value")), F.struct(_text("host").alias("kind"), host.alias("value")))
    return F.when(kind == "name", names).when(kind == "email", parts).otherwise(F.array(F.struct(kind.alias("kind"), value.alias("value"))))


def _number(digest: Column, i: Column) -> Column:
    """Number 0..255 from the i-th byte of a digest in hex; bytes repeat after 60."""
    return F.conv(F.substring(digest, F.pmod(i, F.lit(60)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(options: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(n, F.lit(len(options))) + 1).cast("int"))


def _shaped(value: Column, digest: Column, hexes: bool = True) -> Column:
    """Every digit, lower-case and upper-case letter replaced by one of its class, other characters kept; with ``hexes``
    a value of hex digits stays one."""
    lower, upper = F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    span = F.when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 6).otherwise(26) if hexes else F.lit(26)

    def one(c: Column, i: Column) -> Column:
        n = _number(digest, i)
        return F.when(c.between("0", "9"), F.pmod(n, F.lit(10)).cast("string")).when(c.between("a", "z"), F.substring(lower, F.pmod(n, span) + 1, F.lit(1))) \
            .when(c.between("A", "Z"), F.substring(upper, F.pmod(n, span) + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Check sum of a digit string from its right end."""
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
                       F.lit(0), lambda a, x: a + x) % 10


def _name(kind: Column, digest: Column, attempt: Column) -> Column:
    """An invented name of the kind's script and gender; each attempt adds a syllable to the possible length."""
    got = F.lit("")
    for script, syllables in SYLLABLES.items():
        parts = F.array_join(F.transform(F.sequence(F.lit(0), F.least(attempt, F.lit(6)) + 1), lambda i: _pick(syllables, _number(digest, i))), "")
        family = F.concat(parts, _pick(syllables, _number(digest, F.lit(20))), _pick(["n", "r", "s", "k"] if script == "latin" else ["н", "р", "к", "в"] if script == "cyrillic" else ["ς", "ν", "ρ", "ξ"], _number(digest, F.lit(21))))
        word = family
        for gender, endings in ENDINGS[script].items():
            word = F.when(kind == f"given:{gender}:{script}", F.concat(parts, _pick(endings, _number(digest, F.lit(22))))).otherwise(word)
        got = F.when(kind.endswith(script), F.initcap(word)).otherwise(got)
    return got


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Surrogate value of an entity at one attempt, of the kind and format of ``value``."""
    digest_of = lambda what: F.sha2(F.concat_ws("\u0001", F.lit(key), kind, what, attempt.cast("string")), 512)
    digest = digest_of(value)
    shaped = _shaped(value, digest)
    # from SAME_FORMAT on, hex characters are added, one more each attempt
    more = F.substring(digest, F.lit(65), F.greatest(attempt - SAME_FORMAT + 1, F.lit(0)))
    mailbox = F.concat(_shaped(value, digest, hexes=False), more)
    host = F.concat(_shaped(F.regexp_extract(value, r"^(.*)\.[a-z]+$", 1), digest, hexes=False), more, F.regexp_extract(value, r"(\.[a-z]+)$", 1))
    secret = F.concat(shaped, F.when(value.rlike("^[0-9A-F]+$"), F.upper(more)).otherwise(more))
    octet = lambda i, low, n: (F.pmod(_number(digest, F.lit(i)) * 256 + _number(digest, F.lit(i + 8)), F.lit(n)) + low).cast("string")
    ip = F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))
    area = (F.pmod(_number(digest, F.lit(50)), F.lit(8)) + 2).cast("string")
    phone = F.concat(area, F.substring(shaped, 2, 2), F.when((F.substring(value, 4, 3) == "555") & (attempt < SAME_FORMAT), _text("555")).otherwise(F.substring(shaped, 4, 3)), F.substring(shaped, 7, 4))
    body = F.concat(F.substring(value, 1, 1), F.substring(shaped, F.lit(2), F.length(value) - 2))
    card = F.concat(body, F.pmod(_luhn(value) - _luhn(F.concat(body, _text("0"))), F.lit(10)).cast("string"))
    key_id = F.concat(F.substring(value, 1, 4), F.substring(shaped, 5, 16))
    iban = F.concat(F.substring(value, 1, 2), F.substring(shaped, F.lit(3), F.length(value)))
    return F.when(kind.startswith("mailbox:"), mailbox).when(kind == "host", host).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card).when(kind == "cloud key", key_id) \
        .when(kind == "iban", iban).when(kind == "ssn", shaped).when(kind == "secret", secret).otherwise(_name(kind, digest, attempt))


def _laid_out(mention: Column, digits: Column) -> Column:
    """``mention`` with its last digits replaced by ``digits``, its other characters kept."""
    chars = F.split(mention, "")
    n = F.length(digits)

    def one(c: Column, i: Column) -> Column:
        after = F.length(_digits(F.array_join(F.slice(chars, i + 2, F.size(chars)), "")))
        return F.when(c.between("0", "9") & (after < n), F.substring(digits, n - after, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(chars, one), "")


def rewritten(mentioned: Column, attempts: Column, key: str) -> Column:
    """The mention with its entities' surrogates; ``attempts`` is a map from "kind|value" to attempts above zero, or null."""
    mention, kind = mentioned["text"], mentioned["kind"]
    found = entities_of(mentioned)
    tried = lambda e: F.coalesce(F.try_element_at(attempts, F.concat(e["kind"], _text("|"), e["value"])), F.lit(0))
    values = F.transform(found, lambda e: surrogate(e["kind"], e["value"], tried(e), key))
    first = F.element_at(values, 1)
    return F.when(kind == "name", F.concat(F.regexp_extract(mention, rf"^((?:{_TITLE}) )", 1), F.array_join(values, " "))) \
        .when(kind == "email", F.array_join(values, "@")) \
        .when(kind.isin("phone", "card", "ssn"), _laid_out(mention, first)) \
        .when(kind == "secret", F.concat(F.regexp_extract(mention, f"^({_SECRET})", 1), first)).otherwise(first)


def may_hold(text: Column) -> Column:
    """False for texts without any sign that some mention needs: a digit, one of @ = :, a key prefix or a title. Quicker
    than the patterns."""
    got = text.rlike("[0-9@=:]") | F.contains(text, F.lit("AKIA")) | F.contains(text, F.lit("ASIA"))
    for title in (t.replace("\\", "") for ts in TITLES.values() for t in ts):
        got = got | F.contains(text, F.lit(f"{title} "))
    return got


def mentions_in(text: Column) -> Column:
    """All mentions (text, kind) of a text in order; empty for null."""
    found = F.when(may_hold(text), F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))
    return F.transform(found, lambda m: F.struct(m.alias("text"), kind_of(m).alias("kind")))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """Rows (kind, value, attempt, surrogate) of distinct entities (kind, value): surrogates of a kind all differ and
    none is a value of that kind."""
    real = settle(entities.select("kind", "value").distinct())
    todo, done, attempt, left = real.withColumn("attempt", F.lit(0)), None, 0, real.count()
    while left or done is None:
        tried = settle(todo.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key)))
        # the smallest value of equal surrogates keeps it, unless it is taken or real
        first = tried.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        taken = real.select("kind", F.col("value").alias("surrogate"))
        taken = taken if done is None else taken.unionAll(done.select("kind", "surrogate"))
        first = first.join(taken, ["kind", "surrogate"], "left_anti")
        won = tried.join(first, ["kind", "surrogate", "value"], "left_semi").select("kind", "value", "attempt", "surrogate")
        done = settle(won if done is None else done.unionAll(won))
        todo = settle(tried.join(done.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value", (F.col("attempt") + 1).alias("attempt")))
        before, left, attempt = left, todo.count(), attempt + 1
        if attempt >= ATTEMPTS and left == before:
            raise RuntimeError(f"attempt {attempt} settles none of {left} entities")
    return done


def replace_pii(docs: DataFrame, secret_key: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and n_entities (mentions replaced) and kinds (distinct, sorted, comma-joined).

    Null and empty texts stay as they are with no entities. Repeated rows and null ids are rewritten like any other; an empty
    table gives no rows. Other columns are kept; if one is called n_entities or kinds it is replaced.
    """
    found = docs.select(F.col(key).alias("id"), mentions_in(F.col(text)).alias("m")).where(F.size("m") > 0)
    each = found.select("id", F.explode("m").alias("m")).select("id", F.explode(entities_of(F.col("m"))).alias("e"))
    entities = settle(each.groupBy("id", F.col("e.kind").alias("kind"), F.col("e.value").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    later = settle(assign(entities, secret_key).where("attempt > 0"))
    rows, attempts = docs, F.lit(None).cast("map<string,int>")
    if not later.isEmpty():
        entry = F.struct(F.concat("kind", F.lit("|"), "value"), "attempt")
        theirs = entities.join(later, ["kind", "value"]).groupBy(F.col("id").alias("__id")).agg(F.map_from_entries(F.collect_set(entry)).alias("__attempts"))
        theirs = settle(theirs)  # written, so its size is known before texts would be shuffled to meet it
        rows = docs.join(theirs, docs[key].eqNullSafe(theirs["__id"]), "left")
        attempts = F.col("__attempts")
    marked = rows.withColumn("__m", mentions_in(F.col(text))).withColumn("__p", F.when(F.size("__m") > 0, F.split(F.col(text), ANY, -1)))
    new = F.transform("__m", lambda m: rewritten(m, attempts, secret_key))
    joined = F.array_join(F.flatten(F.zip_with("__p", new, lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))), "")
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("__m", lambda m: m["kind"]))), ",")
    out = {text: F.when(F.size("__m") > 0, joined).otherwise(F.col(text))}
    plain = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    return marked.select(*[out.get(c, F.col(c)).alias(c) for c in plain], F.size("__m").cast("long").alias("n_entities"), kinds.alias("kinds"))
