"""Fire records from text: two delimiters, Fortran numbers, dates in names or columns."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridspark.functions.dates import date_from_name
from gridspark.functions.numbers import is_finite, is_unparsed, parse_double
from gridspark.operators.skew import lookup_join
from gridspark.session import settle

# Share of unparsed tokens that is still accepted, texts of dates,
# and the creation stamp of a container name.
UNPARSED_TOLERANCE = 0.02
CIVIL_DATE = r"^(?:\d{8}|\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2})$"
ORDINAL_DATE = r"^(\d{4})(\d{3})$"
CREATION_STAMP = r"_c\d{6,8}(?=\D|$)"
LAT_NAMES, LON_NAMES = ["LATI", "LAT", "latitude"], ["LONGI", "LON", "longitude"]
AREA_NAMES, FRP_NAMES = ["AREA", "FIRE_AREA", "area"], ["FRP", "frp"]
DAY_NAMES = ["DAY", "DATE", "YYYYMMDD", "date", "day"]


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, pos, line) of text files, plain or gzip; ``pos`` orders the lines of one file.

    A split keeps its offset and row ids grow within it, so the pair orders a file without gathering it.
    """
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("pos"),
        F.col("value").alias("line"))
    return raw


def content_lines(lines: DataFrame) -> DataFrame:
    """Lines without comments and blanks, trimmed."""
    text = F.trim(F.regexp_replace("line", r"#.*$", ""))
    return lines.withColumn("line", text).filter(F.col("line") != "")


def _comma_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))


def file_layouts(lines: DataFrame) -> DataFrame:
    """One row per file: header names and delimiter, from its first two content lines.

    Comma applies when the header has at least two and the first record at least max(2, header - 1);
    otherwise blanks and commas both separate. The header is the first content line and the record the second,
    whatever they begin with; names lose enclosing quotes. Two minima, each combined before the shuffle; where
    positions tell the split, only lines of a file's first split are looked at.
    """
    at = F.struct("pos", "line")
    if isinstance(lines.schema["pos"].dataType, StructType):
        lines = lines.filter("pos.block = 0")
    head = settle(lines.groupBy("file").agg(F.min(at).alias("h")).select("file", F.col("h.pos").alias("head_pos"), F.col("h.line").alias("header")))
    second = lookup_join(lines, head, ["file"], "inner").filter(F.col("pos") > F.col("head_pos")).groupBy("file").agg(F.min(at).alias("d"))
    both = head.join(second.select("file", F.col("d.line").alias("first")), "file", "left")
    n = _comma_count(F.col("header"))
    comma = (n >= 2) & (F.col("first").isNull() | (_comma_count(F.col("first")) >= F.greatest(F.lit(2), n - 1)))
    both = both.withColumn("comma", comma)
    names = F.transform(split_line(F.col("header"), F.col("comma")), lambda x: F.lower(F.trim(F.regexp_replace(F.trim(x), "^([\"'])(.*)\\1$", "$2"))))
    return both.select("file", "head_pos", "comma", names.alias("names"))


def split_line(line: Column, comma: Column) -> Column:
    """Fields of a line; a trailing comma adds an empty last field and moves nothing."""
    return F.when(comma, F.split(line, ",")).otherwise(F.split(F.trim(line), r"[,\s]+"))


def _field(aliases: list[str]) -> Column:
    """Text under the first alias the header has, whatever its case."""
    hits = [F.when(F.array_position("names", a.lower()) > 0, F.get("parts", F.array_position("names", a.lower()).cast("int") - 1))
            for a in aliases]
    return F.coalesce(*hits)


def parse_lines(lines: DataFrame, columns: dict[str, list[str]], text: tuple[str, ...] = ()) -> DataFrame:
    """Records from content lines: (file, columns..., bad_<column>).

    ``columns`` maps an output name to header aliases; numeric unless listed in ``text``. A file may hold
    most of the lines: its one-row layout is broadcast after a size check. Unnamed columns are never read.
    """
    lines = content_lines(lines)
    layouts = file_layouts(lines)
    rows = lookup_join(lines, layouts, ["file"], "inner").filter(F.col("pos") > F.col("head_pos"))
    rows = rows.withColumn("parts", split_line(F.col("line"), F.col("comma")))
    out = [F.col("file")]
    for name, aliases in columns.items():
        raw = _field(aliases)
        out += [raw.alias(name)] if name in text else [parse_double(raw).alias(name), is_unparsed(raw).alias(f"bad_{name}")]
    return rows.select(*out)


def read_fire_text(spark: SparkSession, paths: list[str], columns: dict[str, list[str]],
                   text: tuple[str, ...] = ()) -> DataFrame:
    """Fire records of text files with the date their name carries."""
    return parse_lines(read_lines(spark, paths), columns, text).withColumn("file_date", date_from_name(F.col("file")))


def missing_columns(lines: DataFrame, columns: dict[str, list[str]], mandatory: list[str]) -> DataFrame:
    """Files whose header has none of the aliases of a mandatory column, with the names they do have."""
    layouts = file_layouts(content_lines(lines))
    absent = F.array_compact(F.array(*[
        F.when(~F.arrays_overlap("names", F.array(*[F.lit(a.lower()) for a in columns[m]])), F.lit(m)) for m in mandatory]))
    return layouts.select("file", F.explode(absent).alias("missing"), "names")


def parse_guard(df: DataFrame, mandatory: list[str], tolerance: float = UNPARSED_TOLERANCE, by: str = "file") -> DataFrame:
    """(file, field, rule): a mandatory column without any usable value or with too many unparsed tokens.

    All files and columns share one aggregation.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in mandatory:
        aggs += [F.sum(is_finite(F.col(m)).cast("bigint")).alias(f"ok_{m}"), F.sum(F.col(f"bad_{m}").cast("bigint")).alias(f"no_{m}")]
    per = df.groupBy(by).agg(*aggs)
    rules = [F.struct(F.lit(m).alias("field"), F.when(F.col(f"ok_{m}") == 0, "no_usable_value").when(
        F.col(f"no_{m}") > tolerance * F.col("n"), "too_many_unparsed").alias("rule")) for m in mandatory]
    return per.select(by, F.explode(F.array(*rules)).alias("v")).select(by, "v.*").filter(F.col("rule").isNotNull())


def container_dates(df: DataFrame, day: str = "day", mode: str = "auto", by: str = "file", reference_year: int | None = None) -> DataFrame:
    """file_date of records in annual or monthly files; ``day`` is text.

    Date formats are tried first. A plain number is a day of year, or a day of month when the file name
    holds a year and month and no day exceeds 31; the mode is decided per file. A creation stamp in the
    name is ignored.
    """
    if mode not in ("auto", "doy", "dom"):
        raise ValueError("mode must be auto, doy, or dom")
    raw = F.trim(F.col(day))
    # a cast of one form: a parser that fails builds an exception per row
    civil = _civil(F.when(raw.rlike(CIVIL_DATE), F.regexp_replace(raw, "[-/]", "")))
    y, d = F.regexp_extract(raw, ORDINAL_DATE, 1).try_cast("int"), F.regexp_extract(raw, ORDINAL_DATE, 2).try_cast("int")
    parsed = F.coalesce(civil, _ordinal(y, d))
    number = F.when(parsed.isNull(), parse_double(raw).cast("int"))
    x = df.withColumn("_p", parsed).withColumn("_n", number)
    # what the name of a file says is found once per file
    base = F.regexp_replace(F.regexp_extract(F.col(by), r"([^/]*)$", 1), CREATION_STAMP, "")
    ym = F.regexp_extract(base, r"((?:19|20)\d{2}(?:0[1-9]|1[0-2]))", 1)
    yy = F.regexp_extract(base, r"((?:19|20)\d{2})", 1).try_cast("int")
    highest = x.groupBy(by).agg(F.max("_n").alias("_top")).withColumn("_ym", ym).withColumn("_yy", yy)
    x, ym = lookup_join(x, highest, [by]), F.col("_ym")
    year = F.lit(reference_year) if reference_year is not None else F.col("_yy")
    doy = _ordinal(year, F.col("_n"))
    dom = _civil(F.when(ym != "", F.concat(ym, F.lpad(F.col("_n").cast("string"), 2, "0"))))
    if mode == "auto":
        day_of_year = (F.col("_top") > 31) | (ym == "")
        numbered = F.when(day_of_year, doy).otherwise(dom)
    else:
        numbered = doy if mode == "doy" else dom
    return x.withColumn("file_date", F.coalesce("_p", numbered)).drop("_p", "_n", "_top", "_ym", "_yy")


def undated(df: DataFrame, by: str = "file") -> DataFrame:
    """Files with records to which :func:`container_dates` could give no date, and how many; must be empty before staging."""
    return df.filter(F.col("file_date").isNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n_undated"))


def _civil(text: Column) -> Column:
    """The date of yyyyMMdd, null if there is none."""
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)).try_cast("date")


def _ordinal(year: Column, day: Column) -> Column:
    date = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1)
    return F.when((day >= 1) & (F.year(date) == year), date)


def stage_days(df: DataFrame, start, end, by: str = "file") -> tuple[DataFrame, DataFrame]:
    """(records within the period, days that come from more than one container).

    Write the first with ``partitionBy('file_date')`` so later reads prune by day. The records of the period are written once here,
    so that dates are not found again by every reader.
    """
    kept = settle(df.filter(F.col("file_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))
    repeated = kept.groupBy("file_date").agg(F.countDistinct(by).alias("n_files")).filter("n_files > 1")
    return kept, repeated


def prefer_sources(candidates: DataFrame, key: str = "day", series: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(first candidate per day, conflicts): candidates(day, source, priority, is_local, path, year limits).

    Lower priority numbers win, local beats remote within a source, and a source outside its years is
    ignored. Two different local files of one source on one day are a conflict.
    """
    keys = ([series] if series else []) + [key]
    c = candidates
    if "start_year" in c.columns:
        year = F.year(key)
        c = c.filter((year >= F.coalesce("start_year", F.lit(-999999))) & (year <= F.coalesce("end_year", F.lit(999999))))
    clash = c.filter("is_local").groupBy(*keys, "source").agg(F.countDistinct("path").alias("n_paths")).filter("n_paths > 1")
    rank = F.struct(F.col("priority"), (~F.col("is_local")).alias("remote"), F.col("path"), F.col("source"))
    best = c.groupBy(*keys).agg(F.min(rank).alias("b"))
    return best.select(*keys, F.col("b.source").alias("source"), F.col("b.path").alias("path")), clash
