"""Reading CSV exports in one pass, with an account of what was not read.

Lines go in, records with columns come out; the batch reader and the landing stream share this parser:

1. The files are scanned once, as lines with their file, split offset and place in the split (``scan_lines``, written to
   the shared checkpoint folder). Everything below reads that.
2. Lines become records. A line ends inside a quoted field or not, depending on whether it began inside one; only files
   in which a line opens such a field need that state carried from line to line, all others go line by line.
3. Each file's first record is its header. Records meet their header in a table of one row per file and are parsed by it,
   once, into the shared checkpoint folder, so files with other columns, or the same columns in another order, land in one
   table by column name. On the way a file goes by a number, not by its path.
4. Nothing is lost unseen: every listed file that gave no record, every file left out and every record whose number of
   fields differs from its header's is in ``rejects``.

A file with a record of more fields than its header is left out as a whole, as such a file can't be read ("file"); with
``on_long="row"`` only its records of that kind are. Records with fewer fields are kept with nulls, and reported.
Missing-value texts become null in every column. Blank lines are skipped.
"""

from __future__ import annotations

import csv
from typing import List, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, warehouse_checkpoints

#: Texts that stand for a missing value in any column (fixed values).
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null")
REJECTS = "path string, row long, reason string, record string"
SRC = "_src_path string, _src_depth int, _src_row long, _src_entry array<string>"
NO_RECORD = "no record: empty or unreadable"
UNCLOSED = "a quoted field is never closed"
LONG, SHORT = "more fields than the header", "fewer fields than the header (kept)"
LEFT_OUT = "file left out: a record has more fields than the header"

BLANK = r"^[ \t]*$"

#: A line that begins outside quotes and ends inside a quoted field.
_OPENS = r'^(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+$'


class Feed(NamedTuple):
    """``rows``: the columns of all files and ``_src_*``; ``rejects``: (path, row, reason, record)."""
    rows: DataFrame
    rejects: DataFrame


def no_scheme(path: Column) -> Column:
    """file:/x, file:///x -> /x (the listing and the scan metadata spell local paths differently)."""
    return F.regexp_replace(path, "^file:/+", "/")


def decoded(path: Column) -> Column:
    """The listing's spelling of a scanned path (the scan URL-encodes it, and leaves '+' as it is)."""
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, to go on from there."""
    checkpoint_dir(df.sparkSession, fallback=warehouse_checkpoints(df.sparkSession))
    return df.checkpoint()


def with_source(lines: DataFrame) -> DataFrame:
    """Lines of a text scan (``value``) with file, split offset."""
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def scan_lines(spark: SparkSession, paths: List[str]) -> DataFrame:
    """The one scan of the files: (path, block, mid, value), written to the shared checkpoint folder. Unreadable files give
    no line; ``parse`` reports them."""
    text = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(paths)
    return written(with_source(text).withColumn("mid", F.monotonically_increasing_id()))


def numbered(lines: DataFrame) -> DataFrame:
    """The lines (file, block, mid, ...) with ``row``, the line's place in its file, from 0, without sorting a file in one task.

    Inside a split, ``mid`` is contiguous; splits of a file follow each other by offset. A table of one row per split
    gives each split's start by a running sum over the file's splits."""
    splits = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("mid").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    return lines.join(start, ["file", "block"]).withColumn("row", F.col("start") + F.col("mid")).drop("start")


def _opens(line: Column) -> Column:
    return line.contains('"') & line.rlike(_OPENS)


def file_facts(lines: DataFrame) -> DataFrame:
    """Per file: whether all lines are valid UTF-8, whether one may end inside a quoted field, and its first line that
    isn't blank with its place; a partial aggregate, one row per file."""
    shown = ~F.col("value").rlike(BLANK)
    return lines.groupBy("path").agg(
        F.min(F.is_valid_utf8("value")).alias("utf8"), F.max(_opens(F.col("value"))).alias("quoted"),
        F.min(F.when(shown, F.struct("block", "mid", "value"))).alias("first"))


def quoted_records(lines: DataFrame) -> DataFrame:
    """(file, row, value, closed) of the records of files with line breaks in quoted fields; ``row`` counts records from 0,
    ``closed`` is false where the file ends inside one.

    A line maps the state before it (inside a quoted field or not) to the state after it: it keeps the state, swaps it
    or sets it. The state after a line is what the last setting line left, swapped as often as lines since then did."""
    inside = F.concat(F.lit('"'), F.col("value"))
    df = numbered(lines).withColumn("quote", F.col("value").contains('"'))
    df = df.withColumn("out", _opens(F.col("value"))).withColumn("in", ~F.col("quote") | _opens(inside))
    w = Window.partitionBy("file").orderBy("row")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("odd", F.sum((F.col("out") & ~F.col("in")).cast("long")).over(run) % 2 == 1)
    df = df.withColumn("set", F.when(F.col("out") == F.col("in"), F.col("out") != F.col("odd")))
    df = df.withColumn("after", F.coalesce(F.last("set", ignorenulls=True).over(run), F.lit(False)) != F.col("odd"))
    starts = ~F.coalesce(F.lag("after").over(w), F.lit(False))
    end = F.last("after").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    df = df.withColumn("start", F.sum(starts.cast("long")).over(run) - 1).withColumn("closed", ~end)    # the record's place
    df = df.withColumn("first", starts).withColumn("last", F.max("start").over(Window.partitionBy("file")))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "value"))), lambda x: x["value"]), "\n")
    # a field that is never closed would be one record of the whole rest: it isn't put together
    good = df.filter("closed").groupBy("file", F.col("start").alias("row")).agg(whole.alias("value"))
    bad = df.filter(~F.col("closed") & F.col("first") & (F.col("start") == F.col("last")))
    return good.select("file", "row", "value", F.lit(True).alias("closed")).unionAll(
        bad.select("file", F.col("start").alias("row"), "value", F.lit(False)))


def column_names(header: str) -> List[str]:
    """Names of a header: unnamed columns are numbered, a repeated name gets a number of its own."""
    out: List[str] = []
    seen: set = set()
    for i, name in enumerate(next(csv.reader([header]), [])):
        base = name or f"Unnamed: {i}"
        name, k = base, 0
        while name.lower() in seen:
            k += 1
            name = f"{base}.{k}"
        seen.add(name.lower())
        out.append(name)
    return out


def _value(c: Column) -> Column:
    return F.when(~c.isin(*MISSING), c)


def _fields(record: Column) -> Column:
    """Fields of a record: separators outside quoted fields, and one."""
    return F.regexp_count(F.regexp_replace(record, r'(?:^|(?<=,))"(?:[^"]|"")*+"', ""), F.lit(",")) + 1


def parse(lines: DataFrame, listed: DataFrame | None = None, entry: Column | None = None, on_long: str = "file") -> Feed:
    """The records of ``lines`` (path, block, mid, value) by their files' headers.

    ``listed`` (path) are the files asked for, to report those without a record. ``entry``: names below the folder, the
    load order, as an expression on ``path``."""
    facts = written(file_facts(lines).withColumn("file", F.monotonically_increasing_id()))
    first = (F.col("block") == F.col("first.block")) & (F.col("mid") == F.col("first.mid"))
    known = lines.join(facts, "path").select("file", "block", "mid", "value", "utf8", "quoted", first.alias("head"))
    records = numbered(known.filter(~F.col("quoted"))).select("file", "utf8", "row", "value", F.lit(True).alias("closed"), "head")
    if not facts.filter("quoted").isEmpty():
        whole = written(quoted_records(known.filter("quoted").select("file", "block", "mid", "value")))
        top = whole.filter(F.col("closed") & ~F.col("value").rlike(BLANK)).groupBy("file").agg(F.min("row").alias("top"))
        tops = facts.filter("quoted").select("file", "utf8").join(top, "file", "left")
        records = records.unionAll(whole.join(tops, "file").select(
            "file", "utf8", "row", "value", "closed", F.coalesce(F.col("row") == F.col("top"), F.lit(False))))
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    records = records.filter(~F.col("value").rlike(BLANK)).withColumn("record", F.when(F.col("utf8"), F.col("value")).otherwise(latin))
    header = written(records.filter("head").select("file", F.regexp_replace("record", "^\ufeff", "").alias("header")))
    place = entry if entry is not None else F.split(decoded(no_scheme(F.col("path"))), "/")
    headers = [r["header"] for r in header.join(facts.select("file", "path"), "file").groupBy("header").agg(
        F.min(place).alias("at")).orderBy("at").collect()]
    names = {h: column_names(h) for h in headers}                                        # one per kind of file
    columns: dict = {}
    for h in headers:
        for n in names[h]:
            columns.setdefault(n.lower(), n)
    body = records.filter(~F.col("head")).join(header, "file", "left")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "quote": '"', "escape": '"'}
    # one column per kind of file, null for the other kinds; a record is parsed once, by its own header
    df = body.select("*", *[F.when(F.col("closed") & (F.col("header") == h), F.from_csv(
        "record", ", ".join([*[f"f{i} string" for i in range(len(names[h]))], "_bad string"]), options)).alias(f"_k{k}")
        for k, h in enumerate(headers)])
    parsed = None
    for k, h in enumerate(headers):
        s, at = F.col(f"_k{k}"), {n.lower(): i for i, n in enumerate(names[h])}
        cells = [_value(s[f"f{at[c]}"]).alias(f"c{i}") if c in at else F.lit(None).cast("string").alias(f"c{i}")
                 for i, c in enumerate(columns)]
        delta = F.when(s["_bad"].isNotNull(), _fields(F.col("record")) - len(names[h])).otherwise(F.lit(0)).cast("int")
        made = F.struct(*cells, delta.alias("delta"))
        parsed = F.when(s.isNotNull(), made) if parsed is None else parsed.when(s.isNotNull(), made)
    df = df.withColumn("p", parsed if parsed is not None else F.struct(F.lit(None).cast("int").alias("delta")))
    told = ~F.col("closed") | (F.col("p.delta") != 0)
    # written, as files left out, rejects and rows all go on from it; the text of a record stays where it is reported
    df = written(df.select("file", "row", "closed", "p", F.when(told, F.col("record")).alias("record")))
    bad = df.filter(told).withColumn("reason", F.when(~F.col("closed"), UNCLOSED).when(F.col("p.delta") > 0, LONG).otherwise(SHORT))
    of = facts.select("file", "path")
    rejects = bad.join(of, "file").select("path", "row", "reason", "record")
    kept = df.filter(F.col("closed") & (F.col("p.delta") <= 0))
    if on_long == "file":
        out = written(df.filter("p.delta > 0").select("file").distinct())
        kept = kept.join(out, "file", "left_anti")
        rejects = rejects.unionAll(out.join(of, "file").select(
            "path", F.lit(None).cast("long"), F.lit(LEFT_OUT), F.lit(None).cast("string")))
    # in as many tasks as the scan had, however few files there are
    kept = kept.join(of, "file").repartition(lines.rdd.getNumPartitions(), "file", "row")
    if listed is not None:
        seen = facts.filter("first is not null").select(decoded(no_scheme(F.col("path"))).alias("_p"))
        none = listed.select("path").distinct().join(seen, no_scheme(F.col("path")) == F.col("_p"), "left_anti")
        rejects = rejects.unionAll(none.select("path", F.lit(None).cast("long"), F.lit(NO_RECORD), F.lit(None).cast("string")))
    rows = kept.select(*[F.col("p")[f"c{i}"].alias(n) for i, n in enumerate(columns.values())], F.col("path").alias("_src_path"),
                       (F.size(place) - 1).cast("int").alias("_src_depth"), F.col("row").alias("_src_row"),
                       place.alias("_src_entry"))
    return Feed(rows, rejects)
