"""Line de-duplication by MinHash: one line stays of each group of near-identical lines, over all documents.

A line's shingles are its substrings of ``SHINGLE`` characters (the whole line if shorter); two lines are alike when
the Jaccard similarity of their shingle sets reaches ``PERCENT`` %. Candidates come from MinHash signatures of
``BANDS`` x ``ROWS`` values: lines that agree in all rows of a band meet in its bucket (a pair at the threshold is
found with probability 1 - (1 - 0.75^3)^8 = 0.99). A MinHash value is the least 32-bit shingle hash XOR a mask.
Every line is signed over all its shingles.

Equal lines have one signature. In a bucket all lines are verified against its pivot, the line that meets most others in all its
buckets (of copies with changes of their own, one near the original); then the lines outside the largest provisional
component of the bucket's other lines against all of them, so a bucket never emits all its pairs.
Pairs that can't reach the threshold go unverified: each line that meets another has a bit map of its shingles, and every bit in which
two maps differ is a shingle that one line has and the other lacks. In crowded buckets a line's own shingles, which no other
line of the pivot's crowded buckets has, are counted besides: they differ from any of these lines, and a line with too many of
them links with none there (say, one of many that hold the same passage and much text of their own). Verification is the exact Jaccard similarity. Groups are
the components of verified links (distributed union-find). The first line by (doc_id, line number) of a group stays.

Blank lines are never compared and always stay. Null or empty text has no lines. Lines of a null doc_id come after all
others. Rows that repeat a doc_id have the same line numbers, and equal lines there are kept or dropped alike. An
empty table gives an empty result; other columns are left alone. Lines are told apart by a 64-bit hash. Only DataFrame
functions run.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, likely_in, parallelism, release
from .components import components

SHINGLE = 9
PERCENT = 75
BANDS, ROWS = 8, 3
MAPS = 32              # words of 64 bits in a line's bit map of shingles
CROWD = 512            # pairs left in a bucket from which its lines' own shingles are counted
_ALL = r"(?s)(?=(.{%d}|\A.{0,%d}\z))" % (SHINGLE, SHINGLE - 1)     # at every place; the whole of a shorter line


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, line_id) of the lines that aren't blank; line_no counts all lines from 0."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("line_id", F.xxhash64("line"))


def _masks() -> list[int]:
    rng = random.Random(4)
    return [rng.getrandbits(32) - (1 << 31) for _ in range(BANDS * ROWS)]


def _cut_shingles(lines: DataFrame, *more: str) -> DataFrame:
    """(line_id, *more, n, h): a row per shingle of each row of ``lines`` with its 32-bit hash; n is their number."""
    found = lines.select("line_id", *more, _shingles(F.col("line")).alias("found"))
    rows = found.select("line_id", *more, F.size("found").alias("n"), F.explode("found").alias("shingle"))
    rows = rows.select("line_id", *more, "n", F.xxhash64("shingle").bitwiseAND(F.lit(0xFFFFFFFF)).alias("h"))
    return rows.select("line_id", *more, "n", (F.col("h") - F.lit(1 << 31)).cast("int").alias("h"))


def signed(lines: DataFrame) -> DataFrame:
    """(line_id, mins): the signature of each distinct line.

    Shingles are exploded and their minima taken in one generated aggregate, whose partial step sees all shingles of
    a line in the task that cut it.
    """
    least = _cut_shingles(lines).groupBy("line_id").agg(*[
        F.min(F.col("h").bitwiseXOR(F.lit(m))).alias(f"m{j}") for j, m in enumerate(_masks())])
    return least.select("line_id", F.array(*[f"m{j}" for j in range(BANDS * ROWS)]).alias("mins"))


def shaped(texts: DataFrame) -> DataFrame:
    """(line_id, n, map0, ...) per distinct line: the number of its shingles, repeats counted, and a bit map of them."""
    return _cut_shingles(texts).groupBy("line_id").agg(F.max("n").alias("n"), *_bits("map"))


def _bits(name: str) -> list[Column]:
    bit = "if((h & {}) = {}, shiftleft(1L, h & 63), 0L)"
    return [F.coalesce(F.bit_or(F.expr(bit.format(64 * MAPS - 64, 64 * k))), F.lit(0)).alias(f"{name}{k}") for k in range(MAPS)]


def _maps(prefix: str = "") -> list[str]:
    return [f"{prefix}map{k}" for k in range(MAPS)]


def _few_enough(differ: Column) -> Column:
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (F.col("n") + F.col("x_n"))


def can_reach() -> Column:
    """False where a line and ``x_`` line can't reach the threshold: shingles of one only are at most
    (100 - PERCENT) / (100 + PERCENT) of both lines' then, and no fewer than the bits that differ. ``n`` may count
    repeated shingles, which only lets more pairs through."""
    return _few_enough(sum((F.bit_count(F.col(m).bitwiseXOR(F.col(x))) for m, x in zip(_maps(), _maps("x_"))), F.lit(0)))


def owned(texts: DataFrame) -> DataFrame:
    """(pivot, line_id, own, own0, ...): the number of a line's shingles that no other line of its pivot has, and a bit map of
    them. Lines without any are left out."""
    of = _cut_shingles(texts, "pivot").groupBy("pivot", "h").agg(F.min("line_id").alias("line_id"), F.max("line_id").alias("last"))
    return of.filter("line_id = last").groupBy("pivot", "line_id").agg(F.count("*").alias("own"), *_bits("own"))


def can_reach_in_crowd() -> Column:
    """``can_reach`` where own shingles are counted one by one, and bits of those of a line that aren't its own (``rest``)
    differ if the other has no shingle there."""
    def lacks(k: int) -> Column:
        return F.bit_count(F.expr(f"(rest{k} & ~x_map{k}) | (x_rest{k} & ~map{k})"))

    return _few_enough(sum(map(lacks, range(MAPS)), F.col("own") + F.col("x_own")))


def _buckets() -> Column:
    return F.array(*[F.xxhash64(F.lit(b), *[F.col("mins")[b * ROWS + r] for r in range(ROWS)]) for b in range(BANDS)])


def _shingles(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(_ALL), F.lit(1))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of line ids whose lines reach the threshold; ``texts`` tells how many shingles each line has (size)."""
    j = pairs.join(texts.withColumnsRenamed({"line_id": "a", "line": "la", "size": "na"}), "a")
    # few bytes, much work: adaptive execution would leave it to few tasks
    j = j.repartition(parallelism(texts.sparkSession), "b").join(
        texts.withColumnsRenamed({"line_id": "b", "line": "lb", "size": "nb"}), "b")
    # with the union as the sizes less the common ones each line is cut once: Spark writes the condition out in place
    common = F.size(F.array_intersect(_shingles(F.col("la")), _shingles(F.col("lb"))))
    both = F.col("na") + F.col("nb")
    return j.filter((100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
                    & ((100 + PERCENT) * common >= PERCENT * both)).select("a", "b")


def line_links(lines: DataFrame) -> DataFrame:
    """Verified links (a, b) between line ids."""
    signatures = cut(signed(lines).select("line_id", _buckets().alias("buckets")))
    rows = signatures.select("line_id", F.explode("buckets").alias("bucket"))
    full = cut(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    met = cut(likely_in(rows, full, "bucket").join(full, "bucket"))
    del signatures, rows, full
    release(lines.sparkSession)
    meets = met.groupBy("line_id").agg(F.sum("n").alias("meets"))
    pivots = met.join(meets, "line_id").groupBy("bucket").agg(F.max(F.struct("meets", "line_id")).alias("top"))
    met = cut(met.join(pivots, "bucket").select("bucket", "line_id", F.col("top.line_id").alias("pivot")))
    asked = cut(met.select("line_id").distinct())
    texts = likely_in(lines.select("line_id", "line"), asked, "line_id").groupBy("line_id").agg(
        F.min("line").alias("line")).join(asked, "line_id", "left_semi")
    texts = cut(texts.withColumn("size", F.size(F.array_distinct(_shingles(F.col("line"))))))
    shapes = cut(shaped(texts))
    of_x = shapes.select(F.col("line_id").alias("x"), *[F.col(k).alias(f"x_{k}") for k in ("n", *_maps())])
    pairs = met.filter("line_id <> pivot").select("line_id", F.col("pivot").alias("x")).distinct()
    pairs = pairs.join(shapes, "line_id").join(of_x, "x").filter(can_reach()).select(F.col("line_id").alias("a"), F.col("x").alias("b"))
    first = cut(verified(pairs, texts))
    return first.unionAll(verified(_left(met, shapes, texts, components(first)), texts))


def _left(met: DataFrame, shapes: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): of lines that meet beside their bucket's pivot, the pairs of different components of ``found`` that may link."""
    label = found.select(F.col("node").alias("line_id"), F.col("component").alias("label"))
    c = met.filter("line_id <> pivot").join(label, "line_id", "left").withColumn(
        "label", F.coalesce("label", "line_id"))
    major = c.groupBy("bucket", "label").count().groupBy("bucket").agg(
        F.sum("count").alias("n"), F.max(F.struct("count", "label")).alias("top")).filter("n > top.count").select(
        "bucket", F.col("top.label").alias("major"), ((F.col("n") - F.col("top.count")) * F.col("n") >= CROWD).alias("crowd"))
    c = cut(c.join(major, "bucket"))
    release(met.sparkSession)
    # all lines of a pivot's crowded buckets are told apart; lines of its other buckets may be none of these
    own = owned(texts.join(c.filter("crowd").select("pivot", "line_id").distinct(), "line_id"))
    known = c.join(shapes, "line_id").join(own.withColumn("crowd", F.lit(True)), ["pivot", "line_id", "crowd"], "left")
    known = known.withColumn("own", F.coalesce("own", F.lit(0))).select("bucket", "line_id", "label", "major", "n", "own", *_maps(), *[
        F.col(m).bitwiseAND(F.bitwise_not(F.coalesce(f"own{k}", F.lit(0)))).alias(f"rest{k}") for k, m in enumerate(_maps())])
    # with more own shingles than these a line shares too few with any other
    mixed = cut(known.filter(100 * F.col("own") <= (100 - PERCENT) * F.col("n")))
    few = mixed.filter("label <> major").select("bucket", F.col("line_id").alias("x"), *[
        F.col(k).alias(f"x_{k}") for k in known.columns if k not in ("bucket", "line_id", "major")])
    once = (F.col("label") == F.col("major")) | (F.col("x") > F.col("line_id"))          # not two of the few both ways
    return few.join(mixed, "bucket").filter((F.col("label") != F.col("x_label")) & once & can_reach_in_crowd()).select(
        F.greatest("x", "line_id").alias("a"), F.least("x", "line_id").alias("b")).distinct()


def line_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, keep_doc_id, keep_line_no, group_size, kept) per line that isn't blank."""
    lines = lines_of(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no")
    top = components(line_links(lines)).select(F.col("node").alias("line_id"), "component")
    distinct = lines.groupBy("line_id").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    d = distinct.join(top, "line_id", "left").withColumn(
        "component", F.coalesce("component", "line_id"))
    groups = d.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("group_size"))
    known = d.select("line_id", "component").join(groups, "component").select("line_id", "keep", "group_size")
    out = lines.select("doc_id", "line_no", "line_id").join(known, "line_id")
    return out.select("doc_id", "line_no", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.line_no").alias("keep_line_no"),
                      "group_size", (F.col("doc_id").eqNullSafe(F.col("keep.doc_id"))
                                     & (F.col("line_no") == F.col("keep.line_no"))).alias("kept"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that don't stay taken out of the texts (``n_chars`` follows). A document that loses its
    last line that isn't blank goes, as all it held stays elsewhere; documents without lines are left as they are."""
    gone = line_groups(docs).filter("not kept").groupBy(F.col("doc_id").alias("of")).agg(
        F.collect_set("line_no").alias("gone"))                             # bounded by the document's lines
    # the row goes along as one column, so its columns may have any name
    packed = docs.select("doc_id", F.struct(*docs.columns).alias("row"), "text")
    j = packed.join(gone, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("row", "text", "gone")
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("gone", i)), "\n")
    j = j.select("row", "gone", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))
    j = j.filter(F.col("gone").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    row = F.col("row")
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("gone").isNull(), row["n_chars"]).otherwise(F.char_length("text"))
    return j.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else row[c].alias(c) for c in docs.columns])
