"""Mixing sources to target weights by capped water-filling.

Every source gets words in proportion to its weight; a source at its cap (a maximum of epochs over its words) is
clamped there and its excess goes to the others by weight, until none is above. Clamping in the order of
cap / weight gives that fixed point directly: with the k smallest clamped, the level is
(total - their caps) / (weights left), and the first source below its cap ends the clamping.

The mix takes whole repetitions of every document and one fractional repetition: documents of a source stand on
a line in a seeded order, and the words up to the source's remainder are taken, so one document per source at
most is cut, and the words of a source are its rounded target exactly. The line's running sums are taken in two
levels (``SLICES`` slices of the hash per source), so a source with a third of all rows is spread over many tasks.

Nulls: a null text has size 0, a null source is a source of its own, a null doc_id takes part like any other.
Repeated rows count each time. Sources of size 0 take nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, cut, word_count

#: Slices of the hash line per source, a power of 16.
SLICES_DIGITS = 3
SEED = "mix-1"


def water_fill(sizes: DataFrame, weight: Column, share: float, epochs: float) -> DataFrame:
    """``sizes``: one row per source with ``source``, ``source_size`` and what ``weight`` reads. Adds ``target``."""
    cap = F.col("source_size") * F.lit(float(epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", cap)
    s = (s.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy()))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(onward))
         .withColumn("free", F.col("level") * F.col("weight") < F.col("cap"))
         .withColumn("first_free", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"),
                                                                        F.col("source").isNull(), "source", "level")))
                     .over(Window.partitionBy())))
    return s.withColumn("target", F.when(F.col("first_free").isNull(), F.col("cap")).otherwise(
        F.least("cap", F.col("first_free.level") * F.col("weight")))).select("source", "source_size", "target")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0,
        seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row of ``docs``. ``weights`` go round the sources in
    code-point order, null last; all sources share ``share`` times all words."""
    rows = cut(docs.select("doc_id", "source", word_count().alias("size"),
                           F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("spot")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    targets = water_fill(sizes, F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1), share, epochs)
    words = F.round("target").cast("long")
    targets = targets.select("source", "source_size", "target", F.when(
        F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long").alias("whole"))
    targets = targets.withColumn("rest", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))

    rows = rows.withColumn("slice", F.substring("spot", 1, SLICES_DIGITS))
    along = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("words")).select(
        "source", "slice", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("start"))
    same = lambda a, b, *keys: [a[k].eqNullSafe(b[k]) for k in keys]
    plan = slices.alias("a").join(targets.alias("b"), slices["source"].eqNullSafe(targets["source"])).select(
        "a.source", "slice", "start", "source_size", "target", "whole", "rest")
    inside = Window.partitionBy(rows["source"], rows["slice"]).orderBy("spot", F.col("doc_id").asc_nulls_last(), "size"
                                                                      ).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = placed.join(plan, same(placed, plan, "source", "slice")).select(
        "doc_id", placed["source"], "size", "source_size", "target", "whole", "rest",
        (F.col("start") + F.col("before")).alias("at"))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("at")))
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("whole") * F.col("size") + part).cast("long").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The first n words of ``text``, joined by blanks."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, n), " ")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of the mix with all columns of ``docs``: each document as often as it is taken whole, and the one
    cut document of a source once more with the words taken. A document of size 0 is kept once. Copies keep their
    doc_id. Rows that repeat a doc_id are taken alike only if they agree in size; the first of them decides."""
    plan = mix(docs, **how).groupBy("doc_id", "size").agg(F.max("taken").alias("taken"))
    # the row goes along as one column, so its columns may have any name
    sized = docs.select("doc_id", word_count().alias("size"), "text", F.struct(*docs.columns).alias("row"))
    plan = plan.select(F.col("doc_id").alias("of"), F.col("size").alias("words"), "taken")
    j = sized.join(plan, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("size") == F.col("words"))).select(
        "row", "text", "size", "taken")
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    j = j.withColumn("part", F.explode(F.concat(F.array_repeat(F.lit(0), whole), F.when(rest > 0, F.array(rest)).otherwise(
        F.array().cast("array<int>")))))
    cut_short, row = F.col("part") > 0, F.col("row")
    j = j.withColumn("text", F.when(cut_short, first_words(F.col("text"), F.col("part"))).otherwise(F.col("text")))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut_short, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(row["n_chars"])
    return j.select(*[new.get(c, row[c]).alias(c) for c in docs.columns])
