"""Token counts: an exact histogram of encoded lengths whose suffix sums answer every context limit.

Each task counts lengths of its documents before anything is shuffled, so one row per task and length travels.
Running sums over lengths are taken in two levels (blocks of ``BLOCK`` lengths, then inside a block), so no task
sorts the whole histogram. Null or empty text has length 0; an empty table gives an empty histogram; other
columns are ignored; repeated rows count each time.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, Row, Window, functions as F

from .bpe import default_path, encoder
from .common import cut

BLOCK = 1024


def length_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(length, docs): how many documents have each encoded length; encoded once, as the table reads it twice."""
    path = tokenizer or default_path()

    def count(batches):
        encode, seen = encoder(path), Counter()
        for pdf in batches:
            seen.update(len(encode(t)) for t in pdf["text"])
        yield pd.DataFrame({"length": list(seen.keys()), "docs": list(seen.values())}, dtype="int64")

    part = docs.select("text").mapInPandas(count, "length long, docs long")
    return cut(part.groupBy("length").agg(F.sum("docs").alias("docs")))


def context_table(hist: DataFrame) -> DataFrame:
    """Per length: documents and tokens up to it and beyond it, the share of documents up to it (quantile), and the
    tokens kept when every document is cut at that length (``truncated_total``)."""
    h = hist.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"),
                    F.floor(F.col("length") / BLOCK).cast("long").alias("block"))
    blocks = h.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
                           F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
                           F.sum("d").over(whole).alias("total_docs"), F.sum("t").over(whole).alias("total_tokens"))
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    return (h.join(blocks, "block")
            .withColumn("docs_longer", F.coalesce(F.sum("docs").over(longer), F.lit(0)) + F.col("d_after"))
            .withColumn("tokens_longer", F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("t_after"))
            .select("length", "docs", "docs_longer", "tokens_longer", "total_docs", "total_tokens",
                    (F.col("total_docs") - F.col("docs_longer")).alias("docs_up_to"),
                    ((F.col("total_docs") - F.col("docs_longer")) / F.col("total_docs")).alias("quantile"),
                    (F.col("total_tokens") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer"))
                    .alias("truncated_total")))


def totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs, docs_cut, tokens, truncated_total) for any context limits, in one pass over the histogram."""
    n, k = F.col("length"), F.col("docs")
    row = [F.struct(F.lit(x).cast("long").alias("limit"), F.coalesce(F.sum(k), F.lit(0)).alias("docs"),
                    F.coalesce(F.sum(F.when(n > x, k)), F.lit(0)).alias("docs_cut"),
                    F.coalesce(F.sum(n * k), F.lit(0)).alias("tokens"),
                    F.coalesce(F.sum(F.least(n, F.lit(x)) * k), F.lit(0)).alias("truncated_total")) for x in limits]
    return hist.agg(F.array(*row).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def quantiles(table: DataFrame, shares: list[float]) -> Row:
    """The least length that at least each share of documents doesn't exceed, from ``context_table``."""
    return table.agg(*[F.min(F.when(F.col("docs_up_to") >= F.ceil(s * F.col("total_docs")), F.col("length")))
                       .alias(f"q{s:g}") for s in shares]).first()
