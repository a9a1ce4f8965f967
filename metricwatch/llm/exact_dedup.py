"""Exact de-duplication by a 128-bit content hash with a byte comparison inside each hash group.

Two texts are equal when they are identical after deleting the six ASCII white-space characters. Documents are
grouped by the first 128 bits of the SHA-256 of that normalised text *and* by its bytes, in one aggregate whose
partial step runs before the shuffle: a group holding a third of all rows arrives as one row per task. Hash groups
that hold more than one byte string are collisions; only if there are any are documents matched to their group by
bytes as well, else by the hash alone. Of a group the row with the most code points stays, then the smallest
doc_id (null last).

Nulls: a null text counts as empty, and all empty texts are one group; a null doc_id stays only if the group has
no other. Repeated rows are members of one group and share its keep_id, so rows that repeat the doc_id that stays
are all marked kept. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import SPACES, cut, text_of


def exact_groups(docs: DataFrame, hash_bits: int = 128) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document.

    ``hash_bits`` (a multiple of 4) shortens the content hash; results don't depend on it.
    """
    norm = F.translate(text_of(), SPACES, "")
    rows = docs.select("doc_id", F.char_length(text_of()).alias("chars"), norm.alias("norm")).withColumn(
        "text_sha256", F.sha2("norm", 256)).withColumn("hash", F.substring("text_sha256", 1, hash_bits // 4))
    best = F.min(F.struct((-F.col("chars")).alias("fewer"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    groups = rows.groupBy("hash", "norm").agg(F.count("*").alias("group_size"), best.alias("best"))
    narrow = cut(groups.select("hash", F.sha2("norm", 256).alias("sha"), "group_size",
                               F.col("best.doc_id").alias("keep_id")))
    collided = narrow.groupBy("hash").count().filter("count > 1")
    if collided.isEmpty():
        out = rows.select("doc_id", "text_sha256", "hash").join(narrow.drop("sha"), "hash")
    else:
        full = groups.select("hash", "norm", "group_size", F.col("best.doc_id").alias("keep_id"))
        out = rows.select("doc_id", "text_sha256", "hash", "norm").join(full, ["hash", "norm"])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keep = exact_groups(docs).filter("kept").select("doc_id").distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["doc_id"]), "left_semi")
