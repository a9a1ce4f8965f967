"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

The incidence is cut into blocks of n-gram columns (by hash); documents meet only inside a block, and overlaps are
bounded by set sizes before any pair exists:

1. *Shared columns.* Documents send their n-grams to the columns' blocks, counted within the task first (an n-gram
   that a task holds twice travels once, so a frequent one costs one entry per task). Blocks return, per document, how
   many of its n-grams occur elsewhere. A document with partners has at least 75 % of its n-grams in common with one,
   so documents with fewer shared n-grams are out. Here n-grams travel as 32 bits within a block; a chance collision
   only lets a document through.
2. *Identical rows.* Of the others, equal sets are one representative with members.
3. *Column counts.* Representatives are grouped in chunks, blocks return the exact number of representatives per
   n-gram, and every representative keeps the shared ones among its rarest |x| - ceil(0.75 |x|) + 1: two sets that
   reach the threshold have one of these in common (rarest first, so passages that many documents share fall out).
4. *Overlaps.* In a column all are first verified against its least member only (one best-voted pivot per
   representative), which settles groups of near copies. Then every pair of different provisional components that
   meets in a column within the size bound is verified: rows outside the column's largest component meet all rows.
   So no group emits all its pairs, and no link between different components is missed.

Verification is exact on 64-bit n-gram hashes. The class of a document is the least doc_id reachable by links.

Null, empty or white-space text has an empty set and links with nothing; a text of fewer words than ``WORDS`` is one
n-gram. Rows that repeat a doc_id are one document with the union of their n-grams, and each row gets its result;
a null doc_id links with nothing and gets no class. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, likely_in, parallelism
from .components import components

WORDS = 5
PERCENT = 75
#: N-grams that a task gathers before it sends them on.
CHUNK = 250_000
#: N-grams that a column block holds, about.
BLOCK_GRAMS = 1 << 20
_TURN = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def ngram_set(text: str | None) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes (signed)."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(WORDS, len(words))
    g = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        x = (h[j:len(h) - n + 1 + j] + np.uint64(n)) * _TURN[j]
        g = (g ^ x ^ (x >> np.uint64(31))) * _TURN[4 - j]
    return np.unique((g ^ (g >> np.uint64(29))).view(np.int64))


def _least_shared(n: Column) -> Column:
    return F.ceil(n * PERCENT / 100).cast("long")


def blocks_of(docs: DataFrame) -> int:
    """Column blocks: by the size of the texts (some 7 bytes a word), 64 at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(64, parallelism(docs.sparkSession), -(-size // (7 * BLOCK_GRAMS)))


def _spread(grams: np.ndarray, owner: np.ndarray, blocks: int):
    """Column block of each n-gram, and the order by block and owner."""
    block = (grams.view(np.uint64) >> np.uint64(32)) % np.uint64(blocks)
    return block, np.lexsort((owner, block))


# ---------------------------------------------------------------- 1. documents whose n-grams occur elsewhere

_SENT = "block int, docs binary, counts binary, grams binary, common binary, tally binary"
_TALLY = "doc_id long, shared long, n long, parts long"


def _send(ids: np.ndarray, sets: list[np.ndarray], blocks: int) -> pd.DataFrame:
    """What a task's chunk of documents sends to each block."""
    sizes = np.array([len(s) for s in sets], np.int64)
    grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    run = np.diff(np.append(first, len(s)))
    alone = np.repeat(run == 1, run)
    shared = np.bincount(owner[order][~alone], minlength=len(sets))
    g1, o1, twice = s[alone], owner[order][alone], s[first[run > 1]]
    block, order = _spread(g1, o1, blocks)
    block, g1, o1 = block[order], g1[order], o1[order]
    ends = np.searchsorted(block, np.arange(blocks + 1))
    block2, order2 = _spread(twice, np.zeros(len(twice), np.int64), blocks)
    twice = twice[order2]
    ends2 = np.searchsorted(block2[order2], np.arange(blocks + 1))
    low = lambda x: (x.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    rows = []
    for b in range(blocks):
        at, till = ends[b], ends[b + 1]
        if till > at or ends2[b + 1] > ends2[b]:
            docs, counts = np.unique(o1[at:till], return_counts=True)
            rows.append((b, ids[docs].astype("<i8").tobytes(), counts.astype("<u4").tobytes(), low(g1[at:till]),
                         low(twice[ends2[b]:ends2[b + 1]]), b""))
    tally = np.stack([ids, shared, sizes]).astype("<i8").tobytes()
    rows.append((int(ids[0] % blocks), b"", b"", b"", b"", tally))
    return pd.DataFrame(rows, columns=["block", "docs", "counts", "grams", "common", "tally"])


def _tally(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one block: per document the n-grams that occur more than once; what tasks knew already goes along."""
    part = lambda name, kind: np.frombuffer(b"".join(pdf[name]), kind)
    docs = np.repeat(part("docs", "<i8"), part("counts", "<u4"))
    grams, common = part("grams", "<u4"), part("common", "<u4")
    _, where, times = np.unique(np.concatenate([grams, common, common]), return_inverse=True, return_counts=True)
    hit, shared = np.unique(docs[times[where[:len(grams)]] > 1], return_counts=True)
    out = [pd.DataFrame({"doc_id": hit, "shared": shared, "n": 0, "parts": 0})]
    for t in pdf["tally"]:
        if t:
            ids, some, n = np.frombuffer(t, "<i8").reshape(3, -1)
            out.append(pd.DataFrame({"doc_id": ids, "shared": some, "n": n, "parts": 1}))
    return pd.concat(out).astype("int64")


def shared_counts(docs: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, shared, n, parts): n-grams that occur in other documents too, all n-grams, rows."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, sets, held = [], [], 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids.append(doc_id)
                sets.append(ngram_set(text))
                held += len(sets[-1]) + 1
                if held >= CHUNK:
                    yield _send(np.array(ids, np.int64), sets, blocks)
                    ids, sets, held = [], [], 0
        if ids:
            yield _send(np.array(ids, np.int64), sets, blocks)

    sent = docs.select("doc_id", "text").mapInPandas(send, _SENT)
    return sent.groupBy("block").applyInPandas(_tally, _TALLY).groupBy("doc_id").agg(
        *[F.sum(c).alias(c) for c in ("shared", "n", "parts")])


# ---------------------------------------------------------------- 2. sets of the documents that are left

def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, grams) of the documents in ``ids``. Others are dropped by a bit map before anything is shuffled."""
    some = likely_in(docs.select("doc_id", "text"), ids, "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "grams": [ngram_set(t) for t in pdf["text"]]})

    sets = some.mapInPandas(run, "doc_id long, grams array<long>").join(ids.select("doc_id"), "doc_id", "left_semi")
    lists = sets.groupBy("doc_id").agg(F.collect_list("grams").alias("l"))     # one but for repeated doc_ids
    return lists.select("doc_id", F.when(F.size("l") == 1, F.col("l")[0]).otherwise(
        F.array_sort(F.array_distinct(F.flatten("l")))).alias("grams"))


# ---------------------------------------------------------------- 3. rarest shared n-grams

def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one block: the number of sets per n-gram, told to every chunk that asked."""
    grams = [np.frombuffer(x, "<i8") for x in pdf["grams"]]
    sizes = [len(g) for g in grams]
    _, where = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate([np.frombuffer(x, "<u4") for x in pdf["counts"]]))
    told = np.split(total[where].astype("<u4"), np.cumsum(sizes)[:-1])
    return pd.DataFrame({"chunk": pdf["chunk"], "block": pdf["block"], "counts": [t.tobytes() for t in told]})


def _columns(pdf: pd.DataFrame, blocks: int):
    """A chunk's distinct n-grams in the order of blocks, the block ends, and the chunk's sets by representative."""
    pdf = pdf.sort_values("rep")
    sets = [np.asarray(g, np.int64) for g in pdf["grams"]]
    grams, times = np.unique(np.concatenate(sets), return_counts=True)
    block, order = _spread(grams, grams, blocks)
    return pdf["rep"].to_numpy(), sets, grams[order], times[order], np.searchsorted(block[order], np.arange(blocks + 1))


def rare_columns(reps: DataFrame, blocks: int) -> DataFrame:
    """The shared n-grams among the rarest |x| - ceil(0.75 |x|) + 1 of each set that can have a partner: gram, rep,
    n (set size), rank (of the n-gram among the set's kept ones, rarest first), held (n-grams kept of the set) and own
    (n-grams that no other set has, in thousandths)."""
    names = ["gram", "rep", "n", "rank", "held", "own"]
    chunks = reps.select(F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("chunk"), "rep", "grams")

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, grams, times, ends = _columns(pdf, blocks)
        return pd.DataFrame([(int(pdf["chunk"].iloc[0]), b, grams[s:t].astype("<i8").tobytes(), times[s:t].astype("<u4").tobytes())
                             for b, (s, t) in enumerate(zip(ends[:-1], ends[1:])) if t > s],
                            columns=["chunk", "block", "grams", "counts"])

    def choose(mine: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(told):
            reps, sets, grams, _, _ = _columns(mine, blocks)
            times = np.frombuffer(b"".join(told.sort_values("block")["counts"]), "<u4").astype(np.int64)
            by_gram = np.argsort(grams)
            grams, times = grams[by_gram], times[by_gram]
            for rep, s in zip(reps, sets):
                df = times[np.searchsorted(grams, s)]
                n, alone = len(s), int((df == 1).sum())
                rest = n - -(-n * PERCENT // 100) + 1 - alone
                if rest > 0:
                    pick = np.lexsort((s, df))[alone:alone + rest]
                    out.append(pd.DataFrame({"gram": s[pick], "rep": rep, "n": n, "rank": 1 + np.arange(len(pick)),
                                             "held": len(pick), "own": 1000 * alone // n}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in names}).astype("int64")

    asked = chunks.groupBy("chunk").applyInPandas(ask, "chunk int, block int, grams binary, counts binary")
    told = asked.groupBy("block").applyInPandas(_counted, "chunk int, block int, counts binary")
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(
        choose, ", ".join(f"{c} long" for c in names))


# ---------------------------------------------------------------- 4. overlaps

def _close(a: Column, b: Column) -> Column:
    """The size bound: the smaller set has 75 % of the larger's size."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _overlap_needed(a: Column, b: Column) -> Column:
    """The least overlap of two sets of these sizes that reach the threshold."""
    return F.ceil(PERCENT * (a + b) / (100 + PERCENT))


def _kept_needed(a: Column, b: Column) -> Column:
    """The least number of common n-grams among those kept: common n-grams up to the kept one that ends first are all
    kept by both sets, and behind it a set of n has only ceil(0.75 n) - 1 more."""
    return F.greatest(F.lit(1), _overlap_needed(a, b) - F.ceil(PERCENT * F.greatest(a, b) / 100) + 1)


def verified(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    g = reps.select("rep", "grams")
    j = pairs.join(g.withColumnsRenamed({"rep": "a", "grams": "ga"}), "a").join(
        g.withColumnsRenamed({"rep": "b", "grams": "gb"}), "b")
    both = F.size(F.array_intersect("ga", "gb"))
    j = j.select("a", "b", both.alias("o"), (F.size("ga") + F.size("gb")).alias("s"))
    return j.filter(100 * F.col("o") >= PERCENT * (F.col("s") - F.col("o"))).select("a", "b")


def _pivot_pairs(cols: DataFrame) -> DataFrame:
    """One pair per representative: with the pivot that most of its columns have. A column's pivot is the member with
    the least share of n-grams of its own, so of a group of near copies the one that was changed least."""
    least = cols.groupBy("gram").agg(F.min(F.struct("own", "rep", "n")).alias("p"), F.count("*").alias("k")).filter("k > 1")
    votes = cols.join(least, "gram").filter((F.col("p.rep") != F.col("rep")) & _close(F.col("p.n"), F.col("n")))
    votes = votes.groupBy("rep", F.col("p.rep").alias("pivot")).count()
    return votes.groupBy("rep").agg(F.max(F.struct("count", -F.col("pivot"), "pivot")).alias("m")).select(
        F.col("rep").alias("a"), F.col("m.pivot").alias("b"))


def _cross_pairs(cols: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different provisional components whose kept n-grams have the overlap needed of them.

    Two sets that need k common kept n-grams have one of them among the first held - k + 1 of either, so they meet in
    a rare column; the overlap of all kept ones is counted for the pairs that met.
    """
    c = cols.join(labels, "rep", "left").select("gram", "rep", "n", "rank", "held", F.coalesce("label", "rep").alias("label"))
    per = c.groupBy("gram", "label").count().groupBy("gram").agg(
        F.count("*").alias("k"), F.max(F.struct("count", "label")).alias("top")).filter("k > 1").select(
        "gram", F.col("top.label").alias("major"))
    mixed = cut(c.join(per, "gram"))
    few = mixed.filter("label <> major").select("gram", *[F.col(x).alias(f"{x}_") for x in ("rep", "n", "rank", "held", "label")])
    need = _kept_needed(F.col("n"), F.col("n_"))
    met = few.join(mixed, "gram").filter(
        (F.col("label") != F.col("label_")) & _close(F.col("n"), F.col("n_"))
        & (F.col("rank") <= F.col("held") - need + 1) & (F.col("rank_") <= F.col("held_") - need + 1)
        & ((F.col("label") == F.col("major")) | (F.col("rep") < F.col("rep_"))))
    pairs = met.select(F.greatest("rep", "rep_").alias("a"), F.least("rep", "rep_").alias("b")).distinct()
    kept = cols.groupBy("rep").agg(F.max("n").alias("n"), F.collect_list("gram").alias("kept"))    # bounded by the set
    j = pairs.join(kept.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("kept").alias("ka")), "a").join(
        kept.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("kept").alias("kb")), "b")
    return j.filter(F.size(F.array_intersect("ka", "kb")) >= _kept_needed(F.col("na"), F.col("nb"))).select("a", "b")


def ngram_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    known = docs.filter("doc_id is not null")
    blocks = blocks_of(known)
    counts = cut(shared_counts(known, blocks))
    left = counts.filter("n > 0 and (100 * shared >= %d * n or parts > 1)" % PERCENT).select("doc_id")
    sets = cut(sets_of(known, left))
    key = [F.size("grams").alias("n"), F.xxhash64("grams").alias("h1"), F.xxhash64(F.lit("set"), "grams").alias("h2")]
    keys = sets.select("doc_id", *key)
    same = cut(keys.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep")))
    member = keys.join(same, ["n", "h1", "h2"]).select("doc_id", "n", "rep")
    reps = sets.join(same.select("rep"), sets["doc_id"] == F.col("rep"), "left_semi").select(F.col("doc_id").alias("rep"), "grams")
    cols = cut(rare_columns(reps, blocks))
    first = cut(verified(_pivot_pairs(cols), reps))
    labels = components(first).select(F.col("node").alias("rep"), F.col("component").alias("label"))
    links = first.unionAll(verified(_cross_pairs(cols, labels), reps))
    top = components(links).select(F.col("node").alias("rep"), "component")
    found = member.join(top, "rep", "left").select(F.col("doc_id").alias("id"), F.col("n").alias("exact"),
                                                   F.coalesce("component", "rep").alias("component"))
    each = counts.join(found, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.coalesce("exact", "n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        F.expr("explode(sequence(1, greatest(parts, 1)))").alias("row")).drop("row")

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"n": [len(ngram_set(t)) for t in pdf["text"]]})

    none = docs.filter("doc_id is null").select("text").mapInPandas(sizes, "n long")
    null = F.lit(None).cast("long")
    return each.unionAll(none.select(null.alias("doc_id"), F.col("n").alias("n_shingles"), null.alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's least; rows without a doc_id stay."""
    gone = ngram_components(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


