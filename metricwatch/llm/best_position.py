"""Ranked lexical search by the Best Position Algorithm over sharded impact lists.

Documents are read once into (length, query terms with their counts). A shard is up to ``SHARD`` documents; for every
query term it has an impact list, the shard's documents with that term by descending impact, and a table of positions
for direct access (term by document, so ``CELLS`` bounds its size; documents are cut into smaller shards for more
terms). A search reads the lists in parallel. Each document that it meets is looked up in the other lists, which gives
its whole score and marks its position in each of them. A list's best position is the end of the contiguous run of
seen positions from its start, which is never before the last position read; the impacts just past the best positions
add up to the most that an unseen document can score. A search stops when that is strictly below the k-th score so
far, so documents that tie with the k-th are all seen. A task carries its k best documents of each item from shard to
shard; the best of all tasks are merged. Results are those of scoring every document.

Scores are 64-bit integers. With N documents that have a term, L terms in all, n in the document, df documents that
hold the term and tf occurrences: w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 100 - 50 + (50 * n * N) div L, and the
document's score adds w * ((1000000000 * tf) div (1000 * tf + 20 * m)) per distinct term of the item.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. Null and
empty texts have no terms; such items have no results, such documents count for nothing. Equal scores go by doc_id, null
last; rows that repeat a doc_id are documents of their own, rows that repeat an item_id items of their own. Items go in
blocks of ``ITEM_CHARS`` characters, about, whose terms every task holds. Empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut

TOP = 50
SHARD = 4096           # documents
CELLS = 1 << 24        # positions in a shard's table for direct access
STEP = 32              # positions read first; each turn reads twice as many
ITEM_CHARS = 1 << 22   # characters of items searched at once
#: Bytes of a term stay, upper case goes to lower case, all others end a term.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf) per row: number of terms, and those of the vocabulary with their counts."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            sizes, term, tf, ends = [], [], [], [0]
            for text in batch.column("text"):
                words = terms(text.as_py())
                sizes.append(len(words))
                for w, c in Counter(words).items():
                    if w in number:
                        term.append(number[w])
                        tf.append(c)
                ends.append(len(term))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))], ["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, term array<int>, tf array<long>")


class Shard:
    """The impact lists of some documents for the terms 0, 1, ..., ``count``."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, count: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], np.append(impact[order], 0)     # the last place stands for absence
        self.length = np.bincount(term, minlength=count)
        self.start = np.cumsum(self.length) - self.length
        self.place = np.full((count, docs), len(order), np.int64)
        self.place[term[order], self.doc] = np.arange(len(order))

    def best(self, wanted: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with every document that is among the ``k`` best, ties included, and scores ``least`` or
        more; ``least`` is a score that at least ``k`` documents elsewhere reach."""
        wanted = wanted[self.length[wanted] > 0]
        start, length = self.start[wanted], self.length[wanted]
        place = self.place[wanted]
        seen = np.zeros(len(self.impact), bool)
        met = np.zeros(place.shape[1], bool)
        run = np.zeros(len(wanted), np.int64)                               # seen from the start without a gap
        found, scores, depth, step = [], [], 0, STEP
        while (run < length).any():
            read = [self.doc[s + depth:s + min(depth + step, n)] for s, n in zip(start, length) if n > depth]
            new = np.unique(np.concatenate(read))
            new = new[~met[new]]
            met[new] = True
            at = place[:, new]                                              # direct access in all lists
            seen[at.ravel()] = True
            found.append(new)
            scores.append(self.impact[at].sum(axis=0))
            depth, step = depth + step, 2 * step
            for i, (s, n) in enumerate(zip(start, length)):
                if run[i] < n:
                    rest = seen[s + run[i]:s + n]
                    gap = rest.argmin()
                    run[i] += gap if not rest[gap] else len(rest)
            open_ = run < length
            bound = self.impact[start[open_] + run[open_]].sum()
            if len(met) and sum(map(len, scores)) >= k:
                every = np.concatenate(scores)
                found, scores = [np.concatenate(found)], [every]
                least = max(least, np.partition(every, len(every) - k)[len(every) - k])
            if bound < least:
                break
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, every = np.concatenate(found), np.concatenate(scores)
        good = (every > 0) & (every >= least)
        return found[good], every[good]


def _groups(items: list[np.ndarray], shard: int) -> list[tuple[list[int], np.ndarray, int]]:
    """Items that share a table of positions: (items, their terms, documents in a shard)."""
    groups, some, held = [], [], set()
    for i, t in enumerate(items):
        more = held | set(t.tolist())
        if some and len(more) * shard > CELLS:
            groups.append((some, held))
            some, more = [], set(t.tolist())
        some, held = [*some, i], more
    if some:
        groups.append((some, held))
    return [(some, np.array(sorted(held), np.int64), max(64, min(shard, CELLS // max(1, len(held))))) for some, held in groups]


def _first(doc_id: np.ndarray, none: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((doc_id, none, -score))[:k]


def _searched(postings: DataFrame, items: list[np.ndarray], weight: np.ndarray, docs: int, length: int, k: int,
              shard: int) -> DataFrame:
    """(item, doc_id, score): every task's best documents per item (a number)."""
    sc = postings.sparkSession.sparkContext
    shared = sc.broadcast((items, weight, _groups(items, shard)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, groups = shared.value
        empty = np.zeros(0, np.int64)
        top = [(empty, empty.astype(bool), empty)] * len(items)             # doc_id, whether null, score

        def search(ids: pa.Array, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
            none = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            most = 50 * int(n.max(initial=0)) * docs
            m = 50 + (50 * n * docs // length if most < 1 << 63 else np.array([50 * int(x) * docs // length for x in n]))
            row = np.repeat(np.arange(len(n)), np.diff(ends))
            impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
            for some, held, size in groups:
                number = np.full(len(weight), -1, np.int64)
                number[held] = np.arange(len(held))
                for a in range(0, len(n), size):
                    b = min(a + size, len(n))
                    p = slice(ends[a], ends[b])
                    has = number[term[p]] >= 0
                    lists = Shard(row[p][has] - a, number[term[p][has]], impact[p][has], b - a, len(held))
                    for i in some:
                        d, null, s = top[i]
                        found, score = lists.best(number[items[i]], k, int(s.min()) if len(s) == k else 0)
                        if len(found):
                            d, null = np.append(d, ids[a + found]), np.append(null, none[a + found])
                            s = np.append(s, score)
                            first = _first(d, null, s, k)
                            top[i] = d[first], null[first], s[first]

        for batch in batches:
            for a in range(0, len(batch), shard):
                part = batch.slice(a, shard)
                term, tf = part.column("term"), part.column("tf")
                ends = term.offsets.to_numpy().astype(np.int64)
                search(part.column("doc_id"), part.column("n").to_numpy(), ends - ends[0],
                       term.flatten().to_numpy().astype(np.int64), tf.flatten().to_numpy())
        size = [len(s) for _, _, s in top]
        if sum(size):
            d, null, s = (np.concatenate(x) for x in zip(*top))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(items)), size), pa.int32()),
                                              pa.array(d, pa.int64(), mask=null), pa.array(s, pa.int64())],
                                             ["item", "doc_id", "score"])

    return postings.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, shard: int = SHARD, item_chars: int = ITEM_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks, out = max(1, -(-size // item_chars)), None
    stated = cut(items.select(F.col("item_id").cast("long").alias("item_id"), "text")) if blocks > 1 else items
    for b in range(blocks):
        rows = stated.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select("item_id", "text").collect()
        vocabulary: dict[bytes, int] = {}
        numbers = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in dict.fromkeys(terms(r["text"]))], np.int64)
                   for r in rows]
        postings = cut(counted(docs, vocabulary))
        total = postings.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
        held = postings.select(F.explode("term").alias("t")).groupBy("t").count().collect()      # one row per query term
        n_docs, length = total[0], total[1] or 1
        weight = np.zeros(len(vocabulary) + 1, np.int64)
        for r in held:
            weight[r["t"]] = floor(1000 * log((2 * n_docs + 2) / (2 * r["count"] + 1)))
        found = _searched(postings, numbers, weight, n_docs, length, k, shard)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).join(
            F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = ranked if out is None else out.unionAll(ranked)
    return out
