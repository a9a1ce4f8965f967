"""Packing documents into training windows by lexical retrieval.

Documents are encoded, closed with an end id, and indexed in shards: a shard is a run of documents of one task of
about ``SHARD_TOKENS`` tokens, so memory is bounded and nothing is shuffled. In a shard, parts of a document longer
than a window fill windows of their own; what is left (shorter than a window) is indexed with BM25 over its token
ids. A seed opens a window, the index scores its unused neighbours over all the seed's distinct terms, and the best of
them are put in one after the other. The last one is cut to fit; its rest opens the next window as seed. So every window is full except the
shard's last, whose tokens are cut into sequences of power-of-two lengths, which need no padding.

A document may be cut into pieces; every id lies in exactly one piece. Null or empty text is the end id alone.
Repeated rows and null doc_ids are packed like any other. An empty table gives an empty result; other columns are
ignored. A sequence_id holds the task's number and a running number in it; a lost task is packed again alike, as
the rows of a file split keep their order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import default_path, encoder

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1 << 20
K1, B = 1.2, 0.75
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class Bm25Shard:
    """Inverted index over the token ids of one shard's short parts."""

    def __init__(self, parts: list[np.ndarray]):
        self.n = len(parts)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        terms = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        key = terms * self.n + np.repeat(np.arange(self.n), sizes)
        pairs, tf = np.unique(key, return_counts=True)
        term, self.doc = pairs // max(self.n, 1), pairs % max(self.n, 1)
        self.terms, self.first, df = np.unique(term, return_index=True, return_counts=True)
        self.last = self.first + df
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / max(sizes.mean(), 1)) if self.n else sizes
        self.weight = (np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])).astype(np.float32)
        order = np.argsort(self.doc, kind="stable")
        at = np.searchsorted(self.doc[order], np.arange(self.n + 1))
        rank, shared = np.repeat(np.arange(len(self.terms)), df)[order], (np.repeat(df, df) > 1)[order]
        self.ranks = [rank[a:b][shared[a:b]] for a, b in zip(at[:-1], at[1:])]      # per document: terms others have too
        self.score = np.zeros(self.n, dtype=np.float32)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused parts that share a term with the seed, best first (ties: earlier first)."""
        runs = [slice(a, b) for a, b in zip(self.first[self.ranks[seed]], self.last[self.ranks[seed]])]
        if not runs:
            return np.zeros(0, np.int64)
        docs = np.concatenate([self.doc[r] for r in runs])
        np.add.at(self.score, docs, np.concatenate([self.weight[r] for r in runs]))
        found = np.flatnonzero((self.score > 0) & unused)
        found = found[np.argsort(-self.score[found], kind="stable")]
        self.score[docs] = 0
        return found


def _shard_pieces(docs: list[tuple], sequence: int) -> tuple[list[tuple], int]:
    """Pieces of one shard's documents [(doc_id, ids), ...] and the next free sequence number."""
    out, shorts = [], []

    def put(doc: int, start: int, length: int, seq: int, offset: int) -> None:
        doc_id, ids = docs[doc]
        out.append((doc_id, start, length, zlib.crc32(ids[start:start + length].astype("<u4").tobytes()), len(ids), seq, offset))

    for d, (_, ids) in enumerate(docs):
        full = len(ids) // WINDOW
        for k in range(full):
            put(d, k * WINDOW, WINDOW, sequence, 0)
            sequence += 1
        if len(ids) > full * WINDOW:
            shorts.append((d, full * WINDOW))
    index = Bm25Shard([docs[d][1][s:] for d, s in shorts])
    unused = np.ones(len(shorts), dtype=bool)
    window: list[tuple] = []
    free, seed, rest = WINDOW, 0, None          # rest: (part, start) of a part cut by the last window

    def fill(part: int, start: int) -> None:
        nonlocal free, rest, window, sequence
        doc, size = shorts[part][0], len(docs[shorts[part][0]][1])
        take = min(size - start, free)
        window.append((doc, start, take))
        free -= take
        if free == 0:
            offset = 0
            for d, s, n in window:
                put(d, s, n, sequence, offset)
                offset += n
            sequence, window, free = sequence + 1, [], WINDOW
            rest = (part, start + take) if start + take < size else None

    while True:
        if rest is not None:
            part, start = rest
            rest = None
        else:
            while seed < len(shorts) and not unused[seed]:
                seed += 1
            if seed == len(shorts):
                break
            part, start = seed, shorts[seed][1]
            unused[part] = False
        opened = sequence
        fill(part, start)
        if sequence != opened:
            continue
        for near in index.neighbours(part, unused):
            unused[near] = False
            fill(near, shorts[near][1])
            if sequence != opened:
                break
    left = WINDOW - free                        # the last window: sequences of power-of-two lengths
    room, offset = 0, 0
    for d, s, n in window:
        while n:
            if room == 0:
                room, offset = 1 << (left.bit_length() - 1), 0
                left -= room
                sequence += 1
            take = min(n, room)
            put(d, s, take, sequence - 1, offset)
            s, n, room, offset = s + take, n - take, room - take, offset + take
    return out, sequence


def pack(docs: DataFrame, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = tokenizer or default_path()
    names = [c.split()[0] for c in PIECES.split(", ")]

    def frame(rows):
        pdf = pd.DataFrame(rows, columns=names)
        return pdf.astype({c: "int64" for c in names[1:]}).astype({"doc_id": "Int64"})

    def run(batches):
        encode, sequence, shard, size = encoder(path), TaskContext.get().partitionId() << 36, [], 0
        end = np.array([END_ID], dtype="<u2")
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                shard.append((None if pd.isna(doc_id) else int(doc_id), np.concatenate([encode(text), end])))
                size += len(shard[-1][1])
                if size >= shard_tokens:
                    rows, sequence = _shard_pieces(shard, sequence)
                    yield frame(rows)
                    shard, size = [], 0
        if shard:
            yield frame(_shard_pieces(shard, sequence)[0])

    return docs.select("doc_id", "text").mapInPandas(run, PIECES)
