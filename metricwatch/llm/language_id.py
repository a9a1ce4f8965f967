"""Language identification by a bidirectional gated recurrent network over bytes.

The network (numpy) reads a text's UTF-8 bytes in windows of ``WINDOW`` bytes, forwards and backwards, labels every
position, and a document's probabilities are the mean over all its positions. It is trained by backpropagation
through time on slices of at most ``MAX_ROWS`` labelled rows (a documented bound; the rows of least hash) and applied
to every byte of every text. Only text is an input of a prediction.

Null text, or text without a letter, is ``und`` with score 0. Rows with null lang are predicted but never learned
from; a null doc_id counts as the empty string for the split. If no row can be learned from (an empty table, no
lang), every text is ``und``. Repeated rows are predicted alike; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 64          # bytes read in one go; the state starts anew in each
UNITS = 12           # hidden units per direction
MAX_ROWS = 600       # labelled rows learned from, at most, whole texts
EPOCHS, BATCH, RATE, SEED = 3, 256, 0.01, 11
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the doc_id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _squash(x: np.ndarray) -> np.ndarray:
    """Softsign x / (1 + |x|) in place: a bounded activation that costs far less than tanh; slope (1 - |y|)^2."""
    d = np.abs(x)
    d += 1
    x /= d
    return x


@dataclass
class Direction:
    """A gated recurrent unit layer: gates z (keep) and r (reset) and the candidate n share one table and matrix."""
    table: np.ndarray       # 256 x 3H, what each byte adds to the gates
    cross: np.ndarray       # H x 3H, what the state adds

    def run(self, x: np.ndarray, keep: bool = False):
        """States after each row of ``x`` (T x N bytes) as T x H x N; with ``keep`` also what backpropagation needs."""
        steps, n, k = *x.shape, self.cross.shape[0]
        table, cross = np.ascontiguousarray(self.table.T), np.ascontiguousarray(self.cross.T)
        h, states, trace = np.zeros((k, n), table.dtype), np.empty((steps, k, n), table.dtype), []
        for t in range(steps):
            a, g = table.take(x[t], axis=1), cross @ h
            gates = a[:2 * k]
            gates += g[:2 * k]
            _squash(gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:k], gates[k:]
            cand = r * g[2 * k:]
            cand += a[2 * k:]
            _squash(cand)
            if keep:
                trace.append((h, z, r, cand, g[2 * k:]))
            h = np.subtract(h, cand, out=states[t])
            h *= z
            h += cand
        return (states, trace) if keep else states

    def gradients(self, x: np.ndarray, trace: list, d_states: np.ndarray):
        """Gradients of the table and the matrix, back through time."""
        d_table, d_cross = np.zeros_like(self.table), np.zeros_like(self.cross)
        dh = np.zeros_like(d_states[0])
        for t in range(len(trace) - 1, -1, -1):
            h, z, r, cand, gn = trace[t]
            dh = dh + d_states[t]
            dn = dh * (1 - z) * (1 - np.abs(cand)) ** 2
            dz = dh * (h - cand) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dr = dn * gn * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            np.add.at(d_table, x[t], np.concatenate([dz, dr, dn]).T)
            dg = np.concatenate([dz, dr, dn * r])
            d_cross += h @ dg.T
            dh = dh * z + self.cross @ dg
        return d_table, d_cross


class ByteNetwork:
    def __init__(self, labels: list[str], units: int = UNITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        f = lambda *shape: (rng.normal(size=shape) * 0.3).astype(np.float32)
        self.labels = labels
        self.ahead, self.back = (Direction(f(256, 3 * units), f(units, 3 * units)) for _ in range(2))
        self.out, self.bias = f(2 * units, len(labels)), np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.table, self.ahead.cross, self.back.table, self.back.cross, self.out, self.bias]

    def logits(self, x: np.ndarray, keep: bool = False):
        """T x labels x N for byte windows ``x`` (N x T)."""
        x, k = np.ascontiguousarray(x.T).astype(np.intp), self.ahead.cross.shape[0]
        ahead, back = self.ahead.run(x, keep), self.back.run(x[::-1], keep)
        sa, sb = (ahead[0], back[0]) if keep else (ahead, back)
        out = np.matmul(self.out[:k].T, sa) + np.matmul(self.out[k:].T, sb[::-1]) + self.bias[:, None]
        out -= out.max(axis=1, keepdims=True)
        return (out, x, ahead, back) if keep else out

    def position_probabilities(self, x: np.ndarray) -> np.ndarray:
        """T x labels x N: the probability of each label at each position."""
        p = np.exp(self.logits(x))
        p /= p.sum(axis=1, keepdims=True)
        return p

    def loss_gradients(self, x: np.ndarray, real: np.ndarray, y: np.ndarray):
        """Mean cross-entropy over real positions, and gradients in the order of ``parameters``."""
        k, n = self.ahead.cross.shape[0], np.arange(len(y))
        logits, x, (sa, ta), (sb, tb) = self.logits(x, keep=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        w = real.T / max(real.sum(), 1)
        loss = -(np.log(p[:, y, n] + 1e-9) * w).sum()
        p[:, y, n] -= 1
        d = (p * w[:, None, :]).astype(self.out.dtype)
        d_out = np.concatenate([np.matmul(sa, d.transpose(0, 2, 1)).sum(axis=0),
                                np.matmul(sb[::-1], d.transpose(0, 2, 1)).sum(axis=0)])
        return loss, [*self.ahead.gradients(x, ta, np.matmul(self.out[:k], d)),
                      *self.back.gradients(x[::-1], tb, np.matmul(self.out[k:], d)[::-1]), d_out, d.sum(axis=(0, 2))]


def byte_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts in windows: (windows N x T, real positions N x T, first window of each text)."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    sizes = np.array([max(len(b), 1) for b in raw], dtype=np.int64)
    many = -(-sizes // WINDOW)
    first = np.concatenate([[0], np.cumsum(many)[:-1]]) if len(raw) else np.zeros(0, np.int64)
    x = np.frombuffer(b"".join(b.ljust(m * WINDOW, b"\0") for b, m in zip(raw, many)), np.uint8).reshape(-1, WINDOW)
    left = np.full(len(x), WINDOW, dtype=np.int64)
    if len(raw):
        left[first + many - 1] = sizes - (many - 1) * WINDOW
    return x, np.arange(WINDOW) < left[:, None], first


def train(texts: list[str], langs: list[str]) -> ByteNetwork | None:
    """Backpropagation through time with Adam over shuffled windows; deterministic."""
    labels = sorted(set(langs))
    if not labels:
        return None
    net = ByteNetwork(labels)
    x, real, first = byte_windows(texts)
    y = np.repeat([labels.index(v) for v in langs], np.diff(np.append(first, len(x))))
    rng, step = np.random.default_rng(SEED), 0
    m, v = ([np.zeros_like(p) for p in net.parameters()] for _ in range(2))
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows, step = order[at:at + BATCH], step + 1
            _, grads = net.loss_gradients(x[rows], real[rows], y[rows])
            for p, g, a, b in zip(net.parameters(), grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def predict(net: ByteNetwork | None, texts: list[str | None], block: int = 1024) -> tuple[list[str], list[float]]:
    """(language, score) of each whole text."""
    asked = [i for i, t in enumerate(texts) if net is not None and t and _LETTER.search(t)]
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if asked:
        x, real, first = byte_windows([texts[i] for i in asked])
        sums = np.empty((len(x), len(net.labels)))
        for at in range(0, len(x), block):
            w = real[at:at + block].T[:, None, :]
            sums[at:at + block] = (net.position_probabilities(x[at:at + block]) * w).sum(axis=0).T
        pooled = np.add.reduceat(sums, first, axis=0) / np.add.reduceat(real.sum(axis=1), first)[:, None]
        for i, p in zip(asked, pooled):
            langs[i], scores[i] = net.labels[int(p.argmax())], float(min(p.max(), 1.0))
    return langs, scores


def fit(docs: DataFrame, max_rows: int = MAX_ROWS) -> ByteNetwork | None:
    """Learn from ``max_rows`` rows, those of least hash among those that aren't held out.

    Their number gives a bound on the hash first, so that all tasks together send about twice the wanted rows."""
    spot = F.xxhash64(F.lit("language"), F.col("doc_id"))
    known = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    least = min(-(1 << 63) + (2 * max_rows << 64) // max(known.count(), 1), (1 << 63) - 1)
    rows = (known.filter((spot <= F.lit(least)) & F.col("text").isNotNull()).select(spot.alias("spot"), "text", "lang")
            .orderBy("spot", "text", "lang").limit(max_rows).collect())
    rows = [r for r in rows if _LETTER.search(r["text"])]
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``."""
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, max_rows))     # some 100 KB

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at:at + 512]
                langs, scores = predict(net.value, [t if isinstance(t, str) else None for t in part["text"]])
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "held_out": part["held_out"],
                                    "lang_pred": langs, "score": scores})

    asked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return asked.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least_score: float = 0.35, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text has a language: texts without letters or with an unsure label go. All columns
    of ``docs`` are returned as they are; the network is applied in the task that reads the row."""
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, max_rows))

    # the verdict comes back with the row itself, packed, so no join is needed
    names = docs.columns
    packed = docs.select("text", F.struct(*names).alias("row"))
    verdict = packed.mapInArrow(_with_verdict(net, least_score), "keep boolean, row " + docs.select(
        F.struct(*names).alias("row")).schema["row"].dataType.simpleString())
    return verdict.filter("keep").select("row.*")


def _with_verdict(net, least_score: float):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                langs, scores = predict(net.value, part.column(0).to_pylist())
                keep = pa.array([v != UNKNOWN and s >= least_score for v, s in zip(langs, scores)], pa.bool_())
                yield pa.RecordBatch.from_arrays([keep, part.column(1)], names=["keep", "row"])

    return run
