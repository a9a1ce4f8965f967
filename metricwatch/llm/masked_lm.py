"""Masked pseudo-likelihood: a bidirectional window network scores every word of a document from both sides.

Words (lower-case, split at white space) are counted over all documents; the ``VOCABULARY`` most frequent are types
of their own, any other word falls to the type of its ending and gets its own share of that type from the counts of
all words, which stay a distributed table. A word's conditional probability is
p(class | two words on either side) * p(type | class, the same) * p(word | type): the first two factors are a two-step
softmax over all types on one window network in numpy (embeddings of the four neighbours, a hidden layer), the third comes
from the corpus counts. Classes hold as many frequent words each, by the order of their endings, and the words of one
hash of the ending without a type. The softmax over a class starts from the types' counts. A word never counted shares
one count of its type by a uniform model of its bytes and end.
A document's score is the sum of the conditional log-probabilities of all its words.

Texts are looked up once: their types and their words without a type are written to the shared folder, and learning and
scoring read those. The network is learned from every position of every document: the positions are dealt to ``SHARE``
rounds, and in each round every task goes on from the shared parameters over the round's positions of its documents;
then the parameters are averaged by positions seen (two-level, in tasks).

Null or empty text, or text of white space, has 0 words, log-probability 0 and no mean. A null doc_id stays null;
repeated rows are counted and scored each; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

VOCABULARY = 8192      # word types of their own
CLASSES = 64
ENDING = 2             # last letters that give the class
WIDTH, HIDDEN = 16, 32
SIDES = (-2, -1, 1, 2)
ROUNDS, SHARE = 2, 2   # rounds of learning; one of SHARE positions is learned from in each, another one in the next
BATCH, RATE = 2048, 0.02
EARLY, LARGER = 64, 4  # after EARLY steps batches are LARGER times as large
TEXTS = 256            # texts looked up, learned from or scored at a time
BLOCK = 8192           # parameters averaged at a time
SCORED = 32768         # positions scored at a time


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def class_of(word: str) -> int:
    return zlib.crc32(word[-ENDING:].encode("utf-8", "replace")) % CLASSES


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents; each task counts first."""
    def count(batches):
        for pdf in batches:
            seen = Counter()
            for t in pdf["text"]:
                seen.update(words_of(t))
            yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values()),
                                "cls": [class_of(w) for w in seen]}).astype({"n": "int64", "cls": "int32"})

    part = docs.select("text").mapInPandas(count, "word string, n long, cls int")
    return part.groupBy("word", "cls").agg(F.sum("n").alias("n"))


@dataclass
class Types:
    """Word -> type: 0 is the edge of a text, 1.. the classes' other words, then the frequent words."""
    ids: dict[str, int]
    cls: np.ndarray        # class of each type
    log_p: np.ndarray      # log p(type | class) by the counts
    rest: np.ndarray       # counts of each class's other words, and one for those never counted
    counts: DataFrame | None = None     # (word, n, cls) of all words

    def __getstate__(self):
        return {**self.__dict__, "counts": None}            # tasks don't get the table

    def members(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The types of each class, and every type's place among them."""
        held = [1 + np.flatnonzero(self.cls[1:] == c) for c in range(CLASSES)]
        place = np.zeros(len(self.cls), np.int64)
        for m in held:
            place[m] = np.arange(len(m))
        return held, place

    def types_of(self, words: list[str], rare: list[str] | None = None) -> np.ndarray:
        """Types of the words; those without a type of their own are added to ``rare``."""
        get, ends = self.ids.get, {}
        t = np.array([get(w, 0) for w in words], dtype=np.int32)
        at = np.flatnonzero(t == 0)
        other = [words[k] for k in at.tolist()]
        for w in other:
            if w[-ENDING:] not in ends:
                ends[w[-ENDING:]] = 1 + class_of(w)
        t[at] = [ends[w[-ENDING:]] for w in other]
        if rare is not None:
            rare += other
        return t

    def encode(self, text: str | None, rare: list[str] | None = None) -> np.ndarray:
        return self.types_of(words_of(text), rare)

    def windows(self, text: str | None, first: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Types around every ``step``-th word from ``first``, and its own."""
        t = self.encode(text)
        at = np.arange(first, len(t), step)
        return neighbours(t, at), t[at]


def learn_types(docs: DataFrame, vocabulary: int = VOCABULARY) -> Types:
    """The frequent words and every type's share of its class, from the counts of all words."""
    from .common import cut
    counts = cut(word_counts(docs))
    # the power of two that as many words as wanted reach; only those that reach it are sent
    held = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).count().orderBy(F.desc("b")).collect()
    reached, least = 0, 0
    for r in held:
        least, reached = r["b"], reached + r["count"]
        if reached >= vocabulary:
            break
    top = counts.filter(F.col("n") >= F.lit(1 << least)).orderBy(F.desc("n"), "word").limit(vocabulary).collect()
    total = {r["cls"]: r["n"] for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}   # CLASSES rows
    ending = np.concatenate([[0], np.arange(CLASSES), [r["cls"] for r in top]]).astype(np.int64)
    cls = ending.copy()
    for k, i in enumerate(sorted(range(len(top)), key=lambda i: top[i]["word"][::-1])):
        cls[1 + CLASSES + i] = k * CLASSES // len(top)
    n = np.zeros(len(cls))
    n[1 + CLASSES:] = [r["n"] for r in top]
    n[1:1 + CLASSES] = [total.get(c, 0) for c in range(CLASSES)]
    n[1:1 + CLASSES] -= np.bincount(ending[1 + CLASSES:], weights=n[1 + CLASSES:], minlength=CLASSES)
    n += 1.0                                             # every type may occur
    mass = np.bincount(cls[1:], weights=n[1:], minlength=CLASSES)
    log_p = np.log(n / mass[cls])
    log_p[0] = 0.0
    return Types({r["word"]: 1 + CLASSES + i for i, r in enumerate(top)}, cls, log_p, n[1:1 + CLASSES], counts)


class WindowNetwork:
    """Embeddings, a hidden layer, a softmax over classes and, on the same hidden layer, one over the types of a class."""
    SHAPES = lambda types: [(types, WIDTH), (len(SIDES) * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,),
                            (types, HIDDEN)]

    def __init__(self, types: Types, flat: np.ndarray | None = None):
        shapes = WindowNetwork.SHAPES(len(types.cls))
        self.cls, self.log_p, (self.members, self.place) = types.cls, types.log_p.astype(np.float32), types.members()
        if flat is None:
            rng = np.random.default_rng(5)
            self.p = [(rng.normal(size=s) * (0.1 if len(s) > 1 else 0)).astype(np.float32) for s in shapes]
            self.p[-1][:] = 0                               # at first types share their class by their counts
        else:
            ends = np.cumsum([int(np.prod(s)) for s in shapes])
            self.p = [a.reshape(s).astype(np.float32) for a, s in zip(np.split(flat, ends[:-1]), shapes)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.p])

    def _by_class(self, target: np.ndarray) -> np.ndarray:
        """An order of the rows in which those of a class follow each other."""
        return np.argsort(self.cls[target].astype(np.uint8), kind="stable")

    def _classes(self, target: np.ndarray):
        """(types of a class, first row, end) of every class that occurs, for rows in the order of ``_by_class``."""
        edges = np.searchsorted(self.cls[target], np.arange(CLASSES + 1))
        for k in np.flatnonzero(np.diff(edges)):
            yield self.members[k], edges[k], edges[k + 1]

    def _small(self) -> bool:
        """Whether exponentials neither overflow nor vanish all, without their largest taken off (|h| < 1)."""
        w2, b2, u = self.p[3:]
        return np.abs(u).sum(axis=1).max() < 60 and (np.abs(w2).sum(axis=0) + np.abs(b2)).max() < 60

    def log_prob(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log p(target type | neighbours) for rows of neighbour types: its class, then the type in it."""
        emb, w1, b1, w2, b2, u = self.p
        order = self._by_class(target)
        y = target[order]
        h = np.tanh(emb[around[order]].reshape(len(y), -1) @ w1 + b1)
        small, each = self._small(), np.arange(len(y))

        def log_softmax(z, y):
            if not small:
                z -= z.max(axis=1, keepdims=True)
            own = z[each[:len(y)], y]
            return own - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], z.dtype))

        out = np.empty(len(y), h.dtype)
        out[order] = log_softmax(h @ w2 + b2, self.cls[y])
        for m, lo, hi in self._classes(y):
            z = h[lo:hi] @ u[m].T
            z += self.log_p[m]
            out[order[lo:hi]] += log_softmax(z, self.place[y[lo:hi]])
        return out

    def gradients(self, around: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean of -log_prob, in the order of the parameters."""
        emb, w1, b1, w2, b2, u = self.p
        order = self._by_class(target)
        around, y = around[order], target[order]
        x = emb[around].reshape(len(y), -1)
        h = np.tanh(x @ w1 + b1)
        small, each = self._small(), np.arange(len(y))

        def slope(z, y):
            if not small:
                z -= z.max(axis=1, keepdims=True)
            d = np.exp(z, out=z)
            d /= (d @ np.full(d.shape[1], len(target), d.dtype))[:, None]
            d[each[:len(y)], y] -= 1 / len(target)
            return d

        d = slope(h @ w2 + b2, self.cls[y])
        dh, d_u = d @ w2.T, np.zeros_like(u)
        for m, lo, hi in self._classes(y):
            of = u[m]
            z = h[lo:hi] @ of.T
            z += self.log_p[m]
            e = slope(z, self.place[y[lo:hi]])
            dh[lo:hi] += e @ of
            d_u[m] = e.T @ h[lo:hi]
        dh *= 1 - h * h
        near = around.ravel().astype(np.uint16 if len(emb) <= 1 << 16 else np.int64)      # two bytes sort faster
        d_emb, order = np.zeros_like(emb), np.argsort(near, kind="stable")
        used, starts = np.unique(near[order], return_index=True)
        d_emb[used] = np.add.reduceat((dh @ w1.T).reshape(-1, WIDTH)[order], starts, axis=0)
        one = np.ones(len(y), h.dtype)
        return [d_emb, x.T @ dh, one @ dh, h.T @ d, one @ d, d_u]


def padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The types of texts one after the other, two edges (0) before, between and after them, and the words' places."""
    edge, sizes = np.zeros(2, np.int32), np.array([len(t) for t in texts], np.int64)
    start = np.repeat(2 * np.arange(1, len(sizes) + 1), sizes)
    return np.concatenate([edge, *[a for t in texts for a in (t, edge)]]), start + np.arange(sizes.sum())


def neighbours(types: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Types on either side of the positions ``at`` (0 beyond the edges)."""
    return padded([types])[0][at[:, None] + (np.array(SIDES) + 2)]


def encoded(docs: DataFrame, types: Types) -> DataFrame:
    """(row, doc_id, types, rare) of every whole text, written to the shared folder: its words' types as 32-bit integers
    (16 bits where that holds them all) and its words without a type of their own."""
    from .common import shared_dir
    spark, known = docs.sparkSession, docs.sparkSession.sparkContext.broadcast(types)
    form = _form(types)

    def code(batches):
        ty, row = known.value, TaskContext.get().partitionId() << 36
        for whole in batches:
            for i in range(0, len(whole), TEXTS):
                pdf = whole.iloc[i:i + TEXTS].reset_index(drop=True)
                rare = [[] for _ in range(len(pdf))]
                yield pd.DataFrame({"row": np.arange(row, row + len(pdf)), "doc_id": pdf["doc_id"].astype("Int64"),
                                    "types": [ty.encode(t, r).astype(form).tobytes() for t, r in zip(pdf["text"], rare)],
                                    "rare": rare})
                row += len(pdf)

    folder = f"{shared_dir(spark).rstrip('/')}/masked-{uuid.uuid4().hex}"
    coded = docs.select("doc_id", "text").mapInPandas(code, "row long, doc_id long, types binary, rare array<string>")
    coded.write.parquet(folder)
    known.unpersist()
    return spark.read.parquet(folder)


def _form(types: Types) -> str:
    return "<u2" if len(types.cls) <= 1 << 16 else "<i4"


def _dealt(whole: pd.DataFrame, form: str, number: int, share: int):
    """(types around, own types) of a round's positions, some texts at a time: by a word's place and its text's row."""
    for i in range(0, len(whole), TEXTS):
        pdf = whole.iloc[i:i + TEXTS]
        texts = [np.frombuffer(b, form) for b in pdf["types"]]
        pads, at = padded(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = at[(place + np.repeat(pdf["row"].to_numpy(), sizes) + number) % share == 0]
        if len(at):
            yield pads[at[:, None] + np.array(SIDES)], pads[at]


def _train_round(coded: DataFrame, types, flat, number: int) -> np.ndarray:
    """One pass of every task from the shared parameters over its texts' positions of this round, every ``SHARE``-th of
    them; the average by positions seen. Of ``SHARE`` rounds each takes other positions, together all."""
    sc = coded.sparkSession.sparkContext
    known, start = sc.broadcast(types), sc.broadcast(flat)      # fixed by VOCABULARY and WIDTH, under 3 MB
    form, share = _form(types), SHARE

    def learn(batches):
        net, rng = WindowNetwork(known.value, start.value), np.random.default_rng(number)
        m, v = [np.zeros_like(p) for p in net.p], [np.zeros_like(p) for p in net.p]
        step, seen, around, target, held = 0, 0, [], [], 0

        def update():
            nonlocal step, around, target, held
            a, y = np.concatenate(around), np.concatenate(target)
            mixed, i = rng.permutation(len(a)), 0
            while i < len(a):
                some = mixed[i:i + (BATCH if step < EARLY else BATCH * LARGER)]
                i, step = i + len(some), step + 1
                for p, g, q, r in zip(net.p, net.gradients(a[some], y[some]), m, v):
                    q += 0.1 * (g - q)
                    r += 0.01 * (g * g - r)
                    p -= RATE * (q / (1 - 0.9 ** step)) / (np.sqrt(r / (1 - 0.99 ** step)) + 1e-6)
            around, target, held = [], [], 0

        for whole in batches:
            for a, y in _dealt(whole, form, number, share):
                around.append(a)
                target.append(y)
                held += len(y)
                seen += len(y)
                if held >= 16 * BATCH * LARGER:
                    update()
        if held:
            update()
        if seen:
            w = net.flat()
            yield pd.DataFrame({"block": np.arange(0, len(w), BLOCK) // BLOCK, "task": TaskContext.get().partitionId(),
                                "weight": float(seen), "values": [w[i:i + BLOCK] for i in range(0, len(w), BLOCK)]})

    def average(pdf: pd.DataFrame) -> pd.DataFrame:
        w = pdf["weight"].to_numpy()
        mean = (np.stack(pdf["values"].to_list()) * w[:, None]).sum(axis=0) / w.sum()
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "task": [0], "weight": [w.sum()], "values": [mean.astype(np.float32)]})

    schema = "block long, task int, weight double, values array<float>"
    parts = coded.select("row", "types").mapInPandas(learn, schema)
    some = parts.groupBy("block", F.col("task") % 64).applyInPandas(lambda k, p: average(p), schema)
    rows = some.groupBy("block").applyInPandas(average, schema).orderBy("block").collect()     # the parameters, once
    known.unpersist()
    return np.concatenate([r["values"] for r in rows]).astype(np.float32) if rows else flat


def _learn(coded: DataFrame, types: Types, rounds: int) -> np.ndarray:
    flat = WindowNetwork(types).flat()
    for number in range(max(rounds, SHARE)):            # every position has its turn
        flat = _train_round(coded, types, flat, number)
    return flat


def fit(docs: DataFrame, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> tuple[Types, np.ndarray]:
    types = learn_types(docs, vocabulary)
    return types, _learn(encoded(docs, types), types, rounds)


def log_probability(net: WindowNetwork, t: np.ndarray) -> float:
    """Sum over positions of log p(type | both sides), without p(word | type)."""
    return float(_scores(net, [t])[0])


def _scores(net: WindowNetwork, texts: list[np.ndarray]) -> np.ndarray:
    """``log_probability`` of each text; many short ones share one pass."""
    pads, at = padded(texts)
    each = np.empty(len(at))
    for j in range(0, len(at), SCORED):
        a = at[j:j + SCORED]
        each[j:j + SCORED] = net.log_prob(pads[a[:, None] + np.array(SIDES)], pads[a])
    sizes = np.array([len(t) for t in texts], np.int64)
    ends, run_sum = np.cumsum(sizes), np.concatenate([[0.0], np.cumsum(each)])
    return run_sum[ends] - run_sum[ends - sizes]


def score(docs: DataFrame, types: Types, flat: np.ndarray) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) of every whole document.

    Tasks score the types; words without a type of their own are joined with the counts by word.
    """
    return _score(encoded(docs, types), types, flat)


def _score(coded: DataFrame, types: Types, flat: np.ndarray) -> DataFrame:
    sc = coded.sparkSession.sparkContext
    known, weights, form = sc.broadcast(types), sc.broadcast(flat), _form(types)

    def run(batches):
        net = WindowNetwork(known.value, weights.value)
        for whole in batches:
            for i in range(0, len(whole), TEXTS):
                pdf = whole.iloc[i:i + TEXTS].reset_index(drop=True)
                texts = [np.frombuffer(b, form) for b in pdf["types"]]
                yield pd.DataFrame({"row": pdf["row"].to_numpy(), "doc_id": pdf["doc_id"].astype("Int64"),
                                    "n_words": [len(t) for t in texts], "log_prob": _scores(net, texts)})

    rows = coded.select("row", "doc_id", "types").mapInPandas(run, "row long, doc_id long, n_words long, log_prob double")
    rare = coded.select("row", F.explode("rare").alias("word")).join(types.counts.select("word", "n"), "word", "left")
    cls = F.pmod(F.crc32(F.encode(F.substring("word", -ENDING, ENDING), "utf-8")), F.lit(CLASSES)).cast("int")   # as class_of
    log_rest = F.array(*[F.lit(log(x)) for x in types.rest])[cls]
    unseen = -(F.octet_length("word") + 1) * log(257)          # its bytes and its end, equally likely each
    share = F.coalesce(F.log("n"), unseen) - log_rest
    own = rare.groupBy("row").agg(F.sum(share).alias("own"))
    out = rows.join(own, "row", "left").select(
        "doc_id", "n_words", (F.col("log_prob") + F.coalesce("own", F.lit(0.0))).alias("log_prob"))
    return out.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


def pseudo_likelihood(docs: DataFrame, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    types = learn_types(docs, vocabulary)
    coded = encoded(docs, types)
    return _score(coded, types, _learn(coded, types, rounds))
