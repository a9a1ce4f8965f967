"""Hard-negative mining on a GNAT-style multiway hyperplane tree.

A vector's components become ``floor(256 * x)``; the score of two rows is the integer inner product of these. For an
anchor, the positives are its first rows of the same label, and for each positive the hard negatives are the first rows
of another label whose score lies between ``LOWEST`` % of the positive's score and that score. Higher scores come
first, ties by smaller id.

The tree: each node holds ``FANOUT`` split points, and a row belongs to the nearest of them, down to a leaf. The split
points are chosen from a bounded sample (``SAMPLE`` rows a dimension, about); every row is indexed, and answers do not
depend on the sample. Per node all rows below give, for each split point and each sibling subtree, the range of
distances, and per subtree the range of norms. A score window is an annulus around the anchor, as the squared distance
is the sum of both squared norms less twice the score. A subtree goes when, for some split point, its distance range
and the anchor's distance to that point leave no distance inside the annulus. Leaves that stay are compared exactly.

A search first asks the anchor's own cell (a part of its leaf), whose k-th best score narrows the window, then the
leaves that this window leaves over. Leaves are cut into cells of ``CELL`` rows, about, by a hash, so a leaf that holds
a third of all rows (copies of one vector) is many cells. A cell's rows are held in one task; queries stream past.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Components beyond
+-``LIMIT`` (in 256ths) count as that bound, so that scores are exact. Vectors of different dimension aren't compared.
Repeated rows are rows of their own, also for an anchor with the same id. A negative positive score leaves no window.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut

POSITIVES, NEGATIVES = 5, 5
LOWEST = 80            # percent of the positive's score that a negative has at least
FANOUT = 8             # split points of a node
SAMPLE = 8192          # rows per dimension, about, from which split points are chosen
LEAF = 512             # rows below a node, about, from which on it is split
CELL = 4096            # rows that are held at once
LIMIT = 1 << 20        # with it all products of up to 4,096 dimensions are exact
TRY = 3                # candidates per split point
STEP = 256             # queries compared with a cell at once
ROW = "uid long, vec_id long, label long, q array<int>"
MARGIN = 1e-6          # relative, for the rounding of distances


def quantised(vectors: DataFrame) -> DataFrame:
    """(uid, vec_id, label, q) of the rows that take part; ``uid`` is one of a kind per row."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), v).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(v, lambda x: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.floor(
        F.least(F.lit(1e15), F.greatest(F.lit(-1e15), x.cast("double") * 256)))))
        .cast("int"))
    return rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                       "label", whole.alias("q"))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as int64."""
    most = max(1, a.shape[1]) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(squares, 0))


class Tree:
    """Nodes 0, 1, ... of one dimension: ``points[node]`` are the split points, ``below[node]`` the nodes that their
    subtrees start with; nodes without split points are leaves."""

    def __init__(self, sample: np.ndarray, rows: int, leaf: int = LEAF, seed: int = 12):
        self.points: dict[int, np.ndarray] = {}
        self.below: dict[int, list[int]] = {}
        self.nodes = 1
        self.ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.norms: dict[int, tuple[float, float]] = {}
        rng, todo = np.random.default_rng(seed), [(0, np.unique(sample, axis=0).astype(np.float64))]
        each = rows / max(1, len(todo[0][1]))                   # rows that one of the sample stands for
        while todo:
            node, x = todo.pop()
            if len(x) * each <= leaf or len(x) < 2 * FANOUT:
                continue
            tried = x[rng.choice(len(x), min(len(x), TRY * FANOUT), replace=False)]
            chosen = [0]                                        # each next point is the farthest from those chosen
            far = _distances(tried, tried[:1])[:, 0]
            while len(chosen) < FANOUT:
                chosen.append(int(far.argmax()))
                far = np.minimum(far, _distances(tried, tried[chosen[-1:]])[:, 0])
            self.points[node] = tried[chosen]
            near = _distances(x, self.points[node]).argmin(axis=1)
            self.below[node] = list(range(self.nodes, self.nodes + FANOUT))
            self.nodes += FANOUT
            todo += [(below, x[near == j]) for j, below in enumerate(self.below[node])]

    def descend(self, x: np.ndarray, visit=None) -> np.ndarray:
        """The leaf of each row; ``visit(node, child number, distances to the split points, rows)`` is called on the way."""
        leaf, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if node not in self.points or not len(at):
                leaf[at] = node
                continue
            d = _distances(x[at], self.points[node])
            near = d.argmin(axis=1)
            for j, below in enumerate(self.below[node]):
                inside = near == j
                if inside.any():
                    if visit:
                        visit(node, j, d[inside], x[at[inside]])
                    todo.append((below, at[inside]))
        return leaf

    def survivors(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, numbers of the queries that may have a row with a score from low to high there)."""
        norm = (q * q).sum(axis=1)
        todo = [(0, np.flatnonzero(low <= high))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node not in self.points:
                yield node, at
                continue
            d = _distances(q[at], self.points[node])                                    # queries x split points
            near, far = self.ranges[node]                                               # split points x subtrees
            least = np.maximum(d[:, :, None] - far, near - d[:, :, None]).max(axis=1)   # queries x subtrees
            most = (d[:, :, None] + far).min(axis=1)
            for j, below in enumerate(self.below[node]):
                if below not in self.norms:
                    continue                                                            # holds no row
                small, large = self.norms[below]
                outer, inner = norm[at] + large - 2 * low[at], norm[at] + small - 2 * high[at]
                slack = MARGIN * (norm[at] + large + 1)
                meets = (np.maximum(least[:, j], 0) ** 2 <= outer + slack) & (most[:, j] ** 2 >= inner - slack)
                todo.append((below, at[meets]))


def _matrix(q: pd.Series) -> np.ndarray:
    return np.stack(q.to_list()).astype(np.float64) if len(q) else np.zeros((0, 0))


def _by_dim(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    for pdf in batches:
        for dim, part in pdf.groupby(pdf["q"].map(len)):
            yield int(dim), part


class Index:
    """The tree per dimension with its ranges, and the rows with their cells."""

    def __init__(self, rows: DataFrame, leaf: int = LEAF, cell: int = CELL):
        """``rows`` as ``quantised`` gives them, with their lineage cut."""
        counts = {r["dim"]: r["count"] for r in rows.groupBy(F.size("q").alias("dim")).count().collect()}
        share = F.create_map(*[x for d, n in counts.items() for x in (F.lit(d), F.lit(min(1.0, SAMPLE / n)))])
        spot = F.pmod(F.xxhash64("uid", F.lit("sample")), F.lit(1 << 31)) / float(1 << 31)
        sample: dict[int, list] = {d: [] for d in counts}
        if counts:
            for r in rows.filter(spot < F.element_at(share, F.size("q"))).select("q").toPandas()["q"]:
                sample[len(r)].append(r)
        self.trees = {d: Tree(np.array(x).reshape(len(x), d), counts[d], leaf) for d, x in sample.items()}
        trees = self.trees

        def assign(batches):
            for dim, part in _by_dim(batches):
                yield part.assign(dim=dim, leaf=trees[dim].descend(_matrix(part["q"])))

        placed = cut(rows.mapInPandas(assign, f"{ROW}, dim int, leaf long"))
        sizes = placed.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / cell).cast("int").alias("cells"))
        self.cells = {(r["dim"], r["leaf"]): r["cells"] for r in sizes.collect()}               # bounded by the tree's size
        self.rows = placed.join(F.broadcast(sizes), ["dim", "leaf"]).withColumn(
            "cell", F.pmod(F.xxhash64("uid", F.lit("cell")), "cells").cast("int")).drop("cells")
        self._measure()

    def _measure(self) -> None:
        """The distance and norm ranges, over all rows; a task sends one row per split point and subtree."""
        trees = self.trees

        def ranges(batches):
            found: dict[tuple, list] = {}

            def visit(dim, node, j, d, x):
                norm = (x * x).sum(axis=1)
                for i, (low, high) in enumerate([*zip(d.min(axis=0), d.max(axis=0)), (norm.min(), norm.max())]):
                    old = found.setdefault((dim, node, j, i), [low, high])
                    old[:] = min(old[0], low), max(old[1], high)

            for dim, part in _by_dim(batches):
                trees[dim].descend(_matrix(part["q"]), lambda *a, dim=dim: visit(dim, *a))
            yield pd.DataFrame([(*k, *v) for k, v in found.items()], columns=["dim", "node", "j", "i", "low", "high"])

        rows = self.rows.select("q").mapInPandas(ranges, "dim int, node long, j int, i int, low double, high double")
        got = rows.groupBy("dim", "node", "j", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
        for (dim, node), part in got.groupby(["dim", "node"]):
            tree = trees[dim]
            near, far = np.full((FANOUT, FANOUT), np.inf), np.full((FANOUT, FANOUT), -np.inf)
            j, i = part["j"].to_numpy(), part["i"].to_numpy()
            d = i < FANOUT
            near[i[d], j[d]], far[i[d], j[d]] = part["low"].to_numpy()[d], part["high"].to_numpy()[d]
            empty = near > far
            near[empty], far[empty] = 0, 0
            tree.ranges[int(node)] = near, far
            for child, low, high in zip(j[~d], part["low"].to_numpy()[~d], part["high"].to_numpy()[~d]):
                tree.norms[tree.below[int(node)][child]] = low, high

    def search(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """(uid, w, vec_id, score, rank): per query and window the first ``k`` rows of the same label (or of another).

        ``queries``: rows of the index with ``windows``, an array of (w, low, high); low and high belong to it."""
        q = queries.select("uid", "vec_id", "label", "q", "dim", "leaf", "cell", "windows")
        home = self._scan(q, k, same)
        # the k-th best of the own cell is a lower bound
        kth = home.filter(F.col("rank") == k).select("uid", "w", F.col("score").alias("least"))
        least = kth.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("least"))
        narrow = F.transform("windows", lambda x: x.withField("low", F.greatest(
            x["low"], F.coalesce(F.try_element_at("least", x["w"]), x["low"]))))
        asked = q.join(least, "uid", "left").withColumn("windows", narrow).drop("least", "leaf", "cell")
        return self._scan(self._survivors(asked), k, same)

    def _survivors(self, queries: DataFrame) -> DataFrame:
        """The queries once for each cell that their windows leave over."""
        trees, cells = self.trees, self.cells

        def run(batches):
            for dim, part in _by_dim(batches):
                part = part.reset_index(drop=True)
                x, who = _matrix(part["q"]), np.repeat(np.arange(len(part)), part["windows"].map(len))
                low, high = (np.array([float(w[c]) for ws in part["windows"] for w in ws]) for c in ("low", "high"))
                for leaf, at in trees[dim].survivors(x[who], low, high):
                    some = part.iloc[np.unique(who[at])]
                    for cell in range(cells.get((dim, leaf), 0)):
                        yield some.assign(leaf=leaf, cell=cell)

        q = queries.select("uid", "vec_id", "label", "q", "dim", "windows")
        return q.mapInPandas(run, f"{ROW}, dim int, windows array<struct<w:int,low:long,high:long>>, leaf long, cell int")

    def _scan(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """The first ``k`` rows per query and window among the cells that the queries name."""
        held = self.rows.select("uid", "vec_id", "label", "q", "dim", "leaf", "cell", F.lit(None).cast(
            "array<struct<w:int,low:long,high:long>>").alias("windows"))
        asked = queries.select(*held.columns)
        place = ["dim", "leaf", "cell"]
        both = held.unionAll(asked).repartition(*place).sortWithinPartitions(
            *place, F.col("windows").isNotNull(), "vec_id", "uid")

        def run(batches):
            key, rows, seen = None, [], None
            for pdf in batches:
                if not len(pdf):
                    continue
                ids = pdf[place].to_numpy()
                starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
                for s, t in zip(starts, np.r_[starts[1:], len(pdf)]):
                    if tuple(ids[s]) != key:
                        key, rows, seen = tuple(ids[s]), [], None
                    part = pdf.iloc[s:t]
                    asks = part["windows"].notna()
                    if not asks.all():
                        rows.append(part[~asks])
                    if asks.any() and rows:
                        if seen is None:
                            r = pd.concat(rows)
                            seen = _matrix(r["q"]), r["label"].to_numpy(), r["vec_id"].to_numpy(), r["uid"].to_numpy()
                        yield from _best(part[asks], seen, k, same)

        found = both.mapInPandas(run, "uid long, w int, vec_id long, score long")
        order = Window.partitionBy("uid", "w").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _best(asked: pd.DataFrame, held: tuple, k: int, same: bool) -> Iterator[pd.DataFrame]:
    """The first ``k`` of the held rows (ascending by id) per query and window, as rows (uid, w, vec_id, score)."""
    x, label, vec_id, uid = held
    n = len(x)
    late = np.arange(n, dtype=np.int64)
    for at in range(0, len(asked), STEP):
        part = asked.iloc[at:at + STEP]
        score = dots(_matrix(part["q"]), x)
        fits = (part["label"].to_numpy()[:, None] == label) == same
        fits &= part["uid"].to_numpy()[:, None] != uid
        windows = part["windows"].to_list()
        for j in range(max(map(len, windows), default=0)):
            has = np.array([len(w) > j for w in windows])
            w = [ws[j] for ws in windows if len(ws) > j]
            low, high = (np.array([x[c] for x in w], np.int64)[:, None] for c in ("low", "high"))
            s = score[has]
            good = fits[has] & (s >= low) & (s <= high)
            some = np.flatnonzero(good.any(axis=1))
            if not len(some):
                continue
            order = np.where(good[some], late - s[some] * n, np.iinfo(np.int64).max)       # unique among the good
            top = np.argpartition(order, min(k, n) - 1, axis=1)[:, :k] if n > k else np.tile(late, (len(some), 1))
            line = np.repeat(some, top.shape[1])
            top = top.ravel()
            keep = good[line, top]
            line, top = line[keep], top[keep]
            yield pd.DataFrame({"uid": part["uid"].to_numpy()[has][line], "w": np.array([x["w"] for x in w])[line],
                                "vec_id": vec_id[top], "score": s[line, top]})


def hard_negatives(vectors: DataFrame, anchor: Column, leaf: int = LEAF, cell: int = CELL) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``vectors`` (vec_id,
    embedding, label) that fulfil the condition ``anchor`` on vec_id."""
    index = Index(cut(quantised(vectors)), leaf, cell)
    anchors = cut(index.rows.filter(anchor))
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(-(1 << 62)).cast("long").alias("low"),
                                  F.lit(1 << 62).cast("long").alias("high")))
    positives = cut(index.search(anchors.withColumn("windows", everything), POSITIVES, same=True).select(
        "uid", F.col("rank").cast("int").alias("w"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")))
    p = F.col("positive_score")
    window = F.struct("w", F.expr(f"(positive_score * {LOWEST} + 99) div 100").alias("low"), p.alias("high"))   # rounded up
    windows = positives.filter(p >= 0).groupBy("uid").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    negatives = index.search(anchors.join(windows, "uid"), NEGATIVES, same=False).select(
        "uid", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select("uid", F.col("vec_id").alias("anchor_id"))
    out = negatives.join(positives, ["uid", "w"]).join(ids, "uid")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                      "negative_score")
