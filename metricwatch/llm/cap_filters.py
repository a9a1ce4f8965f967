"""Near-duplicate vectors by spherical-cap filters (locality-sensitive filtering with random product codes).

Filter directions are all concatenations of a code word for the first half of the dimensions with one for the second;
a vector passes every direction whose inner product with it reaches ``alpha``. These are found by list decoding: per
half only code words that can still reach the sum are combined. Vectors meet in the filters that both pass and are
verified by their cosine in double precision. The number of directions and ``alpha`` follow per dimension from the
number of vectors: ``alpha`` is set by the exact tail of the inner product, so that a filter holds a few unrelated
vectors at any size, and the directions are made more until ``RECALL`` of seeded random pairs at the threshold share
one. Where that takes more than ``MOST`` directions a vector, filters are made wider instead.

Large groups need no pairs: identical vectors are one representative with a count; vectors within half the threshold's
angle of their filter's mean direction (a ball) are all linked with each other by the triangle inequality, so only
the ball's size counts. In a filter of more than ``BLOCK`` vectors, those of its most frequent ball are not compared
with each other; the others are compared with all of the filter, in blocks of ``BLOCK`` x ``BLOCK``.

Verification has two steps, so that filters carry little: first all vectors of a block are compared by sketches of one
byte a component, whose error is bounded, which tells the vectors that may have a link in the block; then these alone
are joined with their whole vectors and compared exactly. A pair that meets in several filters counts in the least of
them. Blocks return per vector its number of links and one neighbour of a spanning forest, never the pairs.

Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; nor do rows with a
null id. Vectors of different dimension aren't compared. Repeated rows are vectors of their own. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, cos, pi, sqrt

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, release
from .components import components

THRESHOLD = 0.95
RECALL, PAIRS = 0.98, 1000    # of so many random pairs at the threshold, the share that meets in a filter
FILTERS, MOST = 40, 160       # directions that a vector passes, about: at first, and at most
CROWD = 8              # unrelated vectors in a filter, about
BLOCK = 1024           # vectors on either side of a block of comparisons
FEW = 64               # vectors of a block that are compared row by row instead of as a product
SPLIT_ROWS = 100_000   # split filters that are broadcast at most; more are joined by a shuffle
BALL = 32              # vectors that share a best filter before a ball is tried
MARGIN = 1e-9          # kept from the half angle, for rounding


def _component(dim: int, cells: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Values (ascending) and weights of one component of a random unit vector."""
    if dim < 2:
        return (np.array([-1.0, 1.0]), np.array([0.5, 0.5])) if dim else (np.zeros(1), np.ones(1))
    angle = (np.arange(cells, 0, -1) - 0.5) * pi / cells
    weight = np.sin(angle) ** (dim - 2)
    return np.cos(angle), weight / weight.sum()


def _reach(dim: int, share: float) -> float:
    """The sum of inner products of both halves that a random unit vector reaches with a probability of ``share``."""
    half, other = dim // 2, dim - dim // 2
    (u, wu), (z, wz) = _component(half), _component(other)
    above = np.append(np.cumsum(wz[::-1])[::-1], 0.0)
    edges = np.concatenate([[-1.0], (z[1:] + z[:-1]) / 2, [1.0]])
    angle = (np.arange(256) + 0.5) * pi / 512 if half else np.zeros(1)
    log_w = (half - 1) * np.log(np.sin(angle)) + (other - 1) * np.log(np.cos(angle)) if half else angle
    w = np.exp(log_w - log_w.max())
    a, b = np.sin(angle)[:, None], np.cos(angle)[:, None]       # lengths of the halves
    least, most = -sqrt(2), sqrt(2)
    for _ in range(50):
        mid = (least + most) / 2
        if w @ (np.interp((mid - a * u) / b, edges, above) @ wu) > share * w.sum():
            least = mid
        else:
            most = mid
    return least


@lru_cache(maxsize=256)
def code_size(dim: int, vectors: int, threshold: float = THRESHOLD) -> tuple[int, float]:
    """Code words per half and ``alpha`` with which ``RECALL`` holds among ``vectors`` vectors."""
    rng = np.random.default_rng(dim + 1)
    x, y = rng.normal(size=(2, PAIRS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = threshold * x + sqrt(max(1 - threshold ** 2, 0)) * y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    u, w = _component(dim)
    share = max(CROWD / max(vectors, 1), w[u >= threshold].sum())       # no less than the links' own share
    while dim > 1 and share < 0.5:
        reach, filters = _reach(dim, share), FILTERS
        while filters <= MOST:
            size = max(8, ceil(sqrt(filters / share))), reach
            code = ProductCode(dim, vectors, threshold, size)
            met = sum(len(np.intersect1d(p, q)) > 0 for k in range(0, PAIRS, code.rows)
                      for p, q in zip(code.decode(x[k:k + code.rows])[0], code.decode(y[k:k + code.rows])[0]))
            if met >= RECALL * PAIRS:
                return size
            filters *= 1.2
        share *= 4
    return 1, -2.0                              # one direction, which all pass


class ProductCode:
    """Directions (c1[i], c2[j]) / sqrt(2) for a dimension; deterministic for a ``size``, which is worked out once for
    all tasks."""

    def __init__(self, dim: int, vectors: int, threshold: float = THRESHOLD, size: tuple[int, float] | None = None):
        self.words, self.reach = size or code_size(dim, vectors, threshold)
        self.half = dim // 2
        self.rows = max(8, min(1024, (1 << 22) // self.words))      # decoded at a time
        rng = np.random.default_rng(dim)
        self.codes = []
        for n in (self.half, dim - self.half):
            c = rng.normal(size=(self.words, n))
            self.codes.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12))

    def decode(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Per row of unit vectors all directions passed (ascending; the best if none), and the best."""
        s1, s2 = x[:, :self.half] @ self.codes[0].T, x[:, self.half:] @ self.codes[1].T
        m1, m2 = s1.max(axis=1), s2.max(axis=1)
        best = s1.argmax(axis=1) * self.words + s2.argmax(axis=1)
        passed = []
        for k in range(len(x)):
            a, b = np.flatnonzero(s1[k] >= self.reach - m2[k]), np.flatnonzero(s2[k] >= self.reach - m1[k])
            i, j = np.nonzero(s1[k][a][:, None] + s2[k][b][None, :] >= self.reach)
            passed.append(a[i] * self.words + b[j] if len(i) else best[k:k + 1])
        return passed, best


def usable(v: Column) -> Column:
    """Vectors that can link: components neither null nor non-finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack(rows.to_list()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _sketch(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as one byte a component, the scale of each, and the length of what that leaves out."""
    scale = np.abs(x).max(axis=1) / 127
    sketch = np.rint(x / scale[:, None]).astype(np.int8)
    return sketch, scale, np.linalg.norm(x - sketch * scale[:, None], axis=1)


def _decoded(reps: DataFrame, threshold: float) -> DataFrame:
    """Adds the unit vector, its sketch, its filters (ascending) and its best filter; filter ids carry the dimension."""
    held = reps.groupBy(F.size("v").alias("dim")).count().filter("count > 1").collect()     # one row per dimension
    sizes = {r["dim"]: code_size(r["dim"], r["count"], threshold) for r in held}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[int, ProductCode] = {}
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["v"].map(len)):
                if dim not in codes:
                    codes[dim] = ProductCode(dim, len(part), threshold, sizes.get(dim, (1, -2.0)))
                code = codes[dim]
                for at in range(0, len(part), code.rows):
                    p = part.iloc[at:at + code.rows]
                    x = _unit(p["v"])
                    passed, best = code.decode(x)
                    sketch, scale, err = _sketch(x)
                    yield pd.DataFrame({"rep": p["rep"], "copies": p["copies"], "v": p["v"], "unit": list(x),
                                        "sketch": [q.tobytes() for q in sketch], "scale": scale, "err": err,
                                        "filters": [(dim << 40) + f for f in passed], "home": (dim << 40) + best})

    kind = reps.schema["v"].dataType.simpleString()
    return reps.mapInPandas(run, f"rep long, copies long, v {kind}, unit array<double>, sketch binary, scale double, "
                                 "err double, filters array<long>, home long")


def _centres(vecs: DataFrame) -> DataFrame:
    """(home, centre): the mean direction of the vectors that share a best filter, where there are BALL or more."""
    schema = "home long, salt int, n long, total array<double>"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = TaskContext.get().partitionId() % 64
        for pdf in batches:
            for home, part in pdf.groupby("home"):
                yield pd.DataFrame({"home": [home], "salt": [salt], "n": [len(part)],
                                    "total": [np.stack(part["unit"].to_list()).sum(axis=0)]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"home": pdf["home"].iloc[:1], "salt": [0], "n": [pdf["n"].sum()],
                             "total": [np.stack(pdf["total"].to_list()).sum(axis=0)]})

    crowded = vecs.groupBy("home").count().filter(F.col("count") >= BALL).select("home")
    parts = vecs.join(crowded, "home").select("home", "unit").mapInPandas(partial, schema)
    return parts.groupBy("home", "salt").applyInPandas(add, schema).groupBy("home").applyInPandas(add, schema).select(
        "home", F.col("total").alias("centre"))


def _with_balls(vecs: DataFrame, threshold: float) -> DataFrame:
    """Adds ``ball``: the best filter's id for vectors within half the threshold's angle of its mean direction."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    near = dot(F.col("unit"), F.col("centre")) / F.sqrt(dot(F.col("centre"), F.col("centre")))
    least = cos(acos(threshold) / 2) + MARGIN
    return vecs.join(_centres(vecs), "home", "left").withColumn("ball", F.when(near >= least, F.col("home"))).drop(
        "centre", "home", "unit")


def _block_links(col: dict[str, np.ndarray], s: int, t: int, threshold: float) -> tuple[np.ndarray, ...] | None:
    """Links of the block of rows s to t: per vector the weight of its linked vectors, and the root of its tree."""
    left, right = s + np.flatnonzero(col["left"][s:t]), s + np.flatnonzero(col["right"][s:t])
    if not len(left) or not len(right):
        return None
    unit, rep, copies, ball, minor = (col[k] for k in ("unit", "rep", "copies", "ball", "minor"))
    link = (unit[left] @ unit[right].T) >= threshold
    link &= rep[left][:, None] != rep[right][None, :]
    link &= (ball[left][:, None] != ball[right][None, :]) | (ball[left][:, None] < 0)
    if not link.any():
        return None
    keep_a, keep_b = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    left, right, link = left[keep_a], right[keep_b], link[np.ix_(keep_a, keep_b)]
    # the trees are of all links; the counts leave those to another filter that meet there already
    la, lb = rep[left].copy(), rep[right].copy()
    while True:
        na = np.minimum(la, np.where(link, lb[None, :], np.iinfo(np.int64).max).min(axis=1))
        nb = np.minimum(lb, np.where(link, na[:, None], np.iinfo(np.int64).max).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    fa, fb = [[col["earlier"][i] for i in side] for side in (left, right)]
    shared = np.intersect1d(np.concatenate(fa), np.concatenate(fb))
    if len(shared):
        def table(rows):
            m = np.zeros((len(rows), len(shared)), np.float32)
            for i, x in enumerate(rows):
                m[i, np.searchsorted(shared, x[np.isin(x, shared)])] = 1
            return m
        counted = link & ((table(fa) @ table(fb).T) == 0)
    else:
        counted = link
    links_a, links_b = counted @ copies[right], np.where(minor[right], 0, copies[left] @ counted)
    return np.concatenate([rep[left], rep[right]]), np.concatenate([links_a, links_b]), np.concatenate([la, lb])


def _near_sketches(pdf: pd.DataFrame, starts: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each row may have a link in its block; rows of a block lie together, from ``starts``."""
    n, found = len(pdf), np.zeros(len(pdf), bool)
    size = np.diff(np.r_[starts, n])
    after = np.repeat(starts + size, size) - np.arange(n) - 1       # rows that follow in the block
    few = np.repeat(size <= FEW, size)
    left, right, rep = pdf["left"].to_numpy(), pdf["right"].to_numpy(), pdf["rep"].to_numpy()
    ball, err, dims = pdf["ball"].fillna(-1).to_numpy(dtype=np.int64), pdf["err"].to_numpy(), pdf["sketch"].map(len).to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)                          # one run: blocks are of one dimension, and sorted
        base, slack = rows[0], 1e-5 + dim * 1e-7                    # slack: rounding in single precision
        x = np.frombuffer(b"".join(pdf["sketch"].iloc[rows]), np.int8).reshape(len(rows), dim).astype(np.float32)
        x *= pdf["scale"].to_numpy(np.float32)[rows][:, None]
        near = lambda dot, i, j: dot + err[i] + err[j] + err[i] * err[j] + slack >= threshold
        apart = lambda i, j: (rep[i] != rep[j]) & ((ball[i] != ball[j]) | (ball[i] < 0))
        i, step = rows[few[rows]], 1
        while len(i := i[after[i] >= step]):
            j = i + step
            hit = near(np.einsum("ij,ij->i", x[i - base], x[j - base]), i, j) & apart(i, j)
            hit &= (left[i] & right[j]) | (left[j] & right[i])
            found[i[hit]] = found[j[hit]] = True
            step += 1
        for s, k in zip(starts, size):
            if k > FEW and dims[s] == dim:
                i, j = s + np.flatnonzero(left[s:s + k]), s + np.flatnonzero(right[s:s + k])
                hit = near(x[i - base] @ x[j - base].T, i[:, None], j[None, :]) & apart(i[:, None], j[None, :])
                found[i[hit.any(axis=1)]] = found[j[hit.any(axis=0)]] = True
    return found


def _by_block(rows: DataFrame, make, schema: str) -> DataFrame:
    """Applies ``make(rows, starts)`` to rows dealt by block, whole blocks at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            key = pdf[["f", "a", "b"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            rest = pdf.iloc[starts[-1]:]
            if len(starts) > 1:
                yield from make(pdf.iloc[:starts[-1]], starts[:-1])
        if rest is not None:
            yield from make(rest, np.zeros(1, np.int64))

    return rows.repartition("f", "a", "b").sortWithinPartitions("f", "a", "b").mapInPandas(run, schema)


def _blocks(vecs: DataFrame) -> DataFrame:
    """(f, a, b, at, left, right, minor, rep, ball, sketch, scale, err): the blocks of every filter and their vectors.

    A filter of at most BLOCK vectors is one block. Of a larger one, vectors out of its most frequent ball (``minor``)
    are compared with all, ``left`` with ``right``; it has no blocks if that ball holds all of it."""
    held = vecs.select("ball", F.explode("filters").alias("f")).groupBy("f", "ball").count()
    stats = held.groupBy("f").agg(F.sum("count").alias("n"),
                                  F.max(F.when(F.col("ball").isNotNull(), F.struct("count", "ball"))).alias("top"))
    major = F.coalesce("top.count", F.lit(0))
    large = cut(stats.filter(F.col("n") > BLOCK).select(
        "f", F.col("top.ball").alias("major_ball"), F.ceil(F.col("n") / BLOCK).cast("int").alias("cols"),
        F.ceil((F.col("n") - major) / BLOCK).cast("int").alias("rows")))
    spot = F.xxhash64("rep", F.lit("block"))
    e = vecs.select("rep", "ball", "sketch", "scale", "err", F.posexplode("filters").alias("at", "f"))
    e = e.join(F.broadcast(large) if large.count() <= SPLIT_ROWS else large, "f", "left")
    split = F.col("cols").isNotNull()
    e = e.filter(~split | (F.col("rows") > 0)).withColumn(
        "minor", ~split | ~F.coalesce(F.col("ball") == F.col("major_ball"), F.lit(False))).withColumn(
        "row", F.when(split, F.pmod(spot, "rows")).otherwise(0).cast("int")).withColumn(
        "col", F.when(split, F.pmod(spot, "cols")).otherwise(0).cast("int"))
    as_row = F.transform(F.sequence(F.lit(0), F.col("cols") - 1), lambda j: F.struct(F.col("row").alias("a"), j.alias("b")))
    as_col = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: F.struct(i.alias("a"), F.col("col").alias("b")))
    one = F.array(F.struct(F.col("row").alias("a"), F.col("col").alias("b")))
    e = e.withColumn("cell", F.explode(F.when(~split, one).when(F.col("minor"), F.array_union(as_row, as_col)).otherwise(as_col)))
    return e.select("f", F.col("cell.a").alias("a"), F.col("cell.b").alias("b"), "at",
                    (F.col("minor") & (F.col("row") == F.col("cell.a"))).alias("left"),
                    (F.col("col") == F.col("cell.b")).alias("right"), "minor", "rep", "ball", "sketch", "scale", "err")


def _filter_links(vecs: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, root) rows from the filters in which vectors of different balls, or of none, meet."""
    names = ["f", "a", "b", "at", "left", "right", "minor", "rep", "ball"]

    def screen(pdf: pd.DataFrame, starts: np.ndarray) -> Iterator[pd.DataFrame]:
        yield pdf.loc[_near_sketches(pdf, starts, threshold), names]

    def verify(pdf: pd.DataFrame, starts: np.ndarray) -> Iterator[pd.DataFrame]:
        col = {k: pdf[k].to_numpy() for k in ("left", "right", "minor", "rep", "copies", "earlier")}
        col["ball"] = pdf["ball"].fillna(-1).to_numpy(dtype=np.int64)
        dims = pdf["v"].map(len).to_numpy()
        edge = np.r_[0, np.flatnonzero(np.diff(dims)) + 1, len(pdf)]            # blocks of one dimension lie together
        for lo, hi in zip(edge[:-1], edge[1:]):
            col["unit"] = np.zeros((len(pdf), dims[lo]))
            col["unit"][lo:hi] = _unit(pdf["v"].iloc[lo:hi])
            ends = np.r_[starts[1:], len(pdf)]
            here = (starts >= lo) & (starts < hi)
            found = [_block_links(col, s, t, threshold) for s, t in zip(starts[here], ends[here])]
            if found := [x for x in found if x is not None]:
                yield pd.DataFrame({k: np.concatenate(x) for k, x in zip(("rep", "links", "root"), zip(*found))})

    near = cut(_by_block(_blocks(vecs), screen, "f long, a int, b int, at int, left boolean, right boolean, minor boolean, "
                                                "rep long, ball long"))
    release(vecs.sparkSession)
    whole = near.join(vecs.select("rep", "copies", "v", "filters"), "rep").select(
        *names, "copies", "v", F.slice("filters", F.lit(1), F.col("at")).alias("earlier"))
    return _by_block(whole, verify, "rep long, links long, root long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select("vec_id", F.when(usable(F.col("embedding")) & F.col("vec_id").isNotNull(),
                                           F.col("embedding")).alias("v"))
    reps = cut(rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    vecs = cut(_with_balls(cut(_decoded(reps, threshold)), threshold))
    found = cut(_filter_links(vecs, threshold))
    balls = vecs.filter("ball is not null").groupBy("ball").agg(F.sum("copies").alias("held"), F.min("rep").alias("least"))
    inside = vecs.select("rep", "copies", "ball").join(balls, "ball", "left")
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionAll(
        inside.filter("least is not null").select(F.col("rep").alias("a"), F.col("least").alias("b")))
    top = components(edges).select(F.col("node").alias("rep"), "component")
    links = inside.select("rep", (F.coalesce("held", "copies") - 1).alias("links")).unionAll(found.select("rep", "links"))
    known = links.groupBy("rep").agg(F.sum("links").alias("n_links")).join(top, "rep", "left")
    # v is compared as a whole: identical vectors get their representative's answer
    known = reps.select("rep", "v").join(known, "rep").select(F.col("v").alias("w"), "rep", "n_links", "component")
    out = rows.join(known, F.col("v") == F.col("w"), "left")
    comp = F.coalesce("component", "rep", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp, F.lit(False)).alias("kept"))
