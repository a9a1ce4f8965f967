"""Repetition rules, hard negatives and ranked search against brute force, with nulls, ties, repeats and empty tables."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwatch.llm import best_position, hyperplane_tree, repetition
from metricwatch.llm.common import cut, ship

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, rank string, item string, n_words string, uid string"
VEC = "vec_id long, embedding array<float>, label int, uid string, q string, leaf string"


# --------------------------------------------------------------------------- 11

def windows(words, k):
    """Words in windows of k words that occur twice or more."""
    c = collections.Counter(tuple(words[j:j + k]) for j in range(len(words) - k + 1))
    return len({i for j in range(len(words) - k + 1) if c[tuple(words[j:j + k])] > 1 for i in range(j, j + k)})


def plain_repeats(text, least):
    """Words in repeats of 3 words and of ``least`` words, maximal repeats, the longest: by listing all substrings."""
    w = (text or "").encode().split()
    at = collections.defaultdict(list)
    for i in range(len(w)):
        for j in range(i + 1, len(w) + 1):
            at[tuple(w[i:j])].append(i)
    twice = {s: o for s, o in at.items() if len(o) > 1}
    maximal = sum(len(s) >= least and len({w[i - 1] if i else None for i in o}) > 1
                  and len({w[i + len(s)] if i + len(s) < len(w) else None for i in o}) > 1 for s, o in twice.items())
    return windows(w, 3), maximal, windows(w, least), max(map(len, twice), default=0)


def test_suffix_arrays_against_all_substrings(monkeypatch):
    monkeypatch.setattr(repetition, "MIN_REPEAT", 4)
    rng = random.Random(11)
    texts = [None, "", " \n\t", "x", "a " * 50, "a b " * 30 + "c", "a b c d " * 9 + "a b"]
    texts += [" ".join(rng.choice("ab" if k % 3 else "abcdef") for _ in range(rng.randint(1, 60))) for k in range(60)]
    for (_, t), got in zip(rows := [(i, t) for i, t in enumerate(texts)], repetition.measured(rows)):
        assert got[5:9] == plain_repeats(t, 4), t


def test_repetition_rows(spark):
    ship(spark)
    once = " ".join(f"w{k}" for k in range(200))
    passage = " ".join(f"p{k}" for k in range(130))
    texts = [None, "", "few words", once, once + "\n" + once[:70], f"{passage} {' '.join(f'm{k}' for k in range(900))} {passage}",
             "same line here\n" * 20, "# *$\n# *$\n \n \nß é " + once, "y" * 300_000 + " " + once, once, once]
    ids = [*range(9), 9, 9]
    df = spark.createDataFrame([(i, t, *"abcd") for i, t in zip(ids, texts)] + [(None, once, *"abcd")], DOC)
    got = sorted(repetition.repetition(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [*ids, None]
    for r, t in zip(got, texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "") and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == windows(words, 3) and r.covered_words == windows(words, 16)
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words))
    assert [r.kept for r in got] == [False, False, False, True, True, False, False, True, True, True, True, True]
    assert repetition.repetition(df.limit(0)).collect() == []


# --------------------------------------------------------------------------- 12

def plain_negatives(rows):
    """Rows (vec_id, vector of whole numbers, label): all scores, sorted."""
    out = []
    for a, (aid, q, label) in enumerate(rows):
        if aid % 100:
            continue
        rest = sorted((-sum(x * y for x, y in zip(q, v)), i, l) for k, (i, v, l) in enumerate(rows) if k != a and len(v) == len(q))
        for p, pid, _ in [r for r in rest if r[2] == label][:5]:
            good = [r for r in rest if r[2] != label and 80 * -p <= 100 * -r[0] <= 100 * -p][:5]
            out += [(aid, pid, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(good)]
    return sorted(out)


@pytest.mark.parametrize("leaf, cell", [(16, 7), (10_000, 64)])
def test_hard_negatives_equal_brute_force(spark, leaf, cell):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    data = [(i, (centres[i % 6] + 0.4 * rng.normal(size=8)).tolist() if i % 5 else [0.5] * 8, i % 3) for i in range(400)]
    data += [(i, rng.normal(size=3).tolist(), i % 2) for i in range(400, 440)]          # another dimension
    data += [(500, [1e7, -1e7, 1.0], 1), (501, [1e7, 1e7, 1.0], 0), (600, [0.0] * 8, 1), (700, [], 0), (701, [], 0), (702, [], 1)]
    bad = [(800, None, 1), (801, [1.0] * 8, None), (None, [1.0] * 8, 1), (900, [1.0, None] * 4, 1), (1000, [float("nan")] * 8, 1),
           (1100, [float("inf")] * 8, 1)]
    df = spark.createDataFrame([(*r, *"abc") for r in data + bad], VEC)
    bound = hyperplane_tree.LIMIT
    whole = [(i, [max(-bound, min(bound, math.floor(256 * float(np.float32(x))))) for x in v], l) for i, v, l in data]
    got = hyperplane_tree.hard_negatives(df, F.col("vec_id") % 100 == 0, leaf, cell).collect()
    assert sorted(map(tuple, got)) == plain_negatives(whole)
    assert len(got) > 50


def test_repeated_rows_and_empty_tables(spark):
    data = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [1.0, 0.0], 2), (2, [1.0, 0.0], 2)]
    df = spark.createDataFrame([(*r, *"abc") for r in data], VEC)
    got = hyperplane_tree.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.positive_id, r.rank, r.negative_id) for r in got) == [(0, 1, 2), (0, 1, 2), (0, 2, 2), (0, 2, 2)]
    assert hyperplane_tree.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_tree_leaves_out_subtrees_but_no_answer(spark):
    """Groups far apart: most leaves go, and none that holds a row in the window."""
    rng = np.random.default_rng(3)
    centres = 3 * rng.normal(size=(30, 6))
    x = centres[np.arange(3000) % 30] + 0.05 * rng.normal(size=(3000, 6))
    df = spark.createDataFrame([(i, v.tolist(), i % 2, *"abc") for i, v in enumerate(x)], VEC)
    index = hyperplane_tree.Index(cut(hyperplane_tree.quantised(df)), leaf=64)
    rows = index.rows.toPandas()
    q = np.stack(rows["q"].to_list()).astype(float)
    asked = q[::100]
    scores = hyperplane_tree.dots(asked, q)
    best = np.sort(scores, axis=1)[:, -20:-10]
    low, high = best.min(axis=1).astype(float), best.max(axis=1).astype(float)
    kept = collections.defaultdict(set)
    for leaf, at in index.trees[6].survivors(asked, low, high):
        for k in at:
            kept[k].add(leaf)
    for k in range(len(asked)):
        inside = (scores[k] >= low[k]) & (scores[k] <= high[k])
        assert set(rows["leaf"][inside]) <= kept[k]
    assert sum(map(len, kept.values())) < 0.3 * len(asked) * len(index.cells)


# --------------------------------------------------------------------------- 13

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_search(docs, items, k):
    bags = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n, total = sum(bool(c) for _, c in bags), sum(c.total() for _, c in bags)
    df = collections.Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        wanted = set(TERM.findall((text or "").translate(LOWER)))
        found = []
        for i, c in bags:
            m = 100 - 50 + (50 * c.total() * n) // total if c else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in wanted if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("shard, item_chars", [(7, 60), (4096, 1 << 22)])
def test_search_equals_scoring_all(spark, shard, item_chars):
    ship(spark)
    rng = random.Random(13)
    words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(4000)] + ["Straße", "naïve", "ÄB", "x9"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(150)]
    docs += [(i + 200, docs[3][1]) for i in range(40)]                                 # ties, with the k-th too
    docs += [(7, docs[7][1]), (None, docs[8][1]), (None, docs[3][1]), (300, None), (301, ""), (302, " -- ,.!"), (303, "w1 " * 30_000),
             (304, "W1;w2_W3\x00w4\x7fw5")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(12)]
    items += [(20, docs[3][1]), (21, None), (22, "..."), (23, "unknownterm"), (24, "w1 W1 w1"), (None, "w2 w3")]
    d = spark.createDataFrame([(*r, *"abcd") for r in docs], DOC).repartition(3)
    b = spark.createDataFrame([(*r, "x", "y") for r in items], "item_id long, text string, rank string, doc_id string")
    got = best_position.search(d, b, 10, shard, item_chars).collect()
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(plain_search(docs, items, 10), key=order)
    assert best_position.search(d.limit(0), b).collect() == [] and best_position.search(d, b.limit(0)).collect() == []


def test_search_stops_before_the_ends_of_the_lists():
    """With steep impacts the bound falls below the k-th score long before every document is seen."""
    rng = np.random.default_rng(5)
    docs, count = 4000, 4
    impact = np.round(1e6 / (1 + rng.permuted(np.tile(np.arange(docs), (count, 1)), axis=1))).astype(np.int64)
    doc, term = np.tile(np.arange(docs), count), np.repeat(np.arange(count), docs)
    shard = best_position.Shard(doc, term, impact.ravel(), docs, count)
    seen = []
    full = shard.place
    class Watched:
        shape = full.shape
        def __getitem__(self, at):
            seen.append(np.size(at[1]) if isinstance(at, tuple) else 0)
            got = full[at]
            return got if isinstance(at, tuple) else Inner(got)
    class Inner:
        def __init__(self, x):
            self.x, self.shape = x, x.shape
        def __getitem__(self, at):
            seen.append(len(at[1]))
            return self.x[at]
    shard.place = Watched()
    found, score = shard.best(np.arange(count), 10)
    every = impact.sum(axis=0)
    top = np.sort(every)[-10:]
    assert sorted(np.sort(score)[-10:]) == sorted(top) and sum(seen) < docs / 2


# --------------------------------------------------------------------------- names of columns in the pipeline's stages

def test_stages_keep_columns_of_any_name(spark):
    """Columns named as the operators name their own come through as they are."""
    from metricwatch.llm import line_dedup, mixing
    names = ["__gone", "gone", "of", "row", "size", "words", "taken", "__size", "part", "line_id", "source", "n_chars"]
    text = ["one long line that stands in two documents alike\nfirst", "one long line that stands in two documents alike\nsecond", None, ""]
    df = spark.createDataFrame([(i, t, *["x"] * 10, "s", 5) for i, t in enumerate(text)],
                               "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[:-1]) + ", n_chars long")
    kept = line_dedup.without_repeats(df)
    assert kept.columns == df.columns
    got = {r["doc_id"]: r for r in kept.collect()}
    assert got[1]["text"] == "second" and got[1]["n_chars"] == 6 and got[0]["text"] == text[0] and got[2]["text"] is None
    assert all(r[n] == "x" for r in got.values() for n in names[:-2])
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and all(r[n] == "x" for r in mixed.collect() for n in names[:-2])


def test_shingle_counts_of_repeated_lines(spark):
    """A line's number of shingles doesn't grow with the line's copies."""
    from metricwatch.llm import line_dedup
    line = "abcdefghij" * 5
    texts = spark.createDataFrame([(1, line)], "line_id long, line string")
    assert line_dedup.shaped(texts).first()["n"] == len(line) - line_dedup.SHINGLE + 1


def _passage_lines():
    """Many lines that hold one passage and as much text of their own, of which two are alike besides; no third is."""
    rng = np.random.default_rng(11)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    passage = word(120)
    texts = [passage + word(90) for _ in range(60)]
    return [*texts, texts[7][:-6] + word(6)]


def test_lines_with_a_common_passage_are_told_apart_before_verification(spark, monkeypatch):
    """A bucket of such lines doesn't ask for the verification of all its pairs, and the link in it is found."""
    from metricwatch.llm import line_dedup
    texts, asked = _passage_lines(), []
    real = line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda pairs, t: asked.append(pairs.count()) or real(pairs, t))
    monkeypatch.setattr(line_dedup, "_buckets", lambda: F.array(F.lit(1)))         # all lines meet in one bucket
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    size = {r["doc_id"]: r["group_size"] for r in line_dedup.line_groups(docs).collect()}
    assert {d for d, n in size.items() if n == 2} == {7, 60} and set(size.values()) == {1, 2}
    assert len(asked) == 2 and sum(asked) <= len(texts)


def test_own_shingles_of_a_crowd_say_nothing_of_other_buckets(spark, monkeypatch):
    """A line's text that no other line of a crowded bucket has may still stand in a line it meets elsewhere."""
    from metricwatch.llm import line_dedup
    texts = _passage_lines()[:60]
    own = texts[7][120:] * 3
    texts = [*texts, texts[7][:60] + own, own, own[:-2] + "##"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = [r["id"] for r in docs.select(F.xxhash64("text").alias("id"), "doc_id").orderBy("doc_id").collect()]
    of = F.when(F.col("line_id").isin(ids[:60]), F.array(F.lit(1))).when(F.col("line_id") == ids[60], F.array(F.lit(1), F.lit(2)))
    monkeypatch.setattr(line_dedup, "_buckets", lambda: of.otherwise(F.array(F.lit(2))))
    size = {r["doc_id"]: r["group_size"] for r in line_dedup.line_groups(docs).collect()}
    shingles = lambda s: {s[k:k + 9] for k in range(len(s) - 8)}
    alike = lambda a, b: 100 * len(shingles(a) & shingles(b)) >= 75 * len(shingles(a) | shingles(b))
    assert alike(texts[61], texts[62]) and size[61] == size[62] == 2 + alike(texts[60], texts[61])


def test_short_lines_are_one_shingle(spark):
    from metricwatch.llm import line_dedup
    rows = spark.createDataFrame([(1, "ab\r"), (2, "12345678"), (3, "123456789"), (4, "1234567890")], "line_id long, line string")
    got = {r["line_id"]: r["s"] for r in rows.select("line_id", line_dedup._shingles(F.col("line")).alias("s")).collect()}
    assert got == {1: ["ab\r"], 2: ["12345678"], 3: ["123456789"], 4: ["123456789", "234567890"]}


def test_verification_cuts_each_line_once(spark):
    """The condition on a pair of lines doesn't cut them again for every use of their shingles."""
    from metricwatch.llm import line_dedup
    texts = spark.createDataFrame([(1, "one line of text", 8), (2, "one line of texts", 9)], "line_id long, line string, size int")
    links = line_dedup.verified(spark.createDataFrame([(2, 1)], "a long, b long"), texts)
    assert links._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2
    assert [tuple(r) for r in links.collect()] == [(2, 1)]
