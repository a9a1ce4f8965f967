"""Secret scan with a trigram inverted index (Cox 2012).

From every rule's regular expression a Boolean query over trigrams is derived: an OR of clauses, each an AND of
trigrams that any match must contain. The index holds postings (trigram, document) for the trigrams that the rules
ask for, over lower-cased texts. Postings are intersected by counting, per document and clause, the clause's
trigrams; documents that fulfil a clause are candidates of its rule and are verified with the expression over
their whole text. A rule without mandatory trigrams (such as a run of hex digits) scans every text.

Only DataFrame functions run. Null text counts as empty; an empty text has no spans; documents are told apart by
doc_id and text, so a null or repeated doc_id is fine and repeated rows give equal results; other columns are
ignored; an empty table gives an empty result. Very long texts are scanned whole.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from .common import text_of


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str          # read alike by Java and Python for ASCII classes
    least: int          # characters that `group` must have, else the match is dropped
    group: int = 0
    base: bool = True


#: The base kinds in their listed order.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),   # the runs of [0-9a-f]+ that have 32 characters or more
)
#: Rules beyond the base: provider tokens and private-key headers.
MORE_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 40, base=False),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 10, base=False),
)
RULES = BASE_RULES + MORE_RULES
#: At most so many strings stand for an exact part of an expression; beyond it the part ends.
MOST_STRINGS = 64


def _exact(item) -> set[str] | None:
    """The finite set of strings that a parsed item matches, or None."""
    op, arg = item
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 4:
        return {chr(c) for _, c in arg}
    if op is sre.SUBPATTERN:
        return _exact_run(arg[-1])
    if op is sre.BRANCH:
        parts = [_exact_run(b) for b in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] <= 3:
        one = _exact_run(arg[2])
        if one is not None:
            return {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)}
    return None


def _exact_run(items) -> set[str] | None:
    out = {""}
    for item in items:
        one = _exact(item)
        if one is None or len(out) * len(one) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Clauses (sets of lower-case trigrams), one of which every match fulfils; empty if nothing is mandatory."""
    runs, now = [], {""}
    for item in sre_parser.parse(regex):
        one = _exact(item)
        if one is None or len(now) * len(one) > MOST_STRINGS:
            runs.append(now)
            now = one if one is not None else {""}
        else:
            now = {a + b for a in now for b in one}
    queries = []
    for run in [*runs, now]:
        clauses = {frozenset(s.lower()[i:i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in clauses:
            queries.append([c for c in clauses if not any(d < c for d in clauses)])
    # the most selective part of the expression: the one whose weakest clause has the most trigrams
    return sorted(max(queries, key=lambda q: min(map(len, q)), default=[]), key=sorted)


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<at, till>> of the rule's matches in code points. Matches and the gaps between them alternate,
    so running lengths give the places."""
    rx = F.lit(rule.regex)
    gaps = F.transform(F.split(text, rule.regex, -1), F.char_length)
    found = F.arrays_zip(gaps.alias("gap"),
                         F.transform(F.regexp_extract_all(text, rx, F.lit(0)), F.char_length).alias("n"),
                         F.transform(F.regexp_extract_all(text, rx, F.lit(rule.group)), F.char_length).alias("g"))
    start = F.struct(F.lit(0).alias("pos"), F.expr("cast(array() as array<struct<at:int,till:int,g:int>>)").alias("out"))

    def step(acc, x):
        at = acc["pos"] + x["gap"]
        return F.struct((at + F.coalesce(x["n"], F.lit(0))).alias("pos"),
                        F.when(x["n"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                            at.alias("at"), (at + x["n"]).alias("till"), x["g"].alias("g"))))).alias("out"))

    return F.filter(F.aggregate(found, start, step, lambda acc: acc["out"]), lambda s: s["g"] >= rule.least)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (doc_id, mark, trigram) for the given trigrams over the lower-cased whole texts."""
    low = docs.select("doc_id", "mark", F.lower("text").alias("low"))
    has = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]))
    return low.select("doc_id", "mark", F.explode(has).alias("trigram"))


def candidates(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, mark, rules): the rules with a trigram query whose query the document fulfils."""
    clauses = [(r.kind, i, t, len(c)) for r in rules for i, c in enumerate(trigram_query(r.regex)) for t in sorted(c)]
    asked = docs.sparkSession.createDataFrame(clauses, "kind string, clause int, trigram string, need long")
    found = postings(docs, sorted({c[2] for c in clauses})).join(F.broadcast(asked), "trigram")  # size fixed by the rules
    met = found.groupBy("doc_id", "mark", "kind", "clause").agg(
        F.countDistinct("trigram").alias("n"), F.first("need").alias("need")).filter("n = need")
    return met.groupBy("doc_id", "mark").agg(F.collect_set("kind").alias("kinds"))


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, found) per document: ``found`` holds structs (at, rank, till, kind), sorted by place, then kind."""
    src = docs.select("doc_id", text_of().alias("text")).withColumn("mark", F.xxhash64("text"))
    cand = candidates(src, rules).select(F.col("doc_id").alias("id_c"), F.col("mark").alias("mark_c"), "kinds")
    j = src.join(cand, F.col("doc_id").eqNullSafe(F.col("id_c")) & (F.col("mark") == F.col("mark_c")), "left")
    none = F.expr("cast(array() as array<struct<at:int,rank:int,till:int,kind:string>>)")

    def tagged(rank, r):
        return F.transform(_spans(F.col("text"), r), lambda s: F.struct(
            s["at"].alias("at"), F.lit(rank).alias("rank"), s["till"].alias("till"), F.lit(r.kind).alias("kind")))

    every = []
    for rank, r in enumerate(rules):
        hit = tagged(rank, r)
        verify = F.array_contains("kinds", r.kind) if trigram_query(r.regex) else F.lit(True)
        every.append(F.when(verify & F.col("text").rlike(r.regex), hit).otherwise(none))
    return j.select("doc_id", F.array_sort(F.concat(*every)).alias("found"))


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    base = [r.kind for r in rules if r.base]
    line = lambda arr: F.array_join(F.transform(arr, lambda s: F.concat_ws(
        ":", s["kind"], s["at"].cast("string"), s["till"].cast("string"))), ",")
    ours = F.filter("found", lambda s: s["kind"].isin(base))
    many = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[many(k).alias(f"n_{k}") for k in base],
        F.sha2(line(ours), 256).alias("base_sha256"), line(F.col("found")).alias("spans"))
