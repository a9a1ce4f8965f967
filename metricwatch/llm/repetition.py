"""Quality rules by suffix-array repetition.

The words of a text are sorted as suffixes (prefix doubling: only suffixes that still tie are sorted again), the
longest common prefix of neighbours gives the LCP intervals, and every interval whose suffixes are preceded by
different words is a maximal repeated substring: it can be extended neither to the right nor to the left. The spans of
all their occurrences are united; a text is kept when they cover at most ``MAX_COVERED`` % of its words and the longest
is at most ``MAX_LONGEST`` words long. Repeats count from ``MIN_REPEAT`` words on (the base figure ``n_repeat_words``
counts from ``WINDOW`` words on, from the same arrays).

A suffix's longest repeat starting there is the larger of its two neighbouring LCP values. Either it is an occurrence
of a maximal repeat, or the word before extends every copy of it, and the suffix one word earlier has a span that
holds it; so the union of these spans is the union of all occurrences of all maximal repeats, without listing the
quadratic number of them that a periodic text has.

Many short texts share one array: word numbers are distinct between texts, so no common prefix crosses from one text
to another, and a batch costs a few sorts. A long text is an array of its own, however long.

Words are maximal runs of characters other than ``[\\x20\\x09-\\x0D]``. Null and empty texts have no words, figures of 0
and fail the base rule (under 50 words). Rows that repeat a doc_id or have none are rows of their own. An empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

WINDOW = 3             # words in the windows of n_repeat_words (fixed by the contract)
MIN_WORDS = 50         # a text of fewer words fails the base rule
BASE_PERCENT = 50      # more words than this share in repeated windows fail it too
MIN_REPEAT = 16        # words from which a maximal repeat counts for the verdict
MAX_COVERED = 30       # percent of the words that maximal repeats may cover
MAX_LONGEST = 127      # words that the longest may have
SYMBOLS = "#*$%&|<>"   # fixed by the contract
ARRAY_WORDS = 1 << 18  # words after which a suffix array is built; results don't depend on it

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_maximal long, covered_words long, longest_repeat long, base_failed boolean, kept boolean")


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes of ``words`` (numbers from 0) in order, and the ranks by the first 1, 2, 4, ... words.

    A shorter suffix comes before a longer one that starts with it."""
    n = len(words)
    rank = words.astype(np.int64)
    levels = [rank]
    order, width = np.argsort(rank, kind="stable"), 1
    while True:
        ahead = np.zeros(n, np.int64)
        if width < n:
            ahead[:n - width] = levels[-1][width:] + 1
        # a tie is a run of equal ranks; suffixes outside ties have their final place
        r = levels[-1][order]
        same = r[1:] == r[:-1]
        tied = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
        if not len(tied):
            return order, levels
        at = order[tied]
        by = np.lexsort((ahead[at], levels[-1][at]))
        order[tied] = at = at[by]
        # ranks are places of a run's first suffix, so those outside ties stay as they are
        r, s = levels[-1][at], ahead[at]
        head = np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1])]
        if len(levels) == 1:                                # word numbers become places
            first = np.r_[True, ~same]
            rank = np.empty(n, np.int64)
            rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
            levels[0] = rank
        new = levels[-1].copy()
        new[at] = tied[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        levels.append(new)
        width *= 2


def neighbour_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix in ``order`` shares with the one before it (0 for the first)."""
    n = len(order)
    shared = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        equal = np.zeros(n - 1, bool)
        equal[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = equal.astype(np.int64) << k
        shared[1:] += step
        a += step
        b += step
    return shared


def _next_smaller(x: np.ndarray) -> np.ndarray:
    """Per place the next one with a smaller value (len(x) if none), by jumping along the links found so far."""
    n = len(x)
    link = np.arange(1, n + 1)
    padded = np.r_[x, -1]
    active = np.arange(n)
    while len(active):
        active = active[padded[link[active]] >= x[active]]
        link[active] = link[link[active]]
    return link


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, before: np.ndarray, least: int) -> np.ndarray:
    """Rows (first place, last place, words) of the LCP intervals of ``least`` words or more whose suffixes are preceded
    by different words; ``before`` holds, per suffix in order, the word before it (a value of its own at a text's start)."""
    at = np.flatnonzero(lcp >= least)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # runs of neighbours that share ``least`` words are apart from each other: a 0 between them ends every interval
    gap = np.r_[False, at[1:] != at[:-1] + 1]
    spot = np.arange(len(at)) + np.cumsum(gap)
    x = np.zeros(spot[-1] + 1, np.int64)
    x[spot] = lcp[at]
    place = np.zeros(len(x), np.int64)
    place[spot] = at
    right = _next_smaller(x)[spot] - 1                              # last place in x of the interval
    left = len(x) - _next_smaller(x[::-1])[len(x) - 1 - spot]       # first one
    found = np.unique(np.c_[place[left] - 1, place[right], x[spot]], axis=0)
    changes = np.r_[0, np.cumsum(before[1:] != before[:-1])]
    return found[changes[found[:, 1]] > changes[found[:, 0]]]


def _measure(texts: list[list[int]]) -> list[tuple[int, int, int, int]]:
    """Per text (words numbered apart from other texts): words in repeated windows, maximal repeats, words that they
    cover, and words of the longest."""
    sizes = np.array([len(t) for t in texts])
    words = np.array([w for t in texts for w in t], np.int64)
    n, starts = len(words), np.cumsum(sizes) - sizes
    if not n:
        return [(0, 0, 0, 0)] * len(texts)
    order, levels = suffix_array(words)
    lcp = neighbour_prefixes(order, levels)
    longest = np.zeros(n, np.int64)
    longest[order] = np.maximum(lcp, np.r_[lcp[1:], 0])

    def covered(least: int) -> np.ndarray:
        """Words in repeats of ``least`` words or more, per text."""
        spans = np.flatnonzero(longest >= least)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, spans, 1)
        np.add.at(edge, spans + longest[spans], -1)
        inside = np.r_[0, np.cumsum(np.cumsum(edge[:n]) > 0)]
        return inside[starts + sizes] - inside[starts]

    left = np.r_[-1, words[:-1]]
    left[starts[sizes > 0]] = -1 - np.flatnonzero(sizes > 0)        # a start differs from every word
    found = maximal_repeats(order, lcp, left[order], MIN_REPEAT)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    maximal = np.bincount(text_of[order[found[:, 0]]], minlength=len(texts))
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, text_of, longest)
    return list(zip(covered(WINDOW).tolist(), maximal.tolist(), covered(MIN_REPEAT).tolist(), top.tolist()))


def _base(text: str) -> tuple[int, int, int, list[bytes]]:
    """word_chars, n_symbols, n_dup_lines and the words. ``bytes.split`` cuts at exactly the six white-space characters."""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), words


def measured(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """The figures and the verdict of each (doc_id, text)."""
    base, texts, count = [], [], 0
    for doc_id, text in rows:
        chars, symbols, dup_lines, words = _base(text or "")
        numbers: dict[bytes, int] = {}
        texts.append([count + numbers.setdefault(w, len(numbers)) for w in words])
        count += len(numbers)
        base.append((doc_id, len(words), chars, symbols, dup_lines))
    out = []
    for b, (repeat, maximal, covered, longest) in zip(base, _measure(texts)):
        n = b[1]
        failed = n < MIN_WORDS or 100 * repeat > BASE_PERCENT * n
        kept = not failed and 100 * covered <= MAX_COVERED * n and longest <= MAX_LONGEST
        out.append((*b, repeat, maximal, covered, longest, failed, kept))
    return out


def repetition(docs: DataFrame) -> DataFrame:
    """The figures and the verdict per row of ``docs`` (doc_id, text): base figures, number of maximal repeats, words that
    they cover, words of the longest repeat, base_failed, kept."""
    columns = [c.split()[0] for c in SCHEMA.split(", ")]

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(measured(rows), columns=columns)
        return out.astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, size = [], 0
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                rows.append((None if pd.isna(doc_id) else int(doc_id), text))
                size += len(text or "") // 6 + 1                    # words, about
                if size >= ARRAY_WORDS:
                    yield frame(rows)
                    rows, size = [], 0
            if rows:
                yield frame(rows)

    return docs.select("doc_id", "text").mapInPandas(run, SCHEMA)
