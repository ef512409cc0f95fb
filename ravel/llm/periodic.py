"""Periodic runs of words by an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends, of at least ``min_words`` words and ``min_repeats``
periods. Inside a task, over a slice of documents:

1. Words become numbers. Only stretches of words that a run could cover enter
   the suffix array: all words of a run lie in k-grams that their document
   holds twice (k follows from the two bounds), so nothing else can matter.
   Grams are compared by a 64-bit hash; a collision only adds words.
2. Suffix array, ranks and LCP values come from prefix doubling in numpy; the
   ranks of every level stay, so that the longest common extension of any two
   places takes one step a level.
3. LCP intervals are found by a stack over the LCP values, without tree nodes.
   The suffixes i of all children of an interval but its largest are tested:
   where the rank of i + depth (or i - depth) lies in the interval, in another
   child, a square with that depth as period starts at i (at i - depth) and no
   rotation to the right continues it.
4. Each such square is rotated to the left as long as words agree, by binary
   search over common extensions. The squares of one stretch are merged: its
   smallest period names the run.

Scale: a map over documents without a shuffle, so a hot group of copies or
words is no group at all. A task holds one slice of texts (``SLICE_BYTES``, or
a single longer text) and, for the words in repeated grams, a rank of four
bytes for each doubling level.

Edge cases: a null, empty or blank text has no words and no runs. A null id
and repeated rows give rows of their own. Words are separated by ASCII white
space alone; other characters, whatever they are, belong to words. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, read

MIN_WORDS = 24
MIN_REPEATS = 3
SLICE_BYTES = 4 << 20   # text whose words are numbered and sorted together
_EXPAND = 1 << 20       # suffixes tested at once
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(ids: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Mask of the words that lie in a ``k``-gram which occurs twice in its
    document. ``ids`` are word numbers, ``doc`` the document of each word."""
    n = len(ids) - k + 1
    if n < 2:
        return np.zeros(len(ids), dtype=bool)
    gram = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    gram ^= gram >> np.uint64(29)
    key, at, width = doc[:n].astype(np.uint64) * _MIX, 0, 1
    while True:
        if k & width:
            key = key * np.uint64(0xD6E8FEB86659FD93) + gram[at:at + n]
            at += width
        if width * 2 > k:
            break
        gram = gram[:-width] * np.uint64(0xA0761D6478BD642F) + gram[width:]
        gram ^= gram >> np.uint64(31)
        width *= 2
    whole = np.flatnonzero(doc[:n] == doc[k - 1:])
    key = key[whole]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(whole), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[whole[twice]] += 1
    edge[whole[twice] + k] -= 1
    return np.cumsum(edge[:-1]) > 0


class SuffixArray:
    """Suffix array of ``keys`` (any integers) with the ranks of every
    doubling level: ``levels[j]`` orders the first 2^j entries."""

    def __init__(self, keys: np.ndarray):
        n = self.n = len(keys)
        rank = np.unique(keys, return_inverse=True)[1].astype(np.int32)
        self.levels, width = [rank], 1
        self.sa = np.argsort(rank, kind="stable")
        while n and rank.max() < n - 1:
            pair = rank.astype(np.int64) * (n + 1)
            pair[:n - width] += rank[width:] + 1
            order = np.argsort(pair)
            new = np.empty(n, dtype=np.int32)
            pair = pair[order]
            new[order] = np.concatenate([[0], np.cumsum(pair[1:] != pair[:-1])])
            rank, width, self.sa = new, width * 2, order
            self.levels.append(rank)
        self.rank = rank

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes ``a`` and ``b``
        (different places)."""
        a, b = a.copy(), b.copy()
        first = a.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            inside = np.flatnonzero((a < self.n) & (b < self.n))
            level = self.levels[j]
            hit = inside[level[a[inside]] == level[b[inside]]]
            a[hit] += 1 << j
            b[hit] += 1 << j
        return a - first

    def lcp(self) -> np.ndarray:
        """Common prefix of each suffix with the one before it in order; -1
        before the first and behind the last."""
        out = np.full(self.n + 1, -1, dtype=np.int64)
        out[1:self.n] = self.extension(self.sa[:-1], self.sa[1:])
        return out


def child_intervals(lcp: np.ndarray):
    """Children of all LCP intervals: arrays (depth, first and last position
    of the interval, first and last position of the child), without each
    interval's largest child."""
    n = len(lcp) - 1
    values = lcp.tolist()
    below = [0] * (n + 1)       # nearest earlier position with a smaller value
    equal = [0] * (n + 1)       # whether the interval had a position before
    nearer = [0] * (n + 1)      # next position with no greater value
    beyond = [0] * (n + 1)      # next position with a smaller value
    stack = [0]
    for k in range(1, n + 1):
        v = values[k]
        while values[stack[-1]] > v:
            top = stack.pop()
            beyond[top] = k
            nearer[top] = nearer[top] or k
        top = stack[-1]
        if values[top] == v:
            below[k], equal[k], nearer[top] = below[top], 1, k
        else:
            below[k] = top
        stack.append(k)
    k = np.flatnonzero(lcp[:n] > 0)
    below, equal, nearer, beyond = (np.array(x, dtype=np.int64)[k]
                                    for x in (below, equal, nearer, beyond))
    first = equal == 0
    depth = np.concatenate([lcp[k], lcp[k][first]])
    lo = np.concatenate([below, below[first]])
    hi = np.concatenate([beyond, beyond[first]]) - 1
    child_lo = np.concatenate([k, below[first]])
    child_hi = np.concatenate([nearer - 1, k[first] - 1])
    # (first position, depth) names an interval; its largest child goes
    order = np.lexsort((child_hi - child_lo, depth, lo))
    last = np.append((lo[order][1:] != lo[order][:-1]) | (depth[order][1:] != depth[order][:-1]),
                     True) if len(order) else np.zeros(0, dtype=bool)
    keep = order[~last]
    return depth[keep], lo[keep], hi[keep], child_lo[keep], child_hi[keep]


def branching_squares(array: SuffixArray, most: np.ndarray):
    """(start, period) of the squares that no rotation to the right continues,
    with a period of at most ``most`` at their interval."""
    depth, lo, hi, child_lo, child_hi = child_intervals(array.lcp())
    use = depth <= most[array.sa[lo]]
    depth, lo, hi, child_lo, child_hi = (x[use] for x in (depth, lo, hi, child_lo, child_hi))
    sizes = child_hi - child_lo + 1
    ends = np.cumsum(sizes)
    starts, periods = [], []
    at = 0
    while at < len(sizes):
        base = ends[at] - sizes[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + _EXPAND, "right")))
        part = np.repeat(np.arange(at, stop), sizes[at:stop])
        place = np.arange(base, ends[stop - 1]) - (ends[part] - sizes[part]) + child_lo[part]
        i, d = array.sa[place], depth[part]
        for there, start in ((i + d, i), (i - d, i - d)):
            ok = np.flatnonzero((there >= 0) & (there < array.n))
            p, r = part[ok], array.rank[there[ok]]
            hit = ok[(r >= lo[p]) & (r <= hi[p]) & ((r < child_lo[p]) | (r > child_hi[p]))]
            starts.append(start[hit])
            periods.append(d[hit])
        at = stop
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return found[0], found[1]


def find_runs(keys: np.ndarray, longest: np.ndarray, min_words: int = MIN_WORDS,
              min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """Rows (start, length, period) of the runs of ``keys``, by start, then
    period. ``longest`` bounds a run's length at each place."""
    none = np.zeros((0, 3), dtype=np.int64)
    if len(keys) < 2:
        return none
    array = SuffixArray(keys)
    i, d = branching_squares(array, longest // min_repeats)
    # rotations to the left that a run of the wanted length needs
    need = np.maximum(0, np.maximum(min_words - 2 * d, (min_repeats - 2) * d))
    use = i >= need
    i, d, need = i[use], d[use], need[use]
    use = array.extension(i - need, i - need + d) >= need + d
    i, d, need = i[use], d[use], need[use]
    if not len(i):
        return none
    low, high = need, i.copy()          # rotations that hold; that may hold
    while (low < high).any():
        mid = (low + high + 1) // 2
        holds = array.extension(i - mid, i - mid + d) >= mid + d
        low, high = np.where(holds, mid, low), np.where(holds, high, mid - 1)
    start, end = i - low, i + 2 * d
    order = np.lexsort((d, end, start))
    start, end, d = start[order], end[order], d[order]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    out = np.stack([start, end - start, d], axis=1)[new]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def runs_of(texts: list[list], min_words: int = MIN_WORDS,
            min_repeats: int = MIN_REPEATS) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words."""
    out: list[list] = [[] for _ in texts]
    number = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ids = np.array([number[w] for t in texts for w in t], dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    # a run of length L and period q holds each (L - q)-gram of it twice
    k = max(1, min_words - min_words // min_repeats)
    place = np.flatnonzero(repeated_words(ids, doc, k))
    if not len(place):
        return out
    doc = doc[place]
    new = np.append(True, (np.diff(place) > 1) | (np.diff(doc) > 0))
    stretch = np.cumsum(new) - 1
    longest = np.bincount(stretch)[stretch]
    # words of different stretches never agree
    for start, length, period in find_runs(stretch * len(number) + ids[place], longest,
                                           min_words, min_repeats).tolist():
        d = int(doc[start])
        out[d].append((int(place[start] - first[d]), length, period))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start,length,period>> by start, then
    period, collapsed binary) of every row; ``collapsed`` is the UTF-8 text of
    the words that stay, joined by one space."""
    if min_repeats < 2 or min_words < 1:
        raise ValueError("a run has at least two periods and one word")
    bound_batches(docs.sparkSession)
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def found(ids, texts):
        words = [t.split() for t in texts]
        runs = runs_of(words, min_words, min_repeats)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()),
             pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs],
                      pa.list_(_RUN)),
             pa.array([b" ".join(collapse(w, r)) for w, r in zip(words, runs)], pa.binary())],
            names)

    def run(batches):
        for b in batches:
            ids, texts, size = [], [], 0
            for doc_id, data in zip(b["doc_id"].to_pylist(), b["data"]):
                ids.append(doc_id)
                texts.append(data.as_py())
                size += len(texts[-1])
                if size >= SLICE_BYTES:
                    yield found(ids, texts)
                    ids, texts, size = [], [], 0
            yield found(ids, texts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, "
                                "length: long, period: long>>, collapsed binary")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth document, by the checksum of its id,
    repeats its words from a point on: the contract's test of the operator."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("planted"),
                       F.floor(h / 10).cast("long").alias("g"))
    # split once, as a column of its own
    rows = rows.withColumn("words", F.when(F.col("planted"), F.expr(
        r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")))
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, null)"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    text = F.expr("if(planted and n > 0, array_join(transform(words, (w, i) -> "
                  "if(i >= a, words[cast(a + (i - a) % p as int)], w)), ' '), text)")
    return rows.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``documents``."""
    out = periodic_runs(with_planted_periods(read(spark, sf_dir, "documents")))
    most = F.expr(
        "array_sort(runs, (l, r) -> case "
        "when l.length * r.period > r.length * l.period then -1 "
        "when l.length * r.period < r.length * l.period then 1 "
        "when l.start <> r.start then if(l.start < r.start, -1, 1) "
        "when l.period <> r.period then if(l.period < r.period, -1, 1) else 0 end)")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', "
                   "r.period, '\n')), '')")
    best = F.get(F.col("ranked"), F.lit(0))
    return out.withColumn("ranked", most).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * get(ranked, 0).length) div get(ranked, 0).period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLE: dict[str, str] = {}
