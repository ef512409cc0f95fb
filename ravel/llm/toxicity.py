"""Toxicity grades by cumulative-link ordinal regression.

Features are sparse: the words of a text and their first 4, 5 and 6 letters
(which meet inflected forms), of which the ``FEATURES`` most telling ones of
the labelled sample are kept, if their chi-square is at least ``CHI``. A feature's value is one for its presence plus
the logarithm of its rate. The model has one weight vector for all grades and
an ordered threshold for each: P(grade >= j) = sigmoid(w.x - t_j). Labels say
toxic or not; toxic labelled texts are graded mild, medium and severe by the
terciles of their rate of telling features. The expected severity is the sum
of P(grade >= j); a text is toxic where P(grade >= 1) reaches the cutoff that
tells the labelled sample apart best (by F1 of scores across folds).

Scale: the model is fitted on a bounded sample of labelled rows, about
``SAMPLE`` whatever the table's size, chosen by a hash of the id. The sampled
ids are the only thing broadcast besides the model (at most ``FEATURES``
weights). Scoring maps over the documents and shuffles nothing.

Edge cases: a null or empty text has no features and gets the severity of the
thresholds alone. A label that is null is no label; an id labelled both ways
is toxic. Without both kinds of labels there is no model: every severity is
zero and nothing is rejected. Null ids and repeated rows are scored like any
row. Extra columns are ignored, or pass through where documents are filtered.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, pinned, read

GRADES = 3            # mild, medium, severe
SAMPLE = 20_000       # labelled rows the model is fitted on, about
FEATURES = 1024
MIN_DOCS = 5          # labelled documents that hold a feature
CHI = 24.0            # chi-square of a feature (about one in a million by chance)
TELLING = 2.0         # log odds ratio of a feature that counts for severity
RIDGE = 3e-4
STEPS = 400
FOLDS = 3
_PREFIXES = (4, 5, 6)
_CACHE = 200_000
_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def word_counts(text: str | None) -> Counter:
    return Counter((text or "").lower().encode().translate(_LETTERS).decode().split())


def features_of(word: str) -> list[str]:
    """The word itself and its openings (marked with a star)."""
    return [word] + [word[:n] + "*" for n in _PREFIXES if len(word) > n]


class Severity:
    """A fitted model; small enough to broadcast."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, cuts: np.ndarray,
                 cutoff: float = 0.5):
        self.index, self.weights, self.cuts, self.cutoff = index, weights, cuts, cutoff
        self._seen: dict[str, tuple] = {}

    def __getstate__(self):
        return {**self.__dict__, "_seen": {}}

    def counts(self, text: str | None) -> tuple[dict[int, int], int]:
        """({feature number: count}, words)."""
        words = word_counts(text)
        out: dict[int, int] = {}
        seen, index = self._seen, self.index
        for word, n in words.items():
            at = seen.get(word)
            if at is None:
                if len(seen) >= _CACHE:
                    seen.clear()
                at = seen[word] = tuple(index[f] for f in features_of(word) if f in index)
            for i in at:
                out[i] = out.get(i, 0) + n
        return out, words.total()

    def at_least(self, text: str | None) -> np.ndarray:
        """P(grade >= j) for j = 1 .. GRADES."""
        if not len(self.cuts):
            return np.zeros(GRADES)
        counts, n = self.counts(text)
        score = sum(self.weights[i] * _value(c, n) for i, c in counts.items())
        return 1 / (1 + np.exp(np.clip(self.cuts - score, -500, 500)))


def _value(count, words):
    return 1.0 + math.log1p(100.0 * count / words)


def fit_cumulative_link(rows, cols, values, grades, size: int, levels: int,
                        steps: int = STEPS, ridge: float = RIDGE):
    """Weights and ordered thresholds of P(y >= j) = sigmoid(w.x - t_j), by
    gradient steps (Adam) on the mean negative log likelihood."""
    n = len(grades)
    shares = np.array([(grades >= j).mean() for j in range(1, levels + 1)]).clip(1e-4, 1 - 1e-4)
    first = -math.log(shares[0] / (1 - shares[0]))
    # thresholds: the first, then positive steps (so they stay in order)
    gaps = np.log(np.maximum(np.diff(-np.log(shares / (1 - shares))), 0.1))
    p = np.concatenate([np.zeros(size), [first], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, cuts = p[:size], np.cumsum(np.concatenate([p[size:size + 1], np.exp(p[size + 1:])]))
        eta = np.bincount(rows, w[cols] * values, minlength=n)
        s = 1 / (1 + np.exp(np.clip(cuts[None, :] - eta[:, None], -500, 500)))
        up = np.hstack([np.ones((n, 1)), s, np.zeros((n, 1))])
        slope = up * (1 - up)
        at = np.arange(n)
        prob = np.maximum(up[at, grades] - up[at, grades + 1], 1e-12)
        d_eta = -(slope[at, grades] - slope[at, grades + 1]) / prob / n
        g_w = np.bincount(cols, d_eta[rows] * values, minlength=size) + ridge * w
        d_cut = np.zeros((n, levels + 2))
        d_cut[at, grades] += slope[at, grades] / prob / n
        d_cut[at, grades + 1] -= slope[at, grades + 1] / prob / n
        per_cut = d_cut[:, 1:-1].sum(axis=0)
        after = np.cumsum(per_cut[::-1])[::-1]       # a step moves all later cuts
        g = np.concatenate([g_w, after[:1], after[1:] * np.exp(p[size + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return p[:size], np.cumsum(np.concatenate([p[size:size + 1], np.exp(p[size + 1:])]))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(text, is_toxic 0/1) of about ``size`` labelled documents at most. Near
    copies, told by their three longest words, count once: a copied text says
    nothing new about its words."""
    marks = (labels.where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = marks.count()
    keep = min(1.0, size / max(n, 1))
    marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(keep * (1 << 30)))
    marks = marks.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").alias("is_toxic"))
    rows = (docs.select("doc_id", "text")
            .join(F.broadcast(marks), F.col("doc_id") == F.col("labelled_id"))
            .select("text", "is_toxic"))

    def families(batches):
        for b in batches:
            keys = [" ".join(sorted(sorted(word_counts(t), key=lambda w: (-len(w), w))[:3]))
                    for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.string())],
                                             ["text", "is_toxic", "family"])

    rows = rows.mapInArrow(families, "text string, is_toxic int, family string")
    once = rows.groupBy("family", "is_toxic").agg(F.min("text").alias("text"))
    return pinned(once.select("text", "is_toxic"))


def select_features(sample: DataFrame, size: int = FEATURES) -> dict[str, float]:
    """The most telling features (chi-square) with their log odds ratio."""
    def count(batches):
        pos, neg = Counter(), Counter()
        for b in batches:
            for text, toxic in zip(b["text"].to_pylist(), b["is_toxic"].to_pylist()):
                (pos if toxic else neg).update(
                    {f for w in word_counts(text) for f in features_of(w)})
        names = list({**pos, **neg})
        for at in range(0, len(names), 100_000):
            part = names[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([pos[f] for f in part], pa.int64()),
                 pa.array([neg[f] for f in part], pa.int64())], ["feature", "pos", "neg"])

    n = {r["is_toxic"] > 0: r["count"] for r in sample.groupBy("is_toxic").count().collect()}
    if len(n) < 2:
        return {}
    p, q = F.col("pos") / n[True], F.col("neg") / n[False]
    share = (F.col("pos") + F.col("neg")) / (n[True] + n[False])
    chi = (p - q) ** 2 / (share * (1 - share) + F.lit(1e-9)) * \
        (n[True] * n[False] / (n[True] + n[False]))
    odds = F.log((F.col("pos") + 0.5) / (n[True] + 1)) - F.log((F.col("neg") + 0.5) / (n[False] + 1))
    best = (sample.mapInArrow(count, "feature string, pos long, neg long")
            .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
            .where(F.col("pos") + F.col("neg") >= MIN_DOCS)
            .select("feature", odds.alias("odds"), chi.alias("chi")).where(F.col("chi") >= CHI)
            .orderBy(F.desc("chi"), "feature").limit(size))
    return {r.feature: r.odds for r in best.collect()}


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Severity:
    bound_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, size)
    odds = select_features(sample)
    if not odds:
        return Severity({}, np.zeros(0), np.zeros(0))
    empty = Severity({f: i for i, f in enumerate(odds)}, np.zeros(len(odds)), np.zeros(0))

    def vectors(batches):
        for b in batches:
            rows = [empty.counts(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["key"], b["is_toxic"], pa.array([n for _, n in rows], pa.int64()),
                 pa.array([list(c) for c, _ in rows], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c, _ in rows], pa.list_(pa.int32()))],
                ["key", "is_toxic", "words", "cols", "counts"])

    # about SAMPLE short vectors of at most FEATURES entries, in the order of
    # their texts' hashes: sums and folds are the same on any cluster
    got = sample.select("*", F.sha2("text", 256).alias("key")).mapInArrow(
        vectors, "key string, is_toxic int, words long, cols array<int>, counts array<int>")
    got = got.toArrow().sort_by([("key", "ascending"), ("is_toxic", "ascending")])
    toxic = got["is_toxic"].to_numpy() > 0
    words = np.maximum(got["words"].to_numpy(), 1)
    cols = got["cols"].combine_chunks()
    sizes = np.diff(cols.offsets.to_numpy())
    cols = cols.flatten().to_numpy()
    counts = got["counts"].combine_chunks().flatten().to_numpy()
    rows = np.repeat(np.arange(len(toxic)), sizes)
    values = 1.0 + np.log1p(100.0 * counts / words[rows])
    telling = np.array(list(odds.values())) >= TELLING
    rate = np.bincount(rows, np.where(telling[cols], counts, 0), minlength=len(toxic)) / words
    bounds = np.quantile(rate[toxic], [i / GRADES for i in range(1, GRADES)])
    grades = np.where(toxic, 1 + np.searchsorted(bounds, rate, side="right"), 0)
    weights, cuts = fit_cumulative_link(rows, cols, values, grades, len(odds), GRADES)
    # the cutoff is chosen on scores of rows their model has not seen
    scores, fold = np.zeros(len(toxic)), np.arange(len(toxic)) % FOLDS
    for k in range(FOLDS):
        seen = fold != k
        mine, new = seen[rows], np.cumsum(seen) - 1
        w, c = fit_cumulative_link(new[rows[mine]], cols[mine], values[mine], grades[seen],
                                   len(odds), GRADES)
        s = np.bincount(rows, w[cols] * values, minlength=len(toxic)) - c[0]
        scores[~seen] = s[~seen]
    return Severity(empty.index, weights, cuts, best_cutoff(scores, toxic))


def best_cutoff(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The probability that splits log odds ``scores`` with the best F1."""
    order = np.argsort(-scores)
    s, hits = scores[order], np.cumsum(toxic[order])
    taken = np.arange(1, len(s) + 1)
    ends = np.append(s[1:] < s[:-1], True)          # equal scores stay together
    f1 = np.where(ends, 2 * hits / (taken + toxic.sum()), -1)
    k = int(f1.argmax())
    cut = s[k] if k + 1 == len(s) else (s[k] + s[k + 1]) / 2
    return float(1 / (1 + math.exp(-max(min(cut, 500), -500))))


def score(docs: DataFrame, model: Severity, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, severity double, grade int, p_toxic double, toxic boolean) of
    every row; ``grade`` is the most probable one."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            p = np.array([shared.value.at_least(t) for t in b["text"].to_pylist()]) \
                .reshape(-1, GRADES)
            each = -np.diff(np.hstack([np.ones((len(p), 1)), p, np.zeros((len(p), 1))]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(p.sum(axis=1)),
                 pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0].copy()),
                 pa.array(p[:, 0] >= shared.value.cutoff)],
                ["doc_id", "severity", "grade", "p_toxic", "toxic"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def drop_toxic(docs: DataFrame, model: Severity) -> DataFrame:
    """``docs`` without the rows judged toxic."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            clean = [shared.value.at_least(t)[0] < shared.value.cutoff
                     for t in b["text"].to_pylist()]
            yield b.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of all ``documents`` by a model fitted on ``labels``."""
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}
