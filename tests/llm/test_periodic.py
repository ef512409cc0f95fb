import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ravel.llm import periodic

SF = "/root/testdata/sf0.01"


def brute_runs(words, min_words=24, min_repeats=3):
    """Every period by itself: maximal stretches of w[i] == w[i + q]."""
    n, found = len(words), {}
    ids = np.array([hash(w) for w in words], dtype=np.int64)
    for q in range(1, n // min_repeats + 1):
        same = np.append(ids[:n - q] == ids[q:], False)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = b - a + q
            if length >= max(min_words, min_repeats * q):
                found.setdefault((a, length), q)      # smallest period first
    return sorted((a, n, q) for (a, n), q in found.items())


def brute_collapse(words, runs):
    return [w for i, w in enumerate(words)
            if not any(a + q <= i < a + n for a, n, q in runs)]


def planted(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def row_of(doc_id, words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    milli = 1000 * best[1] // best[2] if runs else None
    kept = b" ".join(brute_collapse(words, runs))
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(row_of(r.doc_id, planted(r.doc_id, r.text)) for r in docs)
    out = periodic.op13_periodic_runs(spark, SF)
    assert dict(out.dtypes) == {c: "string" if c.endswith("256") else "bigint"
                                for c in out.columns}
    got = sorted(tuple(r) for r in out.collect())
    assert got == want
    assert sum(r[1] > 0 for r in got) > 50


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=5), st.integers(1, 12)), max_size=6),
       st.integers(2, 4), st.integers(1, 24))
def test_runs_equal_brute_force(parts, repeats, least):
    words = list("".join(p * n for p, n in parts))
    want = sorted(brute_runs(words, least, repeats))
    assert periodic.runs_of([words, [], words], least, repeats) == [want, [], want]


def test_random_and_nested_runs():
    rng = random.Random(5)
    texts = [["x"] * 4000, list("ab" * 500 + "c" + "ab" * 500),
             list("aab" * 9 + "aac" * 9) * 8, [], ["one"]]
    a = b = "a"
    for _ in range(14):                 # Fibonacci words hold many runs
        a, b = a + b, a
    texts.append(list(a))
    texts += [[rng.choice("ab") for _ in range(rng.randrange(3000))] for _ in range(6)]
    got = periodic.runs_of(texts)
    assert got == [sorted(brute_runs(t)) for t in texts]
    for t, r in zip(texts, got):
        assert periodic.collapse(t, r) == brute_collapse(t, r)


def test_suffix_array_is_one():
    rng = random.Random(2)
    for n in (1, 2, 50, 400):
        x = [rng.randrange(3) for _ in range(n)]
        array = periodic.SuffixArray(np.array(x))
        order = sorted(range(n), key=lambda i: x[i:])
        assert array.sa.tolist() == order
        lcp = array.lcp()[1:n].tolist()
        for k, v in enumerate(lcp):
            p, q = x[order[k]:], x[order[k + 1]:]
            assert v == next((i for i, (s, t) in enumerate(zip(p, q)) if s != t),
                             min(len(p), len(q)))


def test_squares_are_tested_in_parts(monkeypatch):
    words = list("abcab" * 40 + "b" * 90)
    monkeypatch.setattr(periodic, "_EXPAND", 7)
    assert periodic.runs_of([words]) == [sorted(brute_runs(words))]


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(periodic, "SLICE_BYTES", 100)
    loop = "à b  c\t" * 10
    rows = [(1, None, 0), (2, "", 0), (3, " \n\t ", 0), (4, "x " * 30, 0), (4, "x " * 30, 0),
            (None, loop, 1), (6, "w " * 200_000, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed).decode())
                  for r in periodic.periodic_runs(docs).collect()), key=str)
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 30, [(0, 30, 1)], "x"),
            (4, 30, [(0, 30, 1)], "x"), (None, 20, [], " ".join(loop.replace("\t", " ").split(" "))
                                         .replace("  ", " ").strip(" ")),
            (6, 200_000, [(0, 200_000, 1)], "w")]
    assert got == sorted(want, key=str)
    assert periodic.periodic_runs(docs.where("doc_id < 0")).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, min_repeats=1)


def test_no_shuffle(spark):
    plan = periodic.op13_periodic_runs(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
