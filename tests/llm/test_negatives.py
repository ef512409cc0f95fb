import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ravel.llm import negatives

SF = "/root/testdata/sf0.01"
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every, positives=5, negs=3, low=50, high=95):
    """rows: (id, label, integer vector), one per id."""
    out = []
    for a, la, va in rows:
        if a % every:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [s for s in scored if s[2] == la][:positives]:
            fit = [s for s in scored if s[2] != la and low * ps <= 100 * s[0] <= high * ps]
            out += [(a, p, k + 1, n, ps, ns) for k, (ns, n, _) in enumerate(fit[:negs])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


def test_query_equals_sql_and_brute_force(spark):
    out = negatives.op12_hard_negatives(spark, SF)
    got = rows_of(out)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    res = con.execute(negatives.ORACLE["op12_hard_negatives"])
    names = [d[0] for d in res.description]
    assert got == sorted(tuple(r[names.index(c)] for c in COLS) for r in res.fetchall())
    data = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label,
             np.floor(256 * np.array(r.embedding, dtype=np.float64)).astype(int).tolist())
            for r in data]
    assert got == brute(rows, 50) and len(got) > 50


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(0, 70), st.integers(0, 40), st.integers(1, 9),
       st.integers(0, 2**32))
def test_product(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-2**62, 2**62, s) for s in ((m, k), (n, k)))
    assert (negatives.strassen(a, b.T, leaf) == a @ b.T).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(4)
    score = rng.integers(-3, 3, (7, 60))
    score[0, :9] = [2**63 - 1, -2**63] * 4 + [0]
    ids = np.tile(rng.permutation(60), (7, 1))
    used = rng.random((7, 60)) < 0.7
    want = [sorted(((-int(s), int(i)) for s, i, u in zip(score[r], ids[r], used[r]) if u))[:4]
            for r in range(7)]
    for cuts in ([0, 60], [0, 1, 30, 31, 60]):
        heaps = negatives.Heaps(7, 4)
        for a, b in zip(cuts, cuts[1:]):
            heaps.add(score[:, a:b], ids[:, a:b], used[:, a:b])
        got = [[] for _ in range(7)]
        for owner, s, i in zip(*(x.tolist() for x in heaps.entries())):
            got[owner].append((-s, i))
        assert [sorted(g) for g in got] == want


def small(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, label int, tile int, grp string, tiles int")


def test_many_tiles_ties_and_one_hot_vector(spark):
    rng = random.Random(8)
    rows = [(i, rng.randrange(3), [rng.randrange(-3, 4) / 256 for _ in range(9)])
            for i in range(230)]
    rows += [(i, 1, [0.25] * 9) for i in range(230, 400)]       # one vector, one label
    rng.shuffle(rows)
    df = small(spark, [(i, v, lab, 0, "x", 1) for i, lab, v in rows])
    whole = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, lab, v in rows]
    for per_tile in (16, 1024):
        got = negatives.mine(df, F.col("vec_id") % 5 == 0, rows_per_tile=per_tile)
        assert rows_of(got) == brute(whole, 5)
    got = negatives.mine(df, F.col("vec_id") % 5 == 0, positives=2, negatives=7, low=10, high=200,
                         rows_per_tile=64)
    assert rows_of(got) == brute(whole, 5, 2, 7, 10, 200)


def test_edge_cases(spark):
    one = [1.0, 0.5]
    rows = [(0, one, 1), (0, one, 1), (5, one, 1), (7, [0.75, 0.5], 2), (8, [0.5], 2),
            (9, [], 2), (10, None, 1), (15, one, None), (None, one, 1), (20, [None, 1.0], 1),
            (25, [float("nan"), 1.0], 1), (30, [float("inf"), 1.0], 1), (3, [-4.0, 0.0], 1),
            (35, [], 1), (40, [0.0, 0.0], 3)]
    df = small(spark, [(*r, 0, "x", 1) for r in rows])
    kept = {i: (i, lab, [int(256 * x) for x in v]) for i, v, lab in rows
            if i not in (10, 15, None, 20, 25, 30)}
    want = brute([(i, lab, v + [0] * (2 - len(v))) for i, lab, v in kept.values()], 5)
    got = negatives.mine(df, F.col("vec_id") % 5 == 0)
    assert rows_of(got) == want and want
    assert got.columns == COLS
    assert negatives.mine(df.where("vec_id < 0"), F.col("vec_id") % 5 == 0).count() == 0
    assert negatives.mine(df.where("vec_id = 9"), F.col("vec_id") == 9).count() == 0
    # an id with two vectors is the smaller (label, vector)
    twice = small(spark, [(5, [1.0], 1, 0, "x", 1), (5, [0.5], 1, 0, "x", 1),
                          (6, [1.0], 1, 0, "x", 1), (7, [0.5], 2, 0, "x", 1)])
    got = rows_of(negatives.mine(twice, F.col("vec_id") == 5))
    assert got == brute([(5, 1, [128]), (6, 1, [256]), (7, 2, [128])], 5) and got
    # scores are whole numbers modulo 2^64
    huge = small(spark, [(i, [3e38, 1.0], i % 2, 0, "x", 1) for i in range(6)])
    negatives.mine(huge, F.col("vec_id") == 0).collect()


def test_pairs_are_spread(spark):
    """Every tile pair of a label is a key of its own part."""
    df = spark.range(2000).select(F.col("id").alias("vec_id"), F.lit(1).alias("label"),
                                  F.expr("array(id, 1L)").alias("v"))
    packed = negatives.tiles(df, True, 100).collect()
    assert len(packed) == 20 and {r.tiles for r in packed} == {20}
    assert max(len(r.ids) // 8 for r in packed) < 160
    assert {r.bytes for r in packed} == {2}


@pytest.mark.parametrize("values, size", [([], 2), ([-2**15, 5], 2), ([2**15], 4), ([2**31], 8)])
def test_narrowest_integers(values, size):
    data, n = negatives._packed(np.array(values, dtype=np.int64))
    assert n == size and np.frombuffer(data, f"<i{n}").tolist() == values
