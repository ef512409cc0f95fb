import numpy as np
import pytest
from pyspark.sql import functions as F

from ravel.llm import ann


def brute(rows, queries, k=10):
    """rows: (id, vector); exact neighbours by the contract."""
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows
          if i is not None and v is not None and len(v) and None not in v
          and np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in ok:
        if q in queries:
            near = sorted({(float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in ok if i != q})
            out[q] = near[:k]
    return out


def found(index, queries):
    got = {}
    for r in index.search(queries).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_recall_on_whole_table(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in ann.op1_ann(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    rows = [(r.vec_id, r.embedding) for r in v.select("vec_id", "embedding").collect()]
    want = brute(rows, {i for i, _ in rows if i % 100 == 0})
    assert set(got) == set(want)
    exact = dict(rows)
    for q, near in got.items():
        assert near == sorted(near) and len(near) == 10
        for d, i in near:
            diff = np.array(exact[q], dtype=np.float64) - np.array(exact[i], dtype=np.float64)
            assert d == pytest.approx(float(np.sqrt((diff ** 2).sum())), rel=1e-12)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_clustered_data_needs_few_leaves(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 8)) * 20
    x = centres[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 8))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)],
                              "vec_id long, embedding array<double>")
    index = ann.Index(v)
    assert index.visits <= 0.25 * len(index.tree.leaves)
    got = found(index, v.where("vec_id % 50 = 0"))
    want = brute(list(enumerate(x)), set(range(0, 6000, 50)))
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.93 * 10 * len(want)


def test_visits_come_best_first():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    tree = ann.Tree(x, 60)
    leaf = tree.assign(x)
    assert len(tree.leaves) >= 50
    for i in range(20):
        order = list(tree.visit(x[i]))
        assert sorted(order) == list(range(len(tree.leaves)))
        assert order[0] == leaf[i]
        near = leaf[np.argsort(((x - x[i]) ** 2).sum(axis=1))[:20]]
        assert np.mean([order.index(j) for j in near]) < len(order) / 3


@pytest.mark.parametrize("block", [2048, 7])
def test_hot_vector_ties_and_odd_rows(spark, monkeypatch, block):
    """A third of the rows are one vector; visits of all leaves make the
    search exact, so it must equal brute force with its ties."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", block)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", block)
    monkeypatch.setattr(ann, "LEAF_ROWS", 20)
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, -0.0] if i % 3 == 0 else rng.integers(-2, 3, 3).tolist())
            for i in range(400)]
    rows = [(i, [float(c) for c in v]) for i, v in rows]
    rows += [(400, None), (500, []), (600, [0.0, 0.0, 0.0]), (700, [1.0, None, 2.0]),
             (800, [1.0, float("nan"), 2.0]), (900, [float("inf"), 1.0, 1.0]), (1000, [1.0, 2.0]),
             (None, [1.0, 2.0, 0.5]), (300, rows[300][1])]
    v = spark.createDataFrame([(i, x, "a", 1.0) for i, x in rows],
                              "vec_id long, embedding array<double>, key string, v double")
    index = ann.Index(v)
    index.visits = len(index.tree.leaves)
    queries = {i for i, _ in rows if i is not None and i % 20 == 0}
    want = brute([r for r in rows if r[0] != 1000], queries)
    got = found(index, v.where("vec_id % 20 = 0"))
    assert set(got) == set(want)
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]


def test_few_and_no_rows(spark):
    v = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (5, [2.0])],
                              "vec_id long, embedding array<double>")
    assert found(ann.Index(v), v) == {0: [(1.0, 1), (1.0, 5)], 1: [(0.0, 5), (1.0, 0)],
                                      5: [(0.0, 1), (1.0, 0)]}
    one = v.where("vec_id = 0")
    assert found(ann.Index(one), one) == {}
    none = v.where("vec_id = 9")
    assert found(ann.Index(none), none) == {}
    assert ann.Index(v).search(none).columns == ["query_id", "rank", "vec_id", "score"]


def test_ids_with_several_vectors(spark):
    """An id counts once, at its nearest vector, as query and as candidate."""
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    near = rng.normal(size=6)
    rows += [(0, (near + rng.normal(size=6) / 50).tolist()) for _ in range(14)]
    rows += [(7, (near + rng.normal(size=6) / 50).tolist()) for _ in range(14)]
    rows += [(8, (near + 0.03).tolist()), (8, (near - 0.03).tolist()), (8, near.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann.Index(df, k=10)
    asked = [0, 7, 8, 20]
    got = {}
    for r in index.search(df.where(F.col("vec_id").isin(asked))).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for q in asked:
        best = {}
        for i, v in rows:
            if i != q:
                d = min(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()))
                        for j, w in rows if j == q)
                best[i] = min(d, best.get(i, np.inf))
        want = sorted((d, i) for i, d in best.items())[:10]
        assert sorted(got[q]) == list(range(1, 11))
        ids = [got[q][r][0] for r in range(1, 11)]
        assert len(set(ids)) == 10 and q not in ids
        assert len(set(ids) & {i for _, i in want}) >= 9
        true = {i: d for d, i in want}
        assert all(abs(true[i] - d) < 1e-9 for i, d in got[q].values() if i in true)


def test_nearest_ids():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        d = rng.integers(0, 9, n).astype(float)
        ids = [np.sort(rng.choice(12, int(rng.integers(1, 4)), replace=False)) for _ in range(n)]
        best = {}
        for x, own in zip(d, ids):
            for i in own.tolist():
                best[i] = min(best.get(i, np.inf), x)
        want = sorted((x, i) for i, x in best.items())
        # lists hold the smallest ids of a vector, as many as are asked for
        assert ann.nearest_ids(d, ids, 4) == want[:4]


@pytest.mark.parametrize("rows_a_batch", [3, 4096])
def test_vectors_are_not_copied_for_queries(spark, monkeypatch, rows_a_batch):
    """One copy of each vector, whatever batches cut a block and its queries."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 4))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)],
                              "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    index = ann.Index(v)
    index.visits = len(index.tree.leaves)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows_a_batch))
    try:
        got = found(index, v)
    finally:
        spark.conf.set(key, before)
    want = brute(list(enumerate(x.tolist())), set(range(500)))
    assert all([i for _, i in got[q]] == [i for _, i in want[q]] for q in range(500))
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 5)
    assert found(index, v) == got


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(400)],
                              "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "SAMPLE_BYTES", 800)        # 50 vectors of two components
    sizes = []
    plain = ann.Tree.__init__

    def noted(self, points, *more):
        sizes.append(points.shape)
        plain(self, points, *more)

    monkeypatch.setattr(ann.Tree, "__init__", noted)
    ann.Index(v)
    assert 20 <= sizes[0][0] <= 90 and sizes[0][1] == 2
