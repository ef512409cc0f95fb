import random
import re

import numpy as np
import pytest
import xxhash

from ravel.llm import simhash
from ravel.llm.common import connected_components


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
             or [" ".join(words)])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows):
    """rows: (doc_id, fp); smallest doc_id reachable for each row."""
    fp = np.array([f for _, f in rows], dtype=np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    label = np.arange(len(rows))
    while True:
        new = np.where(near, label[None, :], len(rows)).min(axis=1)
        if (new == label).all():
            break
        label = new
    best = {}
    for (d, _), l in zip(rows, label):
        if d is not None:
            best[l] = min(best.get(l, d), d)
    return [best.get(l) for l in label]


def test_query_equals_brute_force_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(rows, slow_components(rows))}
    got = {tuple(r) for r in simhash.op9_simhash(spark, sf)
           .select("doc_id", "fingerprint", "component_id").collect()}
    assert got == want
    assert any(d != c for d, _, c in got)


@pytest.mark.parametrize("tile_rows", [4096, 5])
def test_links_join_what_all_pairs_join(spark, monkeypatch, tile_rows):
    """Planted balls and chains, with tiny tiles so that sub-tiles occur."""
    monkeypatch.setattr(simhash, "TILE_ROWS", tile_rows)
    rng = random.Random(5)
    fps = set()
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            y = x
            for _ in range(rng.randint(1, 4)):
                y ^= 1 << rng.randrange(64)
            x = y if rng.random() < .4 else x
            fps.add(y)
    fps = sorted(fps)
    rows = [(i, f) for i, f in enumerate(fps)]
    want = slow_components(rows)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(df)).collect()}
    got = {}
    for (i, f), w in zip(rows, want):
        s = int(np.uint64(f).astype(np.int64))
        got.setdefault(roots.get(s, s), set()).add(w)
    assert all(len(v) == 1 for v in got.values())
    assert len(got) == len(set(want))


def test_edge_cases(spark):
    long_text = " ".join(f"w{i}" for i in range(70_000))
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "one", "d"),
         (4, "one", "d"), (None, "ONE", "e"), (5, "one two", None),
         (6, long_text, "x"), (7, long_text + " end", "x"), (8, "É a b", "x")],
        "doc_id long, text string, component_id string")
    got = {(r.doc_id, r.fp): r.component_id
           for r in simhash.near_duplicates(docs).collect()}
    by_id = {k[0]: (np.int64(k[1]).astype(np.uint64), v) for k, v in got.items()}
    assert [by_id[i] for i in (1, 2, 3)] == [(0, 1)] * 3
    assert by_id[4][1] == 4 and by_id[None][1] == 4
    assert by_id[6] [1] == by_id[7][1] == 6
    for i, t in ((4, "one"), (5, "one two"), (8, "É a b"), (6, long_text)):
        assert int(by_id[i][0]) == slow_fingerprint(t)
    kept = sorted(r.doc_id or 0 for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == [0, 1, 4, 4, 5, 6, 8]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0


def test_connected_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 700)] + [(3, 640)]
    got = {r.node: r.root for r in connected_components(
        spark.createDataFrame(path + hub + [(9, 9), (None, 4)], "u long, v long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in [3, *range(500, 700)]} == {3}
    assert 9 not in got


def test_pairs_of_one_tile_spread(spark, monkeypatch):
    """One tile cut into many sub-tiles: the links are those of brute force,
    and the pairs go to many keys."""
    rng = random.Random(11)
    monkeypatch.setattr(simhash, "TILE_ROWS", 16)
    quarter = lambda: sum(1 << b for b in rng.sample(range(16), 8))
    values = {sum(quarter() << 16 * i for i in range(4)) for _ in range(500)}
    for v in rng.sample(sorted(values), 60):    # a swap of two bits keeps the tile
        on = [b for b in range(16) if v >> b & 1]
        off = [b for b in range(16) if not v >> b & 1]
        values.add(v ^ (1 << rng.choice(on)) ^ (1 << rng.choice(off)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    packed = simhash.tiles(fps).collect()
    assert len({(r.q0, r.q1, r.q2, r.q3) for r in packed}) == 1 and len(packed) > 20
    roots = {r.node: r.root for r in simhash.connected_components(simhash.links(fps)).collect()}
    plan = simhash.links(fps)._jdf.queryExecution().optimizedPlan().toString()
    assert "sub#" in plan.split("Join Inner, (", 1)[1].splitlines()[0]
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 3:
                parent[find(b)] = find(a)
    want, got = {}, {}
    for v, s in zip(values, signed):
        want.setdefault(find(v), set()).add(v)
        got.setdefault(roots.get(s, s), set()).add(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))
    assert len(want) < len(values)
