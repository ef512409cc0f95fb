"""SimHash near-dedup by tiled exact comparison.

Every document gets a 64-bit SimHash of its word shingles. Distinct
fingerprints are put into tiles by the population counts of their four
16-bit quarters; a tile pair is only compared when those counts differ by no
more than the radius in sum (a lower bound of the bit distance, so no link is
lost). Inside a pair numpy takes the exclusive-or of all rows against all
rows and counts bits; it emits a spanning forest of the pair's links, never
all links, and the forests are joined by connected components.

Scale: rows that cross the network are (doc_id, fingerprint) pairs and packed
tiles, never texts. A tile is cut into sub-tiles of about ``TILE_ROWS`` rows,
and a sub-tile meets each other one by a key of its own, so no task holds an
unbounded group or all pairs of a tile; copies share one fingerprint and enter
the comparison once. The comparison itself is quadratic in the number of
distinct fingerprints, by the method; the quarter counts skip about 95 % of
the pairs.

Edge cases: a null or empty text, or one of white space only, has fingerprint
zero and is linked like any other. A text with fewer words than a shingle is
one shingle. A null id takes part in links but never names a component; a
component whose ids are all null has a null name. Rows that repeat an id are
separate rows of the result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, connected_components, pinned, read

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
# Rows of a sub-tile: a pair is at most about 4096 x 4096 comparisons.
TILE_ROWS = 4096
_BLOCK = 512          # rows of a tile compared at once (bounds the xor matrix)
_HASH_BLOCK = 65536   # shingle hashes whose bits are unpacked at once


def text_fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(lens) - 1
        starts = ends - lens + 1
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a:b], SEED) for a, b in
                  zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _HASH_BLOCK):
        part = np.array(hashes[at:at + _HASH_BLOCK], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    on = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(on.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id long, fp long): the SimHash of every row, as a signed long."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.fromiter((text_fingerprint(t, shingle) for t in b["text"]),
                             dtype=np.uint64, count=len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp.view(np.int64)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    # nullable ids would turn into floats in pandas; carry them as text
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (rows.mapInPandas(run, "doc_id string, fp long")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "fp"))


def _quarters(fp):
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)))
            for i in range(4)]


def _offsets(radius: int) -> list[tuple[int, int, int, int]]:
    """Differences of quarter counts within the radius; one of each pair of
    opposite ones."""
    r = range(-radius, radius + 1)
    return [o for o in ((a, b, c, d) for a in r for b in r for c in r for d in r)
            if sum(map(abs, o)) <= radius and o >= (0, 0, 0, 0)]


def tiles(fps: DataFrame) -> DataFrame:
    """Packed sub-tiles (q0..q3, sub, rows array<long>) of distinct ``fp``."""
    spark = fps.sparkSession
    q = ["q0", "q1", "q2", "q3"]
    rows = fps.select("fp", *[c.alias(n) for c, n in zip(_quarters(F.col("fp")), q)])
    # at most 17^4 = 83,521 tiles exist: this table has a proven bound
    sizes = rows.groupBy(*q).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS)).cast("int").alias("subs"))
    return (rows.join(F.broadcast(sizes), q)
            .withColumn("sub", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("subs")).cast("int"))
            .groupBy(*q, "sub").agg(F.sort_array(F.collect_list("fp")).alias("rows")))


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int):
    """Links of a tile pair reduced to a spanning forest, as index pairs into
    the concatenation of ``a`` and ``b``."""
    n = len(a)
    parent = list(range(n + (0 if same else len(b))))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    base = 0 if same else n
    for at in range(0, n, _BLOCK):
        part = a[at:at + _BLOCK]
        near = np.bitwise_count(part[:, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = i + at, j + base
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        while len(i):
            # one link of each row and of each column, then whatever these
            # did not already connect
            first = np.union1d(np.unique(i, return_index=True)[1],
                               np.unique(j, return_index=True)[1])
            for x, y in zip(i[first].tolist(), j[first].tolist()):
                rx, ry = find(x), find(y)
                if rx != ry:
                    parent[max(rx, ry)] = min(rx, ry)
                    out.append((x, y))
            nodes, back = np.unique(np.concatenate([i, j]), return_inverse=True)
            roots = np.fromiter((find(x) for x in nodes.tolist()), dtype=np.int64,
                                count=len(nodes))[back]
            left = roots[:len(i)] != roots[len(i):]
            i, j = i[left], j[left]
    return out


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links that connect the distinct ``fp`` values of ``fps`` exactly
    as all pairs within ``radius`` bits would."""
    q = ["q0", "q1", "q2", "q3"]
    packed = pinned(tiles(fps))
    # sub-tiles of each tile: at most 17^4 rows, a proven bound
    subs = packed.groupBy(*q).agg(F.max("sub").alias("last"))
    offs = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(o)])
                     for o in _offsets(radius)])
    left = (packed.select("*", F.explode(offs).alias("o"))
            .select(*[(F.col(f"q{i}") + F.col(f"o.d{i}")).cast("int").alias(f"q{i}")
                      for i in range(4)],
                    F.col("sub").alias("sub_a"), F.col("rows").alias("a"),
                    (F.col("o.d0") + F.col("o.d1") * 7 + F.col("o.d2") * 49
                     + F.col("o.d3") * 343 == 0).alias("same_tile")))
    # a copy for each sub-tile it meets: the pairs of one tile are many keys
    first = F.when(F.col("same_tile"), F.col("sub_a")).otherwise(0)
    left = left.join(F.broadcast(subs), q).select(
        *q, "sub_a", "a", "same_tile",
        F.explode(F.when(first <= F.col("last"), F.sequence(first, F.col("last")))).alias("sub"))
    pairs = (left.join(packed.withColumnRenamed("rows", "b"), [*q, "sub"])
             .select("a", "b", F.expr("same_tile and sub_a = sub").alias("same")))

    def run(batches):
        for batch in batches:
            u, v = [], []
            for a, b, same in zip(batch["a"], batch["b"], batch["same"]):
                a = np.asarray(a, dtype=np.int64)
                b = a if same else np.asarray(b, dtype=np.int64)
                every = a if same else np.concatenate([a, b])
                for x, y in _forest(a.view(np.uint64), b.view(np.uint64), same, radius):
                    u.append(every[x])
                    v.append(every[y])
            yield pd.DataFrame({"u": np.array(u, dtype=np.int64),
                                "v": np.array(v, dtype=np.int64)})

    return pairs.mapInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    fps = pinned(fingerprints(docs, id_col, text_col, shingle))
    nodes = pinned(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(links(nodes.select("fp"), radius))
    named = (nodes.join(roots, nodes.fp == roots.node, "left")
             .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                         radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the smallest doc_id. Rows
    without an id cannot be named as copies and stay; rows that repeat an id
    are one document and stay or go together."""
    lost = (near_duplicates(docs, shingle=shingle, radius=radius)
            .where("doc_id <> component_id").select("doc_id").distinct())
    return docs.join(lost, "doc_id", "left_anti")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``documents``."""
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id",
                      F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")


QUERIES = {"op9_simhash": op9_simhash}
ORACLE: dict[str, str] = {}
