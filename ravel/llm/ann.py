"""Nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample of distinct vectors. Every distinct
vector is put into the leaf it descends to; leaves are cut into blocks of
bounded size. A query walks the tree best-bin-first: a priority queue of
subtrees ordered by a lower bound of their distance yields leaves one by one.
How many leaves a query visits is calibrated: for a sample of rows the true
neighbours are found by brute force over all rows, and visits widen until the
share of them in the visited leaves reaches ``RECALL``. A query goes on while
its leaves hold fewer vectors than it needs. Distances are then exact, in
double precision.

Scale: equal vectors are one vector with the smallest ids that could be among
the neighbours, so a vector that fills a third of the table costs one row;
queries with equal vectors are searched once. Neighbouring leaves share a bin;
vectors and queries meet in partitions sorted by (bin, block, chunk): a block's
vectors, of bounded number, come first and are held, its queries stream past them
and each leaves with its k + 1 nearest. A block is copied only where more than
``CHUNK_QUERIES`` queries visit it. What is broadcast is the tree
(at most ``MAX_LEAVES`` leaves) and counts per leaf. The number of leaves
follows the table until that bound; beyond it leaves hold more blocks.

Edge cases: a vector that is null, empty, zero, or holds a null or non-finite
component takes no part, nor does one whose length is not the most common one.
Null ids take no part. An id is one candidate and one query, whether its rows
repeat a vector or hold several: its distance to another id is the smallest
between a vector of the one and a vector of the other. A query never finds its
own id. With fewer than k candidates all are returned. Ties go to the smaller id. Extra columns are
ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, partitions, pinned, read

K = 10
LEAF_ROWS = 64          # distinct vectors a leaf, about
MAX_LEAVES = 16_384
SAMPLE = 65_536         # distinct vectors the tree is fitted on, about
SAMPLE_BYTES = 64 << 20  # and bytes of their components
BRANCH = 8
ROUNDS = 8              # k-means rounds at a node
RECALL = 0.97
CALIBRATION = 128       # rows whose true neighbours are found by brute force
BLOCK_ROWS = 2048       # vectors a task holds at once, about
CHUNK_QUERIES = 1 << 18  # queries that meet one copy of a block, about


class Tree:
    """Nodes as arrays: children[i] lists node numbers, empty for a leaf."""

    def __init__(self, points: np.ndarray, leaves: int, branch: int = BRANCH, seed: int = 1):
        self.centres = [points.mean(axis=0) if len(points) else np.zeros(0)]
        self.children: list[list[int]] = [[]]
        rng = np.random.default_rng(seed)
        n_leaves = 1
        # split the node with most points until there are enough leaves
        heap = [(-len(points), 0, points)]
        while heap and n_leaves < leaves:
            size, node, own = heapq.heappop(heap)
            k = min(branch, leaves - n_leaves + 1, len(own))
            if k < 2:
                continue
            centres, label = kmeans(own, k, rng)
            groups = [own[label == j] for j in range(len(centres))]
            if sum(len(g) > 0 for g in groups) < 2:
                continue
            for c, g in zip(centres, groups):
                if len(g):
                    self.children[node].append(len(self.centres))
                    heapq.heappush(heap, (-len(g), len(self.centres), g))
                    self.centres.append(c)
                    self.children.append([])
            n_leaves += len(self.children[node]) - 1
        self.centres = np.array(self.centres)
        self.leaves = [i for i, c in enumerate(self.children) if not c]
        self.number = {node: j for j, node in enumerate(self.leaves)}

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of every row: descend to the nearest child."""
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.number[node]
                continue
            near = _square_distances(x[rows], self.centres[kids]).argmin(axis=1)
            todo += [(kid, rows[near == j]) for j, kid in enumerate(kids) if (near == j).any()]
        return out

    def in_order(self):
        """Leaf numbers in depth-first order, so that neighbours are close."""
        todo = [0]
        while todo:
            node = todo.pop()
            if self.children[node]:
                todo += reversed(self.children[node])
            else:
                yield self.number[node]

    def visit(self, q: np.ndarray):
        """Leaf numbers, best bin first. A subtree's bound is the distance to
        the border between its centre and its nearest sibling's, at least its
        parent's bound."""
        heap = [(0.0, 0.0, 0)]
        while heap:
            bound, _, node = heapq.heappop(heap)
            kids = self.children[node]
            if not kids:
                yield self.number[node]
                continue
            c = self.centres[kids]
            d = ((c - q) ** 2).sum(axis=1)
            j = int(d.argmin())
            gap = np.sqrt(((c - c[j]) ** 2).sum(axis=1))
            border = np.maximum(d - d[j], 0) / np.maximum(2 * gap, 1e-300)
            for i, kid in enumerate(kids):
                heapq.heappush(heap, (max(bound, float(border[i])), float(d[i]), kid))


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a ** 2).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b ** 2).sum(axis=1)[None, :]


def kmeans(x: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        label = _square_distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, x)
        n = np.bincount(label, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres, _square_distances(x, centres).argmin(axis=1)


def _matrix(col, dim: int) -> np.ndarray:
    return np.array(col.tolist(), dtype=np.float64).reshape(len(col), dim)


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of one query, the measure itself in doubles."""
    return np.sqrt(((x - q) ** 2).sum(axis=1))


def nearest_ids(d: np.ndarray, ids: list, k: int) -> list[tuple[float, int]]:
    """The ``k`` nearest different ids, (distance, id), of vectors at distances
    ``d`` that each belong to a sorted list of ids."""
    at = k
    while True:
        limit = np.partition(d, at - 1)[at - 1] if at < len(d) else np.inf
        best: dict[int, float] = {}
        for j in np.flatnonzero(d <= limit).tolist():
            for i in ids[j][:k].tolist():
                if d[j] < best.get(i, np.inf):
                    best[i] = float(d[j])
        if len(best) >= k or at >= len(d):
            return heapq.nsmallest(k, ((x, i) for i, x in best.items()))
        at *= 4


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(vec_id, v array<double>) of the rows that take part, and their length."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(
        "vec_id is not null and v is not null and size(v) > 0 "
        "and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(v, x -> x <> 0)")
    sizes = rows.groupBy(F.size("v").alias("d")).count() \
        .orderBy(F.desc("count"), "d").limit(1).collect()
    dim = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("v") == dim), dim


def _keyed(rows: DataFrame) -> DataFrame:
    """With ``key``: equal vectors have equal keys (zero has one sign)."""
    plain = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    return rows.withColumn("v", plain).withColumn("key", F.sha2(F.to_json(F.struct("v")), 256))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(key, v, ids): one row per distinct vector with its ``keep`` smallest
    ids; more of them cannot be among the nearest of anything."""
    first = Window.partitionBy("key").orderBy("vec_id")
    return (_keyed(rows).select("key", "v", "vec_id")
            .withColumn("rank", F.dense_rank().over(first)).where(F.col("rank") <= keep)
            .groupBy("key").agg(F.first("v").alias("v"),
                                F.sort_array(F.collect_set("vec_id")).alias("ids")))


class Index:
    """Tree, leaf sizes, calibrated visits and the vectors by leaf."""

    def __init__(self, vectors: DataFrame, k: int = K, id_col: str = "vec_id",
                 vec_col: str = "embedding"):
        spark = vectors.sparkSession
        bound_batches(spark, 4096)
        self.spark, self.k = spark, k
        rows, self.dim = usable(vectors, id_col, vec_col)
        self.distinct = pinned(distinct_vectors(rows, k + 1))
        n = self.distinct.count()
        # so many vectors surely belong to more than k ids
        most = (self.distinct.select(F.explode("ids").alias("id")).groupBy("id").count()
                .agg(F.max("count").alias("n")).first().n) or 1
        self.repeats, self.enough = most > 1, (k + 1) * most
        share = min(1.0, min(SAMPLE, SAMPLE_BYTES / (8 * max(self.dim, 1))) / max(n, 1))
        sample = self.distinct.where(
            F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)))
        points = sample.orderBy("key").select("v").toArrow()["v"].combine_chunks()
        points = points.flatten().to_numpy().reshape(len(points), self.dim)
        self.tree = Tree(points, min(MAX_LEAVES, max(1, math.ceil(n / LEAF_ROWS))))
        self.shared = spark.sparkContext.broadcast(self.tree)
        rows = pinned(self._with_leaf(self.distinct))
        self.sizes = {r.leaf: r["count"] for r in rows.groupBy("leaf").count().collect()}
        self.bins = self._bins()
        self.rows = rows.join(F.broadcast(spark.createDataFrame(
            list(self.bins.items()), "leaf int, bin int")), "leaf")
        self.visits = self._calibrate(n)

    def _bins(self) -> dict[int, int]:
        """Leaves that follow one another in the tree share a bin of about
        BLOCK_ROWS vectors; a larger leaf has a bin of its own."""
        bins, at, held = {}, 0, 0
        for leaf in self.tree.in_order():
            if leaf not in self.sizes:
                continue
            if held and held + self.sizes[leaf] > BLOCK_ROWS:
                at, held = at + 1, 0
            bins[leaf] = at
            held += self.sizes[leaf]
        return bins

    def _with_leaf(self, rows: DataFrame) -> DataFrame:
        tree, dim = self.shared, self.dim

        def run(batches):
            for b in batches:
                yield b.assign(leaf=tree.value.assign(_matrix(b["v"], dim)))

        return rows.mapInPandas(run, "key string, v array<double>, ids array<long>, leaf int")

    def _calibrate(self, n: int) -> int:
        """Leaves to visit so that ``RECALL`` of the true neighbours of sample
        rows lie in them; brute force over all vectors, in blocks."""
        share = min(1.0, CALIBRATION / max(n, 1))
        probes = [(r.key, r.v) for r in self.distinct.where(
            F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
            .select("key", "v").collect()]
        if not probes:
            return 1
        shared, k, dim = self.spark.sparkContext.broadcast(probes), self.k, self.dim

        def run(batches):
            best = [[] for _ in shared.value]
            for b in batches:
                x, keys, leaf = _matrix(b["v"], dim), b["key"].to_numpy(), b["leaf"].to_numpy()
                for i, (key, q) in enumerate(shared.value):
                    d = _distances(np.array(q), x)
                    d[keys == key] = np.inf
                    top = np.argpartition(d, min(k, len(d) - 1))[:k]
                    best[i] = heapq.nsmallest(
                        k, best[i] + [(float(d[j]), int(leaf[j])) for j in top if d[j] < np.inf])
            yield pd.DataFrame([(i, d, leaf) for i, b in enumerate(best) for d, leaf in b],
                               columns=["probe", "d", "leaf"])

        near = self.rows.select("key", "v", "leaf").mapInPandas(
            run, "probe int, d double, leaf int")
        nearest = Window.partitionBy("probe").orderBy("d", "leaf")
        near = near.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k)
        true: dict[int, list] = {}
        for r in near.collect():        # k rows a probe
            true.setdefault(r.probe, []).append((r.d, r.leaf))
        ranks = []
        for i, found in true.items():
            want = [leaf for _, leaf in sorted(found)[:k]]
            left = set(want)
            at = {}
            for rank, leaf in enumerate(self.tree.visit(np.array(probes[i][1]))):
                at[leaf] = rank
                left.discard(leaf)
                if not left:
                    break
            ranks += [at[leaf] for leaf in want]
        if not ranks:
            return 1
        visits = 1
        while np.mean(np.array(ranks) < visits) < RECALL:
            visits = min(len(self.tree.leaves), max(visits + 1, math.ceil(visits * 1.1)))
        return visits

    def search(self, queries: DataFrame, id_col: str = "vec_id",
               vec_col: str = "embedding") -> DataFrame:
        """(query_id, rank, vec_id, score) for every usable query row."""
        k, dim, enough = self.k, self.dim, self.enough
        tree, visits = self.shared, self.visits
        rows, _ = usable(queries, id_col, vec_col)
        asked = pinned(_keyed(rows.where(F.size("v") == dim)))
        sizes = self.spark.sparkContext.broadcast(self.sizes)
        # a tree walk is work for a processor: distinct queries are dealt evenly
        once = asked.groupBy("key").agg(F.first("v").alias("v")) \
            .repartition(partitions(self.spark))

        bins = self.spark.sparkContext.broadcast(self.bins)

        def plan(batches):
            """The leaves a query visits, gathered by bin."""
            for b in batches:
                out = []
                for key, q in zip(b["key"], _matrix(b["v"], dim)):
                    held, mine = 0, {}
                    for n, leaf in enumerate(tree.value.visit(q)):
                        if n >= visits and held >= enough:
                            break
                        if sizes.value.get(leaf):
                            mine.setdefault(bins.value[leaf], []).append(leaf)
                            held += sizes.value[leaf]
                    out += [(key, q, at, leaves) for at, leaves in mine.items()]
                yield pd.DataFrame(out, columns=["key", "v", "bin", "leaves"])

        visited = pinned(once.mapInPandas(
            plan, "key string, v array<double>, bin int, leaves array<int>"))
        # a bin's vectors are cut into blocks; its queries, streamed, only
        # into chunks so large that copying a block for each costs little
        parts = visited.groupBy("bin").agg(
            F.ceil(F.count(F.lit(1)) / CHUNK_QUERIES).cast("int").alias("chunks"))
        in_bin: dict[int, int] = {}
        for leaf, at in self.bins.items():
            in_bin[at] = in_bin.get(at, 0) + self.sizes[leaf]
        held = self.spark.createDataFrame(
            [(at, math.ceil(n / BLOCK_ROWS)) for at, n in in_bin.items()], "bin int, blocks int")
        cuts = F.broadcast(parts.join(held, "bin"))      # at most MAX_LEAVES rows
        left = (visited.join(cuts, "bin")
                .withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("bin", "block", "chunk", F.lit(1).alias("side"), "key", "v", "leaves",
                        F.lit(None).cast("int").alias("leaf"),
                        F.lit(None).cast("array<long>").alias("ids")))
        right = (self.rows.join(cuts, "bin")
                 .withColumn("block", F.pmod(F.xxhash64("key", F.lit(9)), F.col("blocks"))
                             .cast("int"))
                 .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                 .select("bin", "block", "chunk", F.lit(0).alias("side"),
                         F.lit(None).cast("string").alias("key"), "v",
                         F.lit(None).cast("array<int>").alias("leaves"), "leaf", "ids"))

        by = ["bin", "block", "chunk"]

        def meet(batches):
            """The k + 1 nearest ids of each query among its leaves' vectors;
            every group's vectors come before its queries."""
            group, parts, held = None, [], None
            for b in batches:
                out = []
                for at, rows in b.groupby(by, sort=False):
                    if at != group:
                        group, parts, held = at, [], None
                    x, q = rows[rows["side"] == 0], rows[rows["side"] == 1]
                    if len(x):
                        parts.append((_matrix(x["v"], dim), x["leaf"].to_numpy(dtype=np.int32),
                                      [np.asarray(i) for i in x["ids"]]))
                    if not len(q) or not parts:
                        continue
                    if held is None:
                        held = (np.concatenate([m for m, _, _ in parts]),
                                np.concatenate([leaf for _, leaf, _ in parts]),
                                [i for _, _, ids in parts for i in ids])
                        parts = [held]
                    m, leaf, ids = held
                    for key, v, leaves in zip(q["key"], _matrix(q["v"], dim), q["leaves"]):
                        own = np.flatnonzero(np.isin(leaf, leaves))
                        if len(own):
                            d = _distances(v, m[own])
                            out += [(key, *x) for x in
                                    nearest_ids(d, [ids[j] for j in own], k + 1)]
                yield pd.DataFrame(out, columns=["key", "score", "vec_id"])

        met = (right.unionByName(left).repartition(partitions(self.spark), *by)
               .sortWithinPartitions(*by, "side")
               .mapInPandas(meet, "key string, score double, vec_id long"))
        if self.repeats:        # an id's nearest vector counts
            met = met.groupBy("key", "vec_id").agg(F.min("score").alias("score"))
        by_key = Window.partitionBy("key").orderBy("score", "vec_id")
        nearest = met.withColumn("r", F.row_number().over(by_key)).where(F.col("r") <= k + 1)
        own = asked.select("key", F.col("vec_id").alias("query_id")).distinct()
        found = (own.join(nearest, "key").where("query_id <> vec_id")
                 .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
        by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return (found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``embeddings``: ids divisible by 100 search all."""
    vectors = read(spark, sf_dir, "embeddings")
    return Index(vectors).search(vectors.where(F.col("vec_id") % 100 == 0))


QUERIES = {"op1_ann": op1_ann}
ORACLE: dict[str, str] = {}
