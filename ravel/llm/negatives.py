"""Hard-negative mining by Strassen products of integer tiles.

Vectors become integers (floor of ``SCALE`` times each component). Rows are
packed into tiles of bounded size, anchors and candidates apart; a pair of
tiles is multiplied by Strassen's recursion on int64 matrices, padded with
zeros to even sides, down to ``LEAF``; sums, differences and products of
integers are exact. Two passes over tile pairs:

1. Anchors meet candidates of their own label: the first ``positives`` by score
   are an anchor's positives.
2. Anchors meet all candidates: of those with another label, the first
   ``negatives`` inside each positive's window of scores.

What a pair of tiles finds goes into bounded heaps, arrays of the best (score,
id) per anchor or window. Heaps merge by merging their entries: inside a task
over consecutive pairs of one anchor tile, then, as rows, in a ranking whose
limit Spark also applies before its shuffle.

Scale: the anchors are a stated query set that meets all rows in blocks; no
pair of rows is emitted, only heaps. Both sides travel as packed tiles of
``TILE_ROWS`` rows in the narrowest integer type that holds them. The
candidates' tiles are dealt to as many parts as there are; every anchor tile
visits each part, so a label or a vector that fills a third of the table
spreads over many parts like any other. Nothing is collected but counts.

Edge cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part. The rows of one id are one row, that with the
smallest (label, vector). Vectors of different lengths are padded with zeros
at their end; an empty one scores 0 with everything. Components beyond the
64-bit range saturate, and scores are integers modulo 2^64 (exact while they
fit a long). Ties go to the smaller id. A window of a negative positive score
is empty. With too few candidates all are returned. Extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, pinned, read

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95      # a window, in hundredths of the positive's score
TILE_ROWS = 1024
LEAF = 16               # sides from which the recursion multiplies plainly
TILES_PER_PAIR_BATCH = 8


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of int64 matrices by seven products of half the side."""
    m, k = a.shape
    n = b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    out = np.empty((2 * i, 2 * l), dtype=np.int64)
    c11, c12, c21, c22 = out[:i, :l], out[:i, l:], out[i:, :l], out[i:, l:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


class Heaps:
    """The best ``k`` (score, id) of each of ``n`` owners: higher scores
    first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.zeros((n, 0), dtype=np.int64)
        self.id = np.zeros((n, 0), dtype=np.int64)
        self.used = np.zeros((n, 0), dtype=bool)

    def add(self, score: np.ndarray, ids: np.ndarray, used: np.ndarray) -> None:
        """Merge entries (rows by owner) where ``used``."""
        score = np.concatenate([self.score, score], axis=1)
        ids = np.concatenate([self.id, ids], axis=1)
        used = np.concatenate([self.used, used], axis=1)
        # ~score falls as score rises, without overflow
        order = np.lexsort((ids, ~score, ~used), axis=1)[:, :self.k]
        self.score, self.id, self.used = (np.take_along_axis(x, order, axis=1)
                                          for x in (score, ids, used))

    def entries(self):
        """(owner, score, id) of everything held."""
        owner, at = np.nonzero(self.used)
        return owner, self.score[owner, at], self.id[owner, at]


def first_places(score: np.ndarray, wanted: np.ndarray, k: int):
    """Columns of the first ``k`` wanted entries of each row by falling score,
    then column, and whether there are so many."""
    width = min(k, score.shape[1])
    out = np.zeros((len(score), width), dtype=np.int64)
    used = np.zeros((len(score), width), dtype=bool)
    for r in range(len(score)):
        at = np.flatnonzero(wanted[r])
        if len(at) > width:
            s = score[r, at]
            least = np.partition(s, len(s) - width)[len(s) - width]
            above, equal = at[s > least], at[s == least]
            at = np.concatenate([above, equal[:width - len(above)]])
        at = at[np.lexsort((at, ~score[r, at]))]
        out[r, :len(at)], used[r, :len(at)] = at, True
    return out, used


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str,
                 scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v array<long>) of the rows that take part, one per id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(
        "vec_id is not null and label is not null and v is not null and forall(v, x -> "
        "x is not null and not isnan(x) and abs(x) < double('infinity'))")
    # the double next below 2^63 stands for what a long cannot hold
    whole = F.transform("v", lambda x: F.floor(F.greatest(F.lit(-2.0 ** 63), F.least(
        F.lit(2.0 ** 63 - 1024), x * F.lit(float(scale))))).cast("long"))
    return (rows.withColumn("v", whole).groupBy("vec_id")
            .agg(F.min(F.struct("label", "v")).alias("r"))
            .select("vec_id", "r.label", "r.v"))


def _packed(values: np.ndarray) -> tuple[bytes, int]:
    """Integers in the narrowest of 2, 4 and 8 bytes."""
    for kind in ("<i2", "<i4"):
        info = np.iinfo(kind)
        if not values.size or info.min <= values.min() and values.max() <= info.max:
            return values.astype(kind).tobytes(), np.dtype(kind).itemsize
    return values.astype("<i8").tobytes(), 8


_TILE = "ids binary, labels binary, windows binary, width int, bytes int, data binary"


def tiles(rows: DataFrame, grouped: bool, rows_per_tile: int = TILE_ROWS) -> DataFrame:
    """Tiles (grp long, tile int, and the packed columns) of rows (vec_id, label,
    v and, for anchors of the second pass, ``windows`` array<long> of pairs);
    a tile holds rows of one label if ``grouped``."""
    grp = F.col("label") if grouped else F.lit(0).cast("long")
    rows = rows.withColumn("grp", grp)
    if "windows" not in rows.columns:
        rows = rows.withColumn("windows", F.lit(None).cast("array<long>"))
    if grouped:
        sizes = rows.groupBy("grp").agg(
            F.ceil(F.count(F.lit(1)) / rows_per_tile).cast("int").alias("tiles"))
        rows = rows.join(sizes, "grp")
    else:
        rows = rows.withColumn("tiles", F.lit(max(1, -(-rows.count() // rows_per_tile))))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.col("tiles")).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        sizes = np.array([len(v) for v in table["v"]], dtype=np.int64)
        width = int(sizes.max())
        values = np.zeros((len(sizes), width), dtype=np.int64)
        values[np.arange(width) < sizes[:, None]] = np.asarray(
            table["v"].combine_chunks().flatten(), dtype=np.int64)
        data, size = _packed(values)
        ints = [np.asarray(table[c], dtype="<i8").tobytes() for c in ("vec_id", "label")]
        windows = None
        if table["windows"].null_count < len(sizes):
            # (label score pairs) padded to one length: id, score, used
            found = table["windows"].to_pylist()
            most = max(len(w) for w in found) // 2
            grid = np.zeros((len(sizes), most, 3), dtype="<i8")
            for r, w in enumerate(found):
                grid[r, :len(w) // 2, :2] = np.array(w, dtype=np.int64).reshape(-1, 2)
                grid[r, :len(w) // 2, 2] = 1
            windows = grid.tobytes()
        return pa.table({"grp": pa.array([table["grp"][0].as_py()], pa.int64()),
                         "tile": pa.array([table["tile"][0].as_py()], pa.int32()),
                         "tiles": pa.array([table["tiles"][0].as_py()], pa.int32()),
                         "ids": pa.array([ints[0]], pa.binary()),
                         "labels": pa.array([ints[1]], pa.binary()),
                         "windows": pa.array([windows], pa.binary()),
                         "width": pa.array([width], pa.int32()),
                         "bytes": pa.array([size], pa.int32()),
                         "data": pa.array([data], pa.binary())})

    return (rows.select("grp", "tile", "tiles", "vec_id", "label", "v", "windows")
            .groupBy("grp", "tile").applyInArrow(pack, f"grp long, tile int, tiles int, {_TILE}"))


class _Tile:
    def __init__(self, row: dict, side: str):
        self.key = row["grp"], row[f"{side}tile"]
        self.ids, self.labels = (np.frombuffer(row[f"{side}{c}"], dtype="<i8")
                                 for c in ("ids", "labels"))
        kind = f"<i{row[f'{side}bytes']}"
        self.data = np.frombuffer(row[f"{side}data"], dtype=kind).astype(np.int64) \
            .reshape(len(self.ids), row[f"{side}width"])
        if row.get(f"{side}windows") is not None:
            self.windows = np.frombuffer(row[f"{side}windows"], dtype="<i8") \
                .reshape(len(self.ids), -1, 3)


def _scores(a: _Tile, b: _Tile) -> np.ndarray:
    width = max(a.data.shape[1], b.data.shape[1])
    left, right = (np.pad(t.data, ((0, 0), (0, width - t.data.shape[1]))) for t in (a, b))
    return strassen(left, right.T)


def positive_heaps(a: _Tile, b: _Tile, heaps: Heaps | None, k: int) -> Heaps:
    """Anchors' best other rows of their own label."""
    heaps = heaps or Heaps(len(a.ids), k)
    score = _scores(a, b)
    wanted = (a.labels[:, None] == b.labels) & (a.ids[:, None] != b.ids)
    at, used = first_places(score, wanted, k)
    heaps.add(np.take_along_axis(score, at, axis=1), b.ids[at], used)
    return heaps


def window_heaps(a: _Tile, b: _Tile, heaps: Heaps | None, k: int, low: int,
                 high: int) -> Heaps:
    """Best rows of another label inside the window of each anchor's positive;
    an owner is (anchor, positive) in order."""
    n, most = a.windows.shape[:2]
    heaps = heaps or Heaps(n * most, k)
    score = _scores(a, b)
    # low * p <= 100 * s <= high * p, in whole numbers
    least = -(-low * a.windows[:, :, 1] // 100)
    greatest = high * a.windows[:, :, 1] // 100
    other = a.labels[:, None] != b.labels
    width = min(k, len(b.ids))
    at, used = np.zeros((n * most, width), dtype=np.int64), np.zeros((n * most, width), dtype=bool)
    for p in range(most):
        inside = other & (score >= least[:, p, None]) & (score <= greatest[:, p, None]) \
            & (a.windows[:, p, 2] > 0)[:, None]
        at[p::most], used[p::most] = first_places(score, inside, k)
    owner = np.repeat(np.arange(n), most)[:, None]
    heaps.add(score[owner, at], b.ids[at], used)
    return heaps


def _meet(left: DataFrame, right: DataFrame, step, emit, schema: str) -> DataFrame:
    """Every tile of ``left`` with every tile of ``right`` in its group, by
    ``step``; ``emit`` gives the rows of an anchor tile's heaps."""
    # a part of the right side is one tile: each left tile visits them all
    parts = right.groupBy("grp").agg(F.max("tiles").alias("parts"))
    sides = (left.join(parts, "grp")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("grp", "part", *[F.col(c).alias(f"a_{c}") for c in
                                      ("tile", "ids", "labels", "windows", "width", "bytes", "data")]))
    pairs = sides.join(right.select("grp", F.col("tile").alias("part"), F.col("tile").alias("b_tile"),
                                    *[F.col(c).alias(f"b_{c}") for c in
                                      ("ids", "labels", "width", "bytes", "data")]),
                       ["grp", "part"])

    def run(batches):
        a = heaps = None
        for batch in batches:
            for at in range(0, batch.num_rows, TILES_PER_PAIR_BATCH):
                for row in batch.slice(at, TILES_PER_PAIR_BATCH).to_pylist():
                    if a is None or a.key != (row["grp"], row["a_tile"]):
                        if a is not None:
                            yield emit(a, heaps)
                        a, heaps = _Tile(row, "a_"), None
                    heaps = step(a, _Tile(row, "b_"), heaps)
        if a is not None:
            yield emit(a, heaps)

    return pairs.mapInArrow(run, schema)


def mine(vectors: DataFrame, anchors, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         rows_per_tile: int = TILE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); ``anchors`` is a condition on ``vec_id``."""
    bound_batches(vectors.sparkSession)
    rows = pinned(integer_rows(vectors, id_col, vec_col, label_col, scale))
    asked = rows.where(anchors)

    def by_anchor(a, heaps):
        owner, score, ids = heaps.entries()
        return pa.RecordBatch.from_arrays(
            [pa.array(a.ids[owner]), pa.array(ids), pa.array(score)],
            ["anchor_id", "positive_id", "positive_score"])

    found = _meet(tiles(asked, True, rows_per_tile), tiles(rows, True, rows_per_tile),
                  lambda a, b, h: positive_heaps(a, b, h, positives), by_anchor,
                  "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = (found.withColumn("r", F.row_number().over(best))
             .where(F.col("r") <= positives).drop("r"))
    # a bounded list of (id, score) pairs per anchor
    windows = found.groupBy("anchor_id").agg(F.flatten(F.sort_array(F.collect_list(
        F.array("positive_id", "positive_score")))).alias("windows"))
    asked = pinned(asked.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))

    def by_window(a, heaps):
        owner, score, ids = heaps.entries()
        anchor, positive = np.divmod(owner, a.windows.shape[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(a.ids[anchor]), pa.array(a.windows[anchor, positive, 0]),
             pa.array(ids), pa.array(a.windows[anchor, positive, 1]), pa.array(score)],
            ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    out = _meet(tiles(asked, False, rows_per_tile), tiles(rows, False, rows_per_tile),
                lambda a, b, h: window_heaps(a, b, h, negatives, low, high), by_window,
                "anchor_id long, positive_id long, negative_id long, positive_score long, "
                "negative_score long")
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id")
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``embeddings``: ids divisible by 50 are anchors;
    ids divisible by 7 carry the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return mine(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLE = {"op12_hard_negatives": f"""
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         list_dot_product(a.v, c.v)::bigint as score
  from r a join r c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES})
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id
                           order by s.score desc, s.vec_id))::int as rank,
       s.vec_id as negative_id, positive_score, s.score as negative_score
from p join s using (anchor_id)
where not s.same and {LOW} * positive_score <= 100 * s.score
  and 100 * s.score <= {HIGH} * positive_score
qualify rank <= {NEGATIVES}
"""}
