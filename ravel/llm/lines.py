"""Line dedup over levelled sorted runs of line hashes (DataFrame/SQL only).

A line's key is the line stripped of ASCII white space with A-Z lower-cased;
keys of at least ``MIN_CHARS`` code points count. Documents come in batches by
falling id. A batch's keys are aggregated (documents holding the key, largest
id) and merge-anti-joined with the sorted runs written so far: keys found in
no run are new, and the batch names their keeper, the largest id; keys found
are only counted. The batch then adds its own run. Runs are bucketed and
sorted by hash, so joins against them and compactions move no run again; when
a level holds ``FANOUT`` runs they are merged into one run of the next level.
A key held by at least ``min_docs`` documents loses its lines everywhere but
in its keeper.

Scale: one pass hashes the texts; the rows that cross the network are 128-bit
hashes with the id and position. A line in a third of all documents is counted
by partial aggregation and its decision reaches the documents by a join whose
hot side Spark may split. Texts meet their dropped positions in one join by id.

Edge cases: a null or empty text is one empty line. Every row is a document,
rows that repeat an id included; equal rows get equal results. A row with a
null id counts as a document and is never the keeper while a key has a holder
with an id; if all holders lack ids, their lines stay. Extra columns pass
through unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import partitions, pinned, read
from ravel.session import remove_path, scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["h1", "h2"]


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_SPACE))
    # lower() equals the A-Z rule on pure ASCII and is several times faster
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)) \
        .otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, th, h1, h2, pos, first): the keyed lines of every row; ``th``
    tells apart rows that repeat an id, ``first`` marks the first line of a
    key in its row."""
    keys = F.transform(text_lines(F.col("text")), line_key)
    hashes = F.transform(keys, lambda k, i: F.when(
        F.char_length(k) >= min_chars,
        F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("line"), k).alias("h2"),
                 i.alias("pos"))))
    rows = docs.select("id", "th", F.sort_array(F.filter(hashes, lambda s: s.isNotNull()))
                       .alias("s"))
    marked = F.transform("s", lambda x, i: F.struct(
        x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"),
        ((i == 0) | (F.get("s", i - 1)["h1"] != x["h1"])
         | (F.get("s", i - 1)["h2"] != x["h2"])).alias("first")))
    return rows.select("id", "th", F.inline(marked))


class LineRuns:
    """The levelled runs: rows (h1, h2, n_docs, keeper), unique by key inside
    a run. ``n_docs`` adds up over runs; ``keeper`` is set in the run of the
    batch that met the key first and null in later ones."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark = spark
        self.fanout = fanout
        self.levels: list[list[tuple[str, str]]] = []
        self._made: set[tuple[str, str]] = set()    # tables there may be

    def add(self, batch: DataFrame) -> None:
        """Add a batch of (h1, h2, id), one row per key and document; every
        id must be smaller than those of earlier batches (or null)."""
        keys = batch.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.max("id").alias("keeper"))
        seen = []
        for level in self.levels:
            for name, _ in level:
                flag = f"seen{len(seen)}"
                run = self.spark.table(name).select(*_KEY, F.lit(True).alias(flag))
                keys = keys.join(run, _KEY, "left")
                seen.append(F.col(flag).isNull())
        new = F.lit(True)
        for s in seen:
            new = new & s
        self._push(0, keys.select(*_KEY, "n_docs", F.when(new, F.col("keeper")).alias("keeper")))

    def _push(self, at: int, run: DataFrame) -> None:
        if len(self.levels) <= at:
            self.levels.append([])
        self.levels[at].append(self._write(run))
        if len(self.levels[at]) >= self.fanout:
            old, self.levels[at] = self.levels[at], []
            self._push(at + 1, self._merge(old))
            self._drop(old)

    def _write(self, run: DataFrame) -> tuple[str, str]:
        name = f"ravel_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        self._made.add((name, path))
        (run.write.format("parquet").option("path", path)
         .bucketBy(partitions(self.spark), *_KEY).sortBy(*_KEY).saveAsTable(name))
        return name, path

    def _merge(self, runs: list[tuple[str, str]]) -> DataFrame:
        """Merge join of sorted runs; counts add up, the one keeper stays."""
        out = self.spark.table(runs[0][0])
        for name, _ in runs[1:]:
            b = self.spark.table(name).withColumnsRenamed({"n_docs": "n2", "keeper": "k2"})
            out = (out.join(b, _KEY, "full")
                   .select(*_KEY, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n2", F.lit(0)))
                           .alias("n_docs"), F.coalesce("keeper", "k2").alias("keeper")))
        return out

    def merged(self) -> DataFrame:
        return self._merge([r for level in self.levels for r in level])

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove_path(self.spark, path)
            self._made.discard((name, path))

    def close(self) -> None:
        """Drop every run, one whose writing failed too."""
        self._drop(list(self._made))
        self.levels = []


def _batch_number(docs: DataFrame, batches: int) -> Column:
    """0 for the largest ids; null ids come last. Any cut is right: the cuts
    only balance the batches, so approximate quantiles serve."""
    at = [i / batches for i in range(1, batches)]
    number = F.lit(0)
    for c in docs.approxQuantile("id", at, 0.01) if at else []:
        number = number + F.when(F.col("id") >= F.lit(c), 0).otherwise(1)
    return number


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(id, th, drops array<int>): positions to drop, rows with any only."""
    spark = docs.sparkSession
    staged_path = scratch_path(spark, "lines")
    runs = LineRuns(spark)
    number = _batch_number(docs, batches)
    try:
        (_hashed_lines(docs, min_chars).withColumn("batch", number)
         .write.partitionBy("batch").parquet(staged_path))
        staged = spark.read.schema("id long, th long, h1 long, h2 long, pos int, "
                                   "first boolean, batch int").parquet(staged_path)
        for b in range(batches):
            runs.add(staged.where((F.col("batch") == b) & F.col("first")).select(*_KEY, "id"))
        hot = pinned(runs.merged().where((F.col("n_docs") >= min_docs)
                                         & F.col("keeper").isNotNull()).select(*_KEY, "keeper"))
        runs.close()
        return pinned(staged.join(hot, _KEY)
                      .where(F.col("id").isNull() | (F.col("id") < F.col("keeper")))
                      .groupBy("id", "th")
                      .agg(F.sort_array(F.collect_set("pos")).alias("drops")))
    finally:
        runs.close()
        remove_path(spark, staged_path)


def _kept_text(lines: Column, drops: Column) -> Column:
    """The lines at other positions, joined: slices between dropped ones."""
    edges = F.concat(F.array(F.lit(-1)), drops, F.array(F.size(lines)))
    parts = F.transform(F.sequence(F.lit(0), F.size(edges) - 2), lambda i: F.slice(
        lines, F.get(edges, i) + 2, F.get(edges, i + 1) - F.get(edges, i) - 1))
    return F.array_join(F.flatten(parts), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                batches: int = BATCHES) -> DataFrame:
    """The columns of ``docs`` (the text without its dropped lines) inside a
    struct ``doc``, with ``n_lines`` (before dropping) and ``n_dropped``."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text_hash.alias("th"),
                        F.col(text_col).alias("text"))
    drops = dropped_positions(keyed, min_chars, min_docs, batches) \
        .withColumnsRenamed({"id": "drop_id", "th": "drop_th"})
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    rows = rows.join(drops, F.col(f"doc.{id_col}").cast("long").eqNullSafe(F.col("drop_id"))
                     & (F.xxhash64(F.coalesce(F.col(f"doc.{text_col}"), F.lit("")))
                        == F.col("drop_th")), "left")
    text = F.col(f"doc.{text_col}")
    rows = rows.withColumn("lines", text_lines(text))
    kept = F.when(F.col("drops").isNull(), text).otherwise(
        _kept_text(F.col("lines"), F.col("drops")))
    return rows.select(F.col("doc").withField(text_col, kept).alias("doc"),
                       F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out; a document left with
    nothing stays, with an empty text."""
    return dedup_lines(docs).select("doc.*")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``documents``."""
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op2_line_dedup": op2_line_dedup}
ORACLE = {"op2_line_dedup": """
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
hot as (
  select key, max(doc_id) as keeper from k where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
m as (
  select k.doc_id, k.pos, k.line, keeper is not null and k.doc_id < keeper as gone
  from k left join hot on k.key = hot.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), ''))
         as kept_sha256
from m group by doc_id
"""}
