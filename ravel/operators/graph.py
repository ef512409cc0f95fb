"""Degrees of separation on a bipartite actor/movie graph.

Two actors are co-stars when they share a movie; the distance of an actor
is the fewest co-star hops from the source, up to ``max_hops`` (6).

The search never builds the co-star graph (whose size is the sum of the
squared cast sizes, see ``adjacency_sizes``): each hop goes frontier actors
-> their movies not seen before -> those movies' actors not seen before,
i.e. two semi-joins against the bipartite edges plus anti-joins against the
last two layers only. Edges are stored once hash partitioned by actor and
once by movie, each salted by a hash of the other end (reliable checkpoints
that keep their partitioning), so a hop shuffles the frontier only and a hot
movie or actor is spread over several partitions; a frontier that turns out
small is broadcast by Spark's own size threshold. Every hop's result is
checkpointed, which cuts lineage and lets the loop survive lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravel.functions.titles import DEFAULT_MIN_YEAR, qualifying_movies, record_fields
from ravel.operators.ordering import dense_index, number_rows
from ravel.session import ensure_checkpoint_dir

# Fixed value: the hop limit. Unreached actors are left out.
MAX_HOPS = 6


# ----------------------------------------------------------------- parsing
def parse_cast_records(records: DataFrame, is_male: bool, min_year: int = DEFAULT_MIN_YEAR,
                       record_col: str = "value") -> DataFrame:
    """(name, is_male, movies array<string>) per record with at least one
    qualifying movie; blank records are dropped. ``file`` and ``ord``, the
    record's place, are kept where the records have them."""
    f = record_fields(F.col(record_col))
    place = [c for c in ("file", "ord") if c in records.columns]
    parsed = records.select(f.alias("f"), *place).where(F.size("f") > 0).select(
        *place, F.col("f")[0].alias("name"), F.lit(is_male).alias("is_male"),
        qualifying_movies(F.slice("f", 2, F.greatest(F.size("f") - 1, F.lit(0))),
                          min_year).alias("movies"))
    return parsed.where(F.size("movies") > 0)


def cast_actor_ids(male: DataFrame, female: DataFrame) -> DataFrame:
    """Union of the two parsed inputs (same name in both inputs = two actors)
    with ``actor_id`` = 0, 1, 2, ... in the order of the inputs, their files
    and the records in them: the same ids whenever the files are read."""
    ensure_checkpoint_dir(male.sparkSession)
    both = male.withColumn("input", F.lit(0)).unionByName(female.withColumn("input", F.lit(1)))
    both = both.withColumn("block", F.col("ord.block")).withColumn("row", F.col("ord.row"))
    both = both.drop("ord").checkpoint(eager=True)      # the rows' places name one scan
    return dense_index(both, ["input", "file", "block"], "row", out="actor_id") \
        .drop("input", "file", "block", "row")


def movies_of_titles(rows: DataFrame, min_year: int = DEFAULT_MIN_YEAR,
                     title_col: str = "raw_title") -> DataFrame:
    """Row-per-title form of the title rules: keeps rows whose title
    qualifies, with the cut title as ``movie``. Taken by a generator, which the
    optimizer neither copies nor moves, so the rules run once per row."""
    m = qualifying_movies(F.array(F.col(title_col)), min_year)
    kept = [c for c in rows.columns if c not in (title_col, "movie")]
    return rows.select(*kept, F.explode(m).alias("movie"))


def actor_movie_pairs(actors_movies: DataFrame) -> DataFrame:
    """Explode (actor_id, movies) to distinct (actor_id, movie) edges."""
    return actors_movies.select("actor_id", F.explode("movies").alias("movie")).distinct()


# ------------------------------------------------------------- projection
def adjacency_sizes(edges: DataFrame) -> DataFrame:
    """(actor_id, movies, co_star_slots): per actor, the size of its co-star
    adjacency list in the one-mode projection with duplicates kept -- the
    sum over its movies of (cast size - 1) -- without emitting any pair:
    per-movie cast sizes (partial aggregation) joined back to the edges
    (a hot movie is one row on the cast side; AQE splits its edges)."""
    cast = edges.groupBy("movie").agg(F.count(F.lit(1)).alias("cast"))
    return (edges.join(cast, "movie")
            .groupBy("actor_id")
            .agg(F.count(F.lit(1)).alias("movies"),
                 F.sum(F.col("cast") - 1).alias("co_star_slots")))


# -------------------------------------------------------------------- BFS
def _salted_probe(keys: DataFrame, key: str, salts: int) -> DataFrame:
    """One copy of each probe key per salt value, to meet edges stored
    partitioned by (key, salt)."""
    return keys.select(key, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))


def _stored(edges: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``edges`` checkpointed in ``parts`` hash partitions of ``keys``. The
    adaptive planner is off meanwhile: a plan it has touched no longer tells
    its partitioning, and every join would shuffle the edges again."""
    conf = edges.sparkSession.conf
    key, before = "spark.sql.adaptive.enabled", conf.get("spark.sql.adaptive.enabled")
    conf.set(key, "false")
    try:
        return edges.repartition(parts, *keys).checkpoint(eager=True)
    finally:
        conf.set(key, before)


def _expand(stored: DataFrame, probe: DataFrame, key: str, salts: int) -> DataFrame:
    """Edges of ``stored`` whose ``key`` is in ``probe``: a salted semi join
    on the stored partitioning, so a hot key is spread over ``salts``
    partitions and only the probe is shuffled."""
    return stored.join(_salted_probe(probe, key, salts), [key, "salt"], "left_semi")


def degrees(edges: DataFrame, source_id, max_hops: int = MAX_HOPS,
            partitions: int | None = None, salts: int = 16) -> DataFrame:
    """(actor_id, distance) for the source (0) and every actor within
    ``max_hops`` co-star hops. ``edges`` holds distinct (actor_id, movie);
    pin them before (they are read twice here).

    Edges are stored twice, hash partitioned by (movie, salt) and by
    (actor_id, salt) with the salt a hash of the other end modulo
    ``salts``: a movie (or actor) holding a third of all edges still
    spreads over ``salts`` partitions."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = edges.select("actor_id", "movie")
    salt_of = lambda c: F.pmod(F.xxhash64(c), F.lit(salts)).cast("int")
    by_actor = _stored(e.withColumn("salt", salt_of("movie")), n_parts, "actor_id", "salt")
    by_movie = _stored(e.withColumn("salt", salt_of("actor_id")), n_parts, "movie", "salt")

    key_type = dict(e.dtypes)["actor_id"]
    frontier = spark.range(1).select(F.lit(source_id).cast(key_type).alias("actor_id"))
    frontier = frontier.checkpoint(eager=True)
    layers = [frontier.withColumn("distance", F.lit(0))]
    # Co-stars' distances differ by at most one, so the actors reached from
    # layer d-1 lie in layers d-2 .. d: removing the last two layers leaves
    # exactly layer d. Likewise a movie next to layer d-1 was expanded
    # before only if it is among the previous hop's movies. The anti-joins
    # therefore stay the size of two layers, not of everything seen.
    prev_frontier = frontier.where(F.lit(False))
    prev_movies = by_movie.select("movie").where(F.lit(False))

    for hop in range(1, max_hops + 1):
        movies = (_expand(by_actor, frontier, "actor_id", salts)
                  .select("movie").distinct()
                  .join(prev_movies, "movie", "left_anti")
                  .checkpoint(eager=True))
        if movies.isEmpty():
            break
        nxt = (_expand(by_movie, movies, "movie", salts)
               .select("actor_id").distinct()
               .join(frontier, "actor_id", "left_anti")
               .join(prev_frontier, "actor_id", "left_anti")
               .checkpoint(eager=True))
        if nxt.isEmpty():
            break
        layers.append(nxt.withColumn("distance", F.lit(hop)))
        prev_movies, prev_frontier, frontier = movies, frontier, nxt

    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer)
    return out.withColumn("distance", F.col("distance").cast("int"))


# Fixed value: the distance of a vertex that is not reached.
UNREACHED = 100


def vertex_states(edges: DataFrame, sources: DataFrame, max_hops: int = MAX_HOPS,
                  salts: int = 16) -> DataFrame:
    """(source_id, actor_id, distance) of every actor with a co-star, for each
    of ``sources`` (source_id): 0 for the source, ``UNREACHED`` where it is not
    reached within ``max_hops``. A source without a co-star has its own row.

    The states are a table that every hop merges with what it reached, keeping
    the smaller distance; rows that went down are the next frontier, of all
    sources at once. Its rows lie where they are (hash partitioned by source
    and actor), so a hop shuffles only what the frontier reaches. ``edges``
    holds distinct (actor_id, movie), pinned before."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = edges.select("actor_id", "movie")
    salt_of = lambda c: F.pmod(F.xxhash64(c), F.lit(salts)).cast("int")
    by_actor = _stored(e.withColumn("salt", salt_of("movie")), n_parts, "actor_id", "salt")
    by_movie = _stored(e.withColumn("salt", salt_of("actor_id")), n_parts, "movie", "salt")
    shared = e.groupBy("movie").agg(F.count(F.lit(1)).alias("cast")).where("cast > 1")
    actors = e.join(shared, "movie", "left_semi").select("actor_id").distinct()
    sources = sources.select("source_id").distinct().checkpoint(eager=True)
    own = sources.select("source_id", F.col("source_id").alias("actor_id"), F.lit(0).alias("distance"))
    # every source meets every actor: the table that was asked for
    states = actors.crossJoin(F.broadcast(sources)) \
        .select("source_id", "actor_id", F.lit(UNREACHED).alias("distance"))
    states = states.unionByName(own).groupBy("source_id", "actor_id") \
        .agg(F.min("distance").alias("distance"))
    states = _stored(states, n_parts, "source_id", "actor_id")
    frontier = own.select("source_id", "actor_id")

    def next_to(keys: DataFrame, key: str, stored: DataFrame, other: str) -> DataFrame:
        salted = keys.select("source_id", key, F.explode(F.sequence(
            F.lit(0), F.lit(salts - 1))).alias("salt"))
        return stored.join(salted, [key, "salt"]).select("source_id", other).distinct()

    for hop in range(1, max_hops + 1):
        movies = next_to(frontier, "actor_id", by_actor, "movie")
        reached = next_to(movies, "movie", by_movie, "actor_id").withColumn("hop", F.lit(hop))
        merged = states.join(reached, ["source_id", "actor_id"], "left").select(
            "source_id", "actor_id", F.least("distance", "hop").alias("distance"))
        states = _stored(merged, n_parts, "source_id", "actor_id")
        frontier = states.where(F.col("distance") == hop).select("source_id", "actor_id")
        if frontier.isEmpty():
            break
    return states


# ---------------------------------------------------------------- reports
def degree_histogram(dist: DataFrame, people: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """(distance, actors, actresses, pct_actors, pct_actresses) for every
    distance 1..max_hops (0 counts where nobody is that far). ``people``
    holds (actor_id, is_male) of every actor counted in the totals;
    percentages are of each gender's total, formatted '%.1f'."""
    spark = dist.sparkSession
    n_male = people.agg(F.count_if(F.col("is_male"))).scalar()
    n_female = people.agg(F.count_if(~F.col("is_male"))).scalar()
    per = (dist.where(F.col("distance") >= 1)
           .join(people.select("actor_id", "is_male"), "actor_id")
           .groupBy("distance")
           .agg(F.count_if(F.col("is_male")).alias("actors"),
                F.count_if(~F.col("is_male")).alias("actresses")))
    levels = spark.range(1, max_hops + 1).select(F.col("id").cast("int").alias("distance"))
    h = levels.join(per, "distance", "left").na.fill(0, ["actors", "actresses"])
    pct = lambda n, t: F.format_string("%.1f", n * F.lit(100.0) / t)
    return h.select("distance", "actors", "actresses",
                    pct(F.col("actors"), n_male).alias("pct_actors"),
                    pct(F.col("actresses"), n_female).alias("pct_actresses"))


def degree_summary(dist: DataFrame, people: DataFrame, edges: DataFrame,
                   max_hops: int = MAX_HOPS) -> DataFrame:
    """One row: actor totals by gender with integer-truncated percentages,
    distinct movies, actors reached at 1..max_hops and their ratios (float).
    One aggregation over people left-joined with their distance."""
    reach = F.col("distance").between(1, max_hops)
    male = F.col("is_male")
    r = (people.select("actor_id", "is_male")
         .join(dist.where(reach), "actor_id", "left")
         .agg(F.count(F.lit(1)).alias("n_actors"),
              F.count_if(male).alias("n_male"),
              F.count_if(~male).alias("n_female"),
              F.count_if(reach).alias("reached"),
              F.count_if(reach & male).alias("reached_male"),
              F.count_if(reach & ~male).alias("reached_female")))
    n_movies = edges.agg(F.count_distinct("movie")).scalar()
    div = lambda a, b: F.when(b > 0, F.floor(a * 100 / b))
    ratio = lambda a, b: F.when(b > 0, (a / b).cast("float"))
    return r.select(
        "n_actors", "n_male", "n_female",
        div(F.col("n_male"), F.col("n_actors")).cast("bigint").alias("pct_male"),
        div(F.col("n_female"), F.col("n_actors")).cast("bigint").alias("pct_female"),
        n_movies.alias("n_movies"), "reached", "reached_male", "reached_female",
        ratio(F.col("reached"), F.col("n_actors")).alias("ratio"),
        ratio(F.col("reached_male"), F.col("n_male")).alias("ratio_male"),
        ratio(F.col("reached_female"), F.col("n_female")).alias("ratio_female"))


def last_distance(dist: DataFrame) -> int:
    """The largest distance anyone was reached at; 0 if nobody was."""
    return dist.agg(F.max("distance")).first()[0] or 0


def farthest(dist: DataFrame, people: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """(is_male, idx, name, actor_id) of the actors at exactly ``max_hops``;
    ``idx`` numbers each gender's list by name (then id), from 1."""
    far = dist.where(F.col("distance") == max_hops).select("actor_id")
    rows = (people.select("actor_id", "name", "is_male").join(far, "actor_id")
            .select("is_male", "name", "actor_id"))
    return number_rows(rows, "is_male", [F.col("name"), F.col("actor_id")]) \
        .select("is_male", "idx", "name", "actor_id")
