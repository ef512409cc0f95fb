"""Graph-program queries: customers are actors, parts are movies."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ravel.operators import graph
from ravel.plans.programs import find_actor
from ravel.session import ensure_checkpoint_dir
from ravel.sinks.text import degree_report_lines
from ravel.sources.tables import cast_rows

# Binding parameters: the data's years run 1995-2001, so the title rule
# uses 2001. The search makes the program's whole bound of graph.MAX_HOPS hops;
# the lists of the farthest actors are those at the largest distance reached,
# and in the `_max` queries those at the bound itself.
CAST_MIN_YEAR = 2001


def cast_parse(spark, sf_dir):
    return graph.movies_of_titles(cast_rows(spark, sf_dir), CAST_MIN_YEAR)


def _cast(spark, sf_dir):
    """(edges, people), pinned once: distinct (actor_id, movie) of all
    qualifying titles, and the actors who have any."""
    ensure_checkpoint_dir(spark)
    rows = cast_parse(spark, sf_dir).distinct().checkpoint(eager=True)
    return (rows.select("actor_id", "movie"),
            rows.select("actor_id", "name", "is_male").distinct().checkpoint(eager=True))


def adjacency_sizes(spark, sf_dir):
    return graph.adjacency_sizes(_cast(spark, sf_dir)[0])


def _graph(spark, sf_dir, max_hops=graph.MAX_HOPS):
    """Distances from the actor with the first name, found by that name."""
    edges, people = _cast(spark, sf_dir)
    source = find_actor(people, people.agg(F.min("name")).first()[0])
    return edges, people, graph.degrees(edges, source, max_hops)


def degrees(spark, sf_dir):
    return _graph(spark, sf_dir)[2]


def degree_histogram(spark, sf_dir):
    edges, people, dist = _graph(spark, sf_dir)
    return graph.degree_histogram(dist, people)


def degree_summary(spark, sf_dir):
    edges, people, dist = _graph(spark, sf_dir)
    return graph.degree_summary(dist, people, edges)


def farthest_names(spark, sf_dir):
    """Those at the largest distance that the whole search reaches."""
    edges, people, dist = _graph(spark, sf_dir)
    return graph.farthest(dist.where("distance > 0"), people, graph.last_distance(dist))


def farthest_names_max(spark, sf_dir):
    """Those at the search's bound: empty where nobody is that far."""
    edges, people, dist = _graph(spark, sf_dir)
    return graph.farthest(dist, people)


def _report(spark, sf_dir, last_of):
    edges, people, dist = _graph(spark, sf_dir)
    last = last_of(dist)
    return degree_report_lines(graph.degree_summary(dist, people, edges),
                               graph.degree_histogram(dist, people),
                               graph.farthest(dist.where("distance > 0"), people, last),
                               last=last)


def degree_report(spark, sf_dir):
    """The report's lines (sec, sub, line), with the list of those at the
    largest distance reached."""
    return _report(spark, sf_dir, graph.last_distance)


def degree_report_max(spark, sf_dir):
    """The report with the list of those at the bound."""
    return _report(spark, sf_dir, lambda dist: graph.MAX_HOPS)


QUERIES = {
    "cast_parse": cast_parse,
    "adjacency_sizes": adjacency_sizes,
    "degrees": degrees,
    "degree_histogram": degree_histogram,
    "degree_summary": degree_summary,
    "farthest_names": farthest_names,
    "degree_report": degree_report,
    "farthest_names_max": farthest_names_max,
    "degree_report_max": degree_report_max,
}

_TITLE = """
raw as (
  select c_custkey as actor_id, c_name as name, c_acctbal >= 5000 as is_male,
    concat(case when l_linenumber = 7 then '"' else '' end, p_name, ' ', cast(p_partkey as varchar),
           case when p_partkey % 50 = 0 then ' (????)'
                else concat(' (', cast(year(l_shipdate) as varchar), ')') end, '  [role]') as t
  from lineitem join orders on o_orderkey = l_orderkey
    join customer on c_custkey = o_custkey join part on p_partkey = l_partkey),
cut as (select *, left(t, instr(t, ')')) as m from raw where not starts_with(t, '"')),
yr as (select *, left(substring(m, instr(m, '(') + 1, instr(m, ')') - instr(m, '(') - 1), 4) as y
       from cut)
"""

_EDGES = _TITLE.strip() + f""",
pe as (select distinct actor_id, name, is_male, m as movie from yr
       where regexp_matches(y, '^[+-]?[0-9]+$') and try_cast(y as integer) >= {CAST_MIN_YEAR}),
e as (select distinct actor_id, movie from pe),
people as (select distinct actor_id, name, is_male from pe)"""


def _bfs(hops: int) -> str:
    return f"""
with recursive {_EDGES},
co as (select distinct e1.actor_id as a1, e2.actor_id as a2
       from e e1 join e e2 on e1.movie = e2.movie where e1.actor_id <> e2.actor_id),
bfs(actor_id, d) as (
  select min(actor_id), 0 from people where name = (select min(name) from people)
  union
  select co.a2, bfs.d + 1 from bfs join co on co.a1 = bfs.actor_id where bfs.d < {hops}),
dist as (select actor_id, min(d)::int as distance from bfs group by actor_id)
"""


_BFS = _bfs(6)

# '%.1f' in Spark (as in the reference) rounds half up on the decimal form
# (6.25 -> 6.3); DuckDB's printf rounds the binary value, so the oracle
# rounds half up first.
ORACLE = {
    "cast_parse": "with " + _TITLE + f"""
select actor_id, name, is_male, m as movie from yr
where regexp_matches(y, '^[+-]?[0-9]+$') and try_cast(y as integer) >= {CAST_MIN_YEAR}""",
    "adjacency_sizes": f"with {_EDGES}" + """,
c as (select movie, count(*) as cast_n from e group by movie)
select actor_id, count(*) as movies, sum(cast_n - 1)::bigint as co_star_slots
from e join c using (movie) group by actor_id""",
    "degrees": _BFS + "select actor_id, distance from dist",
    "degree_histogram": _BFS + """,
tot as (select count(*) filter (where is_male) as n_male,
               count(*) filter (where not is_male) as n_female from people),
per as (select distance, count(*) filter (where is_male) as actors,
               count(*) filter (where not is_male) as actresses
        from dist join people using (actor_id) where distance >= 1 group by distance),
lv as (select range::int as distance from range(1, 7))
select lv.distance, coalesce(actors, 0) as actors, coalesce(actresses, 0) as actresses,
  printf('%.1f', round(coalesce(actors, 0) * 100.0 / n_male, 1)) as pct_actors,
  printf('%.1f', round(coalesce(actresses, 0) * 100.0 / n_female, 1)) as pct_actresses
from lv left join per using (distance), tot""",
    "degree_summary": _BFS + """,
tot as (select count(*) as n_actors, count(*) filter (where is_male) as n_male,
               count(*) filter (where not is_male) as n_female from people),
r as (select count(*) as reached, count(*) filter (where is_male) as reached_male,
             count(*) filter (where not is_male) as reached_female
      from dist join people using (actor_id) where distance between 1 and 6),
mv as (select count(distinct movie) as n_movies from e)
select n_actors, n_male, n_female, (n_male * 100 // n_actors)::bigint as pct_male,
  (n_female * 100 // n_actors)::bigint as pct_female, n_movies, reached, reached_male,
  reached_female, (reached / n_actors)::float as ratio, (reached_male / n_male)::float as ratio_male,
  (reached_female / n_female)::float as ratio_female
from tot, r, mv""",
}


_HOPS = graph.MAX_HOPS
_LAST = "(select max(distance) from dist)"


def _farthest_sql(last: str) -> str:
    return _BFS + f"""
select is_male, row_number() over (partition by is_male order by name, actor_id) as idx,
  name, actor_id
from dist join people using (actor_id) where distance > 0 and distance = {last}"""


def _report_sql(last: str) -> str:
    return ORACLE["degree_summary"].replace("select n_actors, n_male", """,
sm as (select n_actors, n_male""", 1) + f""")
,
per as (select distance, count(*) filter (where is_male) as actors,
               count(*) filter (where not is_male) as actresses
        from dist join people using (actor_id) where distance >= 1 group by distance),
lv as (select range::int as distance from range(1, {_HOPS + 1})),
far as (select is_male, row_number() over (partition by is_male order by name, actor_id) as idx, name
        from dist join people using (actor_id) where distance > 0 and distance = {last})
select 0 as sec, 0::bigint as sub, format('Total number of actors = {{}}, out of which {{}} ({{}}%) are '
  || 'males while {{}} ({{}}%) are females.', n_actors, n_male, pct_male, n_female, pct_female) as line from sm
union all select 0, 1, format('Total number of movies = {{}}', n_movies) from sm
union all select 0, 2, ''
union all select 1, lv.distance, format('There are {{}} ({{}}%) actors and {{}} ({{}}%) actresses at distance {{}}',
  coalesce(actors, 0), printf('%.1f', round(coalesce(actors, 0) * 100.0 / n_male, 1)),
  coalesce(actresses, 0), printf('%.1f', round(coalesce(actresses, 0) * 100.0 / n_female, 1)), lv.distance)
  from lv left join per using (distance), tot
union all select 2, 0, ''
union all select 2, 1, 'Total number of actors from distance 1 to {_HOPS} = ' || reached || ', ratio = ' || ratio from sm
union all select 2, 2, 'Total number of male actors from distance 1 to {_HOPS} = ' || reached_male
  || ', ratio = ' || ratio_male from sm
union all select 2, 3, 'Total number of female actors (actresses) from distance 1 to {_HOPS} = ' || reached_female
  || ', ratio = ' || ratio_female from sm
union all select 2, 4, ''
union all select 2, 5, 'List of male actors at distance ' || {last} || ':'
union all select 4, 0, ''
union all select 4, 1, 'List of female actors (actresses) at distance ' || {last} || ':'
union all select case when is_male then 3 else 5 end, idx, idx || '. ' || name from far"""


ORACLE |= {"farthest_names": _farthest_sql(_LAST), "degree_report": _report_sql(_LAST),
           "farthest_names_max": _farthest_sql(str(_HOPS)),
           "degree_report_max": _report_sql(str(_HOPS))}


# Titles in a cast-list file, about (files hold whole actors).
TITLES_PER_FILE = 200_000


def cast_file_movies(spark, sf_dir):
    """The cast rows written as male and female cast-list files (header,
    blank-line records, footer, Latin-1 with accented names) in the scratch
    folder, read back with the file reader and parsed: (name, is_male, movie)
    per kept title."""
    from ravel.session import remove_path, scratch_path
    from ravel.sinks.files import write_cast_list
    from ravel.sources.casts import read_cast_file

    ensure_checkpoint_dir(spark)
    named = F.when(F.pmod("actor_id", F.lit(3)) == 0, F.concat(F.lit("Müller-Ødegård, "), F.col("name"))) \
        .otherwise(F.col("name"))
    rows = cast_rows(spark, sf_dir).withColumn("name", named).checkpoint(eager=True)
    path = scratch_path(spark, "cast-list")
    try:
        write_cast_list(rows, path, max(1, math.ceil(rows.count() / TITLES_PER_FILE)))
        parsed = [graph.parse_cast_records(read_cast_file(spark, f"{path}/is_male={str(male).lower()}"),
                                           male, CAST_MIN_YEAR) for male in (True, False)]
        return (parsed[0].unionByName(parsed[1])
                .select("name", "is_male", F.explode("movies").alias("movie")).checkpoint(eager=True))
    finally:
        remove_path(spark, path)


QUERIES["cast_file_movies"] = cast_file_movies
ORACLE["cast_file_movies"] = "with " + _TITLE + f"""
select case when actor_id % 3 = 0 then 'Müller-Ødegård, ' || name else name end as name, is_male, m as movie from yr
where regexp_matches(y, '^[+-]?[0-9]+$') and try_cast(y as integer) >= {CAST_MIN_YEAR}"""


# Titles in a file of the id query, so that small tables have several files.
TITLES_PER_ID_FILE = 20_000


def cast_ids(spark, sf_dir):
    """(actor_id, name, is_male): dense ids of the actors in cast-list files,
    in the order of the files and their records, males first."""
    from ravel.session import remove_path, scratch_path
    from ravel.sinks.files import write_cast_list
    from ravel.sources.casts import read_cast_file

    ensure_checkpoint_dir(spark)
    rows = cast_rows(spark, sf_dir).checkpoint(eager=True)
    path = scratch_path(spark, "cast-ids")
    try:
        write_cast_list(rows, path, max(1, math.ceil(rows.count() / TITLES_PER_ID_FILE)), in_order=True)
        male, female = (graph.parse_cast_records(
            read_cast_file(spark, f"{path}/is_male={str(m).lower()}"), m, CAST_MIN_YEAR)
            for m in (True, False))
        return graph.cast_actor_ids(male, female).select("actor_id", "name", "is_male") \
            .checkpoint(eager=True)
    finally:
        remove_path(spark, path)


def vertex_states(spark, sf_dir):
    """Distances from the actors with the first and the last name, with 100 for
    those not reached."""
    edges, people = _cast(spark, sf_dir)
    names = people.agg(F.min("name").alias("a"), F.max("name").alias("b")).first()
    sources = spark.createDataFrame([(find_actor(people, n),) for n in names], "source_id bigint")
    return graph.vertex_states(edges, sources)


QUERIES |= {"cast_ids": cast_ids, "vertex_states": vertex_states}
ORACLE["cast_ids"] = f"with {_EDGES}" + """
select row_number() over (order by is_male desc, actor_id) - 1 as actor_id, name, is_male from people"""
ORACLE["vertex_states"] = f"""
with recursive {_EDGES},
co as (select distinct e1.actor_id as a1, e2.actor_id as a2
       from e e1 join e e2 on e1.movie = e2.movie where e1.actor_id <> e2.actor_id),
src as (select min(actor_id) as source_id from people where name = (select min(name) from people)
        union select min(actor_id) from people where name = (select max(name) from people)),
bfs(source_id, actor_id, d) as (
  select source_id, source_id, 0 from src
  union
  select source_id, co.a2, bfs.d + 1 from bfs join co on co.a1 = bfs.actor_id where bfs.d < {_HOPS}),
dist as (select source_id, actor_id, min(d) as d from bfs group by all),
v as (select source_id, actor_id from src, (select distinct a1 as actor_id from co)
      union select source_id, source_id from src)
select source_id, actor_id, coalesce(d, {graph.UNREACHED})::int as distance
from v left join dist using (source_id, actor_id)"""
