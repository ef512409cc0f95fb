"""Distributed row numbering vs. plain enumeration, and the numbered list
of the farthest actors."""

import random

from pyspark.sql import functions as F

from ravel.operators import graph
from ravel.operators.ordering import number_rows


def test_number_rows_matches_enumeration(spark):
    rnd = random.Random(12)
    rows = [(rnd.choice(["a", "b", "c"]) if i % 3 else "hot", rnd.randint(0, 50), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    got = {(r.g, r.id): r.idx for r in number_rows(df, "g", [F.desc("v"), F.asc("id")],
                                                   partitions=7).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        ordered = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))
        for k, r in enumerate(ordered, 1):
            want[(g, r[2])] = k
    assert got == want


def test_farthest_numbered_by_gender_and_name(spark):
    # chain 0 - 1 - ... - 8 through movies m0..m7: distance of actor k is k
    edges = [(k, m) for m in range(8) for k in (m, m + 1)]
    e = spark.createDataFrame(edges, "actor_id long, movie long")
    people = spark.createDataFrame(
        [(k, f"n{9 - k}", k % 2 == 0) for k in range(9)], "actor_id long, name string, is_male boolean")
    dist = graph.degrees(e, 0, max_hops=6)
    far = [(r.is_male, r.idx, r.name) for r in graph.farthest(dist, people, 6).orderBy(
        F.desc("is_male"), "idx").collect()]
    assert far == [(True, 1, "n3")]
    far5 = [(r.is_male, r.idx, r.name) for r in graph.farthest(dist, people, 5).collect()]
    assert far5 == [(False, 1, "n4")]


def test_runs_are_stitched_at_slice_borders(spark):
    """Places in runs over many slices, runs longer than slices among them,
    against a walk over the sorted rows."""
    import random

    from pyspark.sql import functions as F

    from ravel.operators.ordering import place_in_run
    rng = random.Random(9)
    rows = []
    for g in range(4):
        n = 0
        while n < (900, 40, 1, 300)[g]:
            v = rng.choice("abc")
            for _ in range(rng.choice([1, 2, 5, 160])):
                rows.append((f"g{g}", n, v))
                n += 1
    want, place, last = {}, 0, None
    for g, k, v in sorted(rows):
        place = place + 1 if (g, v) == last else 1
        want[g, k], last = place, (g, v)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "grp string, k int, v string")
    for n in (1, 3, 37, 200):
        got = place_in_run(df, "grp", "v", [F.asc("k")], partitions=n)
        assert {(r.grp, r.k): r.place for r in got.collect()} == want
        assert n == 1 or got.where("grp = 'g0'").select("_pid").distinct().count() > 1
    assert place_in_run(df.where("k < 0"), "grp", "v", [F.asc("k")]).count() == 0


def test_input_of_the_numbering_runs_once(spark):
    from pyspark.sql import functions as F

    from ravel.operators.ordering import number_rows
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(10_000).withColumn("g", F.col("id") % 2).repartition(4)
    df = df.mapInArrow(count, df.schema)
    assert number_rows(df, "g", [F.asc("id")]).where("idx = 5000").count() == 2
    assert seen.value == 10_000
