"""Phone program: quirks Q9-Q12 and equivalence with a hand-written scanner."""

import random
import unicodedata

from pyspark.sql import functions as F

from ravel.functions.phones import numbers_in
from ravel.operators import phones

FILL = "()- "


def skip_fill(t, at):
    while at < len(t) and t[at] in FILL:
        at += 1
    return at


def zero_group_ends(t, at):
    """Ends of a '(0)' group after filler from ``at``, longest filler first."""
    for open_at in range(skip_fill(t, at), at - 1, -1):
        inner = t[open_at + 1:].lstrip(" ")
        if t[open_at:open_at + 1] == "(" and inner[:1] == "0" and inner[1:].lstrip(" ")[:1] == ")":
            yield len(t) - len(inner[1:].lstrip(" ")) + 1


def walk_digits(t, at, wanted):
    """End after ``wanted`` digits (each a digit to meet, or None for any),
    with filler before each; None if the text runs out of them."""
    for w in wanted:
        at = skip_fill(t, at)
        c = t[at:at + 1]
        if c not in set("0123456789") or w is not None and c != w:
            return None
        at += 1
    return at


def number_end(t, at):
    """End of a number that starts at ``at``, or None."""
    if t[at] == "+":
        body = at + 1
    elif t[at:at + 2] == "00" and at and unicodedata.category(t[at - 1]) != "Nd":
        body = at + 2
    else:
        return None
    body = walk_digits(t, body, "31")
    if body is None:
        return None
    for start in [*zero_group_ends(t, body), body]:
        end = walk_digits(t, start, [None] * 9)
        if end is not None:
            return end
    return None


def bare(m):
    """A match without zero groups and filler, '00' in front as '+'."""
    out, at = "", 0
    while at < len(m):
        after = next(zero_group_ends(m, at), None) or skip_fill(m, at)
        if after == at:
            out, after = out + m[at], at + 1
        at = after
    return "+" + out[2:] if out.startswith("00") else out


def scanned_numbers(t):
    """Numbers of a text by walking it: the expected result."""
    found, at = set(), 0
    while at < len(t):
        end = number_end(t, at)
        if end:
            found.add(bare(t[at:end]))
        at = end or at + 1
    return sorted(found)


def spark_numbers(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(df.select("i", F.sort_array(numbers_in(F.col("t"))).alias("n")).collect())
    return [list(got[i]) for i in range(len(texts))]


def test_quirks(spark):
    texts = ["0031612345678 at start",          # Q9: 00 needs a non-digit before it
             "+31612345678 at start",
             "x +31 6 1234567890123",            # Q10: cut after 9 digits
             "+31(0)12345678",                   # Q11: (0) eaten as a digit
             "call +31 (0)6-12345678 now"]
    got = spark_numbers(spark, texts)
    assert got == [[], ["+31612345678"], ["+31612345678"], ["+3112345678"], ["+31612345678"]]


def test_random_equivalence(spark):
    rnd = random.Random(11)
    parts = ["+31", "0031", "00 31", "+3 1", "(0)", "( 0 )", "-", " ", "(", ")", "6", "12345",
             "9876", "x", "٣", "0", "1"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(1500)]
    assert spark_numbers(spark, texts) == [scanned_numbers(t) for t in texts]


def test_index_repeats_urls_and_splits_hot_numbers(spark):
    recs = spark.createDataFrame(
        [("u1", "+31612345678"), ("u1", "x 0031612345678"), ("u2", "+31612345678 +31612345678"),
         ("", "+31612345678")], "uri string, body string")
    pairs = phones.phone_pairs(recs)
    idx = phones.phone_index(pairs).collect()
    assert [(r.num, r.chunk, r.urls) for r in idx] == [("+31612345678", 0, ["u1", "u1", "u2"])]
    # A number above the row bound continues over consecutive rows: chunk k
    # holds the URLs ranked k*10+1 .. k*10+10; a small number stays whole.
    many = spark.createDataFrame([(f"u{i:02d}", "+31612345678") for i in range(50)] +
                                 [("v", "+31699999999")], "uri string, body string")
    rows = phones.phone_index(phones.phone_pairs(many), max_urls_per_row=10).collect()
    hot = sorted((r for r in rows if r.num == "+31612345678"), key=lambda r: r.chunk)
    assert [r.chunk for r in hot] == [0, 1, 2, 3, 4]
    assert [u for r in hot for u in r.urls] == [f"u{i:02d}" for i in range(50)]
    assert [(r.chunk, r.urls) for r in rows if r.num == "+31699999999"] == [(0, ["v"])]


def test_index_write_fails_when_output_exists(spark, tmp):
    import pytest
    from pyspark.errors import AnalysisException

    recs = spark.createDataFrame([("u1", "+31612345678")], "uri string, body string")
    idx = phones.phone_index(phones.phone_pairs(recs))
    phones.write_phone_index(idx, f"{tmp}/idx")
    assert spark.read.parquet(f"{tmp}/idx").count() == 1
    with pytest.raises(AnalysisException):
        phones.write_phone_index(idx, f"{tmp}/idx")


def test_index_in_folders_is_pruned(spark, tmp):
    """A lookup lists one folder's files; the default mode keeps what is there."""
    import pytest
    from pyspark.sql import functions as F

    from ravel.operators.phones import lookup_join, lookup_numbers, phone_index, write_phone_index
    pairs = spark.range(3000).select(F.concat(F.lit("+31"), F.col("id") % 400).alias("num"),
                                     F.col("id").cast("string").alias("uri"))
    write_phone_index(phone_index(pairs, 3), f"{tmp}/i", buckets=16)
    got = lookup_numbers(spark, f"{tmp}/i", ["+317", "+31999"], 16)
    assert sorted(u for r in got.collect() for u in r.urls) == \
        sorted(str(i) for i in range(3000) if i % 400 == 7)
    one = lookup_numbers(spark, f"{tmp}/i", ["+317"], 16)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    scan = [x for x in plan.splitlines() if "PushedFilters" in x][0]
    assert "EqualTo(num,+317)" in scan or "In(num" in scan
    read = {r.f.split("bucket=")[1].split("/")[0] for r in
            one.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(read) == 1
    assert lookup_numbers(spark, f"{tmp}/i", [], 16).count() == 0
    many = spark.createDataFrame([("+317",), ("+317",), (None,), ("+31999",), ("+3112",)], "n string")
    got = lookup_join(spark, f"{tmp}/i", many, "n", 16)
    assert got.columns == one.columns
    assert sorted(u for r in got.collect() for u in r.urls) == \
        sorted(str(i) for i in range(3000) if i % 400 in (7, 12))
    assert lookup_join(spark, f"{tmp}/i", many.limit(0), "n", 16).count() == 0
    picked = lookup_join(spark, f"{tmp}/i", many.where("n = '+317'"), "n", 16)
    assert "dynamicpruning" in picked._jdf.queryExecution().executedPlan().toString()
    assert picked.select(F.input_file_name().alias("f")).distinct().count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_phone_index(phone_index(pairs), f"{tmp}/i", buckets=16)
