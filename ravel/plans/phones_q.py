"""Phone-program queries.

Real numbers: pages and documents hold North-American forms such as
'+1 (743) 555-3824', so those run with country '1' and 10 digits. The
default Dutch setting (31, 9 digits) runs on texts derived per customer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ravel.operators import phones
from ravel.sources.crawl import route
from ravel.sources.tables import crawl_records_from_tables, dutch_phone_texts, table


def phone_pairs(spark, sf_dir):
    return phones.phone_pairs(crawl_records_from_tables(spark, sf_dir), "1", 10)


# Row bound of one URL list (larger lists continue in the next chunk);
# small, so that the queries' lists do continue.
URL_ROWS = 8


def phone_index(spark, sf_dir):
    return phones.phone_index_flat(phone_pairs(spark, sf_dir), max_urls_per_row=URL_ROWS)


def phone_pairs_nl(spark, sf_dir):
    return phones.phone_pairs(dutch_phone_texts(spark, sf_dir))


def phone_index_nl(spark, sf_dir):
    return phones.phone_index_flat(phone_pairs_nl(spark, sf_dir), max_urls_per_row=URL_ROWS)


QUERIES = {
    "phone_pairs": phone_pairs,
    "phone_index": phone_index,
    "phone_pairs_nl": phone_pairs_nl,
    "phone_index_nl": phone_index_nl,
}


# The number rules written out for the oracle (RE2 has no lookbehind: the
# non-digit before '00' is taken into the match and cut off again).
_NA = (r"(?:\P{Nd}00[\(\)\- ]*1|\+[\(\)\- ]*1)(?:[\(\)\- ]*\( *?0 *?\))?"
       r"(?:[\(\)\- ]*[0-9]){10}")
_DUTCH = (r"(?:\P{Nd}00[\(\)\- ]*3[\(\)\- ]*1|\+[\(\)\- ]*3[\(\)\- ]*1)(?:[\(\)\- ]*\( *?0 *?\))?"
          r"(?:[\(\)\- ]*[0-9]){9}")
_FILLERS = r"(?:[\(\)\- ]*\( *?0 *?\))|[\(\)\- ]*"


def _pairs_sql(records_sql: str, pattern: str) -> str:
    return f"""
with recs as ({records_sql}),
found as (select rk, uri, unnest(regexp_extract_all(body, '{pattern}')) as m
          from recs where uri is not null and uri <> ''),
canon as (select distinct rk, uri,
            regexp_replace(regexp_replace(regexp_replace(m, '(?s)^.00', '00'),
                                          '{_FILLERS}', '', 'g'), '^00', '+') as num
          from found)
"""


_REAL = _pairs_sql("""
  select 'p' || page_id::varchar as rk, url as uri, html as body from pages
  union all
  select 'd' || doc_id::varchar, 'doc:' || doc_id::varchar, text from documents""", _NA)

_NL = _pairs_sql("""
  select 'c' || c_custkey::varchar as rk, 'cust:' || c_custkey::varchar as uri,
    case c_custkey % 6
      when 0 then concat('call +31 (0)6-', n, ' now') when 1 then concat('tel 0031', '6', n)
      when 2 then concat('0031 6 ', n)                when 3 then concat('+31(0)', n)
      when 4 then concat('+316', n, '99')             else concat('x +31 6 ', n, ' or 00316', n)
    end as body
  from (select c_custkey, lpad(cast(c_custkey as varchar), 8, '1') as n from customer) q""",
                 _DUTCH)

_INDEX = f"""
select num, ((r - 1) // {URL_ROWS})::int as chunk, count(*) as n_urls,
  string_agg(uri, ' ' order by uri) as urls
from (select num, uri, row_number() over (partition by num order by uri) as r from canon) q
group by all"""

ORACLE = {
    "phone_pairs": _REAL + "select num, uri from canon",
    "phone_index": _REAL + _INDEX,
    "phone_pairs_nl": _NL + "select num, uri from canon",
    "phone_index_nl": _NL + _INDEX,
}


def _read_back(spark, records, work, rows_per_segment=20_000):
    """(CrawlRead result, scratch folder) of ``records`` written as segments."""
    from ravel.session import ensure_checkpoint_dir, remove_path, scratch_path
    from ravel.sinks.files import write_segment_index, write_wet_segments
    from ravel.sources.crawl import CrawlRead, read_index

    ensure_checkpoint_dir(spark)
    base = scratch_path(spark, "crawl files")       # a path with a space
    for i, (rows, compression) in enumerate(records):
        write_wet_segments(rows, f"{base}/segments {i}", rows_per_segment, compression)
        write_segment_index(spark, f"{base}/segments {i}", f"{base}/index")
    try:
        return work(base, lambda: CrawlRead(spark, read_index(spark, f"{base}/index")))
    finally:
        remove_path(spark, base)


def crawl_phone_pairs(spark, sf_dir):
    """The same records written as gzip crawl segments (in the scratch
    folder), listed in an index, and read back through the crawl reader:
    the file path of the phone program, on data derived from the tables.
    Payloads of documents hold version lines, some records are WARC/1.1."""
    rows = crawl_records_from_tables(spark, sf_dir).where("uri is not null and body is not null")
    trap = F.lit("\r\n\r\nWARC/1.0\r\nWARC-Target-URI: none\r\nContent-Length: 4\r\n\r\n")
    rows = rows.withColumn("body", F.when(F.col("uri").startswith("doc:"), F.concat(
        F.lit("head"), trap, F.col("body"))).otherwise(F.col("body")))
    rows = rows.withColumn("version", F.when(F.pmod(F.xxhash64("uri"), F.lit(3)) == 0,
                                             "WARC/1.1\r\n").otherwise("WARC/1.0\r\n"))
    return _read_back(spark, [(rows, "gzip")], lambda base, read: phones.phone_pairs(
        read().valid_records(), "1", 10).checkpoint(eager=True))


def crawl_counters(spark, sf_dir):
    """(counter, value) of a crawl whose index also names a missing segment,
    one that ends inside a record (its first records are kept), an invalid
    object URI, an unknown scheme, and one segment twice; some payloads are
    not valid UTF-8."""
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("uri"),
        F.when(F.pmod("doc_id", F.lit(7)) == 0, F.concat(
            F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.lit("C3"))))
        .otherwise(F.coalesce("text", F.lit("")).cast("binary")).alias("body"))
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("uri"),
        F.col("n_name").cast("binary").alias("body"), F.col("n_nationkey").alias("k"))
    last = nations.agg(F.max("k")).first()[0]
    cut = nations.coalesce(1).orderBy("k").withColumn(
        "missing", F.when(F.col("k") == last, 99).otherwise(0)).drop("k")

    def work(base, read):
        names = spark.read.format("binaryFile").load(f"{base}/segments 1").select("path")
        twice = names.select(F.col("path").alias("value"))
        more = spark.createDataFrame([(f"file:{base.split(':')[-1]}/segments 1/missing.gz",),
                                      ("s3://nokey",), ("http://x/y.gz",)], "value string")
        twice.unionByName(more).write.mode("append").text(f"{base}/index")
        r = read()
        n = r.valid_records().count()
        return [("failed_parses", r.failed_parses()), ("failed_segments", r.failed_segments()),
                ("records", n)]

    small = nations.drop("k").coalesce(1)
    found = _read_back(spark, [(docs, "gzip"), (small, "gzip"), (cut, "none")], work)
    return spark.createDataFrame(found, "counter string, value bigint")


def uri_routing(spark, sf_dir):
    """Scheme and path of index lines, one per customer."""
    k = F.col("c_custkey").cast("string")
    n = F.pmod("c_custkey", F.lit(6))
    uri = (F.when(n == 0, F.concat(F.lit("file:///data/a b/"), k, F.lit(".gz")))
           .when(n == 1, F.concat(F.lit("file:/data/"), k))
           .when(n == 2, F.concat(F.lit("s3://bucket/dir/"), k, F.lit(".gz")))
           .when(n == 3, F.concat(F.lit("s3://"), k)).when(n == 4, F.concat(F.lit("s3:/"), k))
           .otherwise(F.concat(F.lit("http://host/"), k)))
    return route(table(spark, sf_dir, "customer").select(uri.alias("uri")))


QUERIES["crawl_phone_pairs"] = crawl_phone_pairs
ORACLE["crawl_phone_pairs"] = ORACLE["phone_pairs"]
QUERIES["crawl_counters"] = crawl_counters
ORACLE["crawl_counters"] = """
select 'failed_parses' as counter, count(*) as value from documents where doc_id % 7 = 0
union all select 'failed_segments', 3::bigint
union all select 'records', (select count(*) from documents where doc_id % 7 <> 0)
  + (select 3 * count(*) - 1 from nation)"""
QUERIES["uri_routing"] = uri_routing
ORACLE["uri_routing"] = """
with u as (
  select c_custkey % 6 as n, c_custkey::varchar as k,
    case n when 0 then 'file:///data/a b/' || k || '.gz' when 1 then 'file:/data/' || k
      when 2 then 's3://bucket/dir/' || k || '.gz' when 3 then 's3://' || k
      when 4 then 's3:/' || k else 'http://host/' || k end as uri
  from customer)
select uri, case when n < 2 then 'file' when n < 5 then 's3' end as scheme,
  case n when 0 then 'file:/data/a b/' || k || '.gz' when 1 then 'file:/data/' || k
    when 2 then 's3a://bucket/dir/' || k || '.gz' end as path
from u"""

# Tasks asked for: so many, and one more for each TASK_RECORDS records.
READ_TASKS, TASK_RECORDS = 4, 5000


def crawl_read_plan(spark, sf_dir):
    """(task, has_records, kept, records) of a crawl read with a number of tasks asked for:
    whether each task brought records, and whether its bytes stay within the mean
    plus the longest segment (what packing by size keeps); a last row, without
    a task, has all records and whether the session's settings are as before."""
    from ravel.sources.crawl import CrawlRead, read_index
    from ravel.sources.segments import plan_reads, sizes_of

    rows = crawl_records_from_tables(spark, sf_dir).where("uri is not null and body is not null")
    tasks = READ_TASKS + rows.count() // TASK_RECORDS
    settings = lambda: {r.key: r.value for r in spark.sql("SET").collect()}

    def work(base, read):
        paths = [r.value for r in spark.read.text(f"{base}/index").collect()]  # segment names
        sizes = sizes_of(paths)
        plan = plan_reads(sizes, tasks)
        bound = sum(sizes.values()) / len(plan) + max(sizes.values())
        before = settings()
        r = CrawlRead(spark, read_index(spark, f"{base}/index"), tasks)
        per = {x.segment: x.n for x in r.valid_records().groupBy("segment")
               .agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(per.values())
        out = [(i, sum(per.get(p, 0) for p in task) > 0, sum(map(sizes.get, task)) <= bound, None)
               for i, task in enumerate(plan)]
        return [*out, (None, True, settings() == before, total)]

    found = _read_back(spark, [(rows.repartition(2 * tasks), "gzip")], work,
                       rows_per_segment=500)
    return spark.createDataFrame(found, "task int, has_records boolean, kept boolean, records bigint")


QUERIES["crawl_read_plan"] = crawl_read_plan
ORACLE["crawl_read_plan"] = f"""
with r as (
  select (select count(*) from pages where url is not null and html is not null)
    + (select count(*) from documents where doc_id is not null and text is not null) as n)
select unnest(range({READ_TASKS} + n // {TASK_RECORDS}))::int as task, true as has_records,
  true as kept, null::bigint as records from r
union all
select null, true, true, n from r"""


def phone_lookup(spark, sf_dir):
    """The index of the Dutch-style numbers written into folders by number, and
    the rows of the numbers of every twentieth customer looked up in it."""
    from ravel.session import remove_path, scratch_path

    pairs = phones.phone_pairs(dutch_phone_texts(spark, sf_dir), "31", 9)
    asked = pairs.where(F.pmod(F.substring_index("uri", ":", -1).cast("long"), F.lit(20)) == 0)
    path = scratch_path(spark, "phone-index")
    try:
        phones.write_phone_index(phones.phone_index(pairs, URL_ROWS), path, buckets=phones.BUCKETS)
        return phones.lookup_join(spark, path, asked).select(
            "num", "chunk", "n_urls", F.array_join("urls", " ").alias("urls")).checkpoint(eager=True)
    finally:
        remove_path(spark, path)


QUERIES["phone_lookup"] = phone_lookup
ORACLE["phone_lookup"] = _NL + f"select * from ({_INDEX}) i" + """
where num in (select num from canon where cast(substr(uri, 6) as bigint) % 20 = 0)"""
