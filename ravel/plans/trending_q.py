"""Trending-program queries over statuses derived from ``events``
(window 12 hours, slide 1 hour: the data spans a month)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ravel.functions.text import clean_for_language, hashtags_or_none, language_override
from ravel.operators import trending as tr
from ravel.operators.ordering import number_rows
from ravel.sources.tables import tweets

WINDOW, SLIDE = "12 hours", "1 hour"


def _bounds():
    return [F.unix_seconds(F.col("window.start")).alias("w_start"),
            F.unix_seconds(F.col("window.end")).alias("w_end")]


# Status texts bound to the events for the language rules: scripts in the
# text, and scripts that only stand in parts the cleaning takes out.
STATUS_TEXTS = ("RT @bob: こんにちは", "안녕 RT labas", "RT labas rytas", "@ひらがな labas",
                "https://t.co/ひらがな labas", "labas https://t.co/한글 @한글", "見る RT ひ",
                "カタカナ", "한글 と ひらがな", "RTひ RT한")


def lang_override(spark, sf_dir):
    """Two in three events get the code 'lt' and a status text of its own."""
    t = tweets(spark, sf_dir)
    text = F.element_at(F.array(*[F.lit(x) for x in STATUS_TEXTS]),
                        (F.pmod("event_id", F.lit(len(STATUS_TEXTS))) + 1).cast("int"))
    lang = F.when(F.pmod("event_id", F.lit(3)) > 0, "lt").otherwise(F.col("lang"))
    t = t.select("event_id", lang.alias("lang"), text.alias("status"))
    return t.select("event_id", "status", language_override(
        F.col("lang"), clean_for_language(F.col("status"))).alias("lang"))


def hashtags(spark, sf_dir):
    t = tweets(spark, sf_dir)
    return t.select("event_id", F.explode(hashtags_or_none(F.col("text"))).alias("tag"))


def _wc(spark, sf_dir):
    """Counts over statuses that hold their original as a nested struct."""
    t = tweets(spark, sf_dir)
    nested = t.select("event_id", "ts", "is_retweet", "lang",
                      F.struct("id", "username", "text").alias("retweeted"))
    return tr.windowed_counts(tr.retweets(nested), WINDOW, SLIDE)


def windowed_counts(spark, sf_dir):
    return _wc(spark, sf_dir).select(*_bounds(), "id", "n", "username", "text")


def tag_counts(spark, sf_dir):
    return tr.tag_counts(tr.tweet_tags(_wc(spark, sf_dir))).select(*_bounds(), "tag", "tag_count")


def _rows(spark, sf_dir):
    return tr.trending_rows(_wc(spark, sf_dir))


_ROW_COLS = ["id", "tag_count", "tag", "username", "tweet_count", "text"]


def trending_rows(spark, sf_dir):
    return _rows(spark, sf_dir).select(*_bounds(), *_ROW_COLS)


def trending_top(spark, sf_dir):
    return tr.run_limited_top(_rows(spark, sf_dir)).select(*_bounds(), "rank", *_ROW_COLS)


def trending_log(spark, sf_dir):
    """Every trending row numbered in report order per window."""
    rows = _rows(spark, sf_dir)
    n = number_rows(rows, "window", tr.report_order(), out="line_no")
    return n.select(*_bounds(), "line_no", tr.report_line(F.col("line_no")).alias("line"))


QUERIES = {
    "lang_override": lang_override,
    "hashtags": hashtags,
    "windowed_counts": windowed_counts,
    "tag_counts": tag_counts,
    "trending_rows": trending_rows,
    "trending_top": trending_top,
    "trending_log": trending_log,
}

TWEETS_SQL = """
t as (
  select event_id, ts, event_type <> 'signup' as is_retweet,
    case event_type when 'error' then 'no' when 'view' then 'fr' else 'en' end as lang, k::bigint as id,
    concat('user', cast(k % 17 as varchar)) as username,
    case when k % 5 = 0 then concat('plain post ', cast(k as varchar))
         else concat('post ', cast(k as varchar), ' #t', substring('abcdefg', k % 7 + 1, 1),
                     ' #', substring('xyz', k % 3 + 1, 1), '! #2017 end') end as text
  from (select *, cast(json_extract_string(props, '$.k') as int) as k from events) e),
tags_of as (
  select event_id, id, text,
    list_distinct(list_transform(
      list_filter(string_split(text, ' '), lambda x: starts_with(x, '#')),
      lambda x: case when regexp_matches(x, '\\p{L}\\z') then x else left(x, length(x) - 1) end)) as tl
  from t)
"""

_ROWS = "with " + TWEETS_SQL + """,
rt as (select epoch_us(ts) as us, id, username, text from t
       where is_retweet and lang in ('en', 'no')),
wc as (select (us // 3600000000 - j) * 3600000000 as start, id, count(*) as n,
              min(username) as username, min(text) as text
       from rt, range(0, 12) r(j) group by all),
tg as (select start, id, n, username, text,
         unnest(case when len(tl) > 0 then tl else ['None'] end) as tag
       from wc join (select distinct id, tl from tags_of) x using (id)),
tc as (select start, tag, case when tag = 'None' then 0 else count(*) end::int as tag_count
       from tg group by start, tag),
rows as (select start, id, tag_count, tag, username, (n + 1)::int as tweet_count, text
         from tg join tc using (start, tag))
"""

_B = "start // 1000000 as w_start, start // 1000000 + 43200 as w_end"
_ORDER = "order by tag_count desc, tweet_count desc, tag, id"

ORACLE = {
    "lang_override": "with " + TWEETS_SQL + f""",
s as (select event_id, case when event_id % 3 > 0 then 'lt' else lang end as lang,
             ({list(STATUS_TEXTS)})[event_id % {len(STATUS_TEXTS)} + 1] as status from t),
c as (select *, regexp_replace(regexp_replace(
               case when instr(status, 'RT') > 0
                    then left(status, instr(status, 'RT') - 1) || substr(status, instr(status, 'RT') + 2)
                    else status end,
               '@\\p{{L}}+', '', 'g'), 'https?://[^ ]+ ?', '', 'g') as bare from s)
select event_id, status,
  case when lang = 'lt' and regexp_matches(bare, '[\\x{{3040}}-\\x{{309F}}]') then 'ja'
       when lang = 'lt' and regexp_matches(bare, '\\p{{Hangul}}') then 'ko' else lang end as lang
from c""",
    "hashtags": "with " + TWEETS_SQL + """
select event_id, unnest(case when len(tl) > 0 then tl else ['None'] end) as tag from tags_of""",
    "windowed_counts": _ROWS + f" select {_B}, id, n, username, text from wc",
    "tag_counts": _ROWS + f" select {_B}, tag, tag_count from tc",
    "trending_rows": _ROWS + f"""
select {_B}, id, tag_count, tag, username, tweet_count, text from rows""",
    "trending_top": _ROWS + f""",
r1 as (select *, case when lag(tag) over (partition by start {_ORDER}) is null
                        or lag(tag) over (partition by start {_ORDER}) <> tag then 1 else 0 end as nw
       from rows),
r2 as (select *, sum(nw) over (partition by start {_ORDER} rows unbounded preceding) as run from r1),
r3 as (select *, row_number() over (partition by start, run {_ORDER}) as k from r2),
r4 as (select *, row_number() over (partition by start {_ORDER}) as rank from r3 where k <= 3)
select {_B}, rank::int as rank, id, tag_count, tag, username, tweet_count, text from r4 where rank <= 10""",
    "trending_log": _ROWS + f""",
n as (select *, row_number() over (partition by start {_ORDER}) as line_no from rows)
select {_B}, line_no,
  concat(line_no::varchar, '. ', tag_count::varchar, ' ', tag, ':', username, ':',
         tweet_count::varchar, ' ', text) as line
from n""",
}


# ---------------------------------------------------------------- stream
WATERMARK = "1 hour"
# Warm-up of the second stream query: windows opening before it are left out.
START = "2024-01-10 00:00:00"


def _stream(spark, sf_dir, start=None, read=None):
    """What ``read(out)`` makes of a finished run's outputs (its rows)."""
    from ravel.session import remove_path, scratch_path
    from ravel.streaming.trending_stream import run_to_end

    out, ckpt = scratch_path(spark, "trending-out"), scratch_path(spark, "trending-ckpt")
    try:
        run_to_end(spark, sf_dir, out, ckpt, WINDOW, SLIDE, WATERMARK, start=start)
        return (read or _stream_rows)(spark, out).checkpoint(eager=True)
    finally:
        remove_path(spark, out)
        remove_path(spark, ckpt)


_ROW_SCHEMA = ("window struct<start:timestamp,end:timestamp>, id long, tag_count int, tag string, "
               "username string, tweet_count int, text string, epoch int")


def _stream_rows(spark, out):
    from ravel.streaming.outputs import read_committed

    return read_committed(spark, out, "rows", schema=_ROW_SCHEMA).select(*_bounds(), *_ROW_COLS)


def trending_stream(spark, sf_dir):
    """The stream over the events table, run to the end (availableNow); its
    rows for every window closed by the final watermark."""
    return _stream(spark, sf_dir)


def trending_warmup(spark, sf_dir):
    """The same stream with a warm-up: windows that open before ``START``
    are not reported."""
    return _stream(spark, sf_dir, START)


QUERIES["trending_stream"] = trending_stream
QUERIES["trending_warmup"] = trending_warmup
ORACLE["trending_stream"] = _ROWS + f""",
wm as (select max(us) - 3600000000 as w from rt)
select {_B}, id, tag_count, tag, username, tweet_count, text from rows, wm
where start + 43200000000 <= wm.w"""
ORACLE["trending_warmup"] = ORACLE["trending_stream"] + f"""
  and start >= epoch_us(timestamp '{START}')"""


def trending_joined(spark, sf_dir):
    """The program as one streaming plan, chained aggregations and a
    stream-stream join, run to the end; its rows for every closed window."""
    from ravel.session import remove_path, scratch_path
    from ravel.sources.tables import tweets_from_events
    from ravel.streaming.trending_stream import events_stream, finish, start_joined

    out, ckpt = scratch_path(spark, "joined-out"), scratch_path(spark, "joined-ckpt")
    try:
        finish(start_joined(tweets_from_events(events_stream(spark, sf_dir)), out, ckpt,
                            WINDOW, SLIDE, WATERMARK, available_now=True))
        return spark.read.parquet(out).select(*_bounds(), *_ROW_COLS).checkpoint(eager=True)
    finally:
        remove_path(spark, out)
        remove_path(spark, ckpt)


QUERIES["trending_joined"] = trending_joined
ORACLE["trending_joined"] = ORACLE["trending_stream"]


def trending_stream_top(spark, sf_dir):
    """The top rows the stream wrote for every closed window."""
    from ravel.streaming.outputs import read_committed

    return _stream(spark, sf_dir, read=lambda s, out: read_committed(
        s, out, "top", schema=_ROW_SCHEMA.replace("epoch", "rank int, epoch"))
        .select(*_bounds(), "rank", *_ROW_COLS))


def trending_stream_log(spark, sf_dir):
    """The lines of the log the stream wrote, read from its text files."""
    from ravel.streaming.outputs import read_committed

    return _stream(spark, sf_dir, read=lambda s, out: read_committed(
        s, out, "log", "text", "value string, epoch int").select(F.col("value").alias("line")))


STREAM_PARTS = 4


def trending_resume(spark, sf_dir):
    """The stream over the events in groups of files, one group a tick: stopped
    while it runs on a timed trigger, its last epoch's commit lost, and resumed from
    the checkpoint, with state in RocksDB; its rows for every closed window."""
    from ravel.session import remove_path, scratch_path
    from ravel.sources.tables import table, tweets_from_events
    from ravel.streaming.trending_stream import (finish, forget_last_commit, start_trending,
                                                 stop_after, stream_session, write_in_time_order)

    base = scratch_path(spark, "resume")
    events = table(spark, sf_dir, "events")
    own = stream_session(spark)
    # files of a tick, by the session's partitions
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // STREAM_PARTS)
    try:
        write_in_time_order(events, f"{base}/in", STREAM_PARTS, files=files)

        def start(**how):
            statuses = tweets_from_events(own.readStream.schema(events.schema)
                                          .option("maxFilesPerTrigger", files).parquet(f"{base}/in"))
            return start_trending(statuses, f"{base}/out", f"{base}/ckpt", WINDOW, SLIDE,
                                  WATERMARK, **how)

        stop_after(start(processing_time="1 second"), epochs=STREAM_PARTS // 2)
        forget_last_commit(spark, f"{base}/ckpt")
        finish(start(available_now=True))
        return _stream_rows(spark, f"{base}/out").checkpoint(eager=True)
    finally:
        remove_path(spark, base)


QUERIES |= {"trending_stream_top": trending_stream_top, "trending_stream_log": trending_stream_log,
            "trending_resume": trending_resume}
_CLOSED = ORACLE["trending_stream"].split("select " + _B)[0]
_IS_CLOSED = "start + 43200000000 <= (select w from wm)"
ORACLE["trending_resume"] = ORACLE["trending_stream"]
ORACLE["trending_stream_top"] = ORACLE["trending_top"].replace(_ROWS, _CLOSED.rstrip()) + f"""
  and {_IS_CLOSED}"""
ORACLE["trending_stream_log"] = _CLOSED + f""",
n as (select *, row_number() over (partition by start {_ORDER}) as i from rows where {_IS_CLOSED}),
heads as (select distinct start from n)
select concat(i::varchar, '. ', tag_count::varchar, ' ', tag, ':', username, ':',
              tweet_count::varchar, ' ', text) as line from n
union all select repeat('-', 35) from n
union all select unnest(['', repeat('=', 38),
  'Time: ' || strftime(make_timestamp(start + 43200000000), '%H:%M:%S'), repeat('=', 38)]) from heads"""


def lang_names(spark, sf_dir):
    """The corrected codes of ``lang_override`` with their English names."""
    from ravel.sources.languages import language_names, with_language_name

    return with_language_name(lang_override(spark, sf_dir), language_names(spark)) \
        .select("event_id", "lang", "language")


def trending_arrival(spark, sf_dir):
    """Windows by arrival: the events are recorded by a stream with arrivals up
    to 90 minutes after their own time, and the program's stream runs over the
    record; its rows for every closed window."""
    from ravel.session import remove_path, scratch_path
    from ravel.sources.tables import tweets_from_events
    from ravel.streaming.arrivals import by_arrival, record_arrivals
    from ravel.streaming.trending_stream import events_stream, finish, start_trending

    base = scratch_path(spark, "arrivals")
    try:
        taken = tweets_from_events(events_stream(spark, sf_dir))
        late = F.make_dt_interval(secs=F.pmod(F.col("event_id") * 37, F.lit(DELAY)).cast("int"))
        finish(record_arrivals(taken, f"{base}/record", f"{base}/ckpt-in",
                               F.col("ts") + late, available_now=True))
        kept = spark.readStream.schema(spark.read.parquet(f"{base}/record").schema) \
            .parquet(f"{base}/record")
        finish(start_trending(by_arrival(kept), f"{base}/out", f"{base}/ckpt", WINDOW, SLIDE,
                              WATERMARK, available_now=True))
        return _stream_rows(spark, f"{base}/out").checkpoint(eager=True)
    finally:
        remove_path(spark, base)


DELAY = 5400
QUERIES |= {"lang_names": lang_names, "trending_arrival": trending_arrival}
ORACLE["lang_names"] = f"""
with o as ({ORACLE["lang_override"]})
select event_id, lang, name as language
from o join (values ('en', 'English'), ('no', 'Norwegian'), ('fr', 'French'), ('lt', 'Lithuanian'),
                    ('ja', 'Japanese'), ('ko', 'Korean')) n(code, name) on lang = code"""
ORACLE["trending_arrival"] = ORACLE["trending_stream"].replace(
    "epoch_us(ts) as us", f"epoch_us(ts) + event_id * 37 % {DELAY} * 1000000 as us")
