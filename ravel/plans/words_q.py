"""Word-program queries (documents, one row per line)."""

from __future__ import annotations


from pyspark.sql import functions as F

from ravel.operators import words
from ravel.operators.ordering import number_rows
from ravel.sinks.text import predecessor_report_lines, report_order
from ravel.sources.tables import document_lines


def word_totals(spark, sf_dir):
    return words.word_totals(document_lines(spark, sf_dir))


def word_prev_counts(spark, sf_dir):
    return words.word_prev_counts(document_lines(spark, sf_dir))


# Row bound of one predecessor list (larger lists continue in the next chunk);
# small, so that the queries' lists do continue.
LIST_ROWS = 8


def word_prev_lists(spark, sf_dir):
    return words.predecessor_lists_flat(document_lines(spark, sf_dir), max_prevs_per_row=LIST_ROWS)


def word_report(spark, sf_dir):
    """The report's lines with their line numbers in report order."""
    counts = words.word_prev_counts_all(document_lines(spark, sf_dir))
    rows = predecessor_report_lines(counts).withColumn("report", F.lit(1))
    return number_rows(rows, "report", report_order(), out="line_no").drop("report")


QUERIES = {
    "word_totals": word_totals,
    "word_prev_counts": word_prev_counts,
    "word_prev_lists": word_prev_lists,
    "word_report": word_report,
}

# DuckDB restatement of the word rules: lines -> sentinel segments -> space
# tokens -> adjacent pairs -> (word, prev or NULL).
_PAIRS = r"""
with lines as (
  select unnest(string_split(case when doc_id % 3 = 0 then replace(text, ', ', '--') else text end,
                             chr(10))) as line from documents),
segs as (
  select unnest(string_split(replace('# ' || lower(line), '--', '--# '), '--')) as seg from lines),
toks as (
  select list_filter(string_split(seg, ' '), lambda t: t <> '') as t from segs),
idx as (
  select t, unnest(range(1, len(t))) as i from toks),
raw as (select t[i] as b, t[i + 1] as a from idx),
pairs as (
  select
    case when regexp_matches(a, '^\p{L}')
         then regexp_replace(a, '{P}', '', 'g')
         else regexp_replace(substr(a, 2), '{P}', '', 'g') end as word,
    case when regexp_matches(a, '^\p{L}') and regexp_matches(b, '\p{L}\z')
         then regexp_replace(b, '{P}', '', 'g') end as prev
  from raw),
counts as (select word, prev, count(*) as n from pairs group by word, prev)
""".replace("{P}", r"[!\"#$%&''()*+,./:;<=>?@\[\\\]^_`{|}~]")

ORACLE = {
    "word_totals": _PAIRS + "select word, sum(n)::bigint as n from counts group by word",
    "word_prev_counts": _PAIRS + "select word, prev, n from counts where prev is not null",
    "word_prev_lists": _PAIRS + f""",
stats as (select word, sum(n)::bigint as n from counts group by word),
ranked as (select word, prev, n,
             row_number() over (partition by word order by n desc, prev asc) as r
           from counts where prev is not null),
lists as (select word, ((r - 1) // {LIST_ROWS})::int as chunk,
            string_agg(prev || ':' || n::varchar, ',' order by r) as prevs
          from ranked group by all)
select s.word, coalesce(l.chunk, 0) as chunk, s.n, coalesce(l.prevs, '') as prevs
from stats s left join lists l using (word)""",
    "word_report": _PAIRS + """,
totals as (select word, sum(n)::bigint as word_n from counts group by word),
report as (
select word_n, word, 0 as kind, null::bigint as prev_n, null::varchar as prev,
       word || ':' || word_n::varchar as line from totals
union all
select t.word_n, c.word, 1 as kind, c.n as prev_n, c.prev,
       chr(9) || c.prev || ':' || c.n::varchar as line
from counts c join totals t on t.word = c.word where c.prev is not null)
select *, row_number() over (order by word_n desc, word, kind, prev_n desc nulls last, prev) as line_no
from report""",
}
