"""URL filters: host rules, then a weighted vocabulary found by Aho-Corasick.

A rule names a host (with its subdomains) and a path prefix; the longest rule
that fits decides. Where none fits, one automaton finds all vocabulary terms
in the lower-cased URL. A hit counts only between boundaries: no ASCII letter
or digit right before or after it. A strict term rejects the URL by itself;
of soft terms the weights of the distinct ones add up, and ``SOFT_HITS`` reject
it. The built-in soft terms weigh one each; ``vocabulary`` takes a table of
terms with weights of their own, from a frame or a Parquet path.

Scale: rows are judged where they are read; nothing is shuffled. Rules and
vocabulary (at most ``MAX_TERMS`` terms, checked) travel with the function.

Edge cases: a null URL, or one without ``://``, has an empty host and path and
fits no rule; its text is still searched for terms (a null has none and is
allowed). A host keeps its port and user part. A repeated row is judged again
with the same result. Extra columns are ignored; where pages are filtered they
pass through.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, read

# Fixed values of the contract: (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))
# One strict term is enough; soft terms need company.
STRICT = ("adult", "porn", "porno", "xxx", "casino", "hentai", "escort", "viagra", "gambling",
          "warez")
SOFT = ("free", "bets", "bet", "win", "bonus", "jackpot", "poker", "slots", "cheap", "pills",
        "sex", "nude", "cams", "dating", "hot", "torrent", "crack", "loan", "loans", "prize")
SOFT_HITS = 2
MAX_TERMS = 1_000_000
_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://`` up to / ? # or the end, A-Z
    lower-cased; then up to ? # or the end."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate(_UPPER), path[:stop]


class Filter:
    """Rules and vocabulary, ready to judge; built once in each task."""

    def __init__(self, rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS,
                 terms=None):
        """``terms``: (term, weight, strict) instead of ``strict`` and ``soft``."""
        import ahocorasick

        self.rules = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.rules.setdefault(host, []).append((rule, slash + path, verdict))
        self.soft_hits = soft_hits
        self.terms = ahocorasick.Automaton()
        if terms is None:
            terms = [*((t, 1, False) for t in soft), *((t, soft_hits, True) for t in strict)]
        for term, weight, alone in terms:
            self.terms.add_word(term, (term, max(weight, soft_hits) if alone else weight))
        self.terms.make_automaton()

    def rule_for(self, host: str, path: str):
        """(rule, verdict) of the longest fitting rule, or None."""
        best, at = None, 0
        while True:
            for rule, prefix, verdict in self.rules.get(host[at:], ()):
                if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                    best = (rule, verdict)
            at = host.find(".", at) + 1
            if not at:
                return best

    def weight(self, url: str | None) -> int:
        """Summed weight of the distinct terms between boundaries."""
        text = (url or "").translate(_UPPER)
        found = {}
        for end, (term, weight) in self.terms.iter(text) if len(self.terms) else ():
            start = end - len(term) + 1
            if not (start and _inner(text[start - 1])) and not _inner(text[end + 1:end + 2]):
                found[term] = weight
        return sum(found.values())

    def judge(self, url: str | None):
        """(host, path, rule or None, verdict, weight of terms)."""
        host, path = split_url(url)
        fit = self.rule_for(host, path) if host else None
        weight = self.weight(url)
        if fit:
            return host, path, fit[0], fit[1], weight
        return host, path, None, "block" if weight >= self.soft_hits else "allow", weight


def vocabulary(spark: SparkSession, source) -> list[tuple[str, int, bool]]:
    """(term, weight, strict) of a table with these columns, a frame or a Parquet
    path, for ``terms``. A-Z are lower-cased; null and empty terms go, a null
    weight is 1, a null flag false; a repeated term has its largest weight and
    is strict if any row says so."""
    rows = spark.read.parquet(source) if isinstance(source, str) else source
    term = F.translate("term", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = (rows.where("term is not null and term <> ''").groupBy(term.alias("term"))
            .agg(F.max(F.coalesce(F.col("weight").cast("int"), F.lit(1))).alias("weight"),
                 F.max(F.coalesce("strict", F.lit(False))).alias("strict")))
    found = rows.limit(MAX_TERMS + 1).collect()
    if len(found) > MAX_TERMS:
        raise ValueError(f"over {MAX_TERMS} terms")
    return sorted((r.term, r.weight, r.strict) for r in found)


def _inner(c: str) -> bool:
    return bool(c) and c.isascii() and c.isalnum()


_FIELDS = (("host", "string"), ("path", "string"), ("rule", "string"), ("verdict", "string"),
           ("term_weight", "int"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               **parameters) -> DataFrame:
    """(page_id, host, path, rule, verdict, term_weight) of every row."""
    bound_batches(pages.sparkSession, 4096)

    def run(batches):
        f = Filter(**parameters)
        for b in batches:
            rows = [f.judge(u) for u in b["url"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], *(pa.array([r[i] for r in rows],
                                          pa.string() if t == "string" else pa.int32())
                                 for i, (_, t) in enumerate(_FIELDS))],
                ["page_id", *(n for n, _ in _FIELDS)])

    return pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).alias("url")).mapInArrow(
        run, "page_id long, " + ", ".join(f"{n} {t}" for n, t in _FIELDS))


def keep_allowed(pages: DataFrame, **parameters) -> DataFrame:
    """``pages`` without the blocked rows."""
    bound_batches(pages.sparkSession)

    def run(batches):
        f = Filter(**parameters)
        for b in batches:
            yield b.filter(pa.array([f.judge(u)[3] == "allow" for u in b["url"].to_pylist()],
                                    pa.bool_()))

    return pages.mapInArrow(run, pages.schema)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``pages``."""
    return judge_urls(read(spark, sf_dir, "pages"))


def _term_sql(terms) -> str:
    return " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::int" for t in terms)


_RULE_SQL = ", ".join(f"('{v}', '{r}', '{r.split('/')[0]}', '/{r.split('/', 1)[1]}')"
                      for v, r in RULES)
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

QUERIES = {"op5_url_filter": op5_url_filter}
ORACLE = {"op5_url_filter": f"""
with parts as (
  select row_number() over () as rid, page_id, translate(coalesce(url, ''), {_AZ}) as u,
         case when url like '%://%'
              then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
p as (
  select rid, page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts),
rules(verdict, rule, rule_host, rule_path) as (values {_RULE_SQL}),
fits as (
  select page_id, u, host, path, r.rule, r.verdict,
         row_number() over (partition by rid order by length(r.rule) desc nulls last) as n
  from p left join rules r
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)),
weighed as (
  select *, ({_term_sql(SOFT)}) + {SOFT_HITS} * ({_term_sql(STRICT)}) as w
  from fits where n = 1)
select page_id, host, path, rule,
       coalesce(verdict, case when w >= {SOFT_HITS} then 'block' else 'allow' end) as verdict,
       w::int as term_weight
from weighed
"""}
