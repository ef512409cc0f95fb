"""Cast-list record and title rules.

A record is ``name<TAB>title<NL><TAB><TAB><TAB>title ...``: split on tab,
newlines removed from each field, empty fields dropped; the first field is
the name, the rest are titles. A title is kept when it is not a TV title
(leading double quote), after cutting it after its first ')', and when the
first four characters between its first '(' and first ')' read as an
integer >= ``min_year`` (no '(' -> from the start; unparsable -> dropped).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: release years from this one on qualify by default.
DEFAULT_MIN_YEAR = 2011


def record_fields(record) -> Column:
    fields = F.transform(F.split(record, "\t"), lambda f: F.replace(f, F.lit("\n"), F.lit("")))
    return F.filter(fields, lambda f: f != "")


def is_tv_title(title) -> Column:
    return title.startswith('"')


def cut_after_first_paren(title) -> Column:
    """Prefix up to and including the first ')'; '' when there is none."""
    return F.regexp_extract(title, r"^[^)]*\)", 0)


def year_digits(cut_title) -> Column:
    """The first four characters after the first '(' of a cut title (it
    ends at its first ')'), or from its start when it has no '('."""
    return F.regexp_extract(cut_title, r"^(?:[^(]*\()?([^)]{0,4})", 1)


def _qualifies(four, min_year: int) -> Column:
    return F.coalesce(four.rlike(r"^[+-]?[0-9]+\z")
                      & (four.try_cast("int") >= F.lit(min_year)), F.lit(False))


def year_qualifies(cut_title, min_year: int = DEFAULT_MIN_YEAR) -> Column:
    """Those four characters read as an integer (sign allowed, as an
    integer parser reads it) >= min_year; unparsable -> False."""
    return _qualifies(year_digits(cut_title), min_year)


def qualifying_movies(titles, min_year: int = DEFAULT_MIN_YEAR) -> Column:
    """array<string> of the cut titles that qualify, in record order. Each
    title is cut, and its year found, once: the lambdas hand both on."""
    kept = F.filter(titles, lambda t: ~is_tv_title(t))
    cut = F.transform(kept, cut_after_first_paren)
    dated = F.transform(cut, lambda m: F.struct(m.alias("movie"), year_digits(m).alias("year")))
    return F.transform(F.filter(dated, lambda x: _qualifies(x["year"], min_year)),
                       lambda x: x["movie"])


def movie_of_title(title, min_year: int = DEFAULT_MIN_YEAR) -> Column:
    """The qualifying movie of one raw title, or NULL."""
    return F.get(qualifying_movies(F.array(title), min_year), F.lit(0))
