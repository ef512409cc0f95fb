"""Phone-number patterns: find every international number in a text and
bring it to a canonical '+<country><digits>' form.

Fixed values (must equal the reference's for equal results):
  filler      F = [\\(\\)\\- ]*          brackets, hyphens, spaces, any number
  zero group  Z = (?:F\\( *?0 *?\\))     an optional '(0)' trunk prefix
  number      (?:(?<=non-digit)00 F c1 F c2 .. | \\+ F c1 F c2 ..) Z? (?:F[0-9]){digits}
  canonical   remove Z or F everywhere, then a leading '00' becomes '+'
with country code 31 and 9 digits as the defaults.

"Non-digit" is any character outside Unicode class Nd (what Python's
``\\D`` means), hence ``\\P{Nd}`` -- Java's ``\\D`` is ASCII-only.
There is no trailing boundary: a longer digit run is cut after ``digits``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FILLER = r"[\(\)\- ]*"
ZERO_GROUP = r"(?:" + FILLER + r"\( *?0 *?\))"


def _country(code: str) -> str:
    if not code.isdigit():
        raise ValueError(f"country code must be digits: {code!r}")
    return "".join(FILLER + d for d in code)


def number_pattern(country: str = "31", digits: int = 9) -> str:
    """Java-regex pattern of one number (lookbehind form)."""
    c = _country(country)
    return (r"(?:(?<=\P{Nd})00" + c + r"|\+" + c + r")" + ZERO_GROUP + r"?(?:"
            + FILLER + r"[0-9]){" + str(digits) + "}")


CLEAN = ZERO_GROUP + "|" + FILLER


def canonical(match) -> Column:
    """Canonical form of one matched number."""
    bare = F.regexp_replace(match, CLEAN, "")
    return F.regexp_replace(bare, r"^00", "+")


def numbers_in(text, country: str = "31", digits: int = 9) -> Column:
    """array<string>: the distinct canonical numbers found in ``text``."""
    found = F.regexp_extract_all(text, F.lit(number_pattern(country, digits)), 0)
    return F.array_distinct(F.transform(found, canonical))
