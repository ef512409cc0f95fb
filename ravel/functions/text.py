"""Token-level column expressions shared by the word and hashtag programs.

All are built-in Spark expressions (regex, array higher-order functions),
so they run JVM-side with no Python in the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's for equal results):
# the class "ASCII punctuation except the hyphen", i.e. the characters
#   ! " # $ % & ' ( ) * + , . / : ; < = > ? @ [ \ ] ^ _ ` { | } ~
# written as ranges that Java regex and RE2 both accept.
PUNCT_EXCEPT_HYPHEN = r"[!-,./:-@\[-`{-~]"
# Sentinel put in front of every line and after every "--".
SENTINEL = "#"
# Segment break inside a line.
SEGMENT_BREAK = "--"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The same class spelled out, for character deletion without a regex.
PUNCT_CHARS = "".join(chr(c) for c in range(0x21, 0x7F)
                      if not chr(c).isalnum() and chr(c) != "-")


def strip_punct(c) -> Column:
    """Remove ASCII punctuation except '-' (letters, digits, non-ASCII stay).
    ``translate`` deletes the listed characters (no replacement given):
    code-generated, no regex per value."""
    return F.translate(col_(c), PUNCT_CHARS, "")


def starts_with_letter(c) -> Column:
    return F.left(col_(c), F.lit(1)).rlike(r"^\p{L}")


def ends_with_letter(c) -> Column:
    # \z, not $: '$' would also match before a trailing line terminator.
    return F.right(col_(c), F.lit(1)).rlike(r"\p{L}\z")


def drop_first_char(c) -> Column:
    return F.substr(col_(c), F.lit(2))


def drop_last_char(c) -> Column:
    c = col_(c)
    return F.substring(c, 1, F.greatest(F.length(c) - 1, F.lit(0)))


def space_tokens(c) -> Column:
    """Split on the single space character only, dropping empty tokens
    (a tab or newline stays inside a token)."""
    return F.array_remove(F.split(col_(c), " "), "")


def adjacent_pairs(tokens) -> Column:
    """array<struct<b,a>> of each token ``a`` with the token ``b`` before it.
    NULL (so no rows after explode) when there are fewer than two tokens.
    No lambda functions: plans holding it stay comparable, so Spark reuses
    a shuffle of the same pairs across branches of one query."""
    t = col_(tokens)
    n = F.size(t)
    return F.when(n >= 2, F.arrays_zip(F.slice(t, 1, n - 1).alias("b"),
                                       F.slice(t, 2, n - 1).alias("a")))


def sentinel_segments(line) -> Column:
    """Lower-case the line with the sentinel in front, then cut it at every
    '--', each new segment starting with the sentinel again."""
    s = F.concat(F.lit(SENTINEL + " "), F.lower(col_(line)))
    s = F.replace(s, F.lit(SEGMENT_BREAK), F.lit(SEGMENT_BREAK + SENTINEL + " "))
    return F.split(s, SEGMENT_BREAK)


def hashtags(text) -> Column:
    """Distinct hashtags of a text, case-sensitive, in first-seen order.

    Tokens are split on ' ' only; a token starting with '#' is a tag; when
    its last character is not a letter exactly one character is dropped
    (so '#2017' -> '#201', '#tag!!' -> '#tag!', '#' -> '')."""
    toks = F.filter(F.split(col_(text), " "), lambda t: t.startswith("#"))
    fixed = F.transform(
        toks, lambda t: F.when(t.rlike(r"\p{L}\z"), t).otherwise(drop_last_char(t)))
    return F.array_distinct(fixed)


# Fixed value: the tag reported for a tweet without hashtags.
NO_TAG = "None"


def hashtags_or_none(text) -> Column:
    tags = hashtags(text)
    return F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit(NO_TAG)))


def clean_for_language(text) -> Column:
    """Text the language test looks at: the first 'RT' removed, then
    '@name' mentions, then links with one following whitespace."""
    t = F.regexp_replace(col_(text), r"(?s)^(.*?)RT", "$1")
    t = F.regexp_replace(t, r"@\p{L}+", "")
    return F.regexp_replace(t, r"https?://\S+\s?", "")


def language_override(lang, cleaned_text) -> Column:
    """Code 'lt' becomes 'ja' when the text holds Hiragana, else 'ko' when
    it holds Hangul; other codes are kept."""
    lang = col_(lang)
    t = col_(cleaned_text)
    return (F.when((lang == "lt") & t.rlike(r"\p{InHiragana}"), F.lit("ja"))
             .when((lang == "lt") & t.rlike(r"\p{IsHangul}"), F.lit("ko"))
             .otherwise(lang))
