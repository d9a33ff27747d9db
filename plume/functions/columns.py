"""Column expressions: every scalar operator is a JVM-side expression."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from plume.schemas import HASHTAG_NOISE, LABEL_TO_ID, SENTIMENT_NEG, SENTIMENT_POS, USERNAME_PATTERN

COUNTERS = ["replyCount", "retweetCount", "likeCount", "quoteCount"]

# Characters Python's ``str.strip()`` removes (``str.isspace``), listed so the JVM and the SQL oracle
# strip exactly the same set.
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                  + "\u2028\u2029\u202f\u205f\u3000")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def engagement_strict(*counters) -> Column:
    """Sum of the four counters as long; null as soon as one counter is null (stream rule)."""
    cs = counters or COUNTERS
    out = None
    for c in cs:
        v = _c(c).cast("long")
        out = v if out is None else out + v
    return out


def engagement_safe(*counters) -> Column:
    """Sum of the four counters as long with null counted as 0 (batch rule)."""
    cs = counters or COUNTERS
    out = None
    for c in cs:
        v = F.coalesce(_c(c).cast("long"), F.lit(0).cast("long"))
        out = v if out is None else out + v
    return out


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing whitespace in Python's sense."""
    return F.trim(_c(c), F.lit(PY_SPACE_CHARS))


def username_from_user(c="user") -> Column:
    """First ``'username': '...'`` value; ``''`` when absent, null when the input is null."""
    return F.regexp_extract(_c(c), USERNAME_PATTERN, 1)


def hashtags_array(c="hashtags") -> Column:
    """Hashtag text -> array: list marks, quotes and white space go, commas part the tags, empty ones drop."""
    bare = F.regexp_replace(F.coalesce(_c(c), F.lit("")), HASHTAG_NOISE, "")
    return F.filter(F.split(bare, ","), lambda t: t != "")


# One whole string literal of either quote kind, escapes included (possessive: linear on any input).
_STR = r"""(?:'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+")"""
# A literal once its strings are masked: brackets, numbers and the constants, no names and so no calls.
_LITERAL = r"(?s)^[ \t]*(?:\[.*\]|\{.*\})\s*$"
_PLAIN = r"^(?:[\s,:\[\]{}().+0-9eE_-]|S|None|True|False)*$"
_NESTED = (r"(:\s*)(?:\{(?:[^{}'\"]++|" + _STR + r")*+\}|\[(?:[^\[\]'\"]++|" + _STR + r")*+\])")
_PAIR = rf"(?s){_STR}(?:\s*:\s*{_STR})?+"
_NAME_PAIR = rf"(?s)^(?:'username'|\"username\")\s*:\s*(?:'(.*)'|\"(.*)\")$"


def mentions_array(c="mentionedUsers") -> Column:
    """Mentioned usernames of a text that holds a list of dicts, or one dict.

    The text is read as whole string literals, so quotes, brackets and keys inside other fields mean nothing.
    Null, empty and free text, open lists, and texts with names or calls outside their strings give ``[]``;
    dicts inside a field's value are no items; items without a non-empty text as ``username`` are skipped.
    """
    raw = F.coalesce(_c(c), F.lit(""))
    masked = F.regexp_replace(raw, f"(?s){_STR}", "S")
    literal = masked.rlike(_LITERAL) & masked.rlike(_PLAIN)
    flat = F.regexp_replace(F.regexp_replace(raw, f"(?s){_NESTED}", "$1None"), f"(?s){_NESTED}", "$1None")
    pairs = F.regexp_extract_all(flat, F.lit(_PAIR), 0)
    values = F.transform(F.filter(pairs, lambda p: p.rlike(_NAME_PAIR)), lambda p: F.regexp_replace(F.concat(
        F.regexp_extract(p, _NAME_PAIR, 1), F.regexp_extract(p, _NAME_PAIR, 2)), r"(?s)\\(.)", "$1"))
    return F.when(literal, F.filter(values, lambda v: v != "")).otherwise(F.array().cast("array<string>"))


# What the normalised text is freed of, in order; each match becomes one space.  ``(?U)`` gives the URL rule Python's
# Unicode ``\S`` on the JVM.
_NOISE = (r"(?U)http\S+|www\.\S+", r"[@#][a-z0-9_]+", r"[^a-z]+")
# A text without any of these has no match, and no regex goes over it.
_SIGNS = (("http", "www."), ("@", "#"), ())


def _freed(text: Column, pattern: str, signs: tuple[str, ...]) -> Column:
    """``text`` with matches as spaces; a lambda, so that ``text`` is computed once."""
    if not signs:
        return F.regexp_replace(text, pattern, " ")
    return F.element_at(F.transform(F.array(text), lambda x: F.when(
        reduce(or_, [F.contains(x, F.lit(s)) for s in signs]), F.regexp_replace(x, pattern, " ")).otherwise(x)), 1)


def clean_text(c) -> Column:
    """Lower-case; URLs, @names and #tags -> space; keep a-z and whitespace; collapse and strip.

    Three regex passes give the result of the five-step rule: ``@name`` and
    ``#tag`` matches never overlap, so one pass removes both; and "non-letter
    -> space, then whitespace runs -> one space" is "every run of characters
    outside a-z -> one space".  The first two passes only go over texts with
    their signs.
    """
    t = F.lower(F.coalesce(_c(c), F.lit("")))
    for pattern, signs in zip(_NOISE, _SIGNS):
        t = _freed(t, pattern, signs)
    return F.trim(t)


def clean_text_sql(name: str) -> str:
    """``clean_text`` of a column as Spark SQL text, for stages that are saved."""
    t = f"lower(coalesce(`{name}`, ''))"
    for pattern in _NOISE:
        t = f"regexp_replace({t}, r'{pattern}', ' ')"
    return f"trim({t})"


def argmax_index(arr) -> Column:
    """0-based index of the largest element (first one on ties)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def score_to_class(score) -> Column:
    """Score -> Negative / Neutral / Positive at the fixed thresholds."""
    s = _c(score)
    return (F.when(s <= F.lit(SENTIMENT_NEG), "Negative")
            .when(s >= F.lit(SENTIMENT_POS), "Positive")
            .otherwise("Neutral"))


def label_id(c) -> Column:
    """Sentiment name -> id (null for other names)."""
    m = F.create_map(*[x for k, v in LABEL_TO_ID.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(c)].cast("int")


def label_name(c) -> Column:
    """Sentiment id -> name."""
    m = F.create_map(*[x for k, v in LABEL_TO_ID.items() for x in (F.lit(v), F.lit(k))])
    return m[_c(c)]


def percent(part, total) -> Column:
    """100 * part / total, total 0 treated as 1, rounded to one decimal."""
    t = _c(total)
    return F.round(F.lit(100.0) * _c(part) / F.when(t == 0, F.lit(1)).otherwise(t), 1)
