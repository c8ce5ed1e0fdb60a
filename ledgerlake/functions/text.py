"""String helpers (F1-F4, F14-F18).  All are built-in Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def left(x, n: int) -> Column:
    """first n characters."""
    return F.substring(_c(x), 1, n)


def norm_key(x) -> Column:
    """trimmed, upper-cased text used as a join / lookup key."""
    return F.upper(F.trim(_c(x)))


def concat_keys(*parts, sep: str = "-") -> Column:
    """``a || sep || b`` — NULL when any part is NULL (SQL semantics)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p))
    return F.concat(*cols)


def like_any(x, patterns: Sequence[str]) -> Column:
    """SQL LIKE against any of several patterns."""
    expr = None
    for p in patterns:
        e = _c(x).like(p)
        expr = e if expr is None else (expr | e)
    return expr


def zero_pad(n, width: int = 6) -> Column:
    """zero-padded code; a longer code keeps all its digits."""
    text = _c(n).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


# the outermost JSON array / object inside free text (fences and prose dropped)
JSON_SPAN = r"(?s)([\[{].*[\]}])"


def json_span(text) -> Column:
    """first opening bracket … last closing bracket, or NULL."""
    span = F.regexp_extract(_c(text), JSON_SPAN, 1)
    return F.when(span != "", span)


def json_from_text(text, schema: str) -> Column:
    """parse the JSON span of free text with ``schema``; unparseable → NULL."""
    return F.from_json(json_span(text), schema, {"mode": "PERMISSIVE"})


# F16: reasoning blocks and wrapping quotes / back-ticks removed from an answer
THINK_BLOCK = r"(?is)<think>.*?</think>"
WRAPPING = r"^[\s`'\"]+|[\s`'\"]+$"


def clean_answer(text) -> Column:
    """F16: drop ``<think>…</think>`` blocks, then trim quotes/back-ticks/space."""
    return F.regexp_replace(F.regexp_replace(_c(text), THINK_BLOCK, ""), WRAPPING, "")


def json_path_fallback(payload, paths: Sequence[str]) -> Column:
    """first non-empty value among several JSON paths."""
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(_c(payload), p)), F.lit(""))
                        for p in paths]).cast(StringType())


def split_list(x, pattern: str = "[,/]") -> Column:
    """delimited list → array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(_c(x), pattern), lambda s: F.trim(s)), lambda s: s != "")
