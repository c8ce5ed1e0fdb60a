"""Row filters and classification rules.

Rules are data (dicts / lists) turned into one ``CASE`` expression, so the
whole rule set evaluates inside a single whole-stage-codegen projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def in_filter(df: DataFrame, column, values: Iterable, normalize: str | None = None) -> DataFrame:
    """Membership after optional 'trim' / 'upper' / 'lower' normalisation."""
    c = _c(column)
    if normalize in ("trim", "upper", "lower"):
        c = F.trim(c)
        if normalize == "upper":
            c = F.upper(c)
        elif normalize == "lower":
            c = F.lower(c)
    return df.where(c.isin(list(values)))


def keyword_exclude(df: DataFrame, column, keywords: Sequence[str]) -> DataFrame:
    """P10: drop rows containing any keyword (case-insensitive); NULL is kept."""
    hit = None
    for k in keywords:
        e = F.upper(_c(column)).contains(k.upper())
        hit = e if hit is None else (hit | e)
    return df.where(~F.coalesce(hit, F.lit(False)))


def contains_filter(df: DataFrame, column, needle: str) -> DataFrame:
    """Keep rows whose text contains ``needle``."""
    return df.where(_c(column).contains(needle))


def prefix_filter(df: DataFrame, column, prefixes: Sequence[str]) -> DataFrame:
    """``LIKE 'a%' OR LIKE 'b%'``."""
    cond = None
    for p in prefixes:
        e = _c(column).startswith(p)
        cond = e if cond is None else (cond | e)
    return df.where(cond)


def implication(a: Column, b: Column, c: Column) -> Column:
    """``NOT (a AND b) OR c`` — a restriction that applies only where a∧b
    (SQL three-valued logic is kept: NULL rows are dropped by ``where``)."""
    return (~(a & b)) | c


def nonzero_or_null(df: DataFrame, column) -> DataFrame:
    """Drop numeric zeros but keep NULL and unparseable values."""
    v = (F.trim(_c(column).cast("string"))).try_cast("double")
    return df.where(v.isNull() | (v != 0))


def case_map(column, mapping: Mapping, default=None) -> Column:
    """CASE mapping of a code; no default → NULL."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(_c(column) == k, F.lit(v)) if expr is None else expr.when(_c(column) == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def category_waterfall(pattern_rules: Sequence[tuple[Column, str]], lookup: Column | None,
                       prefix_column, prefixes: Mapping[str, str], default: str) -> Column:
    """First matching pattern → looked-up value → longest matching prefix → default."""
    expr = None
    for cond, value in pattern_rules:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if lookup is not None:
        expr = F.when(lookup.isNotNull(), lookup) if expr is None else expr.when(lookup.isNotNull(), lookup)
    for p in sorted(prefixes, key=len, reverse=True):
        cond = _c(prefix_column).startswith(p)
        expr = F.when(cond, F.lit(prefixes[p])) if expr is None else expr.when(cond, F.lit(prefixes[p]))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def keyword_dictionary(column, ordered: Sequence[tuple[str, str]], default: str | None) -> Column:
    """The first keyword contained in the (upper-cased) text wins; no hit or
    NULL text → default."""
    expr = None
    up = F.upper(_c(column))
    for kw, label in ordered:
        cond = up.contains(kw.upper())
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def override_cascade(base: Column, rules: Sequence[tuple[Column, Column]]) -> Column:
    """C4: rules applied in sequence where later rules override earlier ones —
    one CASE with the rules in reverse order."""
    expr = None
    for cond, value in reversed(list(rules)):
        c = F.coalesce(cond, F.lit(False))
        expr = F.when(c, value) if expr is None else expr.when(c, value)
    return expr.otherwise(base) if expr is not None else base


def regex_class(column, pattern: str, hit: str, miss: str) -> Column:
    """Regex test on the upper-cased text → one of two labels."""
    return F.when(F.coalesce(F.upper(_c(column)).rlike(pattern), F.lit(False)), F.lit(hit)).otherwise(F.lit(miss))


def anchor_switch(period, anchor: Column, when_anchor, otherwise) -> Column:
    """In the anchor period take one source's value, else another's."""
    return F.when(_c(period) == anchor, _c(when_anchor)).otherwise(_c(otherwise))
