"""Aggregates, pivots, reshape and bounded reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mean(x) -> Column:
    """Average as exact-sum ÷ count in DOUBLE (engine-independent rounding)."""
    return F.sum(_c(x)).cast("double") / F.count(_c(x)).cast("double")


def group_avg(df: DataFrame, keys: Sequence[str], value: str, out: str, drop_null_keys: bool = False
              ) -> DataFrame:
    """A1: grouped average.  SQL keeps NULL group keys; the pandas ingest path
    drops them (``drop_null_keys=True``)."""
    src = df.na.drop(subset=list(keys)) if drop_null_keys else df
    return src.groupBy(*keys).agg(mean(value).alias(out))


def weighted_unit(num, den) -> Column:
    """A2: ``SUM(x) / NULLIF(SUM(q), 0)`` as DOUBLE."""
    d = F.sum(_c(den)).cast("double")
    return F.when(d != 0, F.sum(_c(num)).cast("double") / d)


def conditional_pivot(df: DataFrame, keys: Sequence[str], category: str, value: str,
                      targets: Mapping[str, Sequence[str]]) -> DataFrame:
    """A3 / R2: ``SUM(CASE WHEN category IN (...) THEN value END)`` per target
    column; several categories may feed one column.  One aggregate pass."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(category).isin(list(cats)), F.col(value))).alias(col)
        for col, cats in targets.items()])


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """A4."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key tuple occurs more than once.

    Counted with a partial aggregate, then a semi-join back (AQE handles a hot
    key on the join) — instead of a window that would put a hot key in one task."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).drop("count")
    return df.join(dup, [df[k].eqNullSafe(dup[k]) for k in keys], "left_semi")


def violation_sample(df: DataFrame, order: Sequence[str], limit: int = 100) -> tuple[DataFrame, Column]:
    """L3: the first ``limit`` violating rows in sort order (a distributed
    top-k) and the count of the rest."""
    sample = df.orderBy(*order).limit(limit)
    rest = F.greatest(df.select(F.count(F.lit(1))).scalar() - F.lit(limit), F.lit(0))
    return sample, rest


def unpivot_matrix(df: DataFrame, index: Sequence[str], value_cols: Sequence[str], name: str,
                   value: str, label: str | None = None, label_col: str = "label") -> DataFrame:
    """Wide matrix → (index…, name, value) rows, NULL values dropped, an
    optional label column added."""
    out = df.unpivot(list(index), list(value_cols), name, value).where(F.col(value).isNotNull())
    return out.withColumn(label_col, F.lit(label)) if label is not None else out


def ordered_list(df: DataFrame, column: str) -> DataFrame:
    """L2: distinct values in order (range-partitioned sort, no single task)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
