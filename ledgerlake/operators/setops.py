"""Set operations and period accumulation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """SQL ``UNION`` (by name; missing columns become typed NULLs)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def period_accumulate(history: DataFrame, new: DataFrame, period: str = "period",
                      anchor: Column | None = None) -> DataFrame:
    """History without the new period ∪ the new period's rows.

    ``anchor`` defaults to the new batch's period (scalar subquery).  The
    comparison is NULL-safe, so an empty batch does not wipe history (q2)."""
    if anchor is None:
        anchor = new.select(F.max(period)).scalar()
    keep = history.where(~F.col(period).eqNullSafe(anchor) | anchor.isNull())
    return keep.unionByName(new, allowMissingColumns=True)


def restatement(provisional: DataFrame, restated: DataFrame, period: str = "period") -> DataFrame:
    """All provisional periods except the restated one ∪ the restated rows.
    The restated period is the other table's max; an empty restated table keeps
    every provisional row (the reference's ``period != NULL`` drops all, q2)."""
    restated_period = F.coalesce(restated.select(F.max(period)).scalar(), F.lit(""))
    return provisional.where(~F.col(period).eqNullSafe(restated_period)).unionByName(restated, allowMissingColumns=True)
