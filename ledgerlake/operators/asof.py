"""Latest-per-key and as-of picks.

The reference writes these as ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY
period DESC) = 1``.  A window sends every row of a key to one task, which a hot
key (a third of all rows) would overwhelm; an arg-max *aggregate*
(``max(struct(order, payload))``) gives the same row with map-side partial
aggregation, so a hot key is pre-reduced in every task before the shuffle.
Ties are broken by the payload values, which makes the pick deterministic (q13).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def arg_max(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], payload: Sequence[str]
            ) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (NULL sorts
    lowest), ties broken by the greatest payload tuple."""
    packed = F.struct(F.struct(*[_c(o) for o in order]).alias("o"),
                      F.struct(*[F.col(p) for p in payload]).alias("v"))
    best = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.v.{p}").alias(p) for p in payload])


def latest_per_key(df: DataFrame, keys: Sequence[str], period: str, payload: Sequence[str]) -> DataFrame:
    """The latest-period row per key (period is kept in the output)."""
    cols = [period] + [p for p in payload if p != period]
    return arg_max(df, keys, [period], cols)


def asof_latest(df: DataFrame, keys: Sequence[str], period: str, anchor: Column, payload: Sequence[str]
                ) -> DataFrame:
    """Per key, the latest row at or before the anchor period."""
    return latest_per_key(df.where(F.col(period) <= anchor), keys, period, payload)


def priority_pick(df: DataFrame, keys: Sequence[str], rank: Column, then_desc: str, payload: Sequence[str]
                  ) -> DataFrame:
    """Order by a CASE rank (ascending), then a column descending; first row
    wins.  Expressed as arg-max of (−rank, column)."""
    return arg_max(df, keys, [-rank, F.col(then_desc)], payload)


def first_in_group(df: DataFrame, keys: Sequence[str], order: str, out: str = "is_first") -> DataFrame:
    """Flag exactly one row of each group, the one with the lowest ``order``
    (NULLs last; ties by the other columns).  Equal rows are merged and counted
    first, the group's minimum is a partial aggregate joined back on the key (AQE
    splits a skewed key on the join), and of equal rows one copy is flagged: no
    window over a whole group."""
    rest = [F.col(c) for c in df.columns if c not in (*keys, order)]
    place = F.struct(F.col(order).isNull().alias("n"), F.col(order).alias("o"), F.struct(F.lit(0).alias("z"), *rest).alias("r"))
    merged = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    firsts = merged.groupBy(*[F.col(k).alias(f"__fg_{k}") for k in keys]).agg(F.min(place).alias("__first"))
    joined = merged.join(firsts, [F.col(k).eqNullSafe(F.col(f"__fg_{k}")) for k in keys], "left")
    copies = joined.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))))
    return copies.select(*df.columns, (place.eqNullSafe(F.col("__first")) & (F.col("__i") == 1)).alias(out))


def asof_attach(fact: DataFrame, table: DataFrame, on: dict, fact_period: str, value: str, out: str,
                table_period: str = "period") -> DataFrame:
    """J11 generalised per row: attach ``value`` of the table row with the
    latest period at or before the fact row's own period, per key.

    Scale: the as-of search runs on the *distinct* (key, period) pairs of the
    fact — bounded by keys × calendar months, so a hot key contributes at most
    one row per month — merged with the table's (key, period) rows and scanned
    by one window per key carrying the last table period forward.  The result
    is equi-joined back to the table (value) and to the fact (key, period)."""
    keys = list(on)
    k_alias = [f"__a_{i}" for i in range(len(keys))]
    fk = fact.select(*[(F.col(on[k]) if isinstance(on[k], str) else on[k]).alias(a) for k, a in zip(keys, k_alias)],
                     F.col(fact_period).alias("__a_p")).distinct()
    tk = (table.select(*[F.col(k).alias(a) for k, a in zip(keys, k_alias)], F.col(table_period).alias("__a_p"))
          .na.drop(subset=k_alias).distinct())
    merged = (fk.withColumn("__a_t", F.lit(0))
              .unionByName(tk.withColumn("__a_t", F.lit(1))))
    w = (Window.partitionBy(*k_alias).orderBy(F.col("__a_p").asc(), F.col("__a_t").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    asof = (merged.withColumn("__a_asof", F.last(F.when(F.col("__a_t") == 1, F.col("__a_p")), ignorenulls=True).over(w))
            .where(F.col("__a_t") == 0).drop("__a_t"))
    tv = (table.groupBy(*[F.col(k).alias(f"{a}_t") for k, a in zip(keys, k_alias)], F.col(table_period).alias("__a_tp"))
          .agg(F.max(value).alias(out)))  # one value per key and period: the fact never fans out
    cond = [F.col(a) == F.col(f"{a}_t") for a in k_alias] + [F.col("__a_asof") == F.col("__a_tp")]
    asof = asof.join(tv, cond, "left").select(*k_alias, "__a_p", out)
    fcond = [(F.col(on[k]) if isinstance(on[k], str) else on[k]) == F.col(a) for k, a in zip(keys, k_alias)]
    fcond.append(F.col(fact_period) == F.col("__a_p"))
    return fact.join(asof, fcond, "left").drop(*k_alias, "__a_p")


def two_level_agg(df: DataFrame, keys: Sequence[str], period: str, value: str, anchor: Column | None,
                  out: str) -> DataFrame:
    """Average per (key, period), then the latest period per key (at or
    before ``anchor`` if given)."""
    per = (df.groupBy(*keys, period)
           .agg((F.sum(F.col(value)).cast("double") / F.count(F.col(value)).cast("double")).alias(out)))
    if anchor is not None:
        per = per.where(F.col(period) <= anchor)
    return latest_per_key(per, keys, period, [out])
