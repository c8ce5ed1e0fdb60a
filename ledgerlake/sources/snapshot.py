"""Daily-snapshot reads.

Every ``ds`` partition of a mart table is a full copy; readers want the newest
one.  The max is expressed as a *scalar subquery* (``DataFrame.scalar()``), so
Spark plans it as a runtime filter: on a ``ds``-partitioned table it becomes a
partition filter (only the newest folder is read), on a plain table it is a
pushed-down parquet filter.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def max_of(df: DataFrame, column: str) -> Column:
    """``(SELECT max(column) FROM df)`` as a Column."""
    return df.select(F.max(F.col(column))).scalar()


def latest_snapshot(df: DataFrame, ds: str = "ds") -> DataFrame:
    """Rows whose ``ds`` equals the table's max ``ds``."""
    return df.where(F.col(ds) == max_of(df, ds))


def latest_period(df: DataFrame, period: str = "period", ds: str | None = "ds") -> DataFrame:
    """Latest period inside the latest snapshot (two chained maxima)."""
    snap = latest_snapshot(df, ds) if ds else df
    return snap.where(F.col(period) == max_of(snap, period))


def month_aligned_snapshot(snapshots: DataFrame, months: DataFrame, month: str = "period",
                           ds: str = "ds") -> DataFrame:
    """S3: for each requested month, the rows of the newest snapshot taken in
    that month (``max(ds) where substr(ds,1,6) = month``).

    The per-month maxima are a tiny aggregate (one row per month) joined back on
    ``ds`` — no per-row subquery."""
    latest = (snapshots.groupBy(F.substring(F.col(ds), 1, 6).alias("__month"))
              .agg(F.max(F.col(ds)).alias("__ds")))
    wanted = months.select(F.col(month).alias("__month")).distinct().join(latest, "__month")
    return snapshots.join(wanted, snapshots[ds] == wanted["__ds"], "inner").drop("__ds")


def anchor_value(df: DataFrame, column: str) -> Column:
    """The representative value of a single-valued column.  The
    reference takes ``LIMIT 1``; ``max`` gives the same value deterministically."""
    return max_of(df, column)


def newest_partition(spark: SparkSession, path: str, ds: str = "ds") -> str | None:
    """The greatest ``ds`` among the table's partition folders that hold a data file, or None if
    there is none: names are listed, no file is opened."""
    from ledgerlake.operators.writers import partition_folders
    for value, holds_data in partition_folders(spark, path, ds):
        if holds_data():
            return value
    return None


def read_self_snapshot(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The model's own previous output (latest ``ds``), or None on the first
    run, when the path does not exist.  Any other failure to read is an error.

    The newest copy of a ``ds``-partitioned table is known from its folder names, so
    only that folder is read; a plain table is searched for its greatest ``ds``."""
    from ledgerlake.operators.writers import path_exists
    if not path_exists(spark, path):
        return None
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    newest = newest_partition(spark, path)
    stored = reader.parquet(path)
    return latest_snapshot(stored) if newest is None else stored.where(F.col("ds") == F.lit(newest))
