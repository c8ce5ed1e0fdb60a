"""Physical-plan assertions: no Python UDFs, no cartesian products, pushed filters."""

import pytest

from paths import SF_SMALL

from ledgerlake.plans.registry import QUERIES, load_all

load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_latest_snapshot_pushes_scalar_subquery(spark):
    plan = _plan(QUERIES["latest_snapshot"](spark, SF_SMALL))
    assert "Subquery" in plan


def test_partition_pruning_on_ds(spark, tmp_path):
    from pyspark.sql import functions as F
    from ledgerlake.operators.writers import partition_replace
    from ledgerlake.sources.snapshot import latest_snapshot
    path = str(tmp_path / "snap")
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("k"),
                                 F.concat(F.lit("2024010"), (F.col("id") % 3 + 1).cast("string")).alias("ds"))
    partition_replace(df, path)
    latest = latest_snapshot(spark.read.parquet(path))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "Subquery" in plan
    assert {r.ds for r in latest.collect()} == {"20240103"}


def test_scan_prunes_columns(spark):
    plan = _plan(QUERIES["global_agg"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_shipdate:timestamp" in plan and "l_extendedprice" not in plan
