"""Data-quality gates and the validation report (Q1-Q5).

Gates return small driver-side decisions (is the input empty? which columns
are missing?) computed from metadata or a LIMIT-1 probe; key checks are
distributed aggregates whose violating rows stay a DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "table_name string, round int, check_name string, result string, reason string, " \
                "n_violations bigint, n_rows bigint"


def is_empty(df: DataFrame) -> bool:
    """Q1: empty-input gate (reads at most one row)."""
    return df.isEmpty()


def column_check(df: DataFrame, expected: Iterable[str], ignore: Iterable[str] = ("dw_ins_time",)) -> dict:
    """Q2: missing and extra columns against the stored contract."""
    ign = set(ignore)
    have = {c for c in df.columns if c not in ign}
    want = {c for c in expected if c not in ign}
    return {"missing": sorted(want - have), "extra": sorted(have - want)}


def required_columns(df: DataFrame, required: Sequence[str], fail: bool = False) -> list[str]:
    """Q4: required-column check; raises when ``fail`` and something is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing and fail:
        raise ValueError(f"missing required columns: {missing}")
    return missing


def key_counts(df: DataFrame, key_groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per key group and key: ``key_group, round, key_value, n``; keys with a NULL or blank part are left out, and a row
    with ``key_group`` NULL holds the number of all rows.

    All groups are grouping sets of one aggregate, so the table is scanned once and its pre-aggregated keys are
    shuffled once, however many groups there are; a hot key is one row per task.  Groups of equal columns share a set."""
    columns = list(dict.fromkeys(k for keys in key_groups.values() for k in keys))

    def mark(keys: Sequence[str]) -> int:
        """grouping_id of a set: a bit per column, first column highest, 1 where the column is not in the set."""
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)

    sets = {mark(keys): list(dict.fromkeys(keys)) for keys in key_groups.values()} | {mark([]): []}
    counted = (df.select(*columns).groupingSets([[F.col(c) for c in s] for s in sets.values()], *columns)
               .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__set")))
    found = []
    for rnd, (name, keys) in enumerate(key_groups.items(), start=1):
        texts = [F.col(k).cast("string") for k in keys]
        full = F.col("__set") == mark(keys)
        for text in texts:
            full = full & (F.length(F.trim(text)) > 0)
        found.append(F.when(full, F.struct(F.lit(name).alias("key_group"), F.lit(rnd).alias("round"),
                                           F.concat_ws("|", *texts).alias("key_value"))))
    total = F.when(F.col("__set") == mark([]), F.struct(F.lit(None).cast("string").alias("key_group"), F.lit(0).alias("round"),
                                                        F.lit("").alias("key_value")))
    return (counted.select("n", F.explode(F.array(*found, total)).alias("k")).where("k IS NOT NULL")
            .select("k.key_group", "k.round", "k.key_value", "n"))


def unique_key_violations(df: DataFrame, key_groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q3: rows that break uniqueness, for every key group (all groups are evaluated); rows with a NULL or blank key
    part are exempt.  A row stands for each row of the table that has the repeated key."""
    bad = key_counts(df, key_groups).where("key_group IS NOT NULL AND n > 1")
    return bad.select("key_group", "round", "key_value", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("__i")).drop("__i")


def report(spark: SparkSession, table: str, df: DataFrame, key_groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q5: one report row per key-group check: result, reason, violation count and rows examined, from one scan."""
    counts = key_counts(df, key_groups).groupBy("key_group").agg(
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("n_violations"), F.sum("n").alias("n_all"))
    groups = spark.createDataFrame([(name, i) for i, name in enumerate(key_groups, start=1)], "check_name string, round int")
    by_group = counts.select(F.map_from_entries(F.collect_list(F.struct(F.coalesce("key_group", F.lit("")), F.struct("n_violations", "n_all")))).alias("m"))
    r = groups.withColumn("m", by_group.scalar())  # one row per group: the groups are the caller's list
    r = r.select("*", F.coalesce(F.col("m")[F.col("check_name")]["n_violations"], F.lit(0)).cast("bigint").alias("n_violations"),
                 F.coalesce(F.col("m")[F.lit("")]["n_all"], F.lit(0)).cast("bigint").alias("n_rows"))
    passed = F.col("n_violations") == 0
    return r.select(F.lit(table).alias("table_name"), "round", "check_name", F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("result"),
                    F.when(passed, F.lit("")).otherwise(F.lit("duplicate key")).alias("reason"), "n_violations", "n_rows")


def null_shares(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Q4 on rows: per required column ``column_name, n_rows, n_missing`` (NULL or blank; a column that the table lacks
    is missing in every row), in one pre-aggregated scan."""
    have = [c for c in required if c in df.columns]
    blank = {c: F.sum(F.coalesce(F.length(F.trim(F.col(c).cast("string"))) > 0, F.lit(False)).cast("bigint")).alias(f"__{i}")
             for i, c in enumerate(have)}
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *blank.values())
    entries = [F.struct(F.lit(c).alias("column_name"), F.col("n_rows"),
                        (F.col("n_rows") - F.coalesce(F.col(f"__{have.index(c)}"), F.lit(0)) if c in have else F.col("n_rows")).alias("n_missing"))
               for c in required]
    return one.select(F.inline(F.array(*entries)))
