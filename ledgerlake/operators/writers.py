"""Sinks and materialisation (K1-K5, K7).

Plain parquet has no MERGE, so keyed writes are expressed as
``target − incoming keys ∪ incoming`` (an anti-join) and written with dynamic
partition overwrite (only the partitions present in the output are
replaced) or, for unpartitioned targets, to a fresh folder that is then
swapped in — so a job that reads its own previous output never overwrites a
path it is still reading, and a failed job leaves the old table intact.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir


def partition_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ("ds",),
                      compression: str = "gzip") -> None:
    """K1: replace exactly the partitions present in ``df`` (idempotent re-runs
    of the same ``ds``), leave all other partitions untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy(*partition_by).parquet(path))


def merge_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K2: upsert on a unique key: target rows whose key is not in ``source`` ∪ source."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").unionByName(source)


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K3: delete every target row whose (non-unique) key tuple occurs in the
    incoming rows, then append the incoming rows."""
    return merge_by_key(target, source, keys)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _rename(fs, source, target) -> None:
    """Rename, or raise: the file system reports a failure by returning false."""
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def store_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, so that every
    later use sees the same rows and a lost executor repeats nothing."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_by_key(source: DataFrame, path: str, keys: Sequence[str], partition_by: str = "ds") -> None:
    """K2 / K3 on a stored table: rows whose key tuple occurs in ``source`` are
    deleted, ``source`` is appended.  Only the partitions that lose or gain rows
    are rewritten, from a stored copy (the table is read while it is replaced);
    a partition that the delete empties is removed.  Repeating it changes nothing."""
    spark = source.sparkSession
    if not path_exists(spark, path):
        partition_replace(source, path, (partition_by,))
        return
    target = spark.read.parquet(path)
    gone = target.join(source.select(*keys).distinct(), list(keys), "left_semi").select(partition_by).distinct()
    touched = gone.union(source.select(partition_by).distinct()).distinct()
    rows = store_once(merge_by_key(target.join(touched, partition_by, "left_semi"), source, keys), "keyed-write")
    emptied = gone.join(rows.select(partition_by).distinct(), partition_by, "left_anti").collect()  # one row per partition
    partition_replace(rows, path, (partition_by,))
    fs, _, jvm = _fs(spark, path)
    for r in emptied:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_by}={r[0]}"), True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def partition_folders(spark: SparkSession, path: str, column: str) -> list[tuple[str, Callable[[], bool]]]:
    """The values of the folders ``column=value`` under ``path``, greatest first, each with a function
    that tells whether it holds a data file."""
    fs, root, jvm = _fs(spark, path)
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def holds_data(folder) -> bool:
        return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder))

    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}=") and not name.endswith("=__HIVE_DEFAULT_PARTITION__"):
            found[unescape(name[len(column) + 1:])] = status.getPath()
    return [(value, lambda folder=found[value]: holds_data(folder)) for value in sorted(found, reverse=True)]


def full_replace(df: DataFrame, path: str, compression: str = "gzip") -> str:
    """K4: replace a whole (unpartitioned) table safely: write a new folder,
    then swap it in with file-system renames; the old data is kept until the
    new data is complete (no silent destruction on error, q11)."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.__staging_{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", compression).parquet(staging)
    fs, target, jvm = _fs(spark, path)
    old = None
    if fs.exists(target):
        old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old_{uuid.uuid4().hex}")
        _rename(fs, target, old)
    try:
        _rename(fs, jvm.org.apache.hadoop.fs.Path(staging), target)
    except OSError:
        if old is not None:  # the old table comes back
            _rename(fs, old, target)
        raise
    if old is not None:
        fs.delete(old, True)
    return path


def schema_drift(spark: SparkSession, df: DataFrame, path: str, ignore: Iterable[str] = ("dw_ins_time",)) -> dict:
    """K5 / Q2: compare column sets with the stored table (load-time columns
    ignored); on mismatch move the stored table aside to ``<path>_bk_<ts>``."""
    ign = set(ignore)
    if not path_exists(spark, path):
        return {"table": path, "status": "new", "missing": [], "extra": [], "backup": None}
    stored = [c for c in spark.read.parquet(path).columns if c not in ign]
    current = [c for c in df.columns if c not in ign]
    missing = sorted(set(stored) - set(current))
    extra = sorted(set(current) - set(stored))
    backup = None
    if missing or extra:
        fs, p, jvm = _fs(spark, path)
        backup = f"{path.rstrip('/')}_bk_{time.strftime('%Y%m%d%H%M%S')}_{uuid.uuid4().hex[:8]}"
        _rename(fs, p, jvm.org.apache.hadoop.fs.Path(backup))
    return {"table": path, "status": "drift" if backup else "same", "missing": missing, "extra": extra,
            "backup": backup}


def audit_columns(df: DataFrame, ds: str, zone: str = "Asia/Taipei", instant: Column | None = None,
                  fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """K7: load time rendered in a named zone, and the snapshot day."""
    ts = instant if instant is not None else F.current_timestamp()
    return df.withColumns({"dw_ins_time": F.date_format(F.from_utc_timestamp(ts, zone), fmt), "ds": F.lit(ds)})
