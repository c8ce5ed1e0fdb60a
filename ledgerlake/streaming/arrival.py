"""Process-once file arrival.

The reference moves uploaded files upload → processing → done so each file is
consumed once.  Structured Streaming's file source does this natively: the
checkpoint remembers which files were committed, ``trigger(availableNow=True)``
processes everything that has arrived and stops, and ``foreachBatch`` hands
each micro-batch to the ordinary batch pipeline.  Re-running picks up only new
files.  A batch that fails after writing is run again with the same batch id, so
``handle`` must replace what it wrote for that id: :func:`replace_batch` does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators.writers import partition_replace
from ledgerlake.session import ensure_checkpoint_dir


def process_arrivals(spark: SparkSession, landing: str, schema: StructType,
                     handle: Callable[[DataFrame, int], None], name: str, fmt: str = "csv",
                     options: dict | None = None, checkpoint: str | None = None) -> int:
    """Run ``handle(batch_df, batch_id)`` once for every not-yet-processed file
    under ``landing``; returns the number of micro-batches run."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/arrivals/{name}"
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {"header": "true"}).items():
        reader = reader.option(k, v)
    stream = reader.load(landing)
    batches = []

    def _run(df: DataFrame, batch_id: int) -> None:
        batches.append(batch_id)
        handle(df, batch_id)

    q = (stream.writeStream.foreachBatch(_run).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).queryName(f"arrivals_{name}").start())
    q.awaitTermination()
    return len(batches)


def process_new_contents(spark: SparkSession, landing: str, schema: StructType, handle: Callable[[DataFrame, int], None], name: str,
                         fmt: str = "csv", options: dict | None = None, checkpoint: str | None = None, files_at_once: int = 1000) -> int:
    """Like :func:`process_arrivals`, but once by content: a file whose bytes have been processed under any name, in any
    run or earlier in the same drop, is passed over.

    The stream reads files as bytes, and a stateful deduplication by their SHA-256 lets each content through once; its
    state lives in the checkpoint.  A task holds one file's bytes at a time (the source's limit is 2 GB a file).  The
    files that come through, ``files_at_once`` a batch at most, are then read as tables in the usual way."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/arrivals/{name}"
    seen = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
            .option("maxFilesPerTrigger", files_at_once).load(landing)
            .select("path", F.sha2("content", 256).alias("hash")).dropDuplicates(["hash"]))
    batches = []

    def _run(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.select("path").collect()]  # the batch's files at most
        if paths:
            reader = spark.read.format(fmt).schema(schema)
            for k, v in (options or {"header": "true"}).items():
                reader = reader.option(k, v)
            batches.append(batch_id)
            handle(reader.load(paths), batch_id)

    q = (seen.writeStream.foreachBatch(_run).option("checkpointLocation", ckpt).trigger(availableNow=True)
         .queryName(f"arrivals_{name}").start())
    q.awaitTermination()
    return len(batches)


def replace_batch(out: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch to its own partition ``batch_id`` of ``out``,
    replacing what an earlier try of the same batch left there."""
    def handle(df: DataFrame, batch_id: int) -> None:
        partition_replace(df.withColumn("batch_id", F.lit(batch_id)), out, ("batch_id",))
    return handle
