"""Incremental loads as Structured Streaming queries over landed files.

The stream's checkpoint is the cursor: each run picks up only files not
yet processed (``trigger(availableNow=True)`` drains and stops). Every
micro-batch is merged with an idempotent sink, so a batch replayed after
a failure leaves the same table:

* :func:`start_keyed_load` merges by key and rewrites only the partitions a
  micro-batch touches (:func:`tidepool.operators.load.write_merged_partitions`);
* :func:`start_partition_load` replaces the partitions present in the batch
  (:func:`tidepool.operators.load.write_replacing_partitions`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidepool.operators.load import write_merged_partitions, write_replacing_partitions
from tidepool.session import checkpoint_root


def _source(spark: SparkSession, path: str, schema: StructType, fmt: str, max_files: int) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(path)


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"


def start_keyed_load(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    table_root: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    order_col: str | None = None,
    fmt: str = "json",
    name: str = "keyed_load",
    checkpoint: str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Stream landed rows into a keyed table (merge by ``keys``).

    Of several rows of a key in one micro-batch the one with the greatest
    ``order_col`` wins; without it the newest delivery, by the landed file's
    modification time and then its name. ``max_files`` files at most make a
    micro-batch; as the order is explicit it does not decide which row wins.
    """
    source = _source(spark, source_path, schema, fmt, max_files)
    order = order_col or "_delivered"
    if order_col is None:
        source = source.withColumn("_delivered", F.struct("_metadata.file_modification_time", "_metadata.file_path"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        write_merged_partitions(batch.sparkSession, batch, table_root, keys, order, partition_cols)

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", _checkpoint(spark, name, checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def start_partition_load(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    table_path: str,
    partition_cols: Sequence[str],
    fmt: str = "json",
    name: str = "partition_load",
    checkpoint: str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Stream landed batches into a partitioned table, replacing each
    partition a batch touches (delete-insert); empty batches change nothing."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        write_replacing_partitions(batch, table_path, partition_cols)

    return (
        _source(spark, source_path, schema, fmt, max_files)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", _checkpoint(spark, name, checkpoint))
        .trigger(availableNow=True)
        .start()
    )
