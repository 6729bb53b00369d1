"""Row numbers in one total order, without a task that holds all rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import checkpoint_root


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: what follows
    reads a columnar copy instead of computing ``df`` again."""
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/tidepool-runs/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_numbers(df: DataFrame, order: Sequence[str], out: str = "seq", start: int = 1) -> DataFrame:
    """Appends the row's number in the order of the columns (NULLs first); rows
    that tie in all of them are numbered in some order.

    The rows are range-partitioned by the order and sorted inside partitions; each
    gets its place in its partition. The sorted rows are staged, because ranges
    are drawn from a sample and a lost task must not deal them anew. Then the
    partitions are counted, and the rows before each (a sum over one row per
    partition, few enough to be broadcast) are added to the places.

    ``df`` is computed up to three times, twice for that sample: stage it where that is dear."""
    placed = (
        df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
        # partition number in the upper 31 bits, place in the partition in the lower 33
        .withColumn("_at", F.monotonically_increasing_id())
    )
    rows = staged(placed, "numbered").withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + F.lit(start)
    return rows.join(F.broadcast(before), "_part").select(*df.columns, number.cast("bigint").alias(out))
