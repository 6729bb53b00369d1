"""Durable load state: what each resource has loaded, written with the load.

The state is a table of runs (``resource, run, cursor, n_rows, boundary``), one row
per finished run, appended after the run's rows are in their table. The next run reads
the last row of its resource, and of the source only what is new: rows past the cursor,
and rows at the cursor that the last run did not see. Those are told by their hashes
(``boundary`` names the folder that holds them), so ties with the cursor are neither
lost nor loaded again, however many there are.

A run that dies before its state row leaves the state as it was: the next run reads the
same rows again and merges them by key into the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.load import path_exists, write_merged_partitions
from tidepool.operators.ordering import staged


@dataclass
class LoadState:
    """The state table at ``path``; ``cursor_type`` is the simple type of all its cursors."""

    spark: SparkSession
    path: str
    cursor_type: str

    def runs(self) -> DataFrame:
        """All finished runs."""
        schema = f"resource string, run bigint, cursor {self.cursor_type}, n_rows bigint, boundary string"
        folder = f"{self.path.rstrip('/')}/runs"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def last(self, resource: str):
        """The resource's last run, or None."""
        return self.runs().where(F.col("resource") == resource).orderBy(F.desc("run")).first()

    def new_rows(self, source: DataFrame, resource: str, cursor_col: str) -> DataFrame:
        """The source's rows that no finished run of the resource has loaded. Rows
        without a cursor are never loaded."""
        last = self.last(resource)
        if last is None or last["cursor"] is None:
            return source.where(F.col(cursor_col).isNotNull())
        cursor = F.lit(last["cursor"]).cast(self.cursor_type)
        seen = self.spark.read.parquet(last["boundary"])
        later = source.where(F.col(cursor_col) > cursor)
        tied = source.where(F.col(cursor_col) == cursor).withColumn("_row_hash", _row_hash(source))
        return later.unionByName(tied.join(seen, "_row_hash", "left_anti").drop("_row_hash"))

    def finish(self, resource: str, loaded: DataFrame, cursor_col: str) -> None:
        """Records a run that has put ``loaded`` into its table."""
        last = self.last(resource)
        top = loaded.agg(F.max(cursor_col).alias("cursor"), F.count(F.lit(1)).alias("n")).first()
        cursor = top["cursor"] if top["cursor"] is not None else last and last["cursor"]
        boundary = last and last["boundary"]
        if top["n"]:
            boundary = f"{self.path.rstrip('/')}/boundary/{uuid.uuid4().hex}"
            hashes = loaded.where(F.col(cursor_col) == F.lit(cursor).cast(self.cursor_type)).select(_row_hash(loaded).alias("_row_hash"))
            if last is not None and last["cursor"] == cursor and last["boundary"]:
                hashes = hashes.unionByName(self.spark.read.parquet(last["boundary"]))
            hashes.distinct().write.parquet(boundary)
        row = (resource, (last["run"] if last else 0) + 1, cursor, top["n"], boundary)
        done = self.spark.createDataFrame([row], self.runs().schema)
        done.coalesce(1).write.mode("append").parquet(f"{self.path.rstrip('/')}/runs")


def _row_hash(df: DataFrame):
    """128 bits of the whole row's JSON form, NULL fields included."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}))


def load_new(
    state: LoadState,
    source: DataFrame,
    resource: str,
    table_path: str,
    keys: Sequence[str],
    cursor_col: str,
    partition_cols: Sequence[str],
    order_col: str | None = None,
) -> int:
    """Merges the source's new rows by key into the table and records the run; returns
    their number. The rows are read once (staged), merged, then recorded."""
    new = staged(state.new_rows(source, resource, cursor_col), "new-rows")
    n = new.count()
    if n:
        write_merged_partitions(state.spark, new, table_path, keys, order_col or cursor_col, partition_cols)
    state.finish(resource, new, cursor_col)
    return n
