"""Idempotent loads: work-lists, partition replacement, keyed upsert,
incremental cursor, state skip, keyed replace.

The logical operators return the table *after* the load as a DataFrame;
the ``write_*`` sinks persist it. Parquet tables have no MERGE, so the keyed
sink never overwrites what it reads: ``write_merged_partitions`` stages the
merged partitions and swaps them in by dynamic overwrite.

Keys and partitions are compared null-safely: rows with a NULL key are one
key, a NULL partition is a partition like any other.

Every keyed merge needs an order that says which of several rows of a key in
one batch is the newest; a column of the key cannot be that order.

Scale notes:
* upsert dedupes the batch per key with a partial aggregation (``max_by``)
  and anti-joins the base on the raw batch keys: at most one shuffle of the
  base on the key, no sort of the base;
* keyed replace uses ``max_by`` too, so a hot id is combined map-side
  instead of sorted in one task;
* work-lists are generated per area with ``sequence`` (no cross join).
"""

from __future__ import annotations

import re
import uuid
from datetime import date
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.codes import zero_pad


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Row with the greatest ``order_col`` per key.

    Ties on ``order_col`` are broken by a hash of the row, so the same row
    wins whatever the partitioning or task order (retries and replays give
    the same table). ``max_by`` combines map-side, so a key holding a large
    share of the rows is reduced before the shuffle."""
    if order_col in keys:
        raise ValueError(f"{order_col} is part of the key and cannot order its rows")
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    rank = F.struct(F.col(order_col), F.xxhash64(*[F.col(c) for c in others]))
    return (
        df.groupBy(*keys)
        .agg(F.max_by(packed, rank).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in others])
    )


def _without(base: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` whose key is not in ``other`` (NULLs match)."""
    marks = other.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return base.join(marks, same, "left_anti")


def upsert(base: DataFrame, batch: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Merge ``batch`` into ``base`` by ``keys``: batch rows win; within the
    batch the greatest ``order_col`` wins. Output has ``base``'s columns."""
    newest = latest_per_key(batch, keys, order_col)
    return _without(base, batch, keys).unionByName(newest.select(*base.columns))


def replace_partitions(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete-insert by partition: every partition present in ``batch`` (a
    NULL one too) is replaced by the batch rows; other partitions are kept.
    An empty batch changes nothing."""
    kept = _without(base, batch.select(*keys).distinct(), keys)
    return kept.unionByName(batch.select(*base.columns))


def keyed_replace(rows: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """``INSERT OR REPLACE`` by id after a full delete: the last row per id."""
    return latest_per_key(rows, [id_col], order_col)


def state_skip(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items not yet loaded (``NOT EXISTS`` in the state table)."""
    return todo.join(done.select(*keys), list(keys), "left_anti")


def cursor_value(state: DataFrame, cursor_col: str, initial: Column | None = None) -> Column:
    """Largest cursor seen so far as a scalar subquery (``initial`` when empty)."""
    last = state.select(F.max(cursor_col)).scalar()
    return F.coalesce(last, initial) if initial is not None else last


def incremental(
    state: DataFrame,
    source: DataFrame,
    cursor_col: str,
    keys: Sequence[str],
    initial: Column | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Load rows at or past the cursor and merge them by key.

    ``>=`` keeps rows tied with the last maximum; the keyed merge removes
    the duplicates this re-reads, so a rerun changes nothing. Of several
    fresh rows of a key the one with the greatest ``order_col`` (by default
    the cursor) wins.
    """
    fresh = source.where(F.col(cursor_col) >= cursor_value(state, cursor_col, initial))
    return upsert(state, fresh, keys, order_col or cursor_col)


def current_quarter(today: date | None = None) -> tuple[int, int]:
    """(year, quarter) of ``today`` (default: the driver's current date)."""
    today = today or date.today()
    return today.year, (today.month - 1) // 3 + 1


def quarter_work_list(
    areas: DataFrame,
    area_col: str,
    start: tuple[int, int],
    end: tuple[int, int] | None = None,
    completed: DataFrame | None = None,
) -> DataFrame:
    """(area, year, quarter) still to fetch: every area × quarter from
    ``start`` to ``end`` (default: the current quarter) minus ``completed``;
    the ``end`` quarter is always fetched again (it may still grow)."""
    end = end or current_quarter()
    first = F.make_date(F.lit(start[0]), F.lit(3 * start[1] - 2), F.lit(1))
    last = F.make_date(F.lit(end[0]), F.lit(3 * end[1] - 2), F.lit(1))
    grid = areas.select(
        F.col(area_col).alias("area_code"),
        F.explode(F.sequence(first, last, F.expr("INTERVAL 3 MONTHS"))).alias("_q"),
    ).select("area_code", F.year("_q").alias("year"), F.quarter("_q").alias("quarter"))
    if completed is None:
        return grid
    done = completed.select("area_code", "year", "quarter").distinct().withColumn("_done", F.lit(True))
    current = (F.col("year") == end[0]) & (F.col("quarter") == end[1])
    return (
        grid.join(done, ["area_code", "year", "quarter"], "left")
        .where(F.col("_done").isNull() | current)
        .drop("_done")
    )


def area_codes(df: DataFrame, number_col: str, width: int = 2, offset: int = 0) -> DataFrame:
    """Zero-padded area codes (``1`` → ``'01'``)."""
    return df.select(zero_pad(F.col(number_col) + F.lit(offset), width).alias("area_code"))


# --- sinks ------------------------------------------------------------------


def write_replacing_partitions(batch: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Delete-insert on disk: only the partitions present in ``batch`` are
    rewritten (dynamic partition overwrite). Rows are clustered by the
    partition keys with a ``rebalance`` hint: each partition is written by
    few tasks (few files), and AQE splits a partition holding a large share
    of the rows over several tasks instead of one."""
    (
        batch.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def _store(spark: SparkSession, path: str):
    """Hadoop file system and path object: metadata operations from the driver."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _store(spark, path)
    return fs.exists(hpath)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder; an error unless it was moved."""
    fs, hpath = _store(spark, source)
    if not fs.rename(hpath, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a job's own staging output."""
    fs, hpath = _store(spark, path)
    fs.delete(hpath, True)


def write_merged_partitions(
    spark: SparkSession,
    batch: DataFrame,
    table_path: str,
    keys: Sequence[str],
    order_col: str,
    partition_cols: Sequence[str],
    staging_root: str | None = None,
) -> None:
    """Keyed merge that rewrites only the partitions the batch touches.

    The table is partitioned by ``partition_cols``, which must be part of
    the key, so a key lives in exactly one partition. Only touched
    partitions are read; the merged rows are staged first and then swapped
    in with dynamic partition overwrite, so the job never overwrites what it
    is reading. Replaying a batch gives the same table (keyed merge).
    ``order_col`` is stored when the table has it; a struct order is not.
    """
    parts = list(partition_cols)
    if not parts or not set(parts) <= set(keys):
        raise ValueError(f"partition columns {parts} must be part of the key {list(keys)}")
    newest = latest_per_key(batch, keys, order_col)
    if isinstance(batch.schema[order_col].dataType, T.StructType):
        newest = newest.drop(order_col)
    # the batch feeds the touched-partition list, the anti join and the union
    newest = newest.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if newest.isEmpty():
            return
        if not path_exists(spark, table_path):
            # first load: nothing is read, so the batch is written in place
            newest.hint("rebalance", *parts).write.partitionBy(*parts).parquet(table_path)
            return
        current = spark.read.schema(newest.schema).parquet(table_path)
        marks = newest.select(*[F.col(p).alias(f"_part{i}") for i, p in enumerate(parts)]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_part{i}")) for i, p in enumerate(parts)])
        touched = current.join(marks, same, "left_semi")
        merged = _without(touched, newest, keys).unionByName(newest)
        staging = f"{(staging_root or table_path).rstrip('/')}/_staging/{uuid.uuid4().hex}"
        merged.hint("rebalance", *parts).write.partitionBy(*parts).parquet(staging)
    finally:
        newest.unpersist()
    staged = spark.read.schema(merged.schema).parquet(staging)
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(table_path)
    )
    delete_path(spark, staging)


def copy_namespace(spark: SparkSession, source_db: str, target_db: str) -> list[str]:
    """Copies the tables and views of ``source_db`` into ``target_db``.

    A table that the target has already is emptied and filled again (``INSERT
    OVERWRITE``, by column name), so it stays the same table for those who read it; one
    that it lacks is created. Views are created anew from their text, with
    unqualified names meaning the target's own tables: they are resolved when read.
    Tables of the target that the source lacks are left alone. Only names and
    definitions pass through the driver; each copy is a distributed read and write."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target_db}")
    listed = [t for t in spark.catalog.listTables(source_db) if t.tableType != "TEMPORARY"]
    names, views = [t.name for t in listed if t.tableType != "VIEW"], [t.name for t in listed if t.tableType == "VIEW"]
    for name in names:
        source, target = spark.table(f"{source_db}.`{name}`"), f"{target_db}.`{name}`"
        if spark.catalog.tableExists(target):
            columns = ", ".join(f"`{c}`" for c in source.columns)
            spark.sql(f"INSERT OVERWRITE TABLE {target} ({columns}) SELECT {columns} FROM {source_db}.`{name}`")
        else:
            source.write.saveAsTable(target)
    current = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(target_db)
    try:
        for name, text in _by_need(spark, source_db, views):
            spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS {text}")
    finally:
        spark.catalog.setCurrentDatabase(current)
    return names + views


def _by_need(spark: SparkSession, db: str, views: Sequence[str]) -> list[tuple[str, str]]:
    """Names and texts of the views, those that others read first."""
    texts = {}
    for v in views:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.`{v}`").where("col_name = 'View Text'").collect()
        texts[v] = rows[0]["data_type"]
    done: list[str] = []
    met: set[str] = set()

    def visit(v: str) -> None:
        if v not in met:
            met.add(v)
            for other in texts:
                if re.search(rf"\b{re.escape(other)}\b", texts[v], re.IGNORECASE):
                    visit(other)
            done.append(v)

    for v in sorted(texts):
        visit(v)
    return [(v, texts[v]) for v in done]
