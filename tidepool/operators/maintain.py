"""Maintenance jobs: active data files, orphan-file report, contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import human_size


def active_files(data_files: DataFrame, tables: DataFrame, schemas: DataFrame) -> DataFrame:
    """Distinct full paths (schema path + table path + file path) of files
    still current (``end_snapshot IS NULL``).

    data_files(path, table_id, end_snapshot), tables(table_id, schema_id,
    path), schemas(schema_id, path). No hint: the planner broadcasts the
    table and schema lists when their estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans from measured
    shuffle sizes, so a large side falls back to a shuffled join."""
    f = data_files.where(F.col("end_snapshot").isNull()).select(
        F.col("path").alias("_fpath"), "table_id"
    )
    t = tables.select("table_id", "schema_id", F.col("path").alias("_tpath"))
    s = schemas.select("schema_id", F.col("path").alias("_spath"))
    joined = f.join(t, "table_id").join(s, "schema_id")
    return joined.select(F.concat("_spath", "_tpath", "_fpath").alias("full_path")).distinct()


def orphan_files(
    listing: DataFrame, active: DataFrame, cutoff: Column | None = None
) -> DataFrame:
    """Listed files (path, size, modified) that no active file names.
    With ``cutoff``, files modified after it are left alone (still being
    written). Adds a readable ``size_text``."""
    orphans = listing.join(active.select(F.col("full_path").alias("path")).distinct(), "path", "left_anti")
    if cutoff is not None:
        orphans = orphans.where(F.col("modified") <= cutoff)
    return orphans.withColumn("size_text", human_size("size"))


def orphan_summary(listing: DataFrame, active: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """One row: active, listed and orphaned file counts plus orphaned bytes.

    One pass: the listing is full-outer-joined to the distinct active paths
    and a single aggregation counts all four figures (listed paths are
    unique object keys)."""
    act = active.select(F.col("full_path").alias("path")).distinct().withColumn("_active", F.lit(True))
    both = listing.withColumn("_listed", F.lit(True)).join(act, "path", "full_outer")
    orphan = F.col("_listed") & F.col("_active").isNull()
    if cutoff is not None:
        orphan = orphan & (F.col("modified") <= cutoff)
    return both.agg(
        F.count_if(F.col("_active")).cast("bigint").alias("active_count"),
        F.count_if(F.col("_listed")).cast("bigint").alias("listed_count"),
        F.count_if(orphan).cast("bigint").alias("orphan_count"),
        F.coalesce(F.sum(F.when(orphan, F.col("size"))), F.lit(0)).cast("bigint").alias("orphan_bytes"),
    ).withColumn("orphan_size_text", human_size("orphan_bytes"))


def contract_violations(
    df: DataFrame, contract: Sequence[tuple[str, str, bool]]
) -> DataFrame:
    """Check ``(column, expected simple type, not_null)`` against ``df``.

    One aggregation counts rows and the NULLs of every present column. The
    result has one row per contract column — expected/actual type,
    ``type_ok``, NULL count, and the rows violating ``not_null`` (all of them
    when the column is missing) — and one per column the contract does not
    name (no expected type, ``type_ok`` false)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    declared = {c for c, _, _ in contract}
    present = [c for c, _, _ in contract if c in actual]
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c) for c in present],
    )
    rows = []
    for name, expected, not_null in [*contract, *[(c, None, False) for c in actual if c not in declared]]:
        checked = name in present
        nulls = F.col(name) if checked else F.lit(None).cast("bigint")
        violated = F.coalesce(nulls, F.lit(0).cast("bigint")) if checked else F.col("_rows")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(expected).cast("string").alias("expected_type"),
                F.lit(actual.get(name)).cast("string").alias("actual_type"),
                F.lit(expected is not None and actual.get(name) == expected).alias("type_ok"),
                nulls.alias("null_count"),
                F.lit(not_null).alias("not_null"),
                (violated if not_null else F.lit(0).cast("bigint")).alias("violations"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))
