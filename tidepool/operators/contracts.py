"""Contracts enforced at the write: a batch that breaks one never becomes visible.

A table is a folder of batches (``batch=<id>`` subfolders of Parquet files). A batch
is written below ``_staging`` while the same pass counts what the contract forbids
(:meth:`DataFrame.observe`); if nothing is counted, one rename of its folder
makes it part of the table, else the folder is removed and the write raises.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.load import delete_path, path_exists, rename_path

#: Column, its simple type, whether NULL is forbidden.
Contract = Sequence[tuple[str, str, bool]]


class ContractViolation(ValueError):
    """A batch broke its contract; ``violations`` maps what was broken to how often."""

    def __init__(self, violations: dict[str, int]):
        super().__init__("; ".join(f"{k}: {n} rows" if n else k for k, n in violations.items()))
        self.violations = violations


def schema_violations(df: DataFrame, contract: Contract) -> dict[str, int]:
    """What the schema breaks before any row is read: missing or undeclared columns, other types."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = {f"{c} is missing": 0 for c, _, _ in contract if c not in actual}
    found |= {f"{c} is {actual[c]}, not {t}": 0 for c, t, _ in contract if c in actual and actual[c] != t}
    return found | {f"{c} is not declared": 0 for c in actual if c not in {x for x, _, _ in contract}}


def write_enforced(
    batch: DataFrame, path: str, contract: Contract, checks: dict[str, Column] | None = None, overwrite: bool = False
) -> int:
    """Adds the batch to the table at ``path`` (or puts it in the table's place) if it
    keeps the contract; returns its number of rows. Otherwise raises
    :class:`ContractViolation` and leaves the table as it was.

    ``checks`` names further conditions that every row must fulfil (a NULL counts as
    broken). Rows are counted while they are written: one pass, no second scan."""
    spark = batch.sparkSession
    if broken := schema_violations(batch, contract):
        raise ContractViolation(broken)
    rules = {f"{c} is null": F.col(c).isNotNull() for c, _, not_null in contract if not_null} | (checks or {})
    seen = Observation()
    counted = batch.select(*[c for c, _, _ in contract]).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"rule{i}") for i, rule in enumerate(rules.values())],
    )
    name = uuid.uuid4().hex
    staging = f"{path.rstrip('/')}/_staging/{name}"
    try:
        counted.write.parquet(staging)
        found = seen.get
        if broken := {rule: found[f"rule{i}"] for i, rule in enumerate(rules) if found[f"rule{i}"]}:
            raise ContractViolation(broken)
    except BaseException:
        delete_path(spark, staging)
        raise
    old = batches(spark, path) if overwrite else []
    rename_path(spark, staging, f"{path.rstrip('/')}/batch={name}")
    for b in old:
        delete_path(spark, b)
    return found["rows"]


def batches(spark: SparkSession, path: str) -> list[str]:
    """The folders of the table's batches."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch=*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(s.getPath().toString() for s in found or [])


def read_enforced(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The table's rows; empty if nothing was written yet."""
    schema = ", ".join(f"`{c}` {t}" for c, t, _ in contract)
    if not path_exists(spark, path) or not batches(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[c for c, _, _ in contract])
