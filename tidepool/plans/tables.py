"""Reading the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
