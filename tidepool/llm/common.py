"""Shared helpers of the text operators: reading, Arrow passes, shared tables.

Rules that hold for every operator here:

* a null text counts as the empty text unless the operator says otherwise;
* repeated input rows give repeated output rows;
* an empty table gives an empty result with the same columns;
* extra input columns are ignored by queries and passed through by
  ``with_arrow_columns``; an input column named like an output column is
  replaced by it.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidepool.session import checkpoint_root

#: Text bytes handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch on its way to or from a task's Python worker.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in held:
            name += "_"
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold at most ``limit`` bytes (one row at least).

    ``column`` holds texts, binaries, or lists of numbers (eight bytes each).
    """
    if batch.num_rows == 0:
        return
    values = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        lengths = pa.compute.multiply(pa.compute.list_value_length(values), 8)
    else:
        lengths = pa.compute.binary_length(values)
    start, held = 0, 0
    for i, n in enumerate(lengths.fill_null(0).to_numpy(zero_copy_only=False).tolist()):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts, null as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` over batches of bounded bytes: texts differ widely in length, and
    a batch is held on both sides of the pipe. The bound is a session setting."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Gives freed memory back to the system: idle workers wait for the next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def with_arrow_columns(
    df: DataFrame,
    sized_by: str,
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Appends columns computed slice by slice in Arrow batches.

    ``sized_by`` names the column whose bytes bound a slice. ``make()`` runs once per
    task and returns the function from a slice to the new columns, in the order of
    ``fields``.
    """
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new]
    schema = T.StructType(kept + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        try:
            for batch in batches:
                for part in slices(batch, sized_by, limit):
                    made = compute(part)
                    columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                    yield pa.RecordBatch.from_arrays(columns + made, names=[f.name for f in schema.fields])
        finally:
            release_memory()

    return arrow(df, run, schema)
