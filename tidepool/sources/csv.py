"""CSV readers: typed columns by name, legacy encodings, zipped members.

Header names are read from each file's first line; every column is read as
text and then cast by name, so codes with leading zeros stay text and the
column order of a file does not matter. Short rows are padded with NULL
(PERMISSIVE), like ``null_padding``. Columns without a declared type are text, or
get the narrowest type that holds all their values (``default="infer"``).
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.casts import NUMERIC_TEXT, soft_bigint, soft_double
from tidepool.session import prepare
from tidepool.sources.files import open_uri

_CAST = {
    "string": lambda c: c,
    "date": lambda c: c.cast("date"),
    "bigint": soft_bigint,
    "int": lambda c: soft_bigint(c).cast("int"),
    "double": soft_double,
}


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


# --- header lines -----------------------------------------------------------------

_HEAD_BYTES = 1 << 16


def _first_line(path: str, encoding: str) -> str | None:
    """The first line of the file (None: this process cannot open the path)."""
    end, held = "\n".encode(encoding).removeprefix("".encode(encoding)), b""
    try:
        with open_uri(path) as f:
            while end not in held and (more := f.read(_HEAD_BYTES)):
                held += more
    except (ValueError, NotImplementedError, pa.ArrowInvalid):  # a store that only Spark reads
        return None
    return held.decode(encoding, "replace").split("\n", 1)[0].removeprefix("\ufeff").rstrip("\r")


def _headers(spark: SparkSession, paths: Sequence[str], encoding: str) -> list[tuple[list[str], list[str]]]:
    """(column names, paths to scan) of each distinct header line.

    Executors open each file and read its first bytes; the driver gets one row per
    distinct header. Only where headers differ does it also get the files of each,
    which the scans need. A file in a store that only Spark reads is a header of
    its own, read by Spark's reader."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path")  # contents are pruned: a listing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            lines = [_first_line(p, encoding) for p in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(lines, pa.string())], names=["path", "line"]
            )

    lines = files.mapInArrow(run, "path string, line string").where("line IS NULL OR line <> ''")
    lines = lines.withColumn("line", F.coalesce("line", F.concat(F.lit("\u0000"), "path")))
    kinds = lines.groupBy("line").agg(F.min("path").alias("one")).orderBy("line").collect()
    read = spark.read.option("header", True).option("encoding", encoding)
    names = [read.csv(r["one"]).columns for r in kinds]
    if all(n == names[0] for n in names):
        return [(names[0], list(paths))] if names else []
    listed = lines.groupBy("line").agg(F.collect_list("path").alias("files")).collect()
    by_line = {r["line"]: sorted(r["files"]) for r in listed}
    return [(n, by_line[r["line"]]) for n, r in zip(names, kinds, strict=True)]


# --- types of undeclared columns ----------------------------------------------------

# What a value can be: whole number, number, date, text. A column's values are joined
# by OR; numbers widen to numbers, anything else that differs to text.
_WHOLE, _NUMBER, _DATE, _TEXT = 1, 2, 4, 8


def _kind(c: Column) -> Column:
    """The narrowest kind of a text value; 0 for NULL and blank."""
    value = F.trim(c)
    return (
        F.when(c.isNull() | (value == ""), 0)
        .when(value.rlike(r"^[+-]?\d+$") & value.try_cast("bigint").isNotNull(), _WHOLE)
        .when(value.rlike(NUMERIC_TEXT) & value.try_cast("double").isNotNull(), _NUMBER)
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull(), _DATE)
        .otherwise(_TEXT)
    )


def _type_of(kinds: int) -> str:
    if kinds & _TEXT or (kinds & _DATE and kinds != _DATE) or not kinds:
        return "string"
    return "date" if kinds == _DATE else "double" if kinds & _NUMBER else "bigint"


def infer_types(raw: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type (bigint < double < string, date < string) that holds all
    values of each text column: one aggregation over all rows, no sample. A column
    without values is text."""
    if not columns:
        return {}
    found = raw.agg(*[F.bit_or(_kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    return {c: _type_of(found[i] or 0) for i, c in enumerate(columns)}


def read_csv_named(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    default: str = "string",
    encoding: str = "utf-8",
) -> DataFrame:
    """Header CSV → DataFrame with ``types`` applied by column name
    (``string``, ``date``, ``bigint``, ``int``, ``double``); other columns
    get ``default``, or with ``default="infer"`` the type that all their values
    fit (:func:`infer_types`: one more pass over the files).

    Files may hold their columns in different orders or lack some: files with
    the same header line are read in one scan, and the scans are united by
    name (a column that a file lacks is NULL there)."""
    prepare(spark)
    types = dict(types or {})
    reader = spark.read.option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE")

    def text(names: list[str], files: list[str]) -> DataFrame:
        return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(files)

    parts = [text(names, files) for names, files in _headers(spark, _paths(paths), encoding)]
    if not parts:
        parts = [text(reader.csv(_paths(paths)).columns, _paths(paths))]
    raw = parts[0]
    for part in parts[1:]:
        raw = raw.unionByName(part, allowMissingColumns=True)
    if default == "infer":
        types = infer_types(raw, [c for c in raw.columns if c not in types]) | types
    return raw.select(*[_CAST[types.get(c, default)](F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_csv_positional(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    encoding: str = "utf-8",
) -> DataFrame:
    """Headerless CSV with a declared schema (by position)."""
    prepare(spark)
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .csv(_paths(paths))
    )


def _unzip_lines(member: str, encoding: str, chunk: int) -> callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    names = [n for n in zf.namelist() if n == member or n.endswith("/" + member)]
                    for name in names:
                        with zf.open(name) as fh:
                            text = io.TextIOWrapper(fh, encoding=encoding, newline="")
                            buf: list[str] = []
                            for line in text:
                                line = line.rstrip("\r\n")
                                if line:
                                    buf.append(line)
                                if len(buf) >= chunk:
                                    yield pd.DataFrame({"archive": path, "line": buf})
                                    buf = []
                            if buf:
                                yield pd.DataFrame({"archive": path, "line": buf})

    return run


def read_zipped_csv(
    spark: SparkSession,
    zip_paths: str | Sequence[str],
    member: str,
    schema: T.StructType | str,
    encoding: str = "utf-8",
    partitions: int | None = None,
    chunk_lines: int = 50_000,
) -> DataFrame:
    """CSV member of ZIP archives (headerless, declared schema).

    An archive cannot be split, so each is inflated by one task
    (``mapInPandas``, streamed in chunks); the lines are then hash-spread
    over ``partitions`` (default: the cluster's parallelism) and parsed by
    ``from_csv`` on the JVM (quoted commas handled)."""
    prepare(spark)
    ddl = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    lines = (
        spark.read.format("binaryFile").load(_paths(zip_paths))
        .select("path", "content")
        .mapInPandas(_unzip_lines(member, encoding, chunk_lines), "archive string, line string")
    )
    n = partitions or spark.sparkContext.defaultParallelism
    lines = lines.repartition(n, F.xxhash64("archive", "line"))
    parsed = lines.select(F.from_csv("line", ddl, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.*")
