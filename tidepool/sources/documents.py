"""Dataset metadata documents (one JSON file per dataset) and the
registry that says which datasets to read.

Declared top-level fields are typed; nested parts (``tags``, ``schemas``,
``dependencies``, ``lineage``) are kept as compact JSON text for the
catalog flattening to parse once with full schemas.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import prepare

JSON_PARTS = ("tags", "schemas", "dependencies", "lineage")
TEXT_PARTS = ("title", "description", "cover", "ducklake_url", "readme")
DOCUMENT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("title", "description", "cover", "tags",
                                                "ducklake_url", "schemas", "dependencies",
                                                "lineage", "readme")]
)
METADATA_FILE = "metadata.json"


def read_metadata_documents(
    spark: SparkSession, paths: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Read metadata documents in one scan.

    ``paths`` maps datasource → file, or lists files or globs laid out as
    ``…/<datasource>/metadata.json`` (the datasource is the folder name).
    """
    prepare(spark)
    files = list(paths.values()) if isinstance(paths, Mapping) else list(paths)
    raw = spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", True).json(files)
    # file paths come percent-encoded
    raw = raw.withColumn("_file", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    if isinstance(paths, Mapping):
        known = spark.createDataFrame([(_uri(f), d) for d, f in paths.items()], "_known string, datasource string")
        same = F.regexp_replace("_file", "^file:/+", "file:/") == F.col("_known")
        raw = raw.join(known, same, "left").withColumn(
            "datasource", F.coalesce("datasource", F.raise_error(F.concat(F.lit("no datasource for "), F.col("_file"))).cast("string"))
        )
    else:
        raw = raw.withColumn("datasource", F.regexp_extract("_file", r"([^/]+)/[^/]+$", 1))
    return raw.select(
        "datasource",
        *[F.col(c) for c in TEXT_PARTS],
        *[F.get_json_object(c, "$").alias(c) for c in JSON_PARTS],
    ).select("datasource", "title", "description", "cover", "tags", "ducklake_url", "schemas",
             "dependencies", "lineage", "readme")


def read_metadata_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read metadata documents stored one per line (JSON lines, splittable),
    each carrying its ``datasource``; same columns as
    :func:`read_metadata_documents`."""
    prepare(spark)
    schema = T.StructType([T.StructField("datasource", T.StringType())] + DOCUMENT_SCHEMA.fields)
    raw = spark.read.schema(schema).json([paths] if isinstance(paths, str) else list(paths))
    return raw.select(
        "datasource",
        *[F.col(c) for c in TEXT_PARTS],
        *[F.get_json_object(c, "$").alias(c) for c in JSON_PARTS],
    ).select("datasource", "title", "description", "cover", "tags", "ducklake_url", "schemas",
             "dependencies", "lineage", "readme")


def document_lines(docs: DataFrame, *kept: str) -> DataFrame:
    """Documents (nested parts as JSON text) → one JSON line each, the nested
    parts embedded as JSON values (inverse of :func:`read_metadata_lines`);
    columns named in ``kept`` are passed through."""
    parts = []
    for i, c in enumerate(("datasource",) + TEXT_PARTS + JSON_PARTS):
        value = (
            F.coalesce(F.col(c), F.lit("null")) if c in JSON_PARTS
            else F.coalesce(F.regexp_extract(F.to_json(F.array(F.col(c))), r"^\[(.*)\]$", 1), F.lit("null"))
        )
        parts += [F.lit(("{" if i == 0 else ",") + f'"{c}":'), value]
    return docs.select(*kept, F.concat(*parts, F.lit("}")).alias("value"))


def _uri(path: str) -> str:
    """The path as the reader names it: local paths under ``file:/``."""
    uri = path if "://" in path or path.startswith("file:") else "file:" + path
    return "file:/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def registry_paths(datasources: Sequence[str], base: str) -> dict[str, str]:
    """Registry → metadata file per datasource under ``base``."""
    return {d: f"{base.rstrip('/')}/{d}/{METADATA_FILE}" for d in datasources}


def read_registered(spark: SparkSession, registry: DataFrame, base: str) -> DataFrame:
    """The registry's datasets (``datasource`` and further columns) with their documents:
    one whole-file read of ``<base>/<datasource>/metadata.json``, joined on the decoded
    folder name. ``has_document`` is false where the registry names a dataset
    without a file; files that it does not name are left out. Neither paths nor names
    pass through the driver."""
    docs = read_metadata_documents(spark, [f"{base.rstrip('/')}/*/{METADATA_FILE}"])
    found = docs.withColumn("_found", F.lit(True))
    return registry.join(found, "datasource", "left").withColumn("has_document", F.coalesce("_found", F.lit(False))).drop("_found")


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as the files that :func:`read_registered` reads: (path, content)."""
    lines = document_lines(docs.select("datasource", *TEXT_PARTS, *JSON_PARTS), "datasource")
    return lines.select(F.concat("datasource", F.lit(f"/{METADATA_FILE}")).alias("path"), F.col("value").alias("content"))


def stale_sources(present: DataFrame, expected: DataFrame, key: str = "name") -> DataFrame:
    """Entries present (e.g. generated source files) that the registry no
    longer lists: ``present`` minus ``expected`` on ``key``."""
    return present.join(expected.select(key), key, "left_anti")
