"""Driver queries: each operator applied to the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole tables. Column names equal those of the matching SQL in
:mod:`tidepool.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions import casts, codes
from tidepool.functions import text as textf
from tidepool.functions.jsonx import polymorphic_code, polymorphic_text
from tidepool.operators import (
    catalog,
    contracts,
    datasets,
    export,
    information_schema,
    lineage,
    load,
    maintain,
    metadata,
    reshape,
    statistics,
    survey,
)
from tidepool.operators.state import LoadState, load_new
from tidepool.plans.boundary_docs import part_topologies
from tidepool.plans.catalog_docs import part_documents
from tidepool.plans.tables import table
from tidepool.session import checkpoint_root
from tidepool.sources.api_rows import read_batches
from tidepool.sources.csv import read_csv_named, read_csv_positional
from tidepool.sources.documents import (
    document_files,
    document_lines,
    read_metadata_lines,
    read_registered,
    stale_sources,
)
from tidepool.sources.files import write_files
from tidepool.sources.listing import list_files
from tidepool.sources.topojson import decode_topologies
from tidepool.streaming.incremental import start_keyed_load, start_partition_load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# --- statistics views -------------------------------------------------------


@query("category_view")
def q_category_view(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return statistics.category_view(
        events,
        code_col="event_type",
        keep=["event_id", "event_type", "user_id", "ts", "value"],
        labels={"item_name": ("props", "$.k")},
        prefix="p",
    )


@query("item_catalogue")
def q_item_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return statistics.item_catalogue(part, code_col="p_type", label_col="p_brand")


# --- catalog from metadata documents ----------------------------------------


def _parsed_docs(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.parse_documents(part_documents(table(spark, sf, "part")))


@query("catalog_datasets")
def q_catalog_datasets(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.datasets(_parsed_docs(spark, sf))


@query("schemas_from_json")
def q_schemas(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.schemas(_parsed_docs(spark, sf))


@query("tables_from_json")
def q_tables(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tables(_parsed_docs(spark, sf))


@query("columns_from_json")
def q_columns(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.columns(_parsed_docs(spark, sf))


@query("dependencies_from_json")
def q_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.dependencies(_parsed_docs(spark, sf))


@query("lineage_edges")
def q_lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.lineage_edges(_parsed_docs(spark, sf))


@query("lineage_nodes")
def q_lineage_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.lineage_nodes(_parsed_docs(spark, sf))


@query("tag_text")
def q_tag_text(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tag_text(_parsed_docs(spark, sf))


@query("search_entries")
def q_search_entries(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.search_entries(_parsed_docs(spark, sf))


# --- reshape / scalar functions ---------------------------------------------


MEASURE_RULES = [("%_qty", "qty"), ("%_price", "price"), ("%_disc", "disc"), ("%_tax", "tax")]


@query("unpivot_measures")
def q_unpivot_measures(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    wide = li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("gross_qty"),
        F.col("l_extendedprice").alias("gross_price"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("net_disc"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("net_tax"),
    )
    long = reshape.unpivot_drop_nulls(
        wide, ["l_orderkey", "l_linenumber"], ["gross_qty", "gross_price", "net_disc", "net_tax"],
        "label", "amount",
    )
    return long.select(
        "l_orderkey",
        "l_linenumber",
        reshape.label_case("label", [("gross_%", "gross")], "net").alias("kind"),
        reshape.label_case("label", MEASURE_RULES).alias("measure"),
        "amount",
    )


@query("check_digit")
def q_check_digit(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    code5 = codes.zero_pad(F.col("c_custkey") % 100000, 5)
    return cust.select(
        "c_custkey", code5.alias("code5"), codes.with_check_digit(code5).alias("lg_code")
    )


def _qty_text(suffix: str) -> F.Column:
    return F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(suffix))


@query("soft_cast")
def q_soft_cast(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    price_text = (
        F.when(n == 1, F.lit("n/a")).when(n == 2, F.lit("")).when(n == 3, _qty_text(".5"))
        .when(n == 4, F.concat(F.lit("-"), _qty_text(".5"))).when(n == 5, _qty_text("e2"))
        .when(n == 6, F.concat(F.lit("1,"), _qty_text(""))).otherwise(_qty_text(".49999999996"))
    )
    area_text = (
        F.when(n == 1, _qty_text(".5d")).when(n == 2, F.lit(".5")).when(n == 3, _qty_text("."))
        .when(n == 4, _qty_text("")).when(n == 5, F.lit("abc")).when(n == 6, _qty_text("E-1"))
        .otherwise(F.lit(""))
    )
    raw = li.select("l_orderkey", "l_linenumber", price_text.alias("price_text"), area_text.alias("area_text"))
    return reshape.rename_cast(
        raw,
        [
            ("l_orderkey", "order_key", None),
            ("l_linenumber", "line_no", None),
            ("price_text", "price_text", None),
            ("area_text", "area_text", None),
            ("price_text", "trade_price", "bigint"),
            ("area_text", "area", "double"),
        ],
    )


@query("text_dates_arrays")
def q_text_dates_arrays(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")
    raw = orders.select(
        F.col("o_orderkey").alias("slug"),
        F.when(status != "P", prio).alias("title"),
        F.concat(F.lit("status "), status).alias("description"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
        F.when(status == "O", F.lit("[]")).otherwise(F.concat(F.lit("["), status, F.lit("]"))).alias("datasources_text"),
        F.when(status == "F", F.concat(F.lit('["'), F.replace(prio, F.lit("-"), F.lit('","')), F.lit('"]')))
        .otherwise(F.concat(F.lit("["), F.replace(prio, F.lit("-"), F.lit(", ")), F.lit("]")))
        .alias("tags_text"),
    )
    articles = raw.select(
        "slug", "title", "description",
        casts.text_date("date_text").alias("date"),
        casts.text_array("datasources_text").alias("datasources"),
        casts.text_array("tags_text").alias("tags"),
    )
    return articles.select(
        "slug", "title", "description", "date",
        F.array_join("datasources", "|").alias("datasources_list"),
        F.size("datasources").alias("n_datasources"),
        F.array_join("tags", "|").alias("tags_list"),
        F.concat_ws(" ", "title", "description", F.array_join("tags", " ")).alias("search_text"),
    )


@query("union_periods")
def q_union_periods(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return reshape.tag_periods(orders, F.year("o_orderdate")).select(
        "period", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


@query("articles")
def q_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles job over orders: typed date and arrays, search text, newest first."""
    o = table(spark, sf, "orders")
    raw = o.select(
        F.concat(F.lit("order-"), "o_orderkey").alias("slug"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("title"),
        F.concat(F.lit("status "), "o_orderstatus").alias("description"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit('["'), "o_orderstatus", F.lit('"]')).alias("datasources"),
        F.concat(F.lit("["), F.replace("o_orderpriority", F.lit("-"), F.lit(", ")), F.lit("]")).alias("tags"),
    )
    done = datasets.articles(raw)
    return done.withColumns({c: F.array_join(c, "|") for c in ("datasources", "tags")})


@query("statistics_view")
def q_statistics_view(spark: SparkSession, sf: str) -> DataFrame:
    """Category view of a fact table: one category prefix, three labels read
    from JSON metadata."""
    e = table(spark, sf, "events")
    name = lambda c: F.concat(F.lit('{"name":"'), c, F.lit('"}'))
    day = F.date_format("ts", "yyyyMMdd")
    facts = e.select(
        F.concat(F.when(F.col("user_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")), "event_type").alias("cat01"),
        name(F.col("event_type")).alias("cat01_metadata"),
        F.col("user_id").cast("string").alias("area"), name(F.concat(F.lit("area "), "user_id")).alias("area_metadata"),
        day.alias("time"), F.when(F.col("user_id") % 3 != 0, name(day)).alias("time_metadata"),
        F.lit("events").alias("unit"), "value",
    )
    return datasets.statistics_view(facts, "A")


@query("stale_sources")
def q_stale_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Generated source files of all parts that the registry of ordered parts no longer lists."""
    file = lambda c: F.concat(F.lit("raw_"), c, F.lit(".sql")).alias("name")
    present = table(spark, sf, "part").select(file("p_partkey"))
    expected = table(spark, sf, "lineitem").where("l_quantity > 40").select(file("l_partkey"))
    return stale_sources(present, expected)


# --- loads ------------------------------------------------------------------


def _completed(spark: SparkSession, sf: str) -> DataFrame:
    """(area, year, quarter) already loaded: finished orders by customer area.

    Orders are first reduced to distinct (customer, year, quarter) — a
    partial aggregation before any shuffle, which also collapses a customer
    holding a large share of the orders — and only then joined to customers.
    """
    per_customer = (
        table(spark, sf, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_custkey").alias("c_custkey"),
            F.year("o_orderdate").alias("year"),
            F.quarter("o_orderdate").alias("quarter"),
        )
        .distinct()
    )
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        per_customer.join(cust, "c_custkey")
        .select(codes.zero_pad(F.col("c_nationkey") + F.lit(1), 2).alias("area_code"), "year", "quarter")
        .distinct()
    )


WORK_START, WORK_END = (1995, 1), (2002, 2)


@query("completed_keys")
def q_completed_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _completed(spark, sf)


@query("work_list")
def q_work_list(spark: SparkSession, sf: str) -> DataFrame:
    areas = load.area_codes(table(spark, sf, "nation"), "n_nationkey", offset=1)
    return load.quarter_work_list(areas, "area_code", WORK_START, WORK_END, _completed(spark, sf))


def _orders_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("o_year", F.year("o_orderdate"))


@query("replace_partitions")
def q_replace_partitions(spark: SparkSession, sf: str) -> DataFrame:
    base = _orders_by_year(spark, sf)
    batch = base.where(
        (F.col("o_year") == 1997)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & (F.col("o_orderstatus") != "P")
    ).withColumn("o_orderstatus", F.lit("R"))
    return load.replace_partitions(base, batch, ["o_year", "o_orderpriority"])


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("upsert")
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    open_2000 = (F.col("o_orderstatus") == "O") & (F.year("o_orderdate") == 2000)
    b1 = orders.where(open_2000).withColumn("o_orderstatus", F.lit("U")).withColumn("_seq", F.lit(1))
    b2 = (
        orders.where(open_2000 & (F.col("o_orderpriority") == "1-URGENT"))
        .withColumn("o_orderstatus", F.lit("V")).withColumn("_seq", F.lit(2))
    )
    b3 = (
        orders.where((F.year("o_orderdate") == 2001) & (F.col("o_orderpriority") == "5-LOW"))
        .withColumn("o_orderkey", F.col("o_orderkey") + F.lit(10_000_000_000))
        .withColumn("o_orderstatus", F.lit("I")).withColumn("_seq", F.lit(1))
    )
    batch = reshape.union_all(b.select(*_ORDER_COLS, "_seq") for b in (b1, b2, b3))
    return load.upsert(orders.select(*_ORDER_COLS), batch, ["o_orderkey"], "_seq")


@query("upsert_versions")
def q_upsert_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed merge whose batch repeats keys and holds NULL keys: every line of
    an order is a version of its row, the highest line number the newest; orders
    without lines keep their row."""
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey")).alias("o_orderkey"),
        F.concat(F.lit("line "), F.col("l_linenumber")).alias("o_orderstatus"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_seq"),
    )
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderkey")).alias("o_orderkey"), "o_orderstatus"
    )
    return load.upsert(orders, lines, ["o_orderkey"], "_seq")


CURSOR_START = "2024-01-16 00:00:00"


@query("incremental")
def q_incremental(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    state = events.where(F.col("ts") < F.lit(CURSOR_START).cast("timestamp_ntz"))
    source = events.withColumn("event_type", F.upper("event_type"))
    return load.incremental(state, source, "ts", ["event_id"])


@query("state_skip")
def q_state_skip(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    return load.state_skip(docs, table(spark, sf, "labels"), ["doc_id"])


@query("keyed_replace")
def q_keyed_replace(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    rows = cust.select(
        F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("id"),
        "c_custkey", "c_name", "c_acctbal",
    )
    return load.keyed_replace(rows, "id", "c_custkey")


# --- export -----------------------------------------------------------------



@query("sql_literals")
def q_sql_literals(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    rows = docs.join(labels, "doc_id", "left")
    stmt = export.insert_statement(
        "documents",
        [
            ("doc_id", textf.sql_value("doc_id")),
            ("source", textf.sql_value("source")),
            ("lang", textf.sql_value("lang")),
            ("text", textf.sql_value("text")),
            ("is_quality", textf.sql_bool(F.col("quality") == 1)),
            ("tags", textf.sql_json(F.array("lang", "source"))),
        ],
    )
    return rows.select("doc_id", stmt.alias("statement"))


@query("export_rows")
def q_export_rows(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_columns(_parsed_docs(spark, sf))


@query("export_tables")
def q_export_tables(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_tables(catalog.tables(_parsed_docs(spark, sf)))


@query("export_script")
def q_export_script(spark: SparkSession, sf: str) -> DataFrame:
    """Full refresh in order: documents with a cover are exported, the others come as fallbacks."""
    docs = part_documents(table(spark, sf, "part"))
    return export.script(catalog.parse_documents(docs.where("cover IS NOT NULL")), docs)


@query("self_fallback")
def q_self_fallback(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"),
        F.lit("export").alias("origin"),
    )
    # doubled keys: those beyond the last nation have no customer
    nations = table(spark, sf, "nation").select(
        (F.col("n_nationkey") * 2).alias("nationkey"), F.col("n_name").alias("name"),
        F.lit("fallback").alias("origin"),
    )
    return export.with_fallback(rows, nations, ["nationkey"])


# --- maintenance ------------------------------------------------------------


@query("active_files")
def q_active_files(spark: SparkSession, sf: str) -> DataFrame:
    sup = table(spark, sf, "supplier")
    files = sup.select(
        F.when(F.col("s_acctbal") > 5000, F.lit("shared.parquet"))
        .otherwise(F.concat("s_name", F.lit(".parquet"))).alias("path"),
        F.col("s_nationkey").alias("table_id"),
        F.when(F.col("s_acctbal") < 0, F.lit(7)).alias("end_snapshot"),
    )
    tables_ = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("table_id"), F.col("n_regionkey").alias("schema_id"),
        F.concat(F.lower("n_name"), F.lit("/")).alias("path"),
    )
    schemas_ = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("schema_id"), F.concat(F.lower("r_name"), F.lit("/")).alias("path")
    )
    return maintain.active_files(files, tables_, schemas_)


LISTING_EPOCH = "2024-01-01 00:00:00"
ORPHAN_CUTOFF = "2024-01-08 00:00:00"


def _listing_and_active(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf, "documents")
    listing = docs.select(
        F.concat(F.lit("data/"), F.col("doc_id").cast("string"), F.lit(".parquet")).alias("path"),
        (F.col("n_chars") * 37).alias("size"),
        (F.lit(LISTING_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("n_chars").cast("int"))).alias("modified"),
    )
    active = table(spark, sf, "labels").where(F.col("toxic") == 0).select(
        F.concat(F.lit("data/"), F.col("doc_id").cast("string"), F.lit(".parquet")).alias("full_path")
    )
    return listing, active


@query("orphan_files")
def q_orphan_files(spark: SparkSession, sf: str) -> DataFrame:
    listing, active = _listing_and_active(spark, sf)
    return maintain.orphan_files(listing, active, F.lit(ORPHAN_CUTOFF).cast("timestamp_ntz"))


@query("orphan_summary")
def q_orphan_summary(spark: SparkSession, sf: str) -> DataFrame:
    listing, active = _listing_and_active(spark, sf)
    return maintain.orphan_summary(listing, active, F.lit(ORPHAN_CUTOFF).cast("timestamp_ntz"))


CUSTOMER_CONTRACT = [
    ("c_custkey", "bigint", True),
    ("c_name", "string", True),
    ("c_mktsegment", "string", True),
    ("c_acctbal", "double", False),
    ("c_nationkey", "bigint", True),
    ("c_phone", "string", False),
]


@query("contract_check")
def q_contract_check(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select(
        "c_custkey", "c_name",
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        "c_nationkey",
    )
    return maintain.contract_violations(cust, CUSTOMER_CONTRACT)


INFO_SCHEMAS = ["NATION_1", "nation_2", "Nation_3", "NATION_10"]


@query("information_schema")
def q_information_schema(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    sup = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    cust = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    tables_ = sup.select(
        F.when(F.col("s_acctbal") < 0, F.lit("system")).otherwise(F.lit("lake")).alias("database_name"),
        F.col("n_name").alias("schema_name"), F.col("s_name").alias("table_name"),
        F.lit(None).cast("string").alias("comment"),
    )
    views = cust.select(
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("__ducklake_metadata_lake"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit("abducklake_metadata_x"))
        .otherwise(F.lit("lake")).alias("database_name"),
        F.lower("n_name").alias("schema_name"), F.col("c_name").alias("table_name"),
        F.col("c_mktsegment").alias("comment"),
    )
    li = table(spark, sf, "lineitem").join(
        sup.select("s_suppkey", "s_name", "n_name"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    cols_t = li.select(
        F.lit("lake").alias("database_name"), F.col("n_name").alias("schema_name"),
        F.col("s_name").alias("table_name"),
        F.concat(F.lit("l_"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("column_name"),
        F.col("l_linenumber").alias("column_index"), F.lit("DOUBLE").alias("data_type"),
        F.lit(None).cast("string").alias("comment"),
    )
    od = table(spark, sf, "orders").join(
        cust.select("c_custkey", "c_name", "n_name", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    cols_v = od.select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("abducklake_metadata_x"))
        .otherwise(F.lit("lake")).alias("database_name"), F.lower("n_name").alias("schema_name"),
        F.col("c_name").alias("table_name"),
        F.concat(F.lit("o_"), F.col("o_orderkey").cast("string")).alias("column_name"),
        F.lit(1).alias("column_index"), F.lit("BIGINT").alias("data_type"),
        F.col("o_orderpriority").alias("comment"),
    )
    return information_schema.relation_columns(tables_, views, cols_t.unionByName(cols_v), INFO_SCHEMAS)


# --- manifest / metadata ----------------------------------------------------


def _manifest(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), "p_size", "p_type",
        F.concat(F.lit("b"), F.replace(F.lower("p_brand"), F.lit("brand#"), F.lit(""))).alias("ds"),
    )
    model_id = lambda ds, key: F.concat(F.lit("model."), ds, F.lit(".p"), key.cast("string"))
    pm_models = p.select(
        model_id(F.col("ds"), F.col("k")).alias("child"),
        F.array(
            model_id(F.col("ds"), F.col("k") + 1),
            F.concat(F.lit("source."), F.col("ds"), F.lit(".raw_p"), F.col("k").cast("string")),
            model_id(F.concat(F.lit("b"), F.col("p_size").cast("string")), F.col("k") + 2),
        ).alias("parents"),
    )
    pm_seeds = p.where(F.col("p_size") < 5).select(
        F.concat(F.lit("seed."), F.col("ds"), F.lit(".s"), F.col("k").cast("string")).alias("child"),
        F.array().cast("array<string>").alias("parents"),
    )
    nodes = p.where(F.col("p_size") > 10).select(
        model_id(F.col("ds"), F.col("k")).alias("unique_id"),
        F.array("ds", F.lit("main"), F.concat(F.lit("p"), F.col("k").cast("string"))).alias("fqn"),
        F.lit("model").alias("resource_type"),
        F.when(F.col("p_size") > 40, F.lit("table")).otherwise(F.lit("view")).alias("materialized"),
        F.when(F.col("p_size") > 30, F.create_map(F.lit("owner"), F.col("p_type")))
        .otherwise(F.create_map().cast("map<string,string>")).alias("meta"),
    )
    return pm_models.unionByName(pm_seeds), nodes


@query("lineage_extract")
def q_lineage_extract(spark: SparkSession, sf: str) -> DataFrame:
    _, nodes = lineage.extract_lineage(*_manifest(spark, sf))
    return nodes.select(
        "datasource", "name", F.to_json("fqn").alias("fqn_json"), "resource_type", "materialized",
        F.to_json("meta").alias("meta_json"),
    )


@query("lineage_extract_edges")
def q_lineage_extract_edges(spark: SparkSession, sf: str) -> DataFrame:
    edges, _ = lineage.extract_lineage(*_manifest(spark, sf))
    return edges


@query("column_types")
def q_column_types(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    node = F.concat(F.lit("model.x.p"), F.col("p_partkey").cast("string"))
    c = lambda t: F.struct(F.lit(t).alias("type"))
    no_constraints = F.array().cast("array<struct<type:string>>")
    manifest_cols = p.select(
        node.alias("node_id"),
        F.inline(F.array(
            F.struct(
                F.lit("p_name").alias("column_name"),
                F.when(F.col("p_size") % 2 == 0, F.lit("VARCHAR")).alias("data_type"),
                F.when(F.col("p_size") > 20, F.lit("Name")).alias("title"),
                F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("description"),
                F.when(F.col("p_size") > 25, F.array(c("not_null"))).otherwise(no_constraints).alias("constraints"),
            ),
            F.struct(
                F.lit("p_brand").alias("column_name"), F.lit(None).cast("string").alias("data_type"),
                F.lit("Brand").alias("title"), F.lit("   ").alias("description"),
                F.array(c("unique")).alias("constraints"),
            ),
            F.struct(
                F.lit("p_retailprice").alias("column_name"), F.lit("DOUBLE").alias("data_type"),
                F.lit(None).cast("string").alias("title"), F.col("p_type").alias("description"),
                F.when(F.col("p_size") % 3 == 0, F.array(c("unique"), c("not_null")))
                .otherwise(F.array(c("check"))).alias("constraints"),
            ),
        )),
    )
    catalog_cols = p.where(F.col("p_type") != "PROMO").select(
        node.alias("node_id"),
        F.inline(F.array(
            F.struct(F.lit("p_name").alias("column_name"), F.lit("VARCHAR").alias("type")),
            F.struct(
                F.lit("p_brand").alias("column_name"),
                F.when(F.col("p_size") % 3 == 2, F.lit("")).otherwise(F.lit("VARCHAR")).alias("type"),
            ),
        )),
    )
    return lineage.resolve_column_types(manifest_cols, catalog_cols)


@query("group_to_list")
def q_group_to_list(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tables_by_schema(_parsed_docs(spark, sf))


# --- survey -----------------------------------------------------------------

DOC_TIERS = [("licensed", ["License", "license"]), ("contact", ["@"])]


@query("classify")
def q_classify(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    classed = survey.classify(docs, ["source", "lang", "text"], DOC_TIERS)
    return survey.count_per(classed, ["source", "category"])


@query("latest_per_group")
def q_latest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return survey.survey_summary(
        orders, group="o_orderpriority", position="o_orderkey", code="o_custkey", date="d",
        item="o_orderkey",
    )


def _class_json(n: F.Column) -> F.Column:
    item = lambda i: F.concat(
        F.lit('{"@code":"c'), i.cast("string"), F.lit('","@name":"N'), i.cast("string"), F.lit('"}')
    )
    many = F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(1), n), item), ","), F.lit("]"))
    return F.when(n == 1, item(F.lit(1))).otherwise(many)


@query("object_or_list")
def q_object_or_list(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    label = F.concat(F.col("event_type"), F.lit(" "), F.col("event_id").cast("string"))
    uid = F.col("user_id").cast("string")

    def obj(axis_id: str, name: str, classes: F.Column) -> F.Column:
        return F.concat(F.lit(f'{{"@id":"{axis_id}","@name":"{name}","CLASS":'), classes, F.lit("}"))

    area_class = F.concat(F.lit('{"@code":"a'), uid, F.lit('","@name":"Area '), uid, F.lit('"}'))
    raw = e.select(
        "event_id",
        F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit('{"$":"'), label, F.lit('"}')))
        .otherwise(F.concat(F.lit('"'), label, F.lit('"'))).alias("title_json"),
        F.when(
            F.col("user_id") % 2 == 0,
            F.concat(F.lit('{"$":"survey '), uid, F.lit('","@code":"'), F.lpad(uid, 8, "0"), F.lit('"}')),
        ).otherwise(F.concat(F.lit('"survey '), uid, F.lit('"'))).alias("stat_json"),
        F.when(
            F.col("value") >= 50,
            F.concat(F.lit("["), obj("cat01", "Category", _class_json((F.col("event_id") % 7 + 1).cast("int"))),
                     F.lit(","), obj("area", "Area", area_class), F.lit("]")),
        ).otherwise(obj("time", "Time", _class_json((F.col("event_id") % 7 + 1).cast("int")))).alias("class_inf"),
    )
    tagged = raw.select(
        "event_id",
        polymorphic_text("title_json").alias("title"),
        polymorphic_text("stat_json").alias("stat_name"),
        polymorphic_code("stat_json").alias("stat_code"),
        "class_inf",
    )
    return survey.axis_summary(tagged, ["event_id", "title", "stat_name", "stat_code"], "class_inf")


@query("top_sources")
def q_top_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Top-k report (the LIMIT is the feature): largest sources by text size."""
    docs = table(spark, sf, "documents")
    return (
        docs.groupBy("source")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("total_chars"))
        .orderBy(F.desc("total_chars"), "source")
        .limit(10)
    )


# --- sinks, readers and streams on the driver's data --------------------------
#
# These write data Spark derives from the tables into a fresh folder under
# the cluster's shared ``spark.checkpoint.dir`` and read it back, so the
# real readers / sinks / streams run over the whole tables.



def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/tidepool-runs/{name}-{uuid.uuid4().hex}"


@query("csv_reader")
def q_csv_reader(spark: SparkSession, sf: str) -> DataFrame:
    """Header CSV in Shift-JIS, typed by column name; codes keep leading zeros."""
    out = _scratch(spark, "csv")
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"),
        "c_name", "c_acctbal", "c_mktsegment", "c_nationkey",
    )
    cust.write.option("header", True).option("encoding", "Shift_JIS").csv(out)
    return read_csv_named(
        spark, out, {"c_custkey": "bigint", "c_acctbal": "double", "c_nationkey": "int"}, encoding="Shift_JIS"
    )


@query("replace_partitions_sink")
def q_replace_partitions_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Delete-insert on disk: base written partitioned, batch swapped in by
    dynamic partition overwrite, result read back."""
    out = _scratch(spark, "partitions")
    keys = ["o_year", "o_orderpriority"]
    base = _orders_by_year(spark, sf)
    load.write_replacing_partitions(base, out, keys)
    batch = base.where(
        (F.col("o_year") == 1997)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & (F.col("o_orderstatus") != "P")
    ).withColumn("o_orderstatus", F.lit("R"))
    load.write_replacing_partitions(batch, out, keys)
    return spark.read.schema(base.schema).parquet(out).select(*base.columns)


STREAM_SPLIT, STREAM_OVERLAP = "2024-01-16 00:00:00", "2024-01-15 00:00:00"


@query("stream_keyed_load")
def q_stream_keyed_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two landed batches of events loaded by a file stream (availableNow)
    into a keyed table partitioned by day; the second batch re-delivers one
    day with changed rows, which replace the first delivery by key."""
    root = _scratch(spark, "stream")
    landing, target, ckpt = f"{root}/landing", f"{root}/table", f"{root}/checkpoint"
    events = table(spark, sf, "events")
    ts = F.col("ts")
    first = events.where(ts < F.lit(STREAM_SPLIT).cast("timestamp_ntz")).withColumn("_seq", F.lit(1))
    second = (
        events.where(ts >= F.lit(STREAM_OVERLAP).cast("timestamp_ntz"))
        .withColumn("event_type", F.upper("event_type")).withColumn("_seq", F.lit(2))
    )
    first, second = (b.withColumn("_day", F.to_date("ts")) for b in (first, second))
    schema = T.StructType(first.schema.fields)
    for batch in (first, second):
        batch.write.mode("append").parquet(landing)
        start_keyed_load(
            spark, landing, schema, target, ["_day", "event_id"], ["_day"], order_col="_seq", fmt="parquet",
            checkpoint=ckpt,
        ).awaitTermination()
    return spark.read.parquet(target).select(*events.columns)


@query("stream_partition_load")
def q_stream_partition_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two landed batches of events loaded by a file stream that replaces the
    partitions a batch touches: the second re-delivers some days, changed."""
    root = _scratch(spark, "partition-stream")
    landing, target, ckpt = f"{root}/landing", f"{root}/table", f"{root}/checkpoint"
    events = table(spark, sf, "events").withColumn("_day", F.to_date("ts"))
    again = events.where(F.day("_day") % 3 == 0).withColumn("event_type", F.upper("event_type"))
    schema = T.StructType(events.schema.fields)
    for batch in (events, again):
        batch.write.mode("append").parquet(landing)
        start_partition_load(spark, landing, schema, target, ["_day"], fmt="parquet", checkpoint=ckpt).awaitTermination()
    return spark.read.schema(schema).parquet(target).select(*[c for c in events.columns if c != "_day"])


@query("metadata_reader")
def q_metadata_reader(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata documents written as JSON lines (nested parts as JSON values)
    and read back by the document reader, then flattened to tables."""
    out = _scratch(spark, "documents")
    document_lines(part_documents(table(spark, sf, "part"))).write.text(out)
    return catalog.tables(catalog.parse_documents(read_metadata_lines(spark, out)))


# Landing partitions: one folder per fetched quarter (the area code stays a
# column), so a re-fetched quarter replaces its folder as a whole.
PRICE_KEYS = ["_year", "_quarter"]


def _price_rows(orders: DataFrame) -> DataFrame:
    """Orders as property-price API rows: every field optional text, money as
    exact decimal text, some fields blank, junk or missing; request keys added."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    money = F.concat((cents / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    prio = F.col("o_orderpriority")
    return orders.select(
        F.col("o_orderstatus").alias("Type"),
        prio.alias("Region"),
        F.col("o_custkey").cast("string").alias("MunicipalityCode"),
        money.alias("TradePrice"),
        F.when(prio == "5-LOW", F.lit("")).when(prio == "4-NOT SPECIFIED", F.lit("n/a"))
        .otherwise(money).alias("PricePerUnit"),
        F.when(prio == "1-URGENT", F.lit("2000㎡以上")).otherwise(money).alias("Area"),
        F.col("o_orderkey").cast("string").alias("DistrictCode"),
        F.lpad(((F.col("o_custkey") % 47) + 1).cast("string"), 2, "0").alias("_area_code"),
        F.year("o_orderdate").alias("_year"),
        F.quarter("o_orderdate").alias("_quarter"),
    )


@query("price_mart")
def q_price_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Property-price job end to end: API rows land partitioned by request
    keys, the newest year is fetched again (its partitions replaced), and the
    landed batches are typed by the rename / soft-cast spec."""
    landing = _scratch(spark, "prices")
    rows = _price_rows(table(spark, sf, "orders"))
    load.write_replacing_partitions(rows, landing, PRICE_KEYS)
    refetched = rows.where(F.col("_year") == 2001).withColumn("Type", F.lower("Type"))
    load.write_replacing_partitions(refetched, landing, PRICE_KEYS)
    return datasets.trade_prices(read_batches(spark, landing, fmt="parquet"))


@query("export_datasets")
def q_export_datasets(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_datasets(catalog.datasets(_parsed_docs(spark, sf)))


@query("export_schemas")
def q_export_schemas(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_schemas(catalog.schemas(_parsed_docs(spark, sf)))


@query("export_dependencies")
def q_export_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_dependencies(catalog.dependencies(_parsed_docs(spark, sf)))


@query("postal_csv")
def q_postal_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Postal-code job on headerless CSV: customers written as 15-column
    postal rows (a field with a comma is quoted by the writer), read back by
    position with the declared schema, codes extended by their check digit."""
    out = _scratch(spark, "postal")
    c = table(spark, sf, "customer")
    n = F.col("c_nationkey")
    rows = c.select(
        codes.zero_pad(F.col("c_custkey") % 100000, 5).alias("lg_code"),
        codes.zero_pad(n, 3).alias("old_zipcode"),
        codes.zero_pad(F.col("c_custkey") % 10000000, 7).alias("zipcode"),
        F.col("c_mktsegment").alias("prefecture_kana"),
        F.upper("c_name").alias("city_kana"),
        F.concat(F.lit("T"), n.cast("string")).alias("town_kana"),
        F.col("c_mktsegment").alias("prefecture"),
        F.col("c_name").alias("city"),
        F.concat(F.col("c_name"), F.lit(", annex")).alias("town"),
        (n % 2).alias("has_multiple_zipcodes"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("has_koaza_banchi"),
        (n % 3).alias("has_chome"),
        F.lit(0).alias("has_multiple_towns"),
        (n % 5).alias("update_status"),
        (n % 7).alias("update_reason"),
    )
    rows.write.option("header", False).csv(out)
    return datasets.postal_codes(read_csv_positional(spark, out, datasets.POSTAL_SCHEMA))


@query("boundaries")
def q_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    """Boundary job: TopoJSON topologies (one per part row) decoded — delta-coded
    arcs, reversed arcs, shared points — into GeoJSON prefecture boundaries."""
    topologies = part_topologies(table(spark, sf, "part"))
    return datasets.prefecture_boundaries(decode_topologies(topologies))


def _age_value(i: int) -> F.Column:
    """Population of the i-th age×sex column of a customer-derived row
    (empty for some cells, so the unpivot has NULLs to drop)."""
    k = F.col("c_custkey")
    return F.when((k + F.lit(i)) % 11 == 0, F.lit(None).cast("bigint")).otherwise((k * F.lit(i + 3)) % 997)


@query("population_csv")
def q_population_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Population job: customers written as the wide municipal population CSV
    (Japanese headers, Shift-JIS, leading-zero codes, empty cells, two survey
    dates), read back by column name and reshaped to the long table."""
    out = _scratch(spark, "population")
    c = table(spark, sf, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    inv = {v: src for src, v in datasets.POPULATION_KEYS}  # published name → source header
    cols = [
        codes.zero_pad(n * 1000 + 1, 6).alias(inv["lg_code"]),
        codes.zero_pad(k, 6).alias(inv["area_code"]),
        F.col("c_mktsegment").alias(inv["lg_name"]),
        F.when(k % 2 == 0, F.lit("2024-04-01")).otherwise(F.lit("2024-10-01")).alias(inv["reference_date"]),
        F.col("c_name").alias(inv["area_name"]),
        (k % 1000).alias("総人口"),
        (k % 500).alias("男性"),
        (k % 500).alias("女性"),
    ]
    cols += [_age_value(i).alias(src) for i, (src, _) in enumerate(datasets.population_columns())]
    cols += [(k % 300).alias("世帯数"), F.when(n == 0, F.lit("注記")).alias("備考")]
    c.select(*cols).write.option("header", True).option("encoding", "Shift_JIS").csv(out)
    raw = read_csv_named(spark, out, datasets.population_csv_types(), encoding="Shift_JIS")
    return datasets.population_long(raw)


@query("csv_inferred")
def q_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Header CSV with undeclared columns: their types come from all values, so one
    late row can widen a column; a declared code keeps its leading zeros."""
    out = _scratch(spark, "csv-inferred")
    c = table(spark, sf, "customer")
    k, last = F.col("c_custkey"), F.col("c_custkey") == c.agg(F.max("c_custkey")).scalar()
    day = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), (k % 900).cast("int")), "yyyy-MM-dd")
    c.select(
        F.lpad(k.cast("string"), 8, "0").alias("code"),
        F.lpad(k.cast("string"), 8, "0").alias("number"),
        F.when(last, "0.5").otherwise(k.cast("string")).alias("widened"),
        F.when(last, "n/a").otherwise(k.cast("string")).alias("mixed"),
        F.when(k % 3 != 0, day).alias("day"),
        F.when(last, "0").otherwise(day).alias("day_or_number"),
        F.col("c_acctbal").alias("balance"),
        F.lit(None).cast("string").alias("empty"),
        F.col("c_mktsegment").alias("segment"),
    ).write.option("header", True).csv(out)
    return read_csv_named(spark, out, {"code": "string"}, default="infer")


GATE_CONTRACT = [
    ("c_custkey", "bigint", True), ("c_name", "string", True), ("c_mktsegment", "string", True),
    ("c_acctbal", "double", False),
]


@query("contract_gate")
def q_contract_gate(spark: SparkSession, sf: str) -> DataFrame:
    """A table under contract: a good batch is added, one that breaks the contract is
    turned away as a whole, another good one is added; what the table then holds."""
    out = _scratch(spark, "contract")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    checks = {"balance below a million": F.col("c_acctbal") < 1_000_000}
    rich, household = F.col("c_acctbal") >= 0, F.col("c_mktsegment") == "HOUSEHOLD"
    contracts.write_enforced(c.where(rich), out, GATE_CONTRACT, checks)
    broken = c.where(~rich).withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")))
    if not broken.where("c_mktsegment IS NULL").isEmpty():
        try:
            contracts.write_enforced(broken, out, GATE_CONTRACT, checks)
        except contracts.ContractViolation:
            contracts.write_enforced(c.where(~rich & ~household), out, GATE_CONTRACT, checks)
        else:
            raise AssertionError("a batch with forbidden NULLs was written")
    else:
        contracts.write_enforced(broken, out, GATE_CONTRACT, checks)
    return contracts.read_enforced(spark, out, GATE_CONTRACT)


def _loaded(spark: SparkSession, sf: str) -> tuple[LoadState, str, list[str]]:
    """Events loaded in three runs that share a state: the first half, the same again
    (nothing is new), then all of them."""
    root = _scratch(spark, "state")
    events = table(spark, sf, "events")
    source = events.withColumn("_day", F.to_date("ts"))
    half = source.where(F.col("ts") < F.lit(STREAM_SPLIT).cast("timestamp_ntz"))
    state = LoadState(spark, f"{root}/state", "timestamp_ntz")
    for rows in (half, half, source):
        load_new(state, rows, "events", f"{root}/table", ["_day", "event_id"], "ts", ["_day"])
    return state, f"{root}/table", events.columns


@query("load_state")
def q_load_state(spark: SparkSession, sf: str) -> DataFrame:
    """The runs that the state records: cursor and rows read by each."""
    state, _, _ = _loaded(spark, sf)
    return state.runs().select("resource", "run", "cursor", "n_rows")


@query("load_state_table")
def q_load_state_table(spark: SparkSession, sf: str) -> DataFrame:
    """The table that those runs loaded."""
    _, path, columns = _loaded(spark, sf)
    return spark.read.parquet(path).select(*columns)


@query("push_script")
def q_push_script(spark: SparkSession, sf: str) -> DataFrame:
    """The ordered export script pushed in numbered batches of statements and read back."""
    out = _scratch(spark, "push")
    export.push(q_export_script(spark, sf), out)
    # the folder is listed once; a pattern in the path would make every file a listing of its own
    text = spark.read.text(out, wholetext=True, pathGlobFilter="*.sql")
    return text.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"batch-(\d+)\.sql", 1).cast("bigint").alias("batch"),
        F.length("value").cast("bigint").alias("n_chars"),
        F.md5("value").alias("digest"),
    )


@query("registered_documents")
def q_registered_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One metadata file per supplier, in folders with blanks and signs in their
    names, read whole by the registry; some registered datasets have no file."""
    out = _scratch(spark, "registered")
    s = table(spark, sf, "supplier")
    name = F.concat(F.lit("données "), "s_name", F.lit(" 100%"))
    docs = s.where("s_acctbal >= 0").select(
        name.alias("datasource"),
        F.concat(F.col("s_name"), F.lit(' "quoted"\n')).alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("c"), F.col("s_nationkey").cast("string")).alias("cover"),
        F.to_json(F.array(F.col("s_name"), F.lit("標"))).alias("tags"),
        F.lit("https://lake.example.org/").alias("ducklake_url"),
        F.lit('{"main":{"tables":[]}}').alias("schemas"),
        F.lit(None).cast("string").alias("dependencies"), F.lit(None).cast("string").alias("lineage"),
        F.lit(None).cast("string").alias("readme"),
    )
    write_files(document_files(docs), out)
    registry = s.select(name.alias("datasource"), "s_suppkey")
    return read_registered(spark, registry, out).select(
        "s_suppkey", "datasource", "has_document", "title", "description", "cover", "tags", "schemas"
    )


@query("orphan_listing")
def q_orphan_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan report over a real listing: files written below one folder per nation,
    listed by the executors; those of suppliers with a positive balance are in use."""
    out = _scratch(spark, "lake")
    s = table(spark, sf, "supplier")
    path = F.concat(F.lit("nation "), F.col("s_nationkey").cast("string"), F.lit("/"), "s_name", F.lit(".bin"))
    write_files(s.select(path.alias("path"), F.repeat(F.lit("x"), (F.col("s_suppkey") % 3000).cast("int")).alias("content")), out)
    active = s.where("s_acctbal > 0").select(path.alias("full_path"))
    return maintain.orphan_files(list_files(spark, out), active).select("path", "size", "size_text")


@query("build_documents")
def q_build_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata documents of a manifest: each dataset holds twenty parts in the order
    of their places in the manifest (descending keys), in declared and other schemas."""
    p = table(spark, sf, "part").select(
        "p_partkey", "p_size", "p_name", "p_type", "p_brand",
        F.concat(F.lit("d"), F.floor(F.col("p_partkey") / 20).cast("string")).alias("ds"),
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("name"),
        (-F.col("p_partkey")).alias("position"),
    )
    uid = F.concat_ws(".", F.lit("model"), "ds", "name")
    nodes = p.select(
        uid.alias("unique_id"), F.lit("model").alias("resource_type"), F.array("ds", F.lit("x"), "name").alias("fqn"),
        F.when(F.col("p_size") % 3 == 0, "main").when(F.col("p_size") % 3 == 1, "late").otherwise("extra").alias("schema"),
        "name", F.when(F.col("p_size") > 5, F.col("p_type")).alias("description"),
        F.when(F.col("p_size") % 2 == 0, "table").otherwise("view").alias("materialized"),
        F.when(F.col("p_size") > 40, F.concat(F.lit(" select "), "name", F.lit(" "))).alias("compiled_code"),
        F.map_from_arrays(F.array(F.lit("title"), F.lit("published"), F.lit("tags")),
                          F.array(F.col("p_name"), F.when(F.col("p_size") > 25, "true").otherwise("false"),
                                  F.to_json(F.array("p_brand")))).alias("meta"),
        "position",
    )
    columns = p.where("p_size > 10").select(uid.alias("unique_id"), F.explode(F.array(F.lit(2), F.lit(1))).alias("position"), "p_type").select(
        "unique_id", "position", F.concat(F.lit("c"), F.col("position").cast("string")).alias("name"),
        F.lit("").alias("title"), F.col("p_type").alias("description"), F.lit("BIGINT").alias("data_type"),
        (F.col("position") == 1).alias("nullable"),
    )
    parents = p.select(F.col("ds").alias("datasource"), F.col("name").alias("child"),
                       F.when(F.col("p_size") > 30, F.array(F.lit("raw"), F.lit("base"))).otherwise(F.array().cast("array<string>")).alias("parents"),
                       "position")
    lineage_nodes = p.select(F.col("ds").alias("datasource"), "name", F.array("ds", F.lit("x"), "name").alias("fqn"),
                             F.lit("model").alias("resource_type"), F.lit("view").alias("materialized"),
                             F.create_map().cast("map<string,string>").alias("meta"), "position")
    configs = p.select("ds").distinct().select(
        F.col("ds").alias("datasource"), F.concat(F.lit("Title "), "ds").alias("title"), F.lit("about").alias("description"),
        F.lit(None).cast("string").alias("cover"), F.array(F.lit("t")).alias("tags"), F.concat(F.lit("https://x/"), "ds").alias("ducklake_url"),
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("title")) for n, t in (("zero", "Z"), ("main", "M"))]).alias("schemas"),
        F.lit(None).cast("array<struct<alias:string,ducklake_url:string>>").alias("dependencies"), F.lit(None).cast("string").alias("readme"),
    )
    return metadata.build_documents(configs, metadata.model_rows(nodes), columns, parents, lineage_nodes).select(
        "datasource", "document", F.col("total_tables").cast("bigint").alias("total_tables")
    )


@query("survey_report")
def q_survey_report(spark: SparkSession, sf: str) -> DataFrame:
    """Survey of a table listing (one JSON entry per order): classes, surveys, latest entries."""
    o = table(spark, sf, "orders")
    key, prio = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    named = F.concat(F.lit("調査 "), (F.col("o_custkey") % 7).cast("string"))
    kind = F.when(prio == "1-URGENT", "地域メッシュ統計").when(prio == "2-HIGH", "小地域集計").when(prio == "3-MEDIUM", "町丁・字等別").otherwise("都道府県別")
    title = F.concat(kind, F.lit(" "), key)
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    entry = F.concat(
        F.lit('{"@id":'), quoted(key),
        F.lit(',"TITLE":'), F.when(F.col("o_orderstatus") == "O", F.concat(F.lit('{"@no":"1","$":'), quoted(title), F.lit("}"))).otherwise(quoted(title)),
        F.lit(',"STAT_NAME":'), F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit('{"$":'), quoted(named), F.lit(',"@code":'), quoted(F.concat(F.lit("00"), key)), F.lit("}"))).otherwise(quoted(named)),
        F.lit(',"SURVEY_DATE":'), quoted(F.date_format("o_orderdate", "yyyyMM")),
        F.lit("}"),
    )
    return survey.survey_report(o.select(entry.alias("entry"), F.col("o_orderkey").alias("position")), "entry", "position")


@query("municipalities")
def q_municipalities(spark: SparkSession, sf: str) -> DataFrame:
    """Municipality boundaries: all six published columns of the topologies' features."""
    return datasets.municipality_boundaries(decode_topologies(part_topologies(table(spark, sf, "part"))))


@query("copy_namespace")
def q_copy_namespace(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables and a view over them copied to another database, the source changed,
    copied again (tables emptied and filled, the view resolved there), read back."""
    name = uuid.uuid4().hex
    source, target = f"tidepool_src_{name}", f"tidepool_dst_{name}"
    spark.sql(f"CREATE DATABASE {source}")
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    nation.write.saveAsTable(f"{source}.nation_copy")
    supplier.where("s_acctbal >= 0").write.saveAsTable(f"{source}.supplier_copy")
    current = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(source)
    try:
        spark.sql("""CREATE VIEW by_nation AS SELECT n_name, count(s_suppkey) AS n_suppliers, sum(s_acctbal) AS balance
                     FROM nation_copy LEFT JOIN supplier_copy ON s_nationkey = n_nationkey GROUP BY n_name""")
    finally:
        spark.catalog.setCurrentDatabase(current)
    load.copy_namespace(spark, source, target)
    supplier.where("s_acctbal < 0").write.mode("append").saveAsTable(f"{source}.supplier_copy")
    load.copy_namespace(spark, source, target)
    spark.sql(f"DROP DATABASE {source} CASCADE")  # the copies stand alone
    return spark.table(f"{target}.by_nation").select("n_name", "n_suppliers", F.round("balance", 2).alias("balance"))


@query("live_information_schema")
def q_live_information_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Relation report over databases of the session's catalog: a table and a view per region."""
    name = uuid.uuid4().hex
    nation = table(spark, sf, "nation")
    schemas = [f"tidepool_a_{name}", f"tidepool_b_{name}"]
    for schema in schemas:
        spark.sql(f"CREATE DATABASE {schema}")
    for r in table(spark, sf, "region").collect():
        own = nation.where(F.col("n_regionkey") == r.r_regionkey)
        region = r.r_name.lower().replace(" ", "_")
        target = f"{schemas[r.r_regionkey % 2]}.{region}"
        own.select(F.col("n_name").alias("n_name", metadata={"comment": f"nation of {r.r_name}"}), "n_nationkey").write.saveAsTable(target)
        view = f"{schemas[0]}.v_{region}"
        spark.sql(f"CREATE VIEW {view} COMMENT 'about {r.r_name}' AS SELECT n_nationkey * 2.5D AS x FROM {target}")
    try:
        report = information_schema.relation_columns(*information_schema.session_relations(spark, schemas), schemas)
    finally:
        for schema in schemas:
            spark.sql(f"DROP DATABASE {schema} CASCADE")
    return report.withColumn("table_schema", F.regexp_replace("table_schema", "_[0-9a-f]{32}$", ""))
