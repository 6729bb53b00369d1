"""The ordered refresh: row numbers, order of statements, convergence, pushed batches."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidepool.operators import catalog, export
from tidepool.operators.ordering import with_row_numbers
from tidepool.plans.catalog_docs import part_documents
from tidepool.sources.files import write_files


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_numbers_follow_one_total_order(spark, partitions):
    rows = [(k % 5 if k % 11 else None, f"t{k % 3}", k) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(partitions)
    got = with_row_numbers(df, ["a", "b", "c"]).collect()
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.seq)] == expected
    assert sorted(r.seq for r in got) == list(range(1, 501))


def test_row_numbers_of_ties_and_of_no_rows(spark):
    same = spark.createDataFrame([(1,)] * 300, "a int").repartition(5)
    assert sorted(r.n for r in with_row_numbers(same, ["a"], "n", 0).collect()) == list(range(300))
    assert with_row_numbers(same.where("a > 1"), ["a"]).count() == 0


def test_ranges_are_spread_over_tasks(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = with_row_numbers(spark.range(20_000).withColumn("x", F.hash("id")), ["x"])
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        # the one window stands over the counts of partitions
        assert plan.split("\n\n")[0].count("Window") == 1 and "HashAggregate" in plan
        assert [r.seq for r in df.orderBy("x", "id").select("seq").collect()] == list(range(1, 20_001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def _docs(spark, n):
    part = spark.createDataFrame(
        [(k, f"red{k % 4} ring", f"Brand#{k % 5}", "PROMO", k) for k in range(n)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    )
    return part_documents(part)


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted").split("\n\n")[0]


def test_numbering_shuffles_the_rows_only_by_their_order(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the rows are too large for it
        df = with_row_numbers(spark.range(2_000).withColumn("x", F.hash("id")), ["x"])
        assert "BroadcastHashJoin" in _plan(df) and "SortMergeJoin" not in _plan(df)
        assert [r.seq for r in df.orderBy("x", "id").select("seq").collect()] == list(range(1, 2_001))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_documents_of_one_split_are_built_by_several_tasks(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else few small rows are put together again
    try:
        one = spark.range(400).selectExpr("id AS p_partkey", "'red ring' AS p_name", "'B' AS p_brand", "'T' AS p_type", "CAST(id AS int) AS p_size").coalesce(1)
        tasks = [r.n for r in part_documents(one).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(tasks) == 4 and max(tasks) < 200 and sum(tasks) == 400
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_unparsed_fallback_documents_give_the_script_of_parsed_ones(spark):
    docs = _docs(spark, 9).unionByName(_docs(spark, 2).withColumn("datasource", F.lit(None).cast("string")))
    main = catalog.parse_documents(docs.where("datasource < 'ds4'"))
    of = lambda fallback: [tuple(r) for r in export.script(main, fallback).orderBy("seq").collect()]
    rows = of(docs.withColumn("further", F.lit(1)))
    assert [r[:2] for r in rows] == [r[:2] for r in of(catalog.parse_documents(docs))]
    assert sorted(str(r[2]) for r in rows) == sorted(str(r[2]) for r in of(catalog.parse_documents(docs)))
    assert sum("'ds7'" in str(r[2]) for r in rows) > 2


def _script(spark, n, **kw):
    rows = export.script(catalog.parse_documents(_docs(spark, n)), **kw).collect()
    return [(r.table, r.statement) for r in sorted(rows, key=lambda r: r.seq)]


def test_deletes_come_first_then_table_by_table(spark):
    script = _script(spark, 12)
    assert [s for _, s in script[:5]] == [f"DELETE FROM {t};" for t in export.EXPORTED]
    assert not any(s.startswith("DELETE") for _, s in script[5:])
    tables = [t for t, _ in script[5:]]
    order = ["catalog_datasets", "catalog_dependencies", "catalog_schemas", "catalog_tables", "catalog_columns"]
    assert tables == sorted(tables, key=order.index) and set(tables) == set(order)


def test_fallback_documents_follow_dataset_by_dataset(spark):
    docs = _docs(spark, 6)
    main = catalog.parse_documents(docs.where("datasource <> 'ds3' AND datasource <> 'ds5'"))
    rows = export.script(main, catalog.parse_documents(docs)).collect()
    tail = [r.statement for r in sorted(rows, key=lambda r: r.seq) if "'ds3" in r.statement or "'ds5" in r.statement]
    assert tail[0].startswith("INSERT OR REPLACE INTO catalog_datasets") and "'ds3'" in tail[0]
    kinds = [s.split(" ")[4].removeprefix("catalog_") for s in tail if "'ds3" in s]
    # main with three tables (each followed by its columns), then extra
    assert kinds[:3] == ["datasets", "schemas", "tables"] and kinds.index("columns") == 3
    assert kinds.count("schemas") == 2 and kinds[-1] in ("schemas", "tables")
    assert all("'ds5" in s for s in tail[len(kinds) :])


def _target():
    con = duckdb.connect()
    con.execute("CREATE TABLE catalog_datasets (datasource TEXT PRIMARY KEY, title TEXT, description TEXT, cover TEXT, ducklake_url TEXT, tags TEXT)")
    con.execute("CREATE TABLE catalog_schemas (id TEXT PRIMARY KEY, datasource TEXT, schema_name TEXT, title TEXT)")
    con.execute("CREATE TABLE catalog_tables (id TEXT PRIMARY KEY, datasource TEXT, schema_name TEXT, name TEXT, title TEXT, description TEXT, "
                "type TEXT, license TEXT, license_url TEXT, source_url TEXT, is_published INT, tags TEXT, sql TEXT)")
    con.execute("CREATE TABLE catalog_columns (id TEXT PRIMARY KEY, datasource TEXT, schema_name TEXT, table_name TEXT, column_name TEXT, "
                "title TEXT, description TEXT, data_type TEXT, column_index INT)")
    con.execute("CREATE TABLE catalog_dependencies (id TEXT PRIMARY KEY, datasource TEXT, alias TEXT, ducklake_url TEXT)")
    return con


def _held(con):
    return {t: sorted(con.execute(f"SELECT * FROM {t}").fetchall(), key=str) for t in export.EXPORTED}


def test_a_target_with_vanished_rows_converges(spark):
    target, fresh = _target(), _target()
    for _, s in _script(spark, 12):
        target.execute(s)
    target.execute("INSERT INTO catalog_datasets VALUES ('gone', 'g', NULL, NULL, NULL, NULL)")
    for _, s in _script(spark, 7):
        target.execute(s)
        fresh.execute(s)
    assert _held(target) == _held(fresh)
    assert len(_held(target)["catalog_datasets"]) == 7


def _pushed(folder):
    return {p.name: p.read_text().split("\n") for p in folder.glob("*")}


def test_pushed_batches_hold_the_script_once_in_order(spark, tmp):
    df = spark.createDataFrame([(k, f"S{k};") for k in range(1, 1001)], "seq long, statement string").repartition(9)
    for _ in range(2):  # pushing again gives the same files
        export.push(df, str(tmp / "p"), 300)
        got = _pushed(tmp / "p")
        assert sorted(got) == [f"batch-{k:012d}.sql" for k in range(4)]
        assert sum((got[k] for k in sorted(got)), []) == [f"S{k};" for k in range(1, 1001)]


def test_pushed_batches_are_read_back_by_one_listing(spark, tmp):
    from tidepool.plans.registry import QUERIES

    spark.range(60).selectExpr(
        "id AS p_partkey", "concat('red', id, ' ring') AS p_name", "'B' AS p_brand", "'T' AS p_type", "CAST(id AS int) AS p_size"
    ).write.parquet(str(tmp / "part.parquet"))
    batches = QUERIES["push_script"](spark, str(tmp))
    script = [r.statement for r in QUERIES["export_script"](spark, str(tmp)).orderBy("seq").collect()]
    expected = ["\n".join(script[i : i + 200]) for i in range(0, len(script), 200)]
    assert len(expected) > 2 and [(r.batch, r.n_chars) for r in batches.orderBy("batch").collect()] == [(k, len(s)) for k, s in enumerate(expected)]
    # not a listing for each file
    location = next(x for x in batches._sc._jvm.PythonSQLUtils.explainString(batches._jdf.queryExecution(), "formatted").split("\n") if x.startswith("Location"))
    assert "/push-" in location and "batch-" not in location


def test_a_task_that_fails_after_some_batches_leaves_none(spark, tmp):
    df = spark.createDataFrame([(f"batch-{k}.sql", f"S{k};") for k in range(6)], "path string, content string").coalesce(1)
    bad = df.select(F.when(F.col("path") == "batch-3.sql", "../out").otherwise(F.col("path")).alias("path"), "content")
    with pytest.raises(Exception, match="not a path inside"):
        write_files(bad, str(tmp / "p"))
    assert not (tmp / "p").exists() or not list((tmp / "p").iterdir())
    write_files(df, str(tmp / "p"))
    assert _pushed(tmp / "p") == {f"batch-{k}.sql": [f"S{k};"] for k in range(6)}


def test_a_task_that_runs_twice_writes_each_batch_once(spark, tmp):
    """Both attempts write, as with speculation: only what the commit is told counts."""
    import pyarrow as pa

    from tidepool.sources.files import NamedFilesWriter

    writer = NamedFilesWriter(str(tmp / "p"))
    batch = pa.RecordBatch.from_pylist([{"path": "a/1", "content": "x"}, {"path": "a/2", "content": None}])
    writer.write(iter([batch.slice(0, 1)]))  # lost after its first file
    writer.commit([writer.write(iter([batch])), None])
    assert {p.relative_to(tmp / "p").as_posix(): p.read_text() for p in (tmp / "p").rglob("*") if p.is_file()} == {"a/1": "x", "a/2": ""}
    assert not list((tmp / "p").glob("_*"))


def test_a_commit_moves_many_files_and_keeps_the_last_of_a_name(tmp):
    import pyarrow as pa

    from tidepool.sources.files import NamedFilesWriter

    writer = NamedFilesWriter(str(tmp / "p"))
    rows = [{"path": f"{k % 3}/{k}", "content": f"x{k}"} for k in range(100)]
    told = [writer.write(iter([pa.RecordBatch.from_pylist(r)])) for r in (rows, [{"path": "0/0", "content": "z"}])]
    writer.commit(told)
    assert {p.relative_to(tmp / "p").as_posix(): p.read_text() for p in (tmp / "p").rglob("*") if p.is_file()} == {r["path"]: r["content"] for r in rows} | {"0/0": "z"}
    assert not list((tmp / "p").glob("_*"))
    twice = NamedFilesWriter(str(tmp / "q"))
    with pytest.raises(FileExistsError, match="same file twice"):  # none is moved
        twice.commit([twice.write(iter([pa.RecordBatch.from_pylist([*rows, rows[0]])]))])
    assert not list((tmp / "q").iterdir())
