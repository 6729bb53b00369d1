import pytest
from pyspark.sql import functions as F

from tidepool.operators import load


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_idempotent_and_batch_order(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    batch = spark.createDataFrame([(2, "B1", 1), (2, "B2", 2), (4, "D", 1)], "k long, v string, seq int")
    once = load.upsert(base, batch, ["k"], "seq")
    twice = load.upsert(once, batch, ["k"], "seq")
    assert _rows(once) == [(1, "a"), (2, "B2"), (3, "c"), (4, "D")]
    assert _rows(twice) == _rows(once)


def test_replace_partitions_on_disk_is_idempotent(spark, tmp):
    path = str(tmp / "t")
    base = spark.createDataFrame([("01", 2024, 1, "x"), ("01", 2024, 2, "y"), ("02", 2024, 1, "z")],
                                 "_area_code string, _year int, _quarter int, v string")
    load.write_replacing_partitions(base, path, ["_area_code", "_year", "_quarter"])
    batch = spark.createDataFrame([("01", 2024, 1, "new1"), ("01", 2024, 1, "new2")], base.schema)
    for _ in range(2):
        load.write_replacing_partitions(batch, path, ["_area_code", "_year", "_quarter"])
        got = spark.read.schema(base.schema).parquet(path).select(*base.columns)
        assert _rows(got) == [("01", 2024, 1, "new1"), ("01", 2024, 1, "new2"), ("01", 2024, 2, "y"),
                              ("02", 2024, 1, "z")]
    # an empty batch keeps the old partitions
    load.write_replacing_partitions(batch.limit(0), path, ["_area_code", "_year", "_quarter"])
    assert spark.read.parquet(path).count() == 4
    logical = load.replace_partitions(base, batch, ["_area_code", "_year", "_quarter"])
    assert _rows(logical) == _rows(spark.read.schema(base.schema).parquet(path).select(*base.columns))


def test_upsert_dedupes_and_matches_null_keys(spark):
    base = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    batch = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "m", 1), (None, "o", 2)], "k long, v string, seq int")
    for _ in range(2):
        base = load.upsert(base, batch, ["k"], "seq")
        assert sorted(((r.k, r.v) for r in base.collect()), key=str) == [(1, "y"), (None, "o")]
    with pytest.raises(ValueError):
        load.upsert(base, batch, ["k", "seq"], "seq")


def test_incremental_takes_the_newest_of_a_key(spark):
    state = spark.createDataFrame([(1, 10, "o")], "k long, t int, v string")
    source = spark.createDataFrame([(1, 10, "old"), (1, 11, "new")], state.schema)
    assert _rows(load.incremental(state, source, "t", ["k"])) == [(1, 11, "new")]


def test_replace_partitions_agrees_with_the_sink_on_null(spark, tmp):
    path = str(tmp / "nulls")
    base = spark.createDataFrame([(None, "x"), ("a", "y")], "p string, v string")
    batch = spark.createDataFrame([(None, "new")], base.schema)
    load.write_replacing_partitions(base, path, ["p"])
    load.write_replacing_partitions(batch, path, ["p"])
    key = lambda df: sorted(((r.p, r.v) for r in df.collect()), key=str)
    assert key(load.replace_partitions(base, batch, ["p"])) == key(spark.read.schema(base.schema).parquet(path)) == [("a", "y"), (None, "new")]


def test_merged_partitions_keep_null_partitions(spark, tmp):
    path = str(tmp / "null_parts")
    schema = "tab string, cat string, v double, seq int"
    b1 = spark.createDataFrame([(None, "A", 1.0, 1), (None, "B", 2.0, 1), ("t", "A", 3.0, 1), (None, None, 4.0, 1)], schema)
    load.write_merged_partitions(spark, b1, path, ["tab", "cat"], "seq", ["tab"])
    b2 = spark.createDataFrame([(None, "A", 9.0, 2), (None, None, 5.0, 2)], schema)
    for _ in range(2):
        load.write_merged_partitions(spark, b2, path, ["tab", "cat"], "seq", ["tab"])
        got = sorted(((r.tab, r.cat, r.v) for r in spark.read.parquet(path).collect()), key=str)
        assert got == sorted([(None, "A", 9.0), (None, "B", 2.0), ("t", "A", 3.0), (None, None, 5.0)], key=str)
    with pytest.raises(ValueError):
        load.write_merged_partitions(spark, b2, path, ["cat"], "seq", ["tab"])


def test_work_list_skips_done_but_refetches_current(spark):
    areas = load.area_codes(spark.range(1, 3).withColumnRenamed("id", "n"), "n")
    done = spark.createDataFrame([("01", 2005, 3), ("01", 2005, 4), ("02", 2005, 4)],
                                 "area_code string, year int, quarter int")
    got = _rows(load.quarter_work_list(areas, "area_code", (2005, 3), (2005, 4), done))
    assert got == [("01", 2005, 4), ("02", 2005, 3), ("02", 2005, 4)]
    assert load.quarter_work_list(areas, "area_code", (2005, 3), (2006, 1)).count() == 6
    from datetime import date

    assert load.current_quarter(date(2026, 12, 3)) == (2026, 4) and load.current_quarter(date(2024, 1, 1)) == (2024, 1)
    y, q = load.current_quarter()
    assert load.quarter_work_list(areas, "area_code", (y, q)).count() == 2


def test_incremental_cursor_keeps_ties(spark):
    state = spark.createDataFrame([(1, 10), (2, 20)], "k long, t int")
    source = spark.createDataFrame([(2, 20), (3, 20), (4, 30), (0, 5)], "k long, t int")
    got = _rows(load.incremental(state, source, "t", ["k"]))
    assert got == [(1, 10), (2, 20), (3, 20), (4, 30)]
    empty = state.limit(0)
    assert load.incremental(empty, source, "t", ["k"], F.lit(0)).count() == 4


def test_keyed_replace_and_state_skip(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "id string, seq int, v string")
    assert _rows(load.keyed_replace(rows, "id", "seq")) == [("a", 2, "y"), ("b", 1, "z")]
    done = spark.createDataFrame([("a",)], "id string")
    assert _rows(load.state_skip(rows.select("id").distinct(), done, ["id"])) == [("b",)]


def test_copy_namespace(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_src")
    spark.createDataFrame([(1, "a")], "k long, v string").write.mode("overwrite").saveAsTable("lake_src.t1")
    spark.createDataFrame([(2,)], "k long").write.mode("overwrite").saveAsTable("lake_src.t2")
    copied = load.copy_namespace(spark, "lake_src", "lake_dst")
    assert sorted(copied) == ["t1", "t2"]
    assert _rows(spark.table("lake_dst.t1")) == [(1, "a")]
    load.copy_namespace(spark, "lake_src", "lake_dst")  # rerun replaces, no duplicates
    assert spark.table("lake_dst.t2").count() == 1


def test_push_batches_chunks_on_executors(spark, tmp):
    import os
    import uuid

    from tidepool.operators.export import push_batches

    out = str(tmp / "pushed")
    os.makedirs(out)

    def send(chunk):  # runs in executor Python workers
        with open(os.path.join(out, uuid.uuid4().hex), "w") as fh:
            fh.write("\n".join(chunk))

    df = spark.range(0, 1000, numPartitions=3).selectExpr("concat('INSERT ', id, ';') AS statement")
    push_batches(df, send, batch_rows=200)
    sizes = sorted(len(open(os.path.join(out, f)).read().splitlines()) for f in os.listdir(out))
    assert sum(sizes) == 1000 and max(sizes) == 200


def test_write_merged_partitions_by_key_prefix(spark, tmp):
    path = str(tmp / "by_tab")
    b1 = spark.createDataFrame([("t1", "A", 1.0, 1), ("t2", "A", 2.0, 1)], "tab string, cat string, v double, seq int")
    load.write_merged_partitions(spark, b1, path, ["tab", "cat"], "seq", ["tab"])
    b2 = spark.createDataFrame([("t1", "A", 9.0, 2), ("t1", "B", 3.0, 2)], b1.schema)
    load.write_merged_partitions(spark, b2, path, ["tab", "cat"], "seq", ["tab"])
    got = sorted((r.tab, r.cat, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("t1", "A", 9.0), ("t1", "B", 3.0), ("t2", "A", 2.0)]


def _failing_batch(spark):
    """A batch whose evaluation fails inside the write job (ANSI cast error)."""
    return spark.createDataFrame([(9, "x", 5)], "k long, v string, seq int").withColumn(
        "v", F.col("v").cast("int").cast("string")
    )


def test_failed_partition_merge_leaves_the_table(spark, tmp):
    import pytest

    path = str(tmp / "parts")
    b1 = spark.createDataFrame([(i, f"v{i}", 1) for i in range(20)], "k long, v string, seq int")
    load.write_merged_partitions(spark, b1, path, ["k"], "seq", ["k"])
    before = _rows(spark.read.parquet(path).select("k", "v", "seq"))
    with pytest.raises(Exception):
        load.write_merged_partitions(spark, _failing_batch(spark), path, ["k"], "seq", ["k"])
    assert _rows(spark.read.parquet(path).select("k", "v", "seq")) == before


def test_orphan_report_over_real_files(spark, tmp):
    from tidepool.operators import maintain
    from tidepool.sources.listing import list_files

    root = str(tmp / "lake")
    b1 = spark.createDataFrame([(i, "a", 1) for i in range(10)], "k long, v string, seq int")
    v1, v2 = f"{root}/v-1", f"{root}/v-2"
    b1.write.parquet(v1)
    b1.withColumn("seq", F.lit(2)).write.parquet(v2)
    files = list_files(spark, root, "*.parquet")
    current = v2.rsplit("/", 1)[1] + "/"
    active = files.where(F.col("path").startswith(current)).select(F.col("path").alias("full_path"))
    orphans = maintain.orphan_files(files, active).collect()
    assert orphans and all(r.path.startswith(v1.rsplit("/", 1)[1] + "/") for r in orphans)
    summary = maintain.orphan_summary(files, active).first()
    assert summary.listed_count == files.count()
    assert summary.orphan_count == len(orphans) and summary.orphan_bytes == sum(r.size for r in orphans)
    assert summary.active_count + summary.orphan_count == summary.listed_count


def test_checkpoint_folder_must_be_shared_outside_local_mode():
    from types import SimpleNamespace

    from tidepool.session import checkpoint_root

    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(ValueError):
        checkpoint_root(cluster)
