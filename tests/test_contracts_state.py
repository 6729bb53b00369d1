"""Enforced contracts and durable load state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepool.operators import contracts, state
from tidepool.operators.contracts import ContractViolation, read_enforced, write_enforced
from tidepool.operators.state import LoadState, load_new

CONTRACT = [("k", "bigint", True), ("name", "string", True), ("n", "int", False)]


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k long, name string, n int")


def _held(spark, path):
    return sorted(tuple(r) for r in read_enforced(spark, path, CONTRACT).collect())


def test_a_violating_batch_leaves_the_table_as_it_was(spark, tmp):
    path = str(tmp / "t")
    assert _held(spark, path) == []
    assert write_enforced(_batch(spark, [(1, "a", None), (2, "b", 5)]), path, CONTRACT) == 2
    before = sorted(p.relative_to(tmp).as_posix() for p in tmp.rglob("*.parquet"))
    with pytest.raises(ContractViolation) as e:
        write_enforced(_batch(spark, [(3, None, 1), (None, None, 2), (4, "c", 3)]).repartition(3), path, CONTRACT)
    assert e.value.violations == {"k is null": 1, "name is null": 2}
    assert _held(spark, path) == [(1, "a", None), (2, "b", 5)]
    assert sorted(p.relative_to(tmp).as_posix() for p in tmp.rglob("*.parquet")) == before


def test_schema_is_checked_before_any_row_is_read(spark, tmp):
    wrong = spark.createDataFrame([(1, "a", "x")], "k int, name string, extra string")
    with pytest.raises(ContractViolation) as e:
        write_enforced(wrong, str(tmp / "t"), CONTRACT)
    assert set(e.value.violations) == {"n is missing", "k is int, not bigint", "extra is not declared"}
    assert not (tmp / "t").exists()


def test_further_checks_count_nulls_as_broken(spark, tmp):
    checks = {"n positive": F.col("n") > 0}
    with pytest.raises(ContractViolation, match="n positive: 2 rows"):
        write_enforced(_batch(spark, [(1, "a", None), (2, "b", 0), (3, "c", 1)]), str(tmp / "t"), CONTRACT, checks)


def test_overwrite_keeps_the_old_rows_until_the_new_ones_hold(spark, tmp):
    path = str(tmp / "t")
    write_enforced(_batch(spark, [(1, "a", 1)]), path, CONTRACT)
    write_enforced(_batch(spark, [(2, "b", 1)]), path, CONTRACT)
    with pytest.raises(ContractViolation):
        write_enforced(_batch(spark, [(3, None, 1)]), path, CONTRACT, overwrite=True)
    assert len(_held(spark, path)) == 2
    write_enforced(_batch(spark, [(4, "d", 1)]), path, CONTRACT, overwrite=True)
    assert _held(spark, path) == [(4, "d", 1)]
    assert len(contracts.batches(spark, path)) == 1


def test_a_failing_job_leaves_nothing(spark, tmp):
    path = str(tmp / "t")
    bad = _batch(spark, [(1, "a", 1)]).withColumn("name", F.raise_error(F.lit("broken input")).cast("string"))
    with pytest.raises(Exception, match="broken input"):
        write_enforced(bad, path, CONTRACT)
    assert _held(spark, path) == [] and not list((tmp / "t").rglob("*.parquet"))


def test_an_empty_batch_is_a_batch(spark, tmp):
    assert write_enforced(_batch(spark, []), str(tmp / "t"), CONTRACT) == 0
    assert _held(spark, str(tmp / "t")) == []


# --- load state ---


def _events(spark, rows):
    parsed = [(k, dt.datetime(2024, 1, d) if d else None, v) for k, d, v in rows]
    return spark.createDataFrame(parsed, "id long, ts timestamp_ntz, v string").withColumn("day", F.to_date("ts"))


def _load(spark, tmp, rows, resource="events"):
    s = LoadState(spark, str(tmp / "state"), "timestamp_ntz")
    return load_new(s, _events(spark, rows), resource, str(tmp / resource), ["day", "id"], "ts", ["day"]), s


def _table(spark, tmp, resource="events"):
    return sorted(tuple(r) for r in spark.read.parquet(str(tmp / resource)).select("id", "v").collect())


def test_second_run_reads_nothing_and_ties_are_kept(spark, tmp):
    rows = [(1, 1, "a"), (2, 2, "b"), (3, 2, "c")]
    assert _load(spark, tmp, rows)[0] == 3
    assert _load(spark, tmp, rows)[0] == 0
    # a row tied with the cursor that arrives late, and one that changed
    n, s = _load(spark, tmp, [*rows[:2], (3, 2, "C"), (4, 2, "d"), (5, 3, "e")])
    assert n == 3
    assert _load(spark, tmp, [(4, 2, "d"), (5, 3, "e")])[0] == 0
    assert _table(spark, tmp) == [(1, "a"), (2, "b"), (3, "C"), (4, "d"), (5, "e")]
    runs = sorted((r.run, r.cursor.day, r.n_rows) for r in s.runs().collect())
    assert runs == [(1, 2, 3), (2, 2, 0), (3, 3, 3), (4, 3, 0)]


def test_ties_are_remembered_over_several_runs(spark, tmp):
    assert _load(spark, tmp, [(1, 1, "a")])[0] == 1
    assert _load(spark, tmp, [(1, 1, "a"), (2, 1, "b")])[0] == 1
    assert _load(spark, tmp, [(1, 1, "a"), (2, 1, "b")])[0] == 0


def test_a_run_that_dies_before_its_state_repeats_safely(spark, tmp, monkeypatch):
    rows = [(1, 1, "a"), (2, 2, "b")]

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(LoadState, "finish", dies)
        with pytest.raises(KeyboardInterrupt):
            _load(spark, tmp, rows)
    assert _table(spark, tmp) == [(1, "a"), (2, "b")]
    n, s = _load(spark, tmp, rows)
    assert n == 2 and _table(spark, tmp) == [(1, "a"), (2, "b")]
    assert s.runs().count() == 1


def test_a_run_that_dies_while_merging_repeats_safely(spark, tmp, monkeypatch):
    _load(spark, tmp, [(1, 1, "a")])

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(state, "write_merged_partitions", dies)
        with pytest.raises(KeyboardInterrupt):
            _load(spark, tmp, [(1, 1, "a"), (2, 2, "b")])
    assert _table(spark, tmp) == [(1, "a")]
    assert _load(spark, tmp, [(1, 1, "a"), (2, 2, "b")])[0] == 1
    assert _table(spark, tmp) == [(1, "a"), (2, "b")]


def test_resources_share_a_state_table(spark, tmp):
    assert _load(spark, tmp, [(1, 5, "a")], "one")[0] == 1
    assert _load(spark, tmp, [(1, 2, "a"), (2, None, "never")], "two")[0] == 1
    assert _table(spark, tmp, "two") == [(1, "a")]
    n, s = _load(spark, tmp, [], "two")
    assert n == 0 and s.last("one")["run"] == 1 and s.last("two")["run"] == 2
    assert s.last("two")["cursor"] == dt.datetime(2024, 1, 2)
