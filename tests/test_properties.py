"""Property tests: Spark expressions against DuckDB on generated inputs."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepool.functions import check_digit, soft_bigint, soft_double, text_array

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

numeric_text = st.one_of(
    st.integers(-10**12, 10**12).map(str),
    st.decimals(min_value=-10**9, max_value=10**9, places=3, allow_nan=False, allow_infinity=False).map(str),
    st.tuples(st.integers(-999, 999), st.integers(0, 6)).map(lambda t: f"{t[0]}e{t[1]}"),
    st.tuples(st.integers(0, 999), st.sampled_from(["5", "25", "75", "49", "51"])).map(lambda t: f"{t[0]}.{t[1]}"),
    st.sampled_from(["", "n/a", "1,234", "12d", "1f", "--1", ".", "abc", "2000㎡以上"]),
)


def _duck(values, expr):
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return dict(con.execute(f"SELECT i, {expr} FROM t").fetchall())


@SETTINGS
@given(st.lists(numeric_text, min_size=1, max_size=60))
def test_soft_casts_agree_with_duckdb(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    got_b = dict(df.select("i", soft_bigint("x")).collect())
    got_d = dict(df.select("i", soft_double("x")).collect())
    assert got_b == _duck(values, "TRY_CAST(x AS BIGINT)")
    want_d = _duck(values, "TRY_CAST(x AS DOUBLE)")
    assert got_d == want_d


element = st.text(alphabet=st.characters(whitelist_categories=("Ll", "Lu", "Nd"), whitelist_characters=" -_,"),
                  min_size=1, max_size=8).map(str.strip).filter(bool).filter(lambda e: e.upper() != "NULL")


def _bare(item: str) -> str:
    return f'"{item}"' if "," in item else item


@SETTINGS
@given(st.lists(st.tuples(st.lists(element, max_size=5), st.booleans()), min_size=1, max_size=40))
def test_text_arrays_agree_with_duckdb(spark, lists):
    import json

    texts = [json.dumps(items, ensure_ascii=False) if as_json else "[" + ", ".join(map(_bare, items)) + "]"
             for items, as_json in lists]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = {i: list(v) for i, v in df.select("i", text_array("x")).collect()}
    assert got == _duck(texts, "CAST(x AS VARCHAR[])")


@SETTINGS
@given(st.lists(st.integers(0, 99999), min_size=1, max_size=80))
def test_check_digit_agrees_with_sql_formula(spark, codes):
    texts = [f"{c:05d}" for c in codes]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = dict(df.select("i", check_digit("x")).collect())
    total = " + ".join(f"CAST(SUBSTR(x, {p}, 1) AS INTEGER) * {w}" for p, w in zip(range(1, 6), (6, 5, 4, 3, 2)))
    want = _duck(texts, f"CAST(CASE WHEN ({total}) % 11 = 0 THEN 1 WHEN ({total}) % 11 = 1 THEN 0 "
                        f"ELSE 11 - ({total}) % 11 END AS VARCHAR)")
    assert got == want
