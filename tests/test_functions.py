import json

from pyspark.sql import functions as F

from tidepool.functions import (
    as_json_list,
    check_digit,
    classify_keywords,
    human_size,
    json_string_list,
    polymorphic_code,
    polymorphic_text,
    soft_bigint,
    soft_double,
    sql_bool,
    sql_value,
    text_array,
    with_check_digit,
)
from tidepool.operators.survey import SURVEY_TIERS


def py_check_digit(code: str) -> str:
    total = sum(int(d) * w for d, w in zip(code, (6, 5, 4, 3, 2)))
    rem = total % 11
    return str(1 if rem == 0 else 0 if rem == 1 else 11 - rem)


def py_size(n: int) -> str:
    if n < 1024:
        return f"{n} B"
    if n < 1024 * 1024:
        return f"{n / 1024:.1f} KB"
    if n < 1024 ** 3:
        return f"{n / (1024 * 1024):.1f} MB"
    return f"{n / (1024 ** 3):.1f} GB"


def test_check_digit_matches_python_loop(spark):
    codes = [f"{i:05d}" for i in range(0, 99999, 97)] + ["01100", "13101", "47382"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    rows = df.select("code", check_digit("code").alias("d"), with_check_digit("code").alias("full")).collect()
    for r in rows:
        assert r.d == py_check_digit(r.code)
        assert r.full == r.code + r.d
    # the remainder branches 0, 1 and other are all exercised
    assert {py_check_digit(c) for c in codes} >= {"0", "1", "5"}


def test_soft_casts(spark):
    cases = {"12.7": 13, "12.5": 13, "13.5": 14, "-12.5": -13, "1e3": 1000, "1,234": None, "": None,
             "n/a": None, "42": 42, "12345678901234567890": None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = dict(df.select("x", soft_bigint("x").alias("v")).collect())
    assert got == cases
    dcases = {"1d": None, "2.5": 2.5, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "abc": None, "": None, "-3": -3.0}
    df = spark.createDataFrame([(k,) for k in dcases], "x string")
    assert dict(df.select("x", soft_double("x").alias("v")).collect()) == dcases


def test_human_size_matches_python_formatting(spark):
    sizes = [0, 1, 1023, 1024, 1280, 1331, 1536, 2304, 10 * 1024 + 512, 1048575, 1048576,
             5 * 1048576 + 262144, 1024 ** 3 - 1, 1024 ** 3, 3 * 1024 ** 3 + 1024 ** 3 // 4]
    sizes += list(range(1024, 1024 * 40, 53))
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    for s, txt in df.select("s", human_size("s")).collect():
        assert txt == py_size(s), s


def test_text_array_forms(spark):
    # expected values are what the lake engine's VARCHAR[] cast returns
    cases = {'["a","b"]': ["a", "b"], "[a, b]": ["a", "b"], "[]": [], '["x y", "c,d"]': ["x y", "c,d"],
             "[5, 7]": ["5", "7"], '[a, "b c", d]': ["a", "b c", "d"], "[a, 'b c']": ["a", "b c"],
             "[ a ,b ]": ["a", "b"], "[a,,b]": ["a", "", "b"], '["a,b", c]': ["a,b", "c"],
             "[NULL, a]": [None, "a"], "[null]": [None], "[[1,2],[3]]": ["[1,2]", "[3]"],
             '["a", "it\'s, b"]': ["a", "it's, b"], '["q\\"x", "y"]': ['q"x', "y"]}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "x string")
    got = {r.x: r.v for r in df.select("x", text_array("x").alias("v")).collect()}
    assert got.pop(None) is None
    assert got == cases


def test_sql_literals_and_json_lists(spark):
    df = spark.createDataFrame([("it's", True, ["a", 'q"uote', "ü"]), (None, None, None)],
                               "s string, b boolean, arr array<string>")
    r1, r2 = df.select(sql_value("s"), sql_bool("b"), json_string_list("arr")).collect()
    assert r1[0] == "'it''s'" and r1[1] == "1"
    assert r1[2] == json.dumps(["a", 'q"uote', "ü"], ensure_ascii=False)
    assert tuple(r2) == ("NULL", "0", None)


def test_keyword_classes_first_tier_wins(spark):
    rows = [("地域メッシュ 小地域",), ("町丁・字等別",), ("国勢調査",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(classify_keywords("t", SURVEY_TIERS)).collect()]
    assert got == ["mesh", "small_area", "unknown"]


def test_polymorphic_fields(spark):
    rows = [('"plain title"',), ('{"$": "inner", "@code": "00200521"}',), ('{"@code": "9"}',)]
    df = spark.createDataFrame(rows, "j string")
    got = df.select(polymorphic_text("j"), polymorphic_code("j"), F.size(as_json_list("j"))).collect()
    assert tuple(got[0]) == ("plain title", "", 1)
    assert tuple(got[1]) == ("inner", "00200521", 1)
    assert got[2][0] == '{"@code": "9"}' and got[2][1] == "9"
    lst = spark.createDataFrame([('[{"a":1},{"a":2}]',)], "j string")
    assert lst.select(F.size(as_json_list("j"))).first()[0] == 2


def test_soft_bigint_rounds_once(spark):
    values = ["0.49999999996", "-0.49999999996", "0.5", "-0.5", "1.45", " 2.55 ", "12.5", "1e3", "9" * 30, ".", "", "1.5x", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r.v for r in df.select(soft_bigint("x").alias("v")).collect()]
    assert got == [0, 0, 1, -1, 1, 3, 13, 1000, None, None, None, None, None]


def test_text_array_of_many_items(spark):
    names = [f"tag{k}" for k in range(20_000)]
    rows = [("[" + ",".join(f'"{n}"' for n in names) + "]",), ("[" + ", ".join(names) + "]",), ("['a, b', c]",)]
    got = [r.v for r in spark.createDataFrame(rows, "x string").select(text_array("x").alias("v")).collect()]
    assert got == [names, names, ["a, b", "c"]]


def test_contract_reports_missing_and_extra_columns(spark):
    from tidepool.operators.maintain import contract_violations

    df = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "k long, v string, extra string")
    rows = {r.column_name: r for r in contract_violations(df, [("k", "bigint", True), ("v", "string", True), ("gone", "string", True)]).collect()}
    assert (rows["k"].type_ok, rows["k"].violations) == (True, 0) and rows["v"].violations == 1
    assert (rows["gone"].type_ok, rows["gone"].violations, rows["gone"].null_count) == (False, 2, None)
    assert (rows["extra"].type_ok, rows["extra"].expected_type, rows["extra"].actual_type) == (False, None, "string")
