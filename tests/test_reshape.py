from pyspark.sql import functions as F

from tidepool.operators import datasets, reshape, statistics, survey


def test_unpivot_drops_nulls_and_label_case_uses_like(spark):
    df = spark.createDataFrame([(1, 10, None, 3), (2, None, None, None)], "id int, male_0_4 int, female_0_4 int, male_10_14 int")
    long = reshape.unpivot_drop_nulls(df, ["id"], ["male_0_4", "female_0_4", "male_10_14"], "age_sex", "n")
    rows = long.select(
        "id", "n",
        reshape.label_case("age_sex", [("male_%", "male")], "female").alias("sex"),
        reshape.label_case("age_sex", datasets.age_group_rules()).alias("age"),
    ).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 3, "male", "10-14"), (1, 10, "male", "0-4")]


def test_rename_cast_spec_missing_columns_become_null(spark):
    df = spark.createDataFrame([("12.5", "x")], "TradePrice string, Type string")
    out = reshape.rename_cast(df, [("Type", "property_type", None), ("TradePrice", "trade_price", "bigint"),
                                   ("Area", "area", "double")]).first()
    assert (out.property_type, out.trade_price, out.area) == ("x", 13, None)


def test_periods_one_scan_equals_union_of_slices(spark):
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2022), (4, 2021)], "id int, y int")
    one_scan = reshape.tag_periods(df, F.col("y"), [2021, 2022])
    unioned = reshape.read_periods({2021: df.where("y = 2021"), 2022: df.where("y = 2022")})
    assert sorted(map(tuple, one_scan.collect())) == sorted(map(tuple, unioned.collect()))


def test_item_catalogue_labels_from_json(spark):
    facts = spark.createDataFrame(
        [("A1101", '{"name": "総人口"}'), ("A1101", '{"name": "総人口"}'), ("B2101", '{"name": "面積"}')],
        "cat01 string, cat01_metadata string")
    rows = statistics.item_catalogue(facts, "cat01", "cat01_metadata", label_path="$.name").collect()
    assert [tuple(r) for r in rows] == [("A", "A1101", "総人口"), ("B", "B2101", "面積")]


def test_survey_summary_ties_and_last_dates(spark):
    rows = [("s1", 1, "c1", "2020", "t1"), ("s1", 2, "c2", "2022", "t2"), ("s1", 3, "c3", "2022", "t3"),
            ("s2", 4, "c4", "2019", "t4")]
    df = spark.createDataFrame(rows, "survey string, pos int, code string, d string, item string")
    got = {r.survey: r for r in survey.survey_summary(df, "survey", "pos", "code", "d", "item", last_n=5).collect()}
    assert got["s1"].n_items == 3 and got["s1"].first_code == "c1"
    assert got["s1"].latest_item == "t2"  # tie on the latest date: first by position wins
    assert got["s1"].last_dates == "2020,2022" and got["s1"].n_dates == 2


def test_articles_job_types_and_search_text(spark):
    raw = spark.createDataFrame(
        [("a", "Title", "Desc", "2024-05-01", '["population"]', "[x, y]"),
         ("b", None, "D2", "2024-06-01", "[]", '["z"]')],
        "slug string, title string, description string, date string, datasources string, tags string")
    rows = datasets.articles(raw).collect()
    assert [r.slug for r in rows] == ["b", "a"]  # newest first
    assert rows[1].search_text == "Title Desc x y" and rows[0].search_text == "D2 z"
    assert rows[1].datasources == ["population"] and rows[0].datasources == []


def test_statistics_views_register_one_lazy_view_per_prefix(spark):
    facts = spark.createDataFrame(
        [(f"{p}1101", '{"name": "x"}', "08000", '{"name": "a"}', "2020", '{"name": "t"}', "u", 1.0)
         for p in datasets.CATEGORY_PREFIXES],
        "cat01 string, cat01_metadata string, area string, area_metadata string, time string, "
        "time_metadata string, unit string, value double")
    views = {f"pref_{p.lower()}": v for p, v in datasets.statistics_views(facts).items()}
    datasets.views_by_name(views)
    assert len(views) == 11
    assert all(spark.table(name).count() == 1 for name in views)
    assert spark.table("pref_k").first().cat01 == "K1101"


def test_simplify_listing_entries(spark):
    import json

    entries = [
        {"@id": "0003445078", "TITLE": {"$": "人口等基本集計", "@no": "1"},
         "STAT_NAME": {"$": "国勢調査", "@code": "00200521"}, "STATISTICS_NAME": "小地域集計",
         "SURVEY_DATE": 202010, "SMALL_AREA": 1, "COLLECT_AREA": "該当なし"},
        {"@id": "0004000001", "TITLE": "メッシュ統計", "STAT_NAME": "経済センサス"},
    ]
    df = spark.createDataFrame([(i, json.dumps(e, ensure_ascii=False)) for i, e in enumerate(entries)],
                               "pos int, entry string")
    rows = {r.id: r for r in survey.simplify_tables(df, "entry").collect()}
    a, b = rows["0003445078"], rows["0004000001"]
    assert (a.stat_name, a.stat_code, a.title, a.survey_date, a.small_area) == (
        "国勢調査", "00200521", "人口等基本集計", "202010", "1")
    assert (b.stat_name, b.stat_code, b.title, b.survey_date, b.collect_area) == ("経済センサス", "", "メッシュ統計", "", "")
    classed = survey.classify(survey.simplify_tables(df, "entry"), ["title", "stat_name", "statistics_name"])
    assert {r.id: r.category for r in classed.collect()} == {"0003445078": "small_area", "0004000001": "mesh"}
