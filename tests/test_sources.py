import csv
import io
import json
import zipfile

from tidepool.operators import datasets
from tidepool.sources.api_rows import read_batches, rows_frame
from tidepool.sources.csv import read_csv_named, read_zipped_csv
from tidepool.sources.listing import list_files
from tidepool.sources.topojson import read_topojson


def _population_csv(path, rows):
    header = ["全国地方公共団体コード", "地域コード", "地方公共団体名", "調査年月日", "地域名", "総人口", "男性", "女性"]
    header += [src for src, _ in datasets.population_columns()] + ["世帯数", "備考"]
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    for r in rows:
        w.writerow(r)
    path.write_bytes(buf.getvalue().encode("shift_jis"))
    return header


def test_population_csv_shift_jis_to_long(spark, tmp):
    ages = [str(i) for i in range(36)]
    full = ["082201", "0001", "つくば市", "2024-04-01", "吾妻", "100", "50", "50"] + ages + ["40", ""]
    gap = ["082201", "0002", "つくば市", "2024-04-01", "竹園", "90", "45", "45"] + ages[:5] + [""] + ages[6:] + ["30", "備考"]
    short = ["082201", "0003", "つくば市", "2024-04-01", "天久保", "9", "4", "5"] + ages[:10]
    _population_csv(tmp / "p.csv", [full, gap, short])
    raw = read_csv_named(spark, str(tmp / "p.csv"), datasets.population_csv_types(), encoding="shift_jis")
    long = datasets.population_long(raw)
    rows = long.collect()
    # one row per non-empty age cell (36 + 35 + 10)
    assert len(rows) == 81
    assert {r.lg_code for r in rows} == {"082201"}  # leading zero kept
    assert str(rows[0].reference_date) == "2024-04-01"
    got = {(r.area_code, r.sex, r.age_group): r.population for r in rows}
    assert got[("0001", "male", "0-4")] == 0 and got[("0001", "female", "85+")] == 35
    assert got[("0001", "male", "10-14")] == 4
    assert ("0002", "female", "10-14") not in got
    assert len({r.age_group for r in rows}) == 18
    assert dict(long.dtypes)["population"] == "bigint"


def test_zipped_postal_csv_with_check_digit(spark, tmp):
    lines = [
        ["01101", "060  ", "0600000", "ﾎｯｶｲﾄﾞｳ", "ｻｯﾎﾟﾛｼﾁｭｳｵｳｸ", "ｲｶﾆｹｲｻｲｶﾞﾅｲﾊﾞｱｲ", "北海道", "札幌市中央区", "以下に掲載がない場合", 0, 0, 0, 0, 0, 0],
        ["13101", "100  ", "1000001", "ﾄｳｷｮｳﾄ", "ﾁﾖﾀﾞｸ", "ﾁﾖﾀﾞ", "東京都", "千代田区", "千代田（一、二）", 0, 0, 1, 0, 0, 0],
        ["08220", "305  ", "3050031", "ｲﾊﾞﾗｷｹﾝ", "ﾂｸﾊﾞｼ", "ｱｽﾞﾏ", "茨城県", "つくば市", "吾妻", 0, 0, 1, 0, 0, 0],
    ]
    buf = io.StringIO()
    csv.writer(buf, quoting=csv.QUOTE_NONNUMERIC, lineterminator="\r\n").writerows(lines)
    with zipfile.ZipFile(tmp / "ken.zip", "w") as zf:
        zf.writestr("utf_ken_all.csv", buf.getvalue())
    raw = read_zipped_csv(spark, str(tmp / "ken.zip"), "utf_ken_all.csv", datasets.POSTAL_SCHEMA, partitions=2)
    out = {r.zipcode: r for r in datasets.postal_codes(raw).collect()}
    assert len(out) == 3
    assert out["1000001"].town == "千代田（一、二）"  # quoted comma stays in the field
    assert out["0600000"].lg_code == "011011"
    assert out["1000001"].lg_code == "131016"
    assert out["3050031"].lg_code == "082201"
    assert out["1000001"].has_chome == 1


def test_topojson_rings_reversed_arcs_and_transform(spark, tmp):
    topo = {
        "type": "Topology",
        "transform": {"scale": [0.5, 0.5], "translate": [10, 20]},
        "arcs": [[[0, 0], [2, 0], [0, 2]], [[2, 2], [-2, 0], [0, -2]], [[4, 4], [1, 0], [0, 1], [-1, -1]]],
        "objects": {"pref": {"type": "GeometryCollection", "geometries": [
            {"type": "Polygon", "arcs": [[0, 1]], "properties": {"prefecture_code": "08", "prefecture_name": "茨城県"}},
            {"type": "Polygon", "arcs": [[-2, -1]], "properties": {"prefecture_code": "09", "prefecture_name": "栃木県"}},
            {"type": "MultiPolygon", "arcs": [[[0, 1]], [[2]]], "properties": {"prefecture_code": "10", "prefecture_name": "群馬県"}},
        ]}},
    }
    (tmp / "b.topojson").write_text(json.dumps(topo, ensure_ascii=False))
    feats = read_topojson(spark, str(tmp / "b.topojson"))
    out = {r.prefecture_code: json.loads(r.geometry) for r in datasets.prefecture_boundaries(feats).collect()}
    square = [[10.0, 20.0], [11.0, 20.0], [11.0, 21.0], [10.0, 21.0], [10.0, 20.0]]
    assert out["08"] == {"type": "Polygon", "coordinates": [square]}
    assert out["09"]["coordinates"] == [[[10.0, 20.0], [10.0, 21.0], [11.0, 21.0], [11.0, 20.0], [10.0, 20.0]]]
    assert out["10"]["type"] == "MultiPolygon"
    assert out["10"]["coordinates"] == [[square], [[[12.0, 22.0], [12.5, 22.0], [12.5, 22.5], [12.0, 22.0]]]]


def test_listing_reads_metadata_only(spark, tmp):
    (tmp / "data" / "a").mkdir(parents=True)
    (tmp / "data" / "a" / "f1.parquet").write_bytes(b"x" * 10)
    (tmp / "data" / "f2.parquet").write_bytes(b"y" * 2048)
    rows = {r.path: r.size for r in list_files(spark, str(tmp / "data")).collect()}
    assert rows == {"a/f1.parquet": 10, "f2.parquet": 2048}


def test_api_batches_keep_text_codes(spark, tmp):
    part = tmp / "src" / "_area_code=01" / "_year=2024" / "_quarter=1"
    part.mkdir(parents=True)
    (part / "b.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in [
        {"Type": "宅地(土地)", "TradePrice": "12000000", "Area": "2000㎡以上"},
        {"Type": "中古マンション等", "TradePrice": "3.5", "Area": "65.5", "Extra": "x"},
    ]))
    raw = read_batches(spark, str(tmp / "src"))
    mart = datasets.trade_prices(raw).collect()
    assert {r.prefecture_code for r in mart} == {"01"}
    assert sorted((r.trade_price, r.area) for r in mart) == [(4, 65.5), (12000000, None)]
    assert all(r.year == 2024 and r.quarter == 1 for r in mart)
    small = rows_frame(spark, [{"Type": "x", "Unknown": 1}], tags={"_area_code": "13"})
    assert small.first()["Type"] == "x" and small.first()["_area_code"] == "13"


def test_statistics_views_push_prefix(spark):
    facts = spark.createDataFrame(
        [("A1101", '{"name":"総人口"}', "08000", '{"name":"茨城県"}', "2020", '{"name":"2020年"}', "人", 1.0),
         ("B1101", '{"name":"面積"}', "08000", None, "2020", '{}', "km2", 2.0)],
        "cat01 string, cat01_metadata string, area string, area_metadata string, time string, "
        "time_metadata string, unit string, value double")
    views = datasets.statistics_views(facts, ["A", "B", "K"])
    a = views["A"].collect()
    assert [(r.cat01, r.item_name, r.area_name, r.time_name) for r in a] == [("A1101", "総人口", "茨城県", "2020年")]
    b = views["B"].collect()
    assert b[0].area_name is None and b[0].time_name is None
    assert views["K"].count() == 0


def test_positional_csv_and_population_periods(spark, tmp):
    from tidepool.sources.csv import read_csv_positional

    (tmp / "z.csv").write_text('"01101","060","0600000"\n"13101","100","1000001","extra"\n"47382"\n', encoding="utf-8")
    rows = read_csv_positional(spark, str(tmp / "z.csv"), "lg_code string, old string, zipcode string").collect()
    assert [tuple(r) for r in rows] == [("01101", "060", "0600000"), ("13101", "100", "1000001"), ("47382", None, None)]

    ages = [str(i) for i in range(36)]
    for n, date in enumerate(["2024-04-01", "2024-10-01"]):
        _population_csv(tmp / f"p{n}.csv", [["082201", "0001", "つくば市", date, "吾妻", "1", "1", "0"] + ages + ["1", ""]])
    periods = [read_csv_named(spark, str(tmp / f"p{n}.csv"), datasets.population_csv_types(), encoding="shift_jis")
               for n in range(2)]
    long = datasets.population_all_periods(periods)
    assert long.count() == 72
    assert sorted(str(r.reference_date) for r in long.select("reference_date").distinct().collect()) == [
        "2024-04-01", "2024-10-01"]
    one_scan = datasets.population_long(read_csv_named(
        spark, [str(tmp / "p0.csv"), str(tmp / "p1.csv")], datasets.population_csv_types(), encoding="shift_jis"))
    assert sorted(map(tuple, one_scan.collect())) == sorted(map(tuple, long.collect()))


def test_topojson_without_transform_uses_absolute_points(spark, tmp):
    topo = {
        "type": "Topology",
        "arcs": [[[1.5, 2.0], [3.0, 2.0], [3.0, 4.0]], [[3.0, 4.0], [1.5, 4.0], [1.5, 2.0]]],
        "objects": {"m": {"type": "GeometryCollection", "geometries": [
            {"type": "Polygon", "arcs": [[0, 1]],
             "properties": {"lg_code": "082201", "prefecture_code": "08", "prefecture_name": "茨城県",
                            "county_name": None, "city_name": "つくば市"}},
            {"type": "Polygon", "arcs": [], "properties": {"lg_code": "000000"}}]}},
    }
    (tmp / "m.topojson").write_text(json.dumps(topo, ensure_ascii=False))
    rows = {r.lg_code: r for r in datasets.municipality_boundaries(read_topojson(spark, str(tmp / "m.topojson"))).collect()}
    assert rows["000000"].geometry is None  # a feature without arcs keeps a NULL geometry
    row = rows["082201"]
    assert (row.lg_code, row.city_name, row.county_name) == ("082201", "つくば市", None)
    assert json.loads(row.geometry)["coordinates"] == [[[1.5, 2.0], [3.0, 2.0], [3.0, 4.0], [1.5, 4.0], [1.5, 2.0]]]


def test_topojson_keeps_every_geometry_type(spark, tmp):
    topo = {
        "type": "Topology", "transform": {"scale": [2, 2], "translate": [1, 1]},
        "arcs": [[[0, 0], [1, 0]], [[1, 0], [0, 1]]],
        "objects": {
            "mixed": {"type": "GeometryCollection", "geometries": [
                {"type": "Point", "coordinates": [1, 2]},
                {"type": "MultiPoint", "coordinates": [[0, 0], [1, 1]]},
                {"type": "LineString", "arcs": [0, 1]},
                {"type": "MultiLineString", "arcs": [[0], [-2]]},
                {"type": None}]},
            "bare": {"type": "LineString", "arcs": [-1], "properties": {"k": "v"}},
            "empty": {"type": "GeometryCollection", "geometries": []},
        },
    }
    (tmp / "g.topojson").write_text(json.dumps(topo))
    rows = read_topojson(spark, str(tmp / "g.topojson")).orderBy("object", "feature_index").collect()
    got = [(r.object, r.type, r.geometry and json.loads(r.geometry)["coordinates"]) for r in rows]
    assert got == [
        ("bare", "LineString", [[3, 1], [1, 1]]),
        ("mixed", "Point", [3, 5]),
        ("mixed", "MultiPoint", [[1, 1], [3, 3]]),
        ("mixed", "LineString", [[1, 1], [3, 1], [3, 3]]),
        ("mixed", "MultiLineString", [[[1, 1], [3, 1]], [[3, 3], [3, 1]]]),
        ("mixed", None, None),
    ]
    assert rows[0].properties == {"k": "v"}


def test_csv_files_with_different_headers(spark, tmp):
    (tmp / "a.csv").write_text("code,name,v\n001,alpha,1\n")
    (tmp / "b.csv").write_text("name,code,v\nbeta,002,2\n")
    (tmp / "c.csv").write_text("code,v\n003,3\n")
    (tmp / "d.csv").write_text('code,name,v\n004,"de,lta",4\n')
    rows = read_csv_named(spark, [str(tmp / f"{x}.csv") for x in "abcd"], {"v": "bigint"}).select("code", "name", "v").collect()
    assert sorted(map(tuple, rows)) == [("001", "alpha", 1), ("002", "beta", 2), ("003", None, 3), ("004", "de,lta", 4)]


def test_documents_under_paths_with_blanks(spark, tmp):
    folder = tmp / "folder one+%"
    folder.mkdir()
    (folder / "metadata.json").write_text(json.dumps({"title": "T"}))
    from tidepool.sources.documents import read_metadata_documents

    got = read_metadata_documents(spark, {"beta": str(folder / "metadata.json")})
    assert [(r.datasource, r.title) for r in got.collect()] == [("beta", "T")]
    assert [r.datasource for r in read_metadata_documents(spark, [str(folder / "metadata.json")]).collect()] == ["folder one+%"]
