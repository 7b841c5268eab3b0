import json
import os
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fareflow import schemas, sinks
from fareflow.context import RunContext, clean_up, discard, materialize, scope, work_dir
from fareflow.operators import joins, lifecycle
from fareflow.sources import documents, files, quarantine

DATA = "/root/testdata/sf0.001"


def docs(spark, *objects):
    texts = [(o if isinstance(o, str) else json.dumps(o),) for o in objects]
    return spark.createDataFrame(texts, "doc string")


def test_low_price_documents(spark, rows):
    d = docs(
        spark,
        {"_id": "XX1_AAA_BBB_03-05", "dairport": "AAA", "aairport": "BBB", "2019-02-20": "560", "2019-02-21": "oops"},
        {"_id": "XX2_AAA_BBB_03-05", "dairport": "AAA", "aairport": "BBB"},
        '{"broken',
    )
    assert rows(documents.low_prices(d)) == [
        (date(2019, 2, 20), 560, "XX1_AAA_BBB_03-05", "AAA", "BBB"),
        (date(2019, 2, 21), None, "XX1_AAA_BBB_03-05", "AAA", "BBB"),
    ]
    assert rows(documents.latest_price(d), "queryDate", "price") == [(date(2019, 2, 20), 560)]


def test_list_fare_documents(spark, rows):
    d = docs(
        spark,
        {"_id": "a", "date": "2019-03-05", "ut": 1, "src": "s", "XX": {"Y": {"price": "1200"}}, "YY": {"F": {"price": "9"}}, "ZZ": 5},
        {"_id": "b", "date": "2019-01-01", "XX": {"Y": {"price": "1"}}},
    )
    assert rows(documents.list_fares(d, since=date(2019, 3, 1))) == [("a", "XX", 1200)]


def test_seat_documents(spark, rows):
    d = docs(spark, {"_id": "a", "fc": {"2019-02-20 10:30": "85%", "2019-02-20 11:30": ""}}, {"_id": "b"})
    assert rows(documents.seat_snapshots(d)) == [
        (datetime(2019, 2, 20, 10, 30), "85%", "a"),
        (datetime(2019, 2, 20, 11, 30), "", "a"),
    ]


def test_international_and_dated_documents(spark, rows):
    d = docs(
        spark,
        {"_id": "AAA_BBB_OW_Y_D_03-05", "fn": "x", "from": "y", "2019-02-20": 3100},
        {"_id": "AAA_BBB", "2019-02-20": 1},
    )
    assert rows(documents.international_prices(d)) == [("AAA_BBB_OW_Y_D_03-05", date(2019, 2, 20), 3100)]
    keys = docs(spark, {"_id": "k", "2019-02-20": 1, "2019-02-20x": 2, "x2019-02-20": 3, "03-05": 4, "note": 5})
    assert rows(documents.dated_prices(keys), "price") == [("1",), ("2",)]
    assert rows(documents.dated_prices(keys, month_day=True), "price") == [("1",), ("2",), ("4",)]


def test_flat_documents(spark, rows):
    d = docs(spark, {"_id": "AAA", "latitude": "30.5", "longitude": 104}, {"_id": "BBB", "latitude": "x", "longitude": "1"}, "{")
    assert rows(documents.airports(d)) == [("AAA", 30.5, 104.0)]
    info = docs(
        spark,
        {"_id": "i", "date": "2019-03-05", "origindeparttime": "08:15", "originarrivetime": "10:40", "isshare": True},
        {"_id": "j", "date": "2019-03-05", "origindeparttime": "08:15", "isshare": False},
    )
    assert rows(documents.flight_info(info, since=date(2019, 3, 1))) == [("i", "08:15", "10:40", "True")]
    assert documents.stations(docs(spark, {"_id": "S1", "latitude": "1.5"})).first()["latitude"] == 1.5


def test_train_documents(spark, rows):
    stop = lambda n: {"arriveTime": "08:00", "stationCode": n, "departTime": "08:05", "stationName": n}
    d = docs(spark, {"_id": "T1", "array": [stop("S1"), stop("S2")]}, {"_id": "T2", "array": []})
    assert rows(documents.train_stops(d), "tn", "stationCode", "orderNum") == [("T1", "S1", 1), ("T1", "S2", 2)]
    assert documents.train_stops(d).columns == [f.name for f in schemas.TRAIN_STOP.fields]
    t = docs(spark, {"_id": "t", "ut": 1, "2019-02-20 10:00": "1"})
    assert rows(documents.ticket_history(t)) == [("2019-02-20 10:00", "1", "t")]


def test_departing(spark, rows):
    days = documents.month_day_window(date(2019, 3, 1), -1, 30, without_today=True)
    df = spark.createDataFrame([("a_02-28",), ("b_03-01",), ("c_03-31",), ("d_04-01",)], "id string")
    assert rows(documents.departing(df, "id", days)) == [("a_02-28",), ("c_03-31",)]


def test_csv_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([(date(2019, 2, 20), 560, "a", "AAA", "BBB")], schemas.LOW_PRICE)
    for header in (True, False):
        sinks.write_csv(df, str(tmp_path / f"c{header}"), header=header, files=1)
        assert rows(files.read_csv(spark, str(tmp_path / f"c{header}"), schemas.LOW_PRICE, header)) == rows(df)
    text = files.read_csv(spark, str(tmp_path / "cTrue"), files.text_schema(df.columns))
    assert text.dtypes[1] == ("price", "string")
    assert rows(files.typed(text, schemas.LOW_PRICE)) == rows(df)


def test_dated_write_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "dated")
    sinks.write_dated(spark.range(3), path, date(2019, 3, 1))
    sinks.write_dated(spark.range(5), path, date(2019, 3, 2))
    sinks.write_dated(spark.range(4), path, date(2019, 3, 2))
    counts = {r["run_date"]: r["count"] for r in spark.read.parquet(path).groupBy("run_date").count().collect()}
    assert counts == {date(2019, 3, 1): 3, date(2019, 3, 2): 4}


def test_generic_format_and_file_count(spark, tmp_path):
    sinks.write_format(spark.range(3), "json", {"path": str(tmp_path / "j")})
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    sinks.write_parquet(spark.range(100), str(tmp_path / "p"), files=3)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 3
    sinks.write_json(spark.range(2), str(tmp_path / "k"))
    sinks.write_by_day(spark.range(4).withColumn("d", F.lit(date(2019, 3, 1))), str(tmp_path / "d"), "d")
    assert (tmp_path / "d" / "d=2019-03-01").is_dir()


def test_work_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark).startswith(root) and work_dir(spark) != work_dir(spark)
    assert RunContext.of("2019-03-01").yesterday == date(2019, 2, 28)


def test_only_a_local_session_works_in_a_warehouse_on_its_own_disk():
    def session(master, warehouse="file:/w"):
        conf = SimpleNamespace(get=lambda name, default=None: warehouse if name == "spark.sql.warehouse.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app-1"))

    assert work_dir(session("local[2]")).startswith("file:/w/_work/fareflow-app-1/fareflow-")
    assert work_dir(session("yarn", "hdfs://store/w")).startswith("hdfs://store/w/_work/")
    for own in ("file:/w", "/w"):
        with pytest.raises(RuntimeError):
            work_dir(session("yarn", own))


@pytest.mark.parametrize("names", [schemas.FEATURE_COLUMNS, schemas.MODEL_COLUMNS])
def test_column_lists(names):
    assert len(names) == len(set(names)) and len(schemas.MODEL_COLUMNS) == 45


def test_whole_numbers_may_be_written_with_a_point(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("price,QUERYDATE,extra,id,dst,org\n560.0,2019-02-20,x,XX1,BBB,AAA\n,2019-02-20,x,XX2,BBB,AAA\ncheap,2019-02-20,x,XX3,BBB,AAA\n")
    found = files.read_csv(spark, str(tmp_path / "a.csv"), schemas.LOW_PRICE)
    assert found.schema.names == schemas.LOW_PRICE.names
    assert rows(found, "id", "price", "queryDate", "org") == [
        ("XX1", 560, date(2019, 2, 20), "AAA"), ("XX2", None, date(2019, 2, 20), "AAA"), ("XX3", None, date(2019, 2, 20), "AAA")
    ]
    (tmp_path / "b.csv").write_text("price,queryDate\n1,2019-02-20\n")
    with pytest.raises(ValueError, match="org"):
        files.read_csv(spark, str(tmp_path / "b.csv"), schemas.LOW_PRICE)
    docs = spark.createDataFrame([('{"_id": "i", "dairport": "A", "aairport": "B", "2019-02-20": "560.0", "2019-02-21": 570.0}',)], "doc string")
    assert rows(documents.low_prices(docs), "price") == [(560,), (570,)]


def test_stored_append_from_the_first_day_on(spark, rows, tmp_path):
    schema, path = "id long, v int, day date", str(tmp_path / "h")
    first = spark.createDataFrame([(1, 1, date(2019, 1, 1)), (2, 2, None), (3, 3, None)], schema)
    lifecycle.append_stored(path, first, ["id"])
    delta = spark.createDataFrame([(4, 4, None), (3, 33, None), (1, 11, date(2019, 2, 2))], schema)
    for _ in range(2):  # a rerun changes nothing; key 1 comes back on another day
        table = lifecycle.append_stored(path, delta, ["id"])
        assert rows(table.read()) == [(1, 11, date(2019, 2, 2)), (2, 2, None), (3, 33, None), (4, 4, None)]


def test_clean_up_removes_the_intermediate_tables(spark):
    made = materialize(spark.range(3), "short-lived")
    assert made.count() == 3
    clean_up(spark)
    with pytest.raises(Exception):
        made.count()


def test_a_step_starts_without_the_tables_of_the_one_before(spark):
    outside = materialize(spark.range(2), "outside")
    with scope(spark, "steps"):
        first = materialize(spark.range(3), "first")
        assert "/steps/" in first.inputFiles()[0]
    with scope(spark, "steps"):
        second, third = materialize(spark.range(4), "second"), materialize(spark.range(5), "third")
        with pytest.raises(Exception):
            first.count()
        discard(second)
        with pytest.raises(Exception):
            second.count()
    assert third.count() == 5 and outside.count() == 2
    elsewhere = spark.read.parquet(f"{DATA}/nation.parquet") if os.path.isdir(DATA) else None
    if elsewhere is not None:
        discard(elsewhere)  # no table of this application's
        assert elsewhere.count() == 25


def test_broadcast_follows_measured_bytes(spark):
    narrow, wide = spark.range(1000).selectExpr("id", "'x' AS t"), spark.range(1000).selectExpr("id", "repeat('x', 5000) AS t")
    assert joins.table_bytes(narrow) < 50_000 < 5_000_000 <= joins.table_bytes(wide)


def test_bad_records_are_kept_aside(spark, rows, tmp_path):
    lines = ["id,n,day", "a,1,2019-01-01", "b,x,2019-13-01", "c,,2019-01-02", "d,4", 'e,5,2019-01-03,"more"', '"f, g",6.0,', ",7,2019-01-04", "h, ,2019-01-05"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    fields = schemas.schema(id="string", n="int", day="date")
    found = quarantine.read_csv(spark, str(tmp_path / "in.csv"), fields, required=["id"], header=True)
    assert found.good.schema.names == ["id", "n", "day"]
    assert rows(found.good, "id", "n") == [("a", 1), ("c", None), ("f, g", 6), ("h", None)]
    bad = {r.record: r.reasons for r in found.bad.collect()}
    assert bad == {"b,x,2019-13-01": ["n: not int", "day: not date"], "d,4": ["malformed"], 'e,5,2019-01-03,"more"': ["malformed"], ",7,2019-01-04": ["id: missing"]}
    assert found.counts == {"records": 8, "bad": 4, "malformed": 2, "id": 1, "n": 1, "day": 1}


def test_bad_documents_are_kept_aside(spark, rows):
    texts = ['{"id": "a", "n": 1, "more": 2}', '{"id": "b", "n": "x"}', "{broken", "[1]", "", None, '{"n": 3.0}', '{"id": "c", "n": "4"}']
    docs = spark.createDataFrame([(t,) for t in texts], "doc string")
    found = quarantine.read_documents(docs, schemas.schema(id="string", n="int"), required=["id"])
    assert rows(found.good) == [("a", 1), ("c", 4)]
    reasons = sorted((r.record, r.reasons) for r in found.bad.collect())
    assert ('{"id": "b", "n": "x"}', ["n: not int"]) in reasons and ('{"n": 3.0}', ["id: missing"]) in reasons
    assert [r for _, r in reasons].count(["malformed"]) == found.counts["malformed"] >= 3 and found.counts["records"] == 8
    assert found.good.count() + found.bad.count() == 8
    empty = quarantine.read_documents(docs.filter("false"), schemas.schema(id="string"))
    assert empty.good.count() == 0 and empty.counts["records"] == 0
