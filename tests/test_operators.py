import hashlib
import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareflow import schemas
from fareflow.operators import calendar, encoding, enrich, features, forecast, labels, lifecycle, metrics, ml, ranges, windows
from fareflow.operators.hot import DEFAULT, HotPolicy

RUN = date(2019, 3, 1)


def prices(spark, sizes, value=lambda i: 100.0):
    data = [(k, i, value(i)) for k, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "k string, day int, price double")


# --- labels -------------------------------------------------------------------


def test_group_of_14_is_dropped_and_15_kept(spark):
    found = labels.trend(prices(spark, {"a": 14, "b": 15}), ["k"], ["day"])
    assert {r["k"]: r["count"] for r in found.groupBy("k").count().collect()} == {"b": 13}  # last two rows gone


def test_trend_compares_with_the_next_price(spark):
    """Row 0: next price 200, lowest from two ahead 192 = exactly 0.96 of it."""
    given = [100.0, 200.0] + [192.0] * 13
    found = labels.trend(prices(spark, {"a": 15}, lambda i: given[i]), ["k"], ["day"])
    trends = {r["day"]: r["trend"] for r in found.collect()}
    assert trends[0] == 1 and trends[1] == 0


def test_zero_price(spark):
    found = labels.trend(prices(spark, {"a": 15}, lambda i: 0.0), ["k"], ["day"])
    assert {r["trend"] for r in found.collect()} == {None}
    assert {r["trend"] for r in labels.trend_own_price(prices(spark, {"a": 15}, lambda i: 0.0), ["k"], ["day"]).collect()} == {None}


def test_three_classes(spark):
    given = [100.0, 89.0, 90.0] + [100.0] * 12
    found = labels.trend3(prices(spark, {"a": 15}, lambda i: given[i]), ["k"], ["day"])
    trends = {r["day"]: r["trend"] for r in found.collect()}
    assert (trends[0], trends[1], trends[2]) == (2, 0, 1) and len(trends) == 14


def test_empty_history(spark):
    assert labels.trend(prices(spark, {}), ["k"], ["day"]).count() == 0


# --- calendar -----------------------------------------------------------------


def holidays(spark):
    days = [(f"201910{d:02d}", "x", "autumn", "yes", 10, d) for d in range(1, 11)]
    days += [(f"202010{d:02d}", "x", "autumn", "yes", 3, d) for d in range(1, 4)]
    days += [("20191101", "y", "lights", None, None, None), ("bad", "z", "none", "yes", 1, 1)]
    return spark.createDataFrame(days, schemas.HOLIDAYS)


def test_calendar_marks_both_sides_of_every_run(spark):
    built = {r["date"]: r["day_of_vacation_extend"] for r in calendar.build(holidays(spark)).collect()}
    assert built[date(2019, 9, 30)] == -1 and built[date(2019, 10, 10)] == 10
    assert built[date(2019, 10, 11)] == 1001  # day 10 follows day 9, although '9' > '10' as text
    assert built[date(2020, 9, 30)] == -1 and built[date(2020, 10, 4)] == 1001
    assert built[date(2019, 11, 2)] == 1001 and None not in built


def test_calendar_columns(spark):
    df = spark.createDataFrame([(date(2019, 10, 1),), (date(2019, 11, 1),), (date(2019, 6, 1),)], "d date")
    got = {r["d"].month: r for r in calendar.attach(df, calendar.build(holidays(spark)), {"d": "depart"}).collect()}
    assert (got[10]["depart_isFestival"], got[10]["depart_isVacation"], got[10]["depart_vacationDays"]) == (1, 1, 10)
    assert (got[11]["depart_isFestival"], got[11]["depart_isVacation"], got[11]["depart_dayofvacation"]) == (1, 0, -999)
    assert (got[6]["depart_festival"], got[6]["depart_dayofvacation_extend"]) == ("-999", -999)


# --- enrichment ------------------------------------------------------------------


def test_nearest_future(spark, rows):
    df = spark.createDataFrame(
        [("a", date(2019, 2, 28), 1), ("a", RUN, 2), ("a", date(2019, 3, 9), 3), ("b", date(2019, 4, 2), 4)],
        "k string, d date, v int",
    )
    assert rows(enrich.nearest_future(df, ["k"], "d", RUN)) == [("a", RUN, 2), ("b", date(2019, 4, 2), 4)]
    assert rows(enrich.nearest_future(df, ["k"], "d", RUN, max_days=31)) == [("a", RUN, 2)]


def test_last_snapshot_of_the_day(spark, rows):
    at = lambda h, m, s=0: datetime(2019, 2, 20, h, m, s)
    df = spark.createDataFrame([("a", at(9, 0), 1), ("a", at(10, 30), 2), ("a", at(10, 30, 5), 3)], "k string, ts timestamp, v int")
    assert rows(enrich.last_of_day(df, ["k"], "ts"), "v") == [(3,)]
    assert rows(enrich.last_of_day_all(df, ["k"], "ts"), "v") == [(2,), (3,)]


def dimensions(spark):
    airports = spark.createDataFrame([("AAA", 30.67, 104.071), ("BBB", 28.765, 104.622), ("CCC", None, 1.0)], schemas.AIRPORT)
    fares = spark.createDataFrame(
        [("AAA_BBB_2019-02-01_fd", "XX", 900), ("AAA_BBB_2019-03-02_fd", "XX", 1200), ("BBB_AAA_2019-03-02_fd", "XX", 0)],
        schemas.LIST_FARE,
    )
    seats = spark.createDataFrame(
        [(datetime(2019, 2, 20, 9, 0), "85%", "XX1_AAA_BBB_03-05"), (datetime(2019, 2, 20, 10, 0), "80%", "XX1_AAA_BBB_03-05"),
         (datetime(2019, 2, 21, 10, 0), "%", "XX1_AAA_BBB_03-05")],
        schemas.SEAT_LEFT,
    )
    info = spark.createDataFrame(
        [("AAA_BBB_XX1_2019-03-05", "08:15", "10:40", "False"), ("BBB_AAA_XX1_2019-03-04", "09:15", "11:40", None),
         ("BBB_AAA_XX1_2019-03-05", "08:15", "10:40", "True")],
        schemas.FLIGHT_INFO,
    )
    return airports, enrich.list_fares(fares, RUN), enrich.seat_loads(seats), enrich.flight_info(info, RUN)


def test_itinerary(spark):
    rows = [
        ("XX1", "XX", "AAA", "BBB", date(2019, 3, 5), date(2019, 2, 20), 560),
        ("XX1", "XX", "AAA", "BBB", date(2019, 3, 5), date(2019, 2, 21), 600),
        ("XX1", "XX", "BBB", "AAA", date(2019, 3, 5), date(2019, 2, 21), 600),  # list fare 0
        ("XX1", "XX", "AAA", "CCC", date(2019, 3, 5), date(2019, 2, 21), 600),  # airport without a place
        ("YY1", "YY", "AAA", "BBB", date(2019, 3, 5), date(2019, 2, 21), 600),  # no list fare
    ]
    df = spark.createDataFrame(rows, "fn string, fc string, org string, dst string, departDate date, queryDate date, price int")
    got = {(r["org"], r["queryDate"].day): r for r in enrich.itinerary(df, *dimensions(spark)).collect()}
    assert set(got) == {("AAA", 20), ("AAA", 21), ("BBB", 21)}
    assert (got["AAA", 20]["distance"], got["AAA", 20]["discount"], got["AAA", 20]["seatLeft"]) == (219, 0.47, 80.0)
    assert got["AAA", 21]["seatLeft"] is None and got["BBB", 21]["discount"] is None
    assert (got["BBB", 21]["isShare"], got["BBB", 21]["departTime"]) == (1, "08:15")  # the earlier one has no flag


def test_incomplete_records_do_not_hide_complete_ones(spark, rows):
    fares = spark.createDataFrame(
        [("AAA_BBB_2019-03-02_fd", "XX", None), ("AAA_BBB_2019-03-05_fd", "XX", 1200)], schemas.LIST_FARE
    )
    assert rows(enrich.list_fares(fares, RUN)) == [("XX", "AAA", "BBB", 1200)]
    seats = spark.createDataFrame(
        [(datetime(2019, 2, 20, 9, 0), "85%", "XX1_AAA_BBB_03-05"), (datetime(2019, 2, 20, 10, 0), None, "XX1_AAA_BBB_03-05")],
        schemas.SEAT_LEFT,
    )
    assert rows(enrich.seat_loads(seats), "seatLeft") == [(85.0,)]
    info = spark.createDataFrame(
        [("AAA_BBB_XX1_2019-03-02", None, "10:40", "False"), ("AAA_BBB_XX1_2019-03-05", "08:15", "10:40", "False")],
        schemas.FLIGHT_INFO,
    )
    assert rows(enrich.flight_info(info, RUN), "departTime", "isShare") == [("08:15", 0)]


# --- features ----------------------------------------------------------------------


def test_domestic_history(spark, rows):
    raw = spark.createDataFrame(
        [
            (date(2019, 2, 20), 560, "XX1_AAA_BBB_02-28", "AAA", "BBB"),
            (date(2019, 2, 20), 100_000, "XX1_AAA_BBB_02-28", "AAA", "BBB"),  # placeholder price
            (date(2019, 2, 20), 560, "XX1_AAA_BBB_03-05", "AAA", "BBB"),  # not departed
            (date(2018, 11, 1), 560, "XX1_AAA_BBB_11-05", "AAA", "BBB"),  # 120 days old
            (date(2019, 1, 1), 560, "XX1_AAA_BBB_02-27", "AAA", "BBB"),  # 57 days ahead
            (date(2019, 2, 20), None, "XX1_AAA_BBB_02-28", "AAA", "BBB"),
        ],
        schemas.LOW_PRICE,
    )
    assert rows(features.domestic_history(raw, RUN), "departDate", "price") == [(date(2019, 2, 28), 560)]


def test_splits_and_samples(spark):
    df = spark.range(100).select(F.date_add(F.lit(RUN), F.col("id").cast("int") - 50).alias("departDate"))
    train, online = features.split(df, RUN)
    assert (train.count(), online.count()) == (50, 49)
    train, held = features.time_split(df, "departDate", RUN, "<=")
    assert (train.count(), held.count()) == (49, 51)
    assert features.sample_to(df, 1000, 1).count() == 100
    assert features.sample_to(df.filter("false"), 10, 1).count() == 0
    assert 0 < features.sample_to(df, 30, 1).count() < 100
    assert 850 < features.sample_to(spark.range(30_000_000), 1_000, 1).count() < 1_150
    assert features.sample_exactly(df, 10, 1).count() == 10
    assert features.shuffle(df, 1).exceptAll(df).count() == 0


def test_trailing_mean_of_a_single_row_is_its_own_price(spark):
    df = prices(spark, {"a": 1}, lambda i: 70.0)
    assert windows.trailing_mean(df, ["k"], ["day"], "price").first()["preceding3day_price"] == 70.0


# --- encoding --------------------------------------------------------------------------


def test_string_index_ties_are_alphabetical(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "w string")
    assert rows(encoding.string_index(df, ["w"]), "value", "idx") == [("a", 1.0), ("b", 2.0), ("c", 0.0)]


def test_encode_unseen_and_numeric(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 6.0)], "c int, n double")
    index = encoding.feature_index(df, ["c"], ["n"])
    assert encoding.index_stats(index).first() == (2, 3)
    got = encoding.encode(spark.createDataFrame([(2, 9.0), (3, 9.0)], "c int, n double"), index, ["c"], ["n"])
    assert [tuple(r) for r in got.select("c_idx", "c_val", "n_idx", "n_val").collect()] == [(1, 1.0, 2, 9.0), (None, 1.0, 2, 9.0)]


# --- ranges -----------------------------------------------------------------------------


def daily(spark, md, values, start=date(2019, 2, 1)):
    return [(f"XX1_AAA_BBB_{md}", date.fromordinal(start.toordinal() + i), v) for i, v in enumerate(values)]


def test_range_by_average(spark, rows):
    data = daily(spark, "03-05", [100] * 15) + daily(spark, "03-06", [200] * 14 + [201]) + daily(spark, "03-07", [900] * 14)
    df = spark.createDataFrame(data, "flineId string, predictDate date, price int")
    assert rows(ranges.by_average(df)) == [("XX1_AAA_BBB_03", [100.0, 200.0])]


def test_range_by_percentile_and_export(spark):
    data = daily(spark, "03-05", range(1, 21))
    df = spark.createDataFrame(data, "flineId string, predictDate date, price int")
    found = ranges.domestic_by_percentile(df)
    first = found.first()["priceRange_basePercentile"]
    assert (first[0]["label"], first[0]["value"], first[9]["label"], first[9]["value"]) == ("5%", 1.0, "95%", 19.0)
    merged = ranges.merge(found, ranges.by_average(df, min_count=99))
    assert merged.first()["priceRange_baseAvg"] is None
    wanted = spark.createDataFrame([("XX1_AAA_BBB_03",), ("none",)], "_id string")
    assert ranges.export(merged, wanted).first().asDict()["p95"] == 19
    assert ranges.as_text_pairs(merged).first()["priceRange_basePercentile"][0] == ["5%", "1.0"]


def test_range_monthly(spark, rows):
    df = spark.createDataFrame(
        [("R", "03-05", 10.9), ("R", "03-06", 20.9), ("R", "2019-03-06", 99.0), ("R", "03-07", 0.0)], schemas.INTL_AVG_PRICE
    )
    assert rows(ranges.monthly(df)) == [("R_03", [10, 20])]


# --- forecast -----------------------------------------------------------------------------


def test_online_frame(spark):
    raw = spark.createDataFrame(
        [
            (date(2019, 2, 20), 560, "XX1_AAA_BBB_03-05", "AAA", "BBB"),
            (date(2019, 2, 18), 500, "XX1_AAA_BBB_03-05", "AAA", "BBB"),
            (date(2019, 2, 14), 560, "XX2_AAA_BBB_03-05", "AAA", "BBB"),  # 15 days old
            (date(2018, 12, 30), 560, "XX3_AAA_BBB_01-02", "AAA", "BBB"),
        ],
        schemas.LOW_PRICE,
    )
    got = forecast.online_frame(raw, RUN).collect()
    assert [(r["fn"], r["price"], r["queryDate"], r["departDate"], r["trend"]) for r in got] == [
        ("XX1", 560, date(2019, 2, 28), date(2019, 3, 5), None)
    ]
    later = forecast.online_frame(raw, date(2019, 1, 5)).filter("fn = 'XX3'").first()
    assert later["departDate"] == date(2019, 1, 2)  # resolved from the day the price was seen


def test_grid(spark, rows):
    df = spark.createDataFrame([("r", RUN), ("r", date(2019, 3, 3)), ("r", date(2019, 3, 3)), ("r", date(2019, 7, 1))], "route string, departDate date")
    assert rows(forecast.grid(df, "route", RUN), "predictDate") == [(date(2019, 3, 2),), (date(2019, 3, 3),)]
    older = forecast.grid(df, "route", RUN, horizon=None, first_offset=0)
    assert older.filter("departDate = date'2019-03-03'").count() == 3 and older.filter("predictDate = departDate").count() == 2


def summary_rows(spark, data):
    return spark.createDataFrame([(f"U_{d}", date(2019, 3, p), v) for d, p, v in data], "_id string, predictDate date, prediction int")


def test_summary_ties_take_the_later_date(spark):
    df = summary_rows(spark, [("2019-03-09", 1, 5), ("2019-03-09", 2, 5), ("2019-03-09", 3, 8), ("2019-03-09", 9, 8)])
    got = forecast.summary(df).first().asDict()
    assert (got["lowPrice"], got["lowPriceDate"]) == (5, date(2019, 3, 2))
    assert (got["highPrice"], got["highPriceDate"], got["departPrice"]) == (8, date(2019, 3, 9), 8)


def test_summary_of_a_single_prediction(spark):
    df = summary_rows(spark, [("2019-03-09", 1, 5)])
    assert forecast.summary(df).first()["highPrice"] == 5
    compat = forecast.summary(df, compat=True).first()
    assert compat["highPrice"] is None and compat["lowPrice"] == 5 and compat["departPrice"] is None
    pivoted = forecast.pivot_summary(forecast.summary_rows(forecast.summary(df, compat=True))).first()
    assert pivoted["lowPrice"] == "5" and pivoted["highPrice"] is None


def test_scores_at_the_threshold(spark, rows):
    df = spark.createDataFrame(
        [("XX1", "AAA_BBB", date(2019, 3, 5), 0.6), ("XX2", "AAA_BBB", date(2019, 3, 5), 0.61)],
        "fn string, city_code string, departDate date, rawPred double",
    )
    assert rows(forecast.publish_scores(df, RUN)) == [
        ("XX1_AAA_BBB_2019-03-05", "XX1", "AAA", "BBB", RUN, 0),
        ("XX2_AAA_BBB_2019-03-05", "XX2", "AAA", "BBB", RUN, 1),
    ]


# --- lifecycle --------------------------------------------------------------------------------


def kv(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int, at int")


def test_append_twice_is_append_once(spark, rows):
    state, delta = kv(spark, ("a", 1, 1), ("b", 2, 1)), kv(spark, ("b", 3, 2), ("c", 4, 2))
    once = lifecycle.append(state, delta, ["k"])
    assert rows(once) == [("a", 1, 1), ("b", 3, 2), ("c", 4, 2)]
    assert rows(lifecycle.append(once, delta, ["k"])) == rows(once)


def test_upserts(spark, rows):
    base = kv(spark, ("a", 1, 1), ("b", 2, 1))
    updates = kv(spark, ("b", 5, 2), ("b", None, 3), ("c", 7, 2))
    replaced = lifecycle.upsert_replace(base, updates, ["k"], "at")
    assert rows(replaced) == [("a", 1, 1), ("b", None, 3), ("c", 7, 2)]
    merged = lifecycle.upsert_set(base, updates, ["k"], "at")
    assert rows(merged) == [("a", 1, 1), ("b", 2, 3), ("c", 7, 2)]
    assert rows(lifecycle.upsert_set(merged, updates, ["k"], "at")) == rows(merged)


def test_purge_and_retention(spark, rows):
    ids = spark.createDataFrame([("a_2019-02-28",), ("b_2019-03-01",), ("undated",)], "_id string")
    assert rows(lifecycle.purge_departed(ids, RUN)) == [("b_2019-03-01",), ("undated",)]
    names = spark.createDataFrame([("x_20190225.csv",), ("x_20190226.csv",), ("x.csv",)], "name string")
    assert rows(lifecycle.expired_snapshots(names, RUN, keep=4)) == [("x_20190225.csv",)]


# --- metrics and models -----------------------------------------------------------------------------


def test_confusion_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    got = metrics.confusion(df, "y", "p").first()
    assert (got["tn"], got["precision"], got["recall"], got["accuracy"]) == (2, None, None, 1.0)


def test_auc_of_one_class_is_null(spark):
    assert metrics.auc(spark.createDataFrame([(1, 0.5)], "y int, s double"), "y", "s").first()["auc"] is None


def test_pipeline_knows_unseen_categories(spark, tmp_path):
    data = [("a", float(i), 3.0 * i + 1) for i in range(10)] + [("b", float(i), 3.0 * i + 2) for i in range(10)]
    df = spark.createDataFrame(data, "c string, n double, price double")
    encoder = ml.fit_price_encoder(df, ["c"], ["n"])
    ml.save_model(encoder, str(tmp_path / "m"))
    loaded = ml.load_pipeline(str(tmp_path / "m"))
    model = ml.fit_price(loaded.transform(df))
    got = model.transform(loaded.transform(spark.createDataFrame([("a", 4.0), ("new", 4.0)], "c string, n double"))).collect()
    assert got[0]["prediction"] == pytest.approx(13, abs=0.2) and len(got) == 2


def test_feature_ranking(spark):
    df = spark.range(400).selectExpr("id % 2 AS y", "id % 2 AS same", "id % 3 AS other")
    got = {r["feature"]: r for r in ml.rank_by_chi_square(df, ["same", "other"], "y").collect()}
    assert got["same"]["pValue"] < 1e-9 < got["other"]["pValue"]
    own = {r["feature"]: r["statistic"] for r in ml.chi_square(df, ["same", "other"], "y").collect()}
    assert own["same"] == pytest.approx(got["same"]["statistic"])
    assert set(ml.select_features(df, ["same", "other"], "y")) == {"same", "other"}


def test_forest_prefers_the_telling_feature(spark):
    df = spark.range(200).selectExpr("cast(id % 2 AS double) AS trend", "id % 2 AS tell", "id % 5 AS noise")
    model = ml.fit_forest(ml.assemble(df, ["tell", "noise"]), variant="shallow")
    assert ml.importances(model, ["tell", "noise"])[0][0] == "tell"


def test_percentiles_are_exact_for_long_groups(spark):
    prices = spark.range(150_000).selectExpr("'a' AS k", "id * 7919 % 150000 AS price").unionByName(
        spark.sql("SELECT 'b' AS k, 5L AS price UNION ALL SELECT 'b', NULL UNION ALL SELECT 'c', NULL")
    )
    cuts = [0.05, 0.5, 0.95, 1.0]
    found = {r["k"]: r["percentArray"] for r in ranges.percentiles(prices, ["k"], cuts=cuts).collect()}
    assert found == {"a": [math.ceil(c * 150_000) - 1 for c in cuts], "b": [5] * 4, "c": None}


@pytest.mark.parametrize("policy", [DEFAULT, HotPolicy(rows_per_task=5)])
def test_as_of_next(spark, rows, policy):
    days = lambda n: date(2019, 1, 1) + timedelta(days=n)
    r = random.Random(4)
    asked = [(i, r.choice(["x", "y", None]), r.choice([None, *map(days, range(40))])) for i in range(60)]
    events = [(r.choice(["x", "x", "y", None]), r.choice([None, *map(days, range(0, 45, 3))]), i) for i in range(25)]
    expected = []
    for i, k, d in asked:
        later = sorted((t, v) for n, t, v in events if d and t and n == k and k is not None and t >= d)
        near = later and (later[0][0] - d).days <= 6
        expected.append((i, k, d, *(later[0] if near else (None, None))))
    df = spark.createDataFrame(asked, "id int, k string, d date")
    told = spark.createDataFrame(events, "k string, t date, v int")
    found = windows.as_of_next(df, told, ["k"], "d", "t", 6, policy)
    assert found.columns == ["id", "k", "d", "t", "v"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert windows.as_of_next(df, told.filter("false"), ["k"], "d", "t", None, policy).filter("t is not null").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        windows.as_of_next(df, told.withColumnRenamed("v", "id"), ["k"], "d", "t")


def test_list_fares_as_of_each_row(spark, rows):
    raw = spark.createDataFrame([("A_B_2019-01-05_fd", "XX", 100), ("A_B_2019-02-05_fd", "XX", 200)], schemas.LIST_FARE)
    df = spark.createDataFrame([("XX", "A", "B", date(2019, 1, d)) for d in (4, 5, 6)] + [("XX", "A", "B", date(2019, 3, 1))], "fc string, org string, dst string, queryDate date")
    assert rows(enrich.with_list_fare_as_of(df, raw), "queryDate", "orgPrice") == [
        (date(2019, 1, 4), 100), (date(2019, 1, 5), 100), (date(2019, 1, 6), 200), (date(2019, 3, 1), None)
    ]
    assert rows(enrich.with_list_fare_as_of(df, raw, max_days=7), "orgPrice") == [(None,), (None,), (100,), (100,)]


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 333, 999, 1000, 5000])
def test_samples_of_any_size(spark, n):
    # A third of the rows share one key, so their digits are equal to the end.
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    tiny = HotPolicy(rows_per_task=50)
    found = features.hash_sample(df, ["k"], n, tiny)
    got = [r.k for r in found.collect()]
    order = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k in [7 if i % 3 == 0 else i for i in range(1000)])
    assert sorted(got) == sorted(k for _, k in order[:n]) and found.columns == ["k", "id"]
    drawn = features.sample_exactly(df, n, seed=3, policy=tiny).collect()
    assert len(drawn) == min(n, 1000) == len({r.id for r in drawn})


def test_range_sketches_of_few_prices_are_exact(spark, rows):
    days = [date(2019, 1, 1), date(2019, 1, 2), date(2019, 3, 1)]
    data = [("r", days[i % 2], 100 + i) for i in range(60)] + [("r", days[2], 9), ("s", days[0], None)]
    df = spark.createDataFrame(data, "route string, day date, price int")
    sketches = ranges.daily_sketches(df, ["route"], "day")
    assert sketches.count() == 4
    found = ranges.percentiles_of_sketches(sketches, ["route"], "day", days[0], days[1])
    exact = ranges.percentiles(df.filter(F.col("day") < days[2]), ["route"])
    got, expected = ({r.route: r.percentArray for r in x.collect()} for x in (found, exact))
    assert got["s"] is None and all(abs(a - b) <= 1 for a, b in zip(got["r"], expected["r"]))
