"""The composed daily jobs on a small hand-made world."""

import json
from datetime import date, datetime, timedelta

import pytest

from pyspark.sql import functions as F

from fareflow import schemas
from fareflow.context import RunContext
from fareflow.operators import lifecycle
from fareflow.plans import domestic, international

RUN = RunContext.of("2019-03-01")


@pytest.fixture(scope="module")
def world(spark):
    def price_rows(flight, depart, values):
        first = depart - timedelta(days=len(values))
        id_ = f"{flight}_AAA_BBB_{depart:%m-%d}"
        return [(first + timedelta(days=i), v, id_, "AAA", "BBB") for i, v in enumerate(values)]

    falling = [1000 - 20 * i for i in range(20)]
    low = price_rows("XX1", date(2019, 2, 28), falling) + price_rows("XX2", date(2019, 2, 28), [500] * 14)
    online = price_rows("XX1", date(2019, 3, 20), [900] * 25)
    dims = domestic.Dimensions(
        airports=spark.createDataFrame([("AAA", 30.67, 104.071), ("BBB", 28.765, 104.622)], schemas.AIRPORT),
        list_fares=spark.createDataFrame([("AAA_BBB_2019-03-02_fd", "XX", 1200)], schemas.LIST_FARE),
        seats=spark.createDataFrame([(datetime(2019, 2, 10, 9), "85%", "XX1_AAA_BBB_02-28")], schemas.SEAT_LEFT),
        flight_info=spark.createDataFrame([("AAA_BBB_XX1_2019-03-05", "08:15", "10:40", "True")], schemas.FLIGHT_INFO),
        holidays=spark.createDataFrame([("20190211", "x", "spring", "yes", 1, 1)], schemas.HOLIDAYS),
    )
    frame = lambda data: spark.createDataFrame(data, schemas.LOW_PRICE)
    return frame(low), frame(online), dims


def test_daily_domestic_run(spark, world):
    low, online, dims = world
    first = domestic.training_rows(low, dims, RUN)
    history, train, ahead = domestic.run(first, low, online, dims, RUN)
    assert history.count() == 18  # 20 rows, the last two have no future; XX2 is too short
    assert train.columns == schemas.MODEL_COLUMNS and train.count() == 18
    assert [r["trend"] for r in train.orderBy("queryDate").collect()] == [1] * 17 + [0]  # 620 is over 0.96 of 640
    scored = ahead.collect()
    assert len(scored) == 1 and scored[0]["trend"] is None
    assert (scored[0]["queryDate"], scored[0]["departDate"]) == (RUN.yesterday, date(2019, 3, 20))
    assert (scored[0]["intervalDays"], scored[0]["discountOffBucket"], scored[0]["seatLeftBucket"]) == (20, 26.0, 0.0)
    day = train.filter("queryDate = date'2019-02-10'").first()
    assert (day["seatLeftBucket"], day["isShare"], day["departTime"], day["query_dayofvacation_extend"]) == (86.0, 1, 8, -1)
    assert train.filter("queryDate = date'2019-02-12'").first()["query_dayofvacation_extend"] == 1001


def test_two_days_on_a_stored_history(spark, world, rows, tmp_path):
    low, online, dims = world
    path = str(tmp_path / "history")
    first = domestic.training_rows(low, dims, RUN)
    dirty = first.limit(1).withColumn("price", F.lit(100_000)).withColumn("departDate", F.lit(date(2019, 1, 5)))
    lifecycle.append_stored(path, dirty.select(*first.columns), domestic.SAMPLE_KEY)
    later = RunContext.of("2019-03-02")
    domestic.run_stored(path, low, online, dims, RUN)
    history, train, _ = domestic.run_stored(path, low, online, dims, later)
    expected, known, _ = domestic.run(first, low, online, dims, later)
    assert rows(history, *first.columns) == rows(expected, *first.columns) and history.count() == 18
    assert rows(train) == rows(known)


def test_a_run_from_documents(spark, world, rows, tmp_path):
    low, online, dims = world
    texts = lambda objects: spark.createDataFrame([(json.dumps(o),) for o in objects], "doc string")

    def price_docs(df):
        found = {}
        for r in df.collect():
            found.setdefault(r["id"], {"_id": r["id"], "dairport": r["org"], "aairport": r["dst"]})[str(r["queryDate"])] = str(r["price"])
        return texts(found.values())

    raw = domestic.Documents(
        price_docs(low),
        price_docs(online),
        texts([{"_id": "AAA", "latitude": "30.67", "longitude": "104.071"}, {"_id": "BBB", "latitude": "28.765", "longitude": "104.622"}]),
        texts([{"_id": "AAA_BBB_2019-03-02_fd", "XX": {"Y": {"price": "1200"}}}]),
        texts([{"_id": "XX1_AAA_BBB_02-28", "fc": {"2019-02-10 09:00:00": "85%"}}]),
        texts([{"_id": "AAA_BBB_XX1_2019-03-05", "origindeparttime": "08:15", "originarrivetime": "10:40", "isshare": "True"}]),
        dims.holidays,
    )
    assert rows(raw.dimensions().airports) == rows(dims.airports)
    history, train, ahead = domestic.run_documents(str(tmp_path / "d"), raw, RUN)
    assert history.count() == 18 and train.count() == 18 and ahead.count() == 1


def test_labels_of_equal_days_do_not_depend_on_the_input_order(spark, world, rows):
    low, _, dims = world
    doubled = low.unionByName(low.withColumn("price", F.col("price") + 1))
    one = domestic.training_rows(doubled.repartition(7), dims, RUN)
    assert rows(one) == rows(domestic.training_rows(doubled.coalesce(1), dims, RUN)) and one.count() > 30


def test_international_forecast(spark):
    data = []
    for offset in range(0, 60):
        depart = date(2019, 1, 10) + timedelta(days=offset)
        for lead in range(0, 12):
            seen = depart - timedelta(days=lead)
            if lead:  # on the departure day itself the id would mean next year
                data.append((f"AAA_BBB_OW_Y_D_{depart:%m-%d}", seen, 1000 + 10 * lead))
    raw = spark.createDataFrame(data, schemas.INTL_HISTORY)
    names = spark.createDataFrame([], schemas.NAMED_DATES)
    holidays = spark.createDataFrame([("20190205", "x", "spring", "yes", 1, 1)], schemas.HOLIDAYS)
    past = international.history(raw, names, holidays, ["price"])
    run = RunContext.of("2019-03-01")
    found = {r["_id"]: r for r in international.forecast_summary(past, holidays, run, ["price"]).collect()}
    best = found["AAA_BBB_OW_Y_D_2019-03-10"]
    # Lead times 8 … 1 are known, the departure day has no reference price.
    assert best["lowPriceDate"] == date(2019, 3, 9) and best["highPriceDate"] == date(2019, 3, 2)
    assert best["lowPrice"] == pytest.approx(1010, abs=5) and best["highPrice"] == pytest.approx(1080, abs=5)
    assert best["departPrice"] is None

    held = international.evaluate(past, date(2019, 2, 20)).first()
    assert held.rows > 50 and held.mape < 0.05


def test_scores_of_both_runs_take_one_shuffle(spark, capsys):
    """A group without a line of a run is not in it; one whose scores are all NULL is."""
    from fareflow.plans.checks import forecasts

    lines = [("f", "c", 1, 0.5), ("f", "c", 3, 0.9), ("f", "c", 7, 0.2), ("g", "c", 2, None), ("h", "c", 5, 0.1), ("i", "c", None, 0.3)]
    scored = spark.createDataFrame(lines, "fn string, city_code string, l_linenumber int, rawPred double")
    best = forecasts._best(scored.withColumn("departDate", F.lit("2000-01-01").cast("date")))
    best.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
    found = {r.fn: (r.in60, r.best60, r.in0, r.best0) for r in best.collect()}
    assert found == {"f": (True, 0.9, True, 0.9), "g": (True, None, False, None), "h": (False, None, True, 0.1), "i": (None, None, None, None)}
