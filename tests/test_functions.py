from datetime import date

import pytest
from pyspark.sql import functions as F

from fareflow.functions import dates, fares, keys
from fareflow.operators import calendar


def one(spark, value, *columns):
    """Evaluate columns over a one-row frame."""
    df = spark.createDataFrame([value], "a string, b string, d date, e date, x double, y double")
    return tuple(df.select(*columns).first())


BLANK = (None, None, None, None, None, None)


def row(**given):
    return tuple(given.get(c) for c in "abdexy")


@pytest.mark.parametrize(
    "query, month_day, same, following",
    [
        (date(2019, 2, 20), "03-05", date(2019, 3, 5), date(2019, 3, 5)),
        (date(2019, 3, 5), "03-05", date(2019, 3, 5), date(2020, 3, 5)),  # equal days differ
        (date(2019, 12, 30), "01-02", date(2020, 1, 2), date(2020, 1, 2)),
        (date(2020, 2, 1), "02-29", date(2020, 2, 29), date(2020, 2, 29)),
        (date(2019, 2, 1), "02-29", None, None),
        (date(2019, 2, 1), None, None, None),
        (date(2019, 2, 1), "xx", None, None),
    ],
)
def test_depart_year(spark, query, month_day, same, following):
    got = one(
        spark,
        row(a=month_day, d=query),
        keys.resolve_depart_date("d", "a", "same"),
        keys.resolve_depart_date("d", "a", "next"),
    )
    assert got == (same, following)


def test_depart_year_rejects_unknown_rule():
    with pytest.raises(ValueError):
        keys.resolve_depart_date("d", "a", "other")


def test_short_ids_give_null(spark, rows):
    df = spark.createDataFrame([("XX1_AAA_BBB_03-05",), ("XX1_AAA",), (None,)], "id string")
    got = rows(keys.parse_low_price(df).select("fn", "fc", "city_code", "depart_md"))
    assert got == [(None, None, None, None), ("XX1", "XX", "AAA_BBB", "03-05"), ("XX1", "XX", "XX1_AAA", None)]


def test_parsers(spark):
    df = spark.createDataFrame(
        [("AAA_BBB_2019-03-05_fd", "XX1_AAA_BBB_03-05", "AAA_BBB_XX1_2019-03-05", "AAA_BBB_OW_Y_D_Spring-8")],
        "orgPrice_id string, seatLeft_id string, infoBase_id string, flineId string",
    )
    assert keys.parse_list_fare(df).first()["departDate"] == date(2019, 3, 5)
    assert keys.parse_seat(df).first()["depart_md"] == "03-05"
    assert keys.parse_flight_info(df).select("org", "dst", "fn").first() == ("AAA", "BBB", "XX1")
    intl = keys.parse_international(df).first()
    assert (intl["flineId_noDate"], intl["cabin"], intl["depart_text"]) == ("AAA_BBB_OW_Y_D", "Y", "Spring-8")
    assert one(spark, row(a="AAA_BBB_OW_Y_D"), keys.route_without_cabin("a", F.lit("03"))) == ("AAA_BBB_OW_D_03",)


def test_symbolic_dates(spark, rows):
    names = spark.createDataFrame([("2018-Spring-8", date(2018, 2, 22))], "dateDesc string, date date")
    df = spark.createDataFrame(
        [("Spring-8", date(2018, 1, 3)), ("Spring-8", date(2019, 1, 3)), ("01-03", date(2018, 1, 3)), ("02-01", date(2018, 1, 3))],
        "tail string, seen date",
    )
    got = rows(calendar.resolve_symbolic(df, names, "tail", "seen"), "tail", "seen", "departDate")
    assert got == [
        ("01-03", date(2018, 1, 3), date(2019, 1, 3)),
        ("02-01", date(2018, 1, 3), date(2018, 2, 1)),
        ("Spring-8", date(2018, 1, 3), date(2018, 2, 22)),
        ("Spring-8", date(2019, 1, 3), None),
    ]


def test_admission(spark):
    for text, ok in [("AAA_BBB_03-05", True), ("AAA_BBB", False), ("A_03-05DETAIL", False), ("A,B_03-05", False)]:
        assert one(spark, row(a=text), keys.admitted("a")) == (ok,)


@pytest.mark.parametrize("day, dow, bucket", [(date(2017, 1, 5), 4, 0), (date(2017, 1, 8), 7, 7), (date(2019, 3, 8), 5, 5)])
def test_weekday(spark, day, dow, bucket):
    """Also before 2017-01-09, the anchor date of the older modulo formula."""
    assert one(spark, row(d=day), dates.day_of_week("d"), dates.weekday_bucket("d")) == (dow, bucket)


def test_lead_times(spark):
    parts = dates.lead_times("d", "e")
    got = one(spark, row(d=date(2019, 3, 31), e=date(2019, 2, 28)), *parts.values())
    assert got == (31, 1.0, 4.0, 0.0)


def test_month_days_cross_the_year():
    days = dates.month_days(date(2019, 12, 30), date(2020, 1, 2), without=date(2019, 12, 31))
    assert days == ["12-30", "01-01", "01-02"]


def test_hour(spark):
    assert one(spark, row(a="08:15", b=""), dates.hour_of("a"), dates.hour_of("b")) == (8, None)


def test_distance_of_a_known_pair(spark):
    """Chengdu to Yibin."""
    df = spark.createDataFrame([(104.071, 30.67, 104.622, 28.765)], "a double, b double, c double, d double")
    assert df.select(fares.distance_km("a", "b", "c", "d")).first()[0] == 219
    same = spark.createDataFrame([(10.0, 0.0, -170.0, 0.0)], "a double, b double, c double, d double")
    assert same.select(fares.distance_km("a", "b", "c", "d")).first()[0] == 20016  # antipodes
    assert same.select(fares.distance_km("a", "b", F.lit(None), "d")).first()[0] is None


@pytest.mark.parametrize(
    "price, listed, expected",
    [(560.0, 1200.0, (0.47, 46.7, 46.67, 53.33)), (560.0, 0.0, (None,) * 4), (560.0, None, (None,) * 4), (1300.0, 1200.0, (1.08, 108.3, 108.33, -8.33))],
)
def test_discount(spark, price, listed, expected):
    kinds = [fares.discount("x", "y", k) for k in ("ratio", "percent", "percent2", "off")]
    assert one(spark, row(x=price, y=listed), *kinds) == expected


def test_percent(spark):
    for text, value in [("85%", 85.0), ("%", None), ("", None), ("12.5%", 12.5), ("x%", None)]:
        assert one(spark, row(a=text), fares.percent("a")) == (value,)


@pytest.mark.parametrize(
    "name, value, bucket",
    [
        ("discountOff", -3.0, 0), ("discountOff", 0.0, 1), ("discountOff", 99.9, 100), ("discountOff", 100.0, 100),
        ("distance", 0.0, 0), ("distance", 300.0, 1), ("distance", 6000.0, 20), ("distance", 9e9, 20),
        ("seatLeft", -999.0, 0), ("seatLeft", 104.0, 104), ("seatLeft", None, None),
    ],
)
def test_buckets(spark, name, value, bucket):
    got = one(spark, row(x=value), fares.step_bucket("x", *fares.MODEL_BUCKETS[name]))
    assert got == (bucket,)


def test_buckets_equal_sparks_bucketizer(spark):
    from pyspark.ml.feature import Bucketizer

    splits = [float("-inf")] + [float(i) for i in range(101)]
    df = spark.createDataFrame([(v / 4.0,) for v in range(-20, 401)], "x double")
    both = Bucketizer(splits=splits, inputCol="x", outputCol="b").transform(df)
    own = both.withColumn("o", fares.step_bucket("x", *fares.MODEL_BUCKETS["discountOff"]))
    assert own.filter("b <> o").count() == 0
