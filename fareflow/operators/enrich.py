"""Dimensions around an itinerary: distance, list fare, seat load, flight schedule."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from ..functions import fares, keys as ids
from . import windows
from .hot import DEFAULT, HotPolicy
from .joins import lookup_join, sized


def nearest_future(
    df: DataFrame, keys: list[str], date_col: str, run_date: date, max_days: int | None = None
) -> DataFrame:
    """Per key the first record on or after ``run_date`` (at most ``max_days`` ahead)."""
    run = F.lit(run_date)
    ahead = F.col(date_col) >= run
    if max_days is not None:
        ahead = ahead & (F.col(date_col) <= F.date_add(run, max_days))
    return windows.earliest(df.filter(ahead), keys, [date_col])


def last_of_day(df: DataFrame, keys: list[str], ts: str, out: str = "queryDate") -> DataFrame:
    """The last snapshot of every key and day."""
    return windows.latest(df.withColumn(out, F.to_date(ts)), [*keys, out], [ts])


def last_of_day_all(df: DataFrame, keys: list[str], ts: str, out: str = "queryDate") -> DataFrame:
    """Like :func:`last_of_day`, but every row of the day's last minute is kept."""
    minute = F.date_trunc("minute", F.col(ts))
    df = df.withColumns({out: F.to_date(ts), "_minute": minute})
    last = df.groupBy(*keys, out).agg(F.max("_minute").alias("_minute"))
    return df.join(last, [*keys, out, "_minute"], "left_semi").drop("_minute")


def latest_snapshot(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """The most recent record of every key."""
    return windows.latest(df, keys, [date_col])


def with_distance(df: DataFrame, airports: DataFrame, org: str = "org", dst: str = "dst") -> DataFrame:
    """Add both ends' coordinates and ``distance`` in km; unknown airports drop out."""
    located = sized(airports.dropna())  # measured once for both ends
    for side, code in (("org", org), ("dst", dst)):
        dim = located.select(
            F.col("Airport_code").alias(f"_{side}_code"),
            F.col("latitude").alias(f"{side}_latitude"),
            F.col("longitude").alias(f"{side}_longitude"),
        )
        df = df.join(dim, F.col(code) == F.col(f"_{side}_code")).drop(f"_{side}_code")
    return df.withColumn(
        "distance", fares.distance_km("org_longitude", "org_latitude", "dst_longitude", "dst_latitude")
    )


def list_fares(raw: DataFrame, run_date: date, max_days: int | None = None) -> DataFrame:
    """``fc, org, dst → orgPrice`` from the next departure that has a list fare.

    Incomplete records drop out before the next one is looked for.
    """
    parsed = ids.parse_list_fare(raw).select("fc", "org", "dst", "departDate", F.col("orgPrice").cast("int")).dropna()
    return nearest_future(parsed, ["fc", "org", "dst"], "departDate", run_date, max_days).drop("departDate")


def with_list_fare_as_of(df: DataFrame, raw: DataFrame, at: str = "queryDate", max_days: int | None = None, policy: HotPolicy = DEFAULT) -> DataFrame:
    """Add ``orgPrice`` of the next departure on or after each row's own day, NULL where there is none.

    :func:`list_fares` looks from one run date for all rows; this serves rows of
    many days at once, so a history can be filled in later.
    """
    parsed = ids.parse_list_fare(raw).select("fc", "org", "dst", F.col("departDate").alias("_fareDate"), F.col("orgPrice").cast("int")).dropna()
    return windows.as_of_next(df, parsed, ["fc", "org", "dst"], at, "_fareDate", max_days, policy).drop("_fareDate")


def seat_loads(raw: DataFrame) -> DataFrame:
    """``fn, org, dst, departDate, queryDate → seatLeft`` from each day's last complete snapshot."""
    complete = raw.dropna(subset=["seatLeft_id", "queryDatetime", "seatLeft"])
    last = ids.parse_seat(last_of_day(complete, ["seatLeft_id"], "queryDatetime"))
    columns = {"departDate": ids.resolve_depart_date("queryDate", "depart_md"), "seatLeft": fares.percent("seatLeft")}
    return ids.once(last, columns).select("fn", "org", "dst", "departDate", "queryDate", "seatLeft").dropna()


def flight_info(raw: DataFrame, run_date: date, max_days: int | None = None) -> DataFrame:
    """``fn, org, dst → departTime, arriveTime, isShare`` of the next departure that has all of them."""
    parsed = ids.parse_flight_info(raw).select(
        "fn", "org", "dst", "departDate", "departTime", "arriveTime", (F.col("isShare") == "True").cast("int").alias("isShare")
    )
    return nearest_future(parsed.dropna(), ["fn", "org", "dst"], "departDate", run_date, max_days).drop("departDate")


def itinerary(
    df: DataFrame, airports: DataFrame, list_fare: DataFrame, seats: DataFrame, info: DataFrame
) -> DataFrame:
    """Distance, list fare, discount, seat load and schedule for priced itineraries.

    Rows without airport, list fare or schedule drop out; the seat load may be
    missing.  List fares and schedules boil long tables down to one row per
    route, so they are written down before their size is looked at.  The seat
    table is as long as the history itself: that join is left to Spark's
    shuffled join.
    """
    list_fare, info = materialize(list_fare, "list-fares"), materialize(info, "flight-info")
    priced = lookup_join(with_distance(df, airports), list_fare, ["fc", "org", "dst"])
    scheduled = lookup_join(
        priced.withColumn("discount", fares.discount("price", "orgPrice")), info, ["fn", "org", "dst"]
    )
    return scheduled.join(seats, ["fn", "org", "dst", "departDate", "queryDate"], "left")
