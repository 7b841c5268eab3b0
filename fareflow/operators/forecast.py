"""Online frames, prediction grids and their summaries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from ..functions import dates, fares, keys as ids
from ..schemas import MAX_PRICE
from . import windows
from .features import international_dates
from .hot import DEFAULT, HotPolicy
from .joins import lookup_join


def online_frame(raw: DataFrame, run_date: date, max_age: int = 14) -> DataFrame:
    """Itineraries to score: the latest price per id, if not older than ``max_age`` days.

    The departure date is resolved from the day the price was seen; the query
    date then becomes yesterday.  Label and future minimum are typed NULLs.
    """
    last = windows.latest(raw.dropna(), ["id"], ["queryDate"])
    usable = last.filter(fares.sane_price("price", MAX_PRICE)).filter(
        F.datediff(F.lit(run_date), "queryDate") <= max_age
    )
    resolved = ids.resolve_depart_date("queryDate", "depart_md", on_equal="same")
    dated = ids.once(ids.parse_low_price(usable), {"departDate": resolved})
    return (
        dated.drop("id", "depart_md")
        .withColumn("queryDate", F.lit(run_date - timedelta(days=1)))
        .dropna()
        .withColumns({"futureMinPrice": F.lit(None).cast("int"), "trend": F.lit(None).cast("int")})
    )


def grid(
    df: DataFrame,
    route: str,
    run_date: date,
    depart: str = "departDate",
    horizon: int | None = 90,
    first_offset: int = 1,
) -> DataFrame:
    """Every (route, departure) still ahead, once per day from ``run_date + first_offset``
    through the departure day, as ``predictDate``.

    ``horizon`` bounds the departures in days ahead, so a pair expands to at most
    that many rows.  ``horizon=None`` with ``first_offset=0`` is the older
    unbounded grid, which leaves out departures on the run date.
    """
    run = F.lit(run_date)
    ahead = F.col(depart) > run if horizon is None else F.col(depart).between(run, F.date_add(run, horizon))
    first = F.lit(run_date + timedelta(days=first_offset))
    pairs = df.filter(ahead).select(route, depart).distinct().filter(F.col(depart) >= first)
    return pairs.withColumn("predictDate", F.explode(F.sequence(first, F.col(depart), F.expr("interval 1 day"))))


def reference_price(
    df: DataFrame, keys: list[str], order: list[str], price: str = "price", n: int = 3, out: str = "preceding3day_price"
) -> DataFrame:
    """Mean of the ``n`` latest prices per key."""
    return windows.latest_rows(df, keys, order, n).groupBy(*keys).agg(F.avg(price).alias(out))


def grid_features(
    pairs: DataFrame, reference: DataFrame, calendar: DataFrame, attach_calendar
) -> DataFrame:
    """Route, calendar and lead-time columns of grid rows with a reference price.

    The reference prices boil a long history down: they are written before they
    are measured and joined.
    """
    reference = materialize(reference, "reference-prices")
    parts = {n: ids.part("flineId_noDate", i) for i, n in enumerate(["org", "dst", "isReturn_type", None, "isDirect_type"]) if n}
    dated = international_dates(attach_calendar(pairs, calendar, "departDate").withColumns(parts))
    return lookup_join(dated, reference, ["flineId_noDate", "intervalDays"], "inner").dropna()


def summary(predictions: DataFrame, compat: bool = False) -> DataFrame:
    """Low, high and departure-day prediction per id, with their dates.

    Input ``_id`` (ending in the departure date), ``predictDate``, ``prediction``.
    Equal predictions resolve to the later date.  ``compat=True`` leaves the high
    price empty where the lowest row is also the highest.
    """
    on_day = F.col("predictDate") == dates.iso_date(F.substring_index("_id", "_", -1))
    # Smallest prediction first, latest date among equals: the date counts backwards.
    day = F.unix_date("predictDate")
    best = predictions.groupBy("_id").agg(
        F.min(F.struct("prediction", (-day).alias("back"))).alias("_low"),
        F.max(F.struct("prediction", day.alias("day"))).alias("_high"),
        F.max(F.when(on_day, F.col("prediction"))).alias("departPrice"),
        F.max(F.when(on_day, F.col("predictDate"))).alias("departDate"),
    )
    same_row = (F.col("_low.prediction") == F.col("_high.prediction")) & (-F.col("_low.back") == F.col("_high.day"))
    high = ~same_row if compat else F.lit(True)
    return best.select(
        "_id",
        F.col("_low.prediction").alias("lowPrice"),
        F.date_from_unix_date(-F.col("_low.back")).alias("lowPriceDate"),
        F.when(high, F.col("_high.prediction")).alias("highPrice"),
        F.when(high, F.date_from_unix_date("_high.day")).alias("highPriceDate"),
        "departPrice",
        "departDate",
    )


#: Keys of the published key/value form.
SUMMARY_KEYS = ["departDate", "departPrice", "highPrice", "highPriceDate", "lowPrice", "lowPriceDate"]


def summary_rows(wide: DataFrame) -> DataFrame:
    """Key/value rows of a summary, empty values left out."""
    texts = wide.select("_id", *[F.col(c).cast("string").alias(c) for c in SUMMARY_KEYS])
    return texts.unpivot(["_id"], SUMMARY_KEYS, "key", "value").filter(F.col("value").isNotNull())


def pivot_summary(rows: DataFrame) -> DataFrame:
    """Key/value rows back to one row per id; the key list is fixed, so no extra job."""
    return rows.groupBy("_id").pivot("key", SUMMARY_KEYS).agg(F.max("value"))


def series(df: DataFrame, keys: list[str], order: list[str], value: str, part: Column | None = None) -> DataFrame:
    """Ordered array of (order columns, value) per key and part, as ``part, content``.

    ``part`` is the month of the first order column, a date, unless another
    expression of it is given; joined by ``part`` the arrays are the key's series.
    The parts are the same for every size of the table.  One task holds the rows
    of a key and part, so a denser history wants narrower parts, such as days.
    """
    part = F.trunc(order[0], "month") if part is None else part
    content = F.array_sort(F.collect_list(F.struct(*order, value))).alias("content")
    return df.groupBy(*keys, part.alias("part")).agg(content).select(*keys, "part", "content")


#: Rows of one part of a series.
PART_ROWS = 10_000


def series_in_parts(
    df: DataFrame, keys: list[str], order: list[str], value: str, rows: int = PART_ROWS, policy: HotPolicy = DEFAULT
) -> DataFrame:
    """:func:`series` in parts of ``rows`` rows, numbered from 0 for each key.

    The places of rows come from :func:`~fareflow.operators.windows.position`, which
    cuts hot keys, so no task and no array holds more than a part of a key however
    long its series is; joined by ``part`` the arrays are the series.
    """
    placed = windows.position(df.select(*keys, *order, value), keys, order, "_place", policy)
    part = F.floor(F.col("_place") / rows).cast("long").alias("part")
    content = F.array_sort(F.collect_list(F.struct("_place", *order, value)))
    whole = placed.groupBy(*keys, part).agg(content.alias("content"))
    names = [*order, value]
    return whole.withColumn("content", F.transform("content", lambda x: F.struct(*[x[n].alias(n) for n in names])))


def publish_scores(df: DataFrame, run_date: date, threshold: float = 0.6, score: str = "rawPred") -> DataFrame:
    """Published form of scores: ``_id``, its parts, the run date and a 0/1 trend.

    A score equal to the threshold is 0.
    """
    keyed = df.select(
        ids.build("fn", "city_code", F.date_format("departDate", "yyyy-MM-dd")).alias("_id"),
        F.lit(run_date).alias("queryDate"),
        (F.col(score) > threshold).cast("int").alias("trend"),
    )
    return ids.parse_result(keyed).select("_id", "fn", "org", "dst", "queryDate", "trend")
