"""Usual price ranges of a route and month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from ..functions import keys as ids
from . import windows
from .features import look_back
from .hot import DEFAULT, HotPolicy

#: Cut points of the published percentile range.
CUTS = [0.05, 0.1, 0.15, 0.2, 0.25, 0.75, 0.8, 0.85, 0.9, 0.95]
LABELS = [f"{round(c * 100)}%" for c in CUTS]


def _range(low: Column | str, high: Column | str) -> Column:
    return F.array(low, high).alias("priceRange_baseAvg")


def in_domestic_window(df: DataFrame, days: int = 50) -> DataFrame:
    """Prices queried in the last ``days`` days before departure; adds ``departDate``."""
    resolved = ids.resolve_depart_date("predictDate", F.substring_index("flineId", "_", -1), on_equal="next")
    return look_back(ids.once(df, {"departDate": resolved}), days)


def by_average(df: DataFrame, min_count: int = 15, days: int = 50) -> DataFrame:
    """Lowest and highest departure-day average per route and month.

    The average of an itinerary counts only with at least ``min_count`` prices.
    Cutting the id at its first ``-`` leaves ``fn_org_dst_MM``.
    """
    average = average_price(in_domestic_window(df, days), ["flineId"], min_count)
    return rollup(average.withColumn("flineId", F.substring_index("flineId", "-", 1)), "flineId")


def average_price(df: DataFrame, keys: list[str], min_count: int = 15, price: str = "price") -> DataFrame:
    """Whole-number average per key where enough prices were seen."""
    return (
        df.groupBy(*keys)
        .agg(F.round(F.avg(price)).alias("avgPrice"), F.count(F.lit(1)).alias("_count"))
        .filter(F.col("_count") >= min_count)
        .drop("_count")
    )


def rollup(averages: DataFrame, route: str) -> DataFrame:
    """``_id, priceRange_baseAvg`` = [lowest, highest average] per route."""
    return (
        averages.groupBy(F.col(route).alias("_id"))
        .agg(F.min("avgPrice").alias("_low"), F.max("avgPrice").alias("_high"))
        .select("_id", _range("_low", "_high"))
    )


def monthly(df: DataFrame) -> DataFrame:
    """International range from stored averages: route and departure month.

    Input ``flineId, departDate (MM-dd), avgPrice``; other date texts are skipped.
    """
    usable = df.filter((F.length("departDate") == 5) & (F.col("avgPrice") > 0))
    whole = F.col("avgPrice").cast("int")
    return (
        usable.groupBy(F.concat_ws("_", "flineId", F.substring_index("departDate", "-", 1)).alias("_id"))
        .agg(F.min(whole).alias("_low"), F.max(whole).alias("_high"))
        .select("_id", _range("_low", "_high"))
    )


def percentiles(
    df: DataFrame, keys: list[str], price: str = "price", cuts: list[float] = CUTS, policy: HotPolicy = DEFAULT
) -> DataFrame:
    """``percentArray`` of prices per key: for each cut the least price that so large a share does not exceed.

    Equal prices are counted before the shuffle and ranked by running counts, so
    the values are exact for a route of any length.  Missing prices do not count;
    a key without prices has a NULL array.
    """
    counts = materialize(df.groupBy(*keys, price).agg(F.count(F.lit(1)).alias("_n")), "price-counts")
    priced = counts.filter(F.col(price).isNotNull())
    below = windows.running_total(priced, keys, [price], "_n", "_below", policy)
    names = {k: f"_on{i}" for i, k in enumerate(keys)}
    totals = counts.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(
        F.sum(F.when(F.col(price).isNotNull(), F.col("_n"))).alias("_total")
    )
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    ranked = totals.join(below, match, "left")
    reached = F.col("_below") + F.col("_n")
    values = [F.min(F.when(reached >= F.greatest(F.ceil(F.lit(c) * F.col("_total")), F.lit(1)), F.col(price))) for c in cuts]
    found = ranked.groupBy(*names.values()).agg(F.max("_total").alias("_total"), F.array(*values).alias("_values"))
    array = F.when(F.col("_total") > 0, F.col("_values")).alias("percentArray")
    return found.select(*[F.col(n).alias(k) for k, n in names.items()], array)


#: Accuracy of a price sketch: about 1.3 % of the rank at one cut point, with the probability 0.99.
SKETCH_K = 200


def daily_sketches(df: DataFrame, keys: list[str], day: str, price: str = "price", k: int = SKETCH_K) -> DataFrame:
    """``keys, day, sketch``: one mergeable sketch of the prices of a key and day.

    A sketch has a few kilobytes however many prices it has seen, and a hot key's
    prices are sketched in every task before the shuffle.  Stored by day, sketches
    stand for the history: a new day adds its own, and a window of days is merged
    without reading a price again.
    """
    return df.groupBy(*keys, day).agg(F.kll_sketch_agg_double(F.col(price).cast("double"), F.lit(k)).alias("sketch"))


def percentiles_of_sketches(
    sketches: DataFrame, keys: list[str], day: str, first: date, last: date, cuts: list[float] = CUTS
) -> DataFrame:
    """``percentArray`` per key of the days from ``first`` to ``last``, like :func:`percentiles` but for a small error of the rank."""
    window = sketches.filter(F.col(day).between(F.lit(first), F.lit(last)))
    merged = window.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_sketch"))
    values = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(float(c)) for c in cuts]))
    seen = F.kll_sketch_get_n_double("_sketch") > 0
    return merged.select(*keys, F.when(seen, values).alias("percentArray"))


def label_percentiles(df: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """Turn ``percentArray`` into ``priceRange_basePercentile``: structs of label and value."""
    names = F.array(*[F.lit(x) for x in labels])
    pairs = F.zip_with(
        names, "percentArray", lambda label, value: F.struct(label.alias("label"), value.cast("double").alias("value"))
    )
    return df.withColumn("priceRange_basePercentile", pairs).drop("percentArray")


def by_percentile(df: DataFrame, route: Column | str, price: str = "price") -> DataFrame:
    """``_id, priceRange_basePercentile`` per route expression."""
    route = F.col(route) if isinstance(route, str) else route
    keyed = df.select(route.alias("_id"), price)
    return label_percentiles(percentiles(keyed, ["_id"], price))


def domestic_by_percentile(df: DataFrame, days: int = 50) -> DataFrame:
    return by_percentile(in_domestic_window(df, days), F.substring_index("flineId", "-", 1))


def international_by_percentile(history: DataFrame, days: int = 180) -> DataFrame:
    """From international history features: cabin dropped from the id, month added."""
    month = F.date_format("departDate", "MM")
    return by_percentile(look_back(history, days), ids.route_without_cabin("flineId_noDate", month))


def merge(percentile: DataFrame, average: DataFrame) -> DataFrame:
    """Both ranges per id; a range only one side knows leaves the other NULL."""
    return percentile.join(average, "_id", "full_outer")


def as_text_pairs(df: DataFrame) -> DataFrame:
    """The published form of the percentile range: array of [label, value] texts."""
    pair = lambda p: F.array(p["label"], p["value"].cast("string"))
    return df.withColumn("priceRange_basePercentile", F.transform("priceRange_basePercentile", pair))


def export(merged: DataFrame, wanted: DataFrame, id_col: str = "_id") -> DataFrame:
    """Flat table for a list of ids: average range, then the percentiles as whole numbers."""
    picked = merged.join(wanted.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi")
    return picked.select(
        "_id",
        F.get("priceRange_baseAvg", F.lit(0)).alias("avg_low"),
        F.get("priceRange_baseAvg", F.lit(1)).alias("avg_high"),
        *[
            F.get("priceRange_basePercentile", F.lit(i))["value"].cast("int").alias(f"p{round(c * 100):02d}")
            for i, c in enumerate(CUTS)
        ],
    )
