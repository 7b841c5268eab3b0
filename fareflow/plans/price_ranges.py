"""Price-range jobs: average and percentile ranges per route and month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import ranges


def domestic(prices: DataFrame, min_count: int = 15) -> DataFrame:
    """``_id, priceRange_basePercentile, priceRange_baseAvg`` from ``flineId, predictDate, price``."""
    return ranges.merge(ranges.domestic_by_percentile(prices), ranges.by_average(prices, min_count))


def international(history: DataFrame, averages: DataFrame) -> DataFrame:
    """The same from feature history and stored departure-day averages."""
    return ranges.merge(ranges.international_by_percentile(history), ranges.monthly(averages))
