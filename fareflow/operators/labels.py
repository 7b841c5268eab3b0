"""Price-drop labels over an itinerary's price history.

``policy`` and ``bound`` are those of :mod:`fareflow.operators.windows`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows
from .hot import DEFAULT, HotPolicy


def _labelled(df, keys, order, price, min_group, skip, policy, bound):
    seen = windows.future_prices(df, keys, order, price, skip=skip, policy=policy, bound=bound)
    return seen.filter(F.col("group_count") >= min_group).drop("group_count")


def trend(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    price: str = "price",
    min_group: int = 15,
    drop_ratio: float = 0.96,
    policy: HotPolicy = DEFAULT,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Label 1 where waiting pays: the lowest price from two rows ahead is at most
    ``drop_ratio`` of the next row's price.

    Groups below ``min_group`` rows are dropped, and so are rows with no such
    future, the last two of each group.  Adds ``futureMinPrice`` and ``trend``.
    """
    ratio = F.try_divide(F.col("futureMinPrice").cast("double"), F.col("nextQueryPrice").cast("double"))
    return (
        _labelled(df, keys, order, price, min_group, 2, policy, bound)
        .dropna(subset=["futureMinPrice", "nextQueryPrice"])
        .withColumn("trend", ratio.between(0, drop_ratio).cast("int"))
        .drop("nextQueryPrice")
    )


def own_price_drop(price: str = "price", future: str = "futureMinPrice"):
    """Share by which the future minimum lies below the row's own price."""
    own = F.col(price).cast("double")
    return F.try_divide(own - F.col(future).cast("double"), own)


def trend_own_price(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    price: str = "price",
    min_group: int = 15,
    drop: float = 0.04,
    policy: HotPolicy = DEFAULT,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Older label: 1 where the future minimum is more than ``drop`` below the own price.

    Rows without a future keep a NULL label.
    """
    rate = own_price_drop(price)
    return (
        _labelled(df, keys, order, price, min_group, 2, policy, bound)
        .withColumn("trend", (rate > drop).cast("int"))
        .drop("nextQueryPrice")
    )


def trend3(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    price: str = "price",
    min_group: int = 15,
    band: float = 0.1,
    policy: HotPolicy = DEFAULT,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Three classes against the minimum from one row ahead: 2 falls, 0 flat, 1 rises.

    The last row of each group has no future and is dropped.
    """
    rate = own_price_drop(price)
    return (
        _labelled(df, keys, order, price, min_group, 1, policy, bound)
        .dropna(subset=["futureMinPrice"])
        .withColumn("trend", F.when(rate > band, 2).when(F.abs(rate) <= band, 0).when(rate.isNotNull(), 1))
        .drop("nextQueryPrice")
    )
