"""Fare arithmetic: discount, distance, seat load, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371



def whole_number(text: Column | str, kind="int") -> Column:
    """A number in a text, cut to a whole one: ``560`` and ``560.0`` alike; NULL for other texts."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.try_cast(kind), c.try_cast("double").try_cast(kind))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def discount(price: Column | str, list_price: Column | str, kind: str = "ratio") -> Column:
    """Price against list price; NULL when the list price is 0 or missing.

    ``ratio``     0.85, two decimals
    ``percent``   85.0, one decimal
    ``percent2``  85.0, two decimals
    ``off``       15.0, two decimals: how far below the list price
    """
    ratio = F.try_divide(_c(price).cast("double"), _c(list_price).cast("double"))
    if kind == "ratio":
        return F.round(ratio, 2)
    if kind == "percent":
        return F.round(ratio * 100, 1)
    if kind == "percent2":
        return F.round(ratio * 100, 2)
    if kind == "off":
        return F.round((1 - ratio) * 100, 2)
    raise ValueError(f"unknown discount kind {kind!r}")


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in km, unrounded."""
    lon1, lat1, lon2, lat2 = (F.radians(c) for c in (lon1, lat1, lon2, lat2))
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    # Rounding can push a of two antipodes a hair above 1, where asin is NaN.
    return 2 * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a))) * EARTH_RADIUS_KM


def distance_km(lon1, lat1, lon2, lat2, digits: int | None = None) -> Column:
    """Great-circle distance in whole km, rounded up, or rounded to ``digits`` decimals."""
    exact = haversine_km(lon1, lat1, lon2, lat2)
    return F.ceil(exact).cast("int") if digits is None else F.round(exact, digits)


def percent(text: Column | str) -> Column:
    """``'85%'`` as 85.0; empty or broken text is NULL."""
    return F.substring_index(text, "%", 1).try_cast("double")


def sane_price(price: Column | str, ceiling: int = 100_000) -> Column:
    """Prices at or above the ceiling are placeholders of the sources."""
    return _c(price) < ceiling


def step_bucket(
    value: Column | str, low: float, high: float, step: float, below: bool = False, above: bool = False
) -> Column:
    """Index of the left-closed bucket ``low, low+step … high`` a value falls into.

    ``below`` puts one more bucket (-inf, low) in front, ``above`` one more
    [high, inf) at the end.  Without ``above`` the last bucket also takes
    ``high``.  A value outside the range counts for the outermost bucket; a
    missing value has no bucket.
    """
    value = _c(value).cast("double")
    count = round((high - low) / step) + (1 if above else 0)
    raw = F.floor((value - F.lit(float(low))) / F.lit(float(step)))
    bounded = F.least(F.greatest(raw, F.lit(-1 if below else 0)), F.lit(count - 1))
    return F.when(value.isNotNull() & ~F.isnan(value), (bounded + (1 if below else 0)).cast("double"))


#: Bucket layouts of the trained models (low, high, step, below, above).
MODEL_BUCKETS = {
    "discountOff": (0, 100, 1, True, False),
    "distance": (0, 6000, 300, False, True),
    "seatLeft": (0, 104, 1, True, False),
}
ANALYSIS_BUCKETS = {
    "discount": (0, 150, 5, False, False),
    "distance": (0, 10000, 500, False, True),
    "seatLeft": (0, 100, 5, False, False),
    "intervalDays": (0, 35, 7, False, False),
}


def buckets(layout: dict) -> dict[str, Column]:
    """``<name>Bucket`` columns for one of the layouts above."""
    return {f"{name}Bucket": step_bucket(name, *spec) for name, spec in layout.items()}


def hash_bucket(value: Column | str, count: int = 60) -> Column:
    """Hash bucket 0…count-1."""
    return F.pmod(F.hash(value), F.lit(count))


def document(fields: dict[str, Column | str]) -> Column:
    """A JSON document of some columns, in the given order; NULL fields are left out."""
    return F.to_json(F.struct(*[_c(c).alias(name) for name, c in fields.items()]))
