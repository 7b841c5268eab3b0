"""Feature tables and their splits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from ..functions import dates, fares, keys as ids
from ..schemas import MAX_PRICE, MISSING
from . import calendar as holiday_calendar
from . import windows
from .hot import DEFAULT, HotPolicy


def fresh(df: DataFrame, run_date: date, query: str = "queryDate", under_days: int = 100) -> DataFrame:
    """Records queried less than ``under_days`` days before the run."""
    return df.filter(F.datediff(F.lit(run_date), query) < under_days)


def within_lead(df: DataFrame, depart: str = "departDate", query: str = "queryDate", max_days: int = 30) -> DataFrame:
    """Records queried at most ``max_days`` days before departure."""
    return df.filter(F.datediff(depart, query) <= max_days)


def look_back(df: DataFrame, days: int, depart: str = "departDate", query: str = "predictDate") -> DataFrame:
    """Records queried in (departure - days, departure]."""
    ahead = F.datediff(depart, query)
    return df.filter((ahead >= 0) & (ahead < days))


def clean_history(stored: DataFrame, optional: tuple[str, ...] = ("seatLeft",)) -> DataFrame:
    """Stored history without placeholder prices and without incomplete rows; ``optional`` columns may be missing."""
    needed = [c for c in stored.columns if c not in optional]
    return stored.dropna(subset=needed).filter(fares.sane_price("price", MAX_PRICE))


def domestic_history(raw: DataFrame, run_date: date, under_days: int = 100, max_lead: int = 30) -> DataFrame:
    """Departed itineraries from raw low prices: sane, fresh, keyed, dated."""
    clean = fresh(raw.dropna().filter(fares.sane_price("price", MAX_PRICE)), run_date, under_days=under_days)
    resolved = ids.resolve_depart_date("queryDate", "depart_md", on_equal="same")
    dated = ids.once(ids.parse_low_price(clean), {"departDate": resolved})
    departed = dated.filter(F.col("departDate") < F.lit(run_date))
    return within_lead(departed, max_days=max_lead).drop("id", "depart_md")


def build(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar, lead-time, schedule and bucket columns of enriched itineraries."""
    df = df.withColumns(
        {
            "discountOff": fares.discount("price", "orgPrice", "off"),
            "distance": F.col("distance").cast("double"),
            "departTime": dates.hour_of("departTime"),
            "arriveTime": dates.hour_of("arriveTime"),
        }
    ).na.fill({"seatLeft": float(MISSING)})
    df = holiday_calendar.attach(df, calendar, {"departDate": "depart", "queryDate": "query"})
    return df.withColumns(
        {
            **dates.date_parts("departDate", "depart"),
            **dates.date_parts("queryDate", "query"),
            **dates.lead_times("departDate", "queryDate"),
            **fares.buckets(fares.MODEL_BUCKETS),
        }
    )


def international(
    raw: DataFrame, names: DataFrame, calendar: DataFrame, cabin: str = "Y"
) -> DataFrame:
    """International history: route parts, departure date, holiday data, whole prices.

    Input ``flineId, predictDate, price``.  Only one cabin is kept, and rows
    with any missing value drop out.
    """
    priced = raw.filter(F.col("price") > 0).withColumn("price", F.col("price").cast("int"))
    parsed = ids.parse_international(priced).filter(F.col("cabin") == cabin)
    dated = holiday_calendar.resolve_symbolic(parsed, names, "depart_text", "predictDate")
    return holiday_calendar.attach_international(
        dated.drop("flineId", "cabin", "depart_text"), calendar, "departDate"
    ).dropna()


def international_dates(df: DataFrame) -> DataFrame:
    """Departure date parts and lead times, without the weekday bucket."""
    parts = dates.date_parts("departDate", "depart")
    parts.pop("depart_dayofweek_bucket")
    return df.withColumns({**parts, **dates.lead_times("departDate", "predictDate")})


def international_history(
    df: DataFrame, order: list[str], policy: HotPolicy = DEFAULT, bound: DataFrame | None = None
) -> DataFrame:
    """Date columns plus the mean price of the four departures before, per lead time."""
    dated = international_dates(df)
    key, by = ["flineId_noDate", "intervalDays"], ["departDate", *order]
    return windows.trailing_mean(dated, key, by, "price", rows=4, policy=policy, bound=bound)


def split(df: DataFrame, run_date: date, depart: str = "departDate") -> tuple[DataFrame, DataFrame]:
    """(departed, not yet departed); departures on the run date are in neither."""
    run = F.lit(run_date)
    return df.filter(F.col(depart) < run), df.filter(F.col(depart) > run)


def time_split(
    df: DataFrame, column: str, day: date, holdout: str = ">="
) -> tuple[DataFrame, DataFrame]:
    """(training, holdout) by a date.

    ``holdout`` says which rows are held out: ``'>='`` or ``'=='`` with training
    before the day, or ``'<='`` with training after it.
    """
    c, d = F.col(column), F.lit(day)
    rules = {">=": (c < d, c >= d), "==": (c < d, c == d), "<=": (c > d, c <= d)}
    train, held = rules[holdout]
    return df.filter(train), df.filter(held)


def sample_to(df: DataFrame, target: int, seed: int) -> DataFrame:
    """Bernoulli sample of about ``target`` rows; all rows if there are fewer."""
    count = df.count()
    fraction = target / count if count else 1.0
    return df if fraction >= 1.0 else df.sample(False, fraction, seed)


def sample_exactly(df: DataFrame, n: int, seed: int, policy: HotPolicy = DEFAULT) -> DataFrame:
    """``n`` random rows, for any ``n``; all rows if there are fewer."""
    drawn = df.withColumn("_draw", F.lower(F.lpad(F.hex((F.rand(seed) * (1 << 52)).cast("long")), 32, "0")))
    # The draws are written down: they are looked at several times and must stay the same.
    return _least(materialize(drawn, "drawn"), "_draw", [], n, policy, zeros=19).drop("_draw")


def hash_sample(df: DataFrame, keys: list[str], n: int, policy: HotPolicy = DEFAULT) -> DataFrame:
    """The ``n`` rows whose keys have the least MD5, for any ``n``: the same rows on every run and for every layout of the input."""
    text = F.concat_ws("_", *[F.col(k).cast("string") for k in keys])
    return _least(df.withColumn("_draw", F.md5(text.cast("binary"))), "_draw", keys, n, policy).drop("_draw")


def _least(df: DataFrame, digits: str, order: list[str], n: int, policy: HotPolicy, zeros: int = 0) -> DataFrame:
    """The ``n`` rows that come first by 32 hex digits and then by ``order``; no task holds them all.

    Rows are counted by their leading digits, combined before the shuffle.  The cells
    before the one in which the ``n``-th row lies are taken whole; that cell is
    counted by further digits until one task could hold it.  What is left of it is
    numbered in order, in segments if even equal digits have too many rows.
    """
    border, taken, rows = "0" * zeros, 0, None
    while rows is None or (rows > policy.rows_per_task and len(border) < 32):
        cell = F.substring(digits, 1, min(len(border) + 4, 32))
        counts = df.filter(F.col(digits).startswith(border)).groupBy(cell).agg(F.count(F.lit(1)))
        last = None
        for name, count in sorted((r[0], r[1]) for r in counts.collect()):  # at most 65,536 cells
            if taken + count > n:
                last = name, count
                break
            taken += count
        if last is None:  # only the whole table can have too few rows
            return df
        border, rows = last
    whole = df.filter(F.substring(digits, 1, len(border)) < border)
    if taken == n:
        return whole
    placed = windows.position(df.filter(F.col(digits).startswith(border)), [], [digits, *order], "_place", policy)
    return whole.unionByName(placed.filter(F.col("_place") < n - taken).drop("_place"))


def shuffle(df: DataFrame, seed: int, files: int | None = None) -> DataFrame:
    """Rows in random order, range-partitioned on the random number.

    The order survives a write because nothing repartitions the rows afterwards.
    """
    drawn = df.withColumn("_draw", F.rand(seed))
    drawn = drawn.repartitionByRange(files, "_draw") if files else drawn.repartitionByRange("_draw")
    return drawn.sortWithinPartitions("_draw").drop("_draw")
