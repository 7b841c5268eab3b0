"""Daily domestic job: price history to training and online feature tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from ..context import RunContext, materialize
from ..operators import calendar as holiday_calendar
from ..operators import encoding, enrich, features, forecast, labels, lifecycle
from ..operators.hot import DEFAULT, HotPolicy
from ..schemas import BASE_COLUMNS, INDEXED, MODEL_COLUMNS, indexed_name
from ..sources import documents

#: A sample is known by its itinerary and the day it was queried.
SAMPLE_KEY = BASE_COLUMNS


@dataclass(frozen=True)
class Dimensions:
    """Raw dimension tables of one run, see ``schemas`` for their columns."""

    airports: DataFrame
    list_fares: DataFrame
    seats: DataFrame
    flight_info: DataFrame
    holidays: DataFrame


def _enriched(df: DataFrame, dims: Dimensions, run_date: date) -> DataFrame:
    return enrich.itinerary(
        df,
        dims.airports,
        enrich.list_fares(dims.list_fares, run_date),
        enrich.seat_loads(features.fresh(dims.seats, run_date, "queryDatetime")),
        enrich.flight_info(dims.flight_info, run_date),
    )


def training_rows(
    low_prices: DataFrame, dims: Dimensions, run: RunContext, min_group: int = 15, policy: HotPolicy = DEFAULT
) -> DataFrame:
    """Labelled, enriched history of departed itineraries.

    Prices seen on one day follow each other by their other columns.
    """
    history = features.domestic_history(low_prices, run.run_date)
    labelled = labels.trend(
        history,
        ["fn", "city_code", "departDate"],
        ["queryDate"],
        min_group=min_group,
        policy=policy,
        bound=low_prices,
    )
    return _enriched(labelled, dims, run.run_date)


def online_rows(low_prices: DataFrame, dims: Dimensions, run: RunContext) -> DataFrame:
    """Enriched itineraries to score, without a label."""
    return _enriched(forecast.online_frame(low_prices, run.run_date), dims, run.run_date)


def daily_history(yesterday: DataFrame, today: DataFrame) -> DataFrame:
    """Yesterday's cleaned training history plus today's newly departed itineraries."""
    return lifecycle.append(features.clean_history(yesterday), today, SAMPLE_KEY)


def feature_table(rows: DataFrame, holidays: DataFrame, policy: HotPolicy = DEFAULT) -> DataFrame:
    """The model's columns for training and online rows together.

    The string indexes need a pass over the built rows before the result can
    read them, so what both need is written down in between.
    """
    built = features.build(rows, holiday_calendar.build(holidays))
    needed = [c for c in MODEL_COLUMNS if c in built.columns]
    built = materialize(built.select(*needed, *[c for c in INDEXED if c not in needed]), "built-rows")
    index = materialize(encoding.string_index(built, INDEXED, policy), "string-index")
    return encoding.attach_index(built, index, INDEXED, name=indexed_name).select(*MODEL_COLUMNS)


def _tables(
    history: DataFrame, online_prices: DataFrame, dims: Dimensions, ctx: RunContext
) -> tuple[DataFrame, DataFrame]:
    everything = history.unionByName(online_rows(online_prices, dims, ctx), allowMissingColumns=True)
    return features.split(feature_table(everything, dims.holidays), ctx.run_date)


def run(
    yesterday: DataFrame, low_prices: DataFrame, online_prices: DataFrame, dims: Dimensions, ctx: RunContext
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new history, training features, online features) of one day."""
    history = daily_history(yesterday, training_rows(low_prices, dims, ctx))
    return history, *_tables(history, online_prices, dims, ctx)


def run_stored(
    path: str, low_prices: DataFrame, online_prices: DataFrame, dims: Dimensions, ctx: RunContext
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """:func:`run` on a stored history, see ``lifecycle.append_stored``.

    The first day makes it, and a second run of a day changes nothing.
    """
    today = materialize(training_rows(low_prices, dims, ctx), "today")
    table = lifecycle.append_stored(path, today, SAMPLE_KEY, ctx.run_date)
    history = features.clean_history(table.read().select(*today.columns))
    return history, *_tables(history, online_prices, dims, ctx)


@dataclass(frozen=True)
class Documents:
    """The raw documents of one run, one JSON text per row in a column ``doc``, and the holiday table."""

    low_prices: DataFrame
    online_prices: DataFrame
    airports: DataFrame
    list_fares: DataFrame
    seats: DataFrame
    flight_info: DataFrame
    holidays: DataFrame

    def dimensions(self) -> Dimensions:
        return Dimensions(
            documents.airports(self.airports),
            documents.list_fares(self.list_fares),
            documents.seat_snapshots(self.seats),
            documents.flight_info(self.flight_info),
            self.holidays,
        )


def run_documents(path: str, raw: Documents, ctx: RunContext) -> tuple[DataFrame, DataFrame, DataFrame]:
    """:func:`run_stored` from the documents as they arrive.

    Documents are parsed once: the prices and dimensions they hold are written down,
    and the job reads those.
    """
    low = materialize(documents.low_prices(raw.low_prices), "low-prices")
    online = materialize(documents.low_prices(raw.online_prices), "online-prices")
    dims = raw.dimensions()
    dims = Dimensions(
        materialize(dims.airports, "airports"),
        materialize(dims.list_fares, "list-fares"),
        materialize(dims.seats, "seats"),
        materialize(dims.flight_info, "flight-info"),
        dims.holidays,
    )
    return run_stored(path, low, online, dims, ctx)
