"""International job: price history to a day-by-day forecast per itinerary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext, materialize, work_dir
from ..operators import calendar as holiday_calendar
from ..operators import features, forecast, metrics, ml
from ..operators.hot import DEFAULT, HotPolicy


def history(
    raw: DataFrame, names: DataFrame, holidays: DataFrame, order: list[str], policy: HotPolicy = DEFAULT
) -> DataFrame:
    """Feature history.  ``order`` names columns that break ties of equal departures.

    Written down once: encoder, model, grid and reference prices all read it.
    """
    known = features.international(raw, names, holiday_calendar.build(holidays))
    return materialize(features.international_history(known, order, policy, bound=raw), "intl-history")


def prediction_frame(past: DataFrame, holidays: DataFrame, run: RunContext, order: list[str]) -> DataFrame:
    """Every itinerary and day to predict, with features and reference price."""
    key = ["flineId_noDate", "intervalDays"]
    reference = forecast.reference_price(past, key, ["departDate", *order])
    pairs = forecast.grid(past, "flineId_noDate", run.run_date)
    return forecast.grid_features(
        pairs, reference, holiday_calendar.build(holidays), holiday_calendar.attach_international
    )


def predictions(past: DataFrame, holidays: DataFrame, run: RunContext, order: list[str]) -> DataFrame:
    """``_id, predictDate, prediction`` from a linear model fitted on the history."""
    encoder = ml.fit_price_encoder(past)
    path = work_dir(past.sparkSession, "encoder")
    ml.save_model(encoder, path)
    model = ml.fit_price(encoder.transform(past))
    frame = prediction_frame(past, holidays, run, order)
    return ml.predict_price(model, ml.load_pipeline(path).transform(frame))


def forecast_summary(past: DataFrame, holidays: DataFrame, run: RunContext, order: list[str]) -> DataFrame:
    """Low, high and departure-day prediction of every itinerary ahead."""
    return forecast.summary(predictions(past, holidays, run, order))


def evaluate(past: DataFrame, day: date) -> DataFrame:
    """``rows, mape``: a model fitted on departures before ``day``, judged on the later ones it has not seen."""
    train, held = features.time_split(past, "departDate", day, ">=")
    encoder = ml.fit_price_encoder(train)
    model = ml.fit_price(encoder.transform(train))
    scored = materialize(model.transform(encoder.transform(held)).select("price", "prediction"), "evaluated")
    return metrics.mape(scored, "price", "prediction").withColumn("rows", F.lit(scored.count())).select("rows", "mape")
