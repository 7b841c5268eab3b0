"""Publication of results: what users read is one stored table, changed by each run in a few steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext, materialize
from ..functions.dates import iso_date
from ..operators import forecast
from ..operators.stored import KeyedTable, stored
from ..sinks.manifests import oldest_kept

#: Days that published states are kept.
KEEP_DAYS = 4


def publish(root: str, results: DataFrame, run: RunContext, key: str = "_id", keep: int = KEEP_DAYS) -> KeyedTable:
    """Bring a run's results in, take departed itineraries out, and let old states expire.

    A result replaces the one with its key.  A published id ends in its departure
    date; those before the run date go.  Each step publishes a state of its own, and
    a run that died in between may be run again: it finds nothing left to do for the
    steps that were done.
    """
    results = materialize(results, "results")
    table = stored(results.sparkSession, root, results, [key])
    table.upsert(results, "replace", day=run.run_date)
    departed = iso_date(F.substring_index(key, "_", -1)) < F.lit(run.run_date)
    table.delete(materialize(table.read().filter(departed).select(key), "departed"), day=run.run_date)
    table.expire(oldest_kept(run.run_date, keep))
    return table


def publish_scores(root: str, scored: DataFrame, run: RunContext, threshold: float = 0.6) -> KeyedTable:
    """Scores of a trend model as published rows, see ``forecast.publish_scores``."""
    return publish(root, forecast.publish_scores(scored, run.run_date, threshold), run)


def publish_forecast(root: str, summary: DataFrame, run: RunContext) -> KeyedTable:
    """Low, high and departure-day predictions, see ``international.forecast_summary``."""
    return publish(root, summary.withColumn("queryDate", F.lit(run.run_date)), run)
