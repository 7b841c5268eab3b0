"""Prediction grids, summaries, series and published scores."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ...context import RunContext, materialize, work_dir
from ...operators import forecast
from ...operators.hot import HotPolicy
from ...sinks import manifests
from .. import publication
from .registry import ITINERARIES_SQL, RUN, RUN_SQL, Tables, itineraries, query


def _grid_sql(first: str, keep: str) -> str:
    return f"""WITH {ITINERARIES_SQL}, pairs AS (SELECT DISTINCT fn, "departDate" FROM itineraries WHERE {keep})
SELECT fn, "departDate", CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), CAST("departDate" AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS "predictDate"
FROM pairs"""


@query("q_predict_grid", _grid_sql(f"{RUN_SQL} + 1", f'"departDate" BETWEEN {RUN_SQL} AND {RUN_SQL} + 90'))
def predict_grid(t):
    return forecast.grid(itineraries(t), "fn", RUN.run_date)


@query(
    "q_predict_grid_open",
    f"""WITH {ITINERARIES_SQL}, pairs AS (SELECT DISTINCT fc, "departDate" FROM itineraries WHERE "departDate" > DATE '2001-06-01')
SELECT fc, "departDate", CAST(unnest(generate_series(TIMESTAMP '2001-06-01', CAST("departDate" AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS "predictDate"
FROM pairs""",
)
def predict_grid_open(t):
    """The older grid: from the run date on, without a horizon."""
    return forecast.grid(itineraries(t), "fc", date(2001, 6, 1), horizon=None, first_offset=0)


def _predictions(t: Tables):
    """Whole-number predictions per user, departing on 15 January."""
    return t.events.select(
        F.concat(F.lit("U"), "user_id", F.lit("_AAA_BBB_2024-01-15")).alias("_id"),
        F.to_date("ts").alias("predictDate"),
        F.col("value").cast("int").alias("prediction"),
    )


_SUMMARY_SQL = """p AS (
  SELECT 'U' || user_id || '_AAA_BBB_2024-01-15' AS _id, CAST(ts AS DATE) AS d, CAST(trunc(value) AS INT) AS v FROM events),
ends AS (SELECT _id, min(v) AS lo, max(v) AS hi FROM p GROUP BY _id),
summary AS (
  SELECT e._id, any_value(lo) AS "lowPrice", max(d) FILTER (v = lo) AS "lowPriceDate", any_value(hi) AS "highPrice",
    max(d) FILTER (v = hi) AS "highPriceDate", max(v) FILTER (d = DATE '2024-01-15') AS "departPrice",
    max(d) FILTER (d = DATE '2024-01-15') AS "departDate"
  FROM ends e JOIN p ON e._id = p._id GROUP BY e._id)"""


@query("q_price_summary", f"WITH {_SUMMARY_SQL} SELECT * FROM summary")
def price_summary(t):
    return forecast.summary(_predictions(t))


@query(
    "q_price_summary_pivot",
    f"""WITH {_SUMMARY_SQL} SELECT _id, "lowPrice"::VARCHAR AS "lowPrice", "lowPriceDate"::VARCHAR AS "lowPriceDate",
  CASE WHEN "lowPrice" <> "highPrice" THEN "highPrice"::VARCHAR END AS "highPrice",
  CASE WHEN "lowPrice" <> "highPrice" THEN "highPriceDate"::VARCHAR END AS "highPriceDate",
  "departPrice"::VARCHAR AS "departPrice", "departDate"::VARCHAR AS "departDate" FROM summary""",
)
def price_summary_pivot(t):
    rows = forecast.summary_rows(forecast.summary(_predictions(t), compat=True))
    return forecast.pivot_summary(rows)


@query(
    "q_collect_series",
    """SELECT user_id, date_trunc('month', ts)::DATE AS part,
  string_agg(CAST(ts AS DATE) || '=' || CAST(trunc(value) AS INT), ',' ORDER BY CAST(ts AS DATE), event_id) AS content
FROM events GROUP BY ALL""",
)
def collect_series(t):
    seen = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id", F.col("value").cast("int").alias("v"))
    found = forecast.series(seen, ["user_id"], ["day", "event_id"], "v")
    text = F.transform("content", lambda x: F.concat_ws("=", x["day"].cast("string"), x["v"].cast("string")))
    return found.withColumn("content", F.array_join(text, ","))


_PART = 7


@query(
    "q_series_in_parts",
    f"""WITH e AS (SELECT user_id % 5 AS u, CAST(ts AS DATE) AS day, event_id, CAST(trunc(value) AS INT) AS v FROM events),
n AS (SELECT *, (row_number() OVER (PARTITION BY u ORDER BY day, event_id) - 1) // {_PART} AS part FROM e)
SELECT u, part, count(*) AS rows, string_agg(day || '=' || v, ',' ORDER BY day, event_id) AS content FROM n GROUP BY u, part""",
)
def series_in_parts(t):
    """Series of five users with all events, in parts of seven rows, with users cut into segments."""
    seen = t.events.select((F.col("user_id") % 5).alias("u"), F.to_date("ts").alias("day"), "event_id", F.col("value").cast("int").alias("v"))
    found = forecast.series_in_parts(seen, ["u"], ["day", "event_id"], "v", _PART, HotPolicy(rows_per_task=500))
    text = F.transform("content", lambda x: F.concat_ws("=", x["day"].cast("string"), x["v"].cast("string")))
    return found.select("u", "part", F.size("content").cast("long").alias("rows"), F.array_join(text, ",").alias("content"))


#: Days before the run date that a run of the publication is made, and the lines it scores.
_RUNS = {60: "l_linenumber <= 4", 0: "l_linenumber >= 3"}


def _best(scored):
    """Best scores of every run in one shuffle; a run has the groups that any of its lines is in."""
    best = {f"best{back}": F.max(F.when(F.expr(lines), F.col("rawPred"))) for back, lines in _RUNS.items()}
    some = {f"in{back}": F.bool_or(F.expr(lines)) for back, lines in _RUNS.items()}
    return scored.groupBy("fn", "city_code", "departDate").agg(*[a.alias(name) for name, a in (best | some).items()])


@query(
    "q_publication",
    f"""WITH {ITINERARIES_SQL}, scored AS (SELECT fn || '_' || org || '_' || dst || '_' || "departDate" AS _id, fn, org, dst, l_linenumber,
    max(CAST(("departDate" - "queryDate") / 50.0::DOUBLE > 0.6 AS INT)) AS trend, "departDate" FROM itineraries GROUP BY ALL),
one AS (SELECT _id, fn, org, dst, {RUN_SQL} - 60 AS "queryDate", max(trend) AS trend, "departDate" FROM scored WHERE l_linenumber <= 4 GROUP BY ALL),
two AS (SELECT _id, fn, org, dst, {RUN_SQL} AS "queryDate", max(trend) AS trend, "departDate" FROM scored WHERE l_linenumber >= 3 GROUP BY ALL),
kept AS (SELECT * FROM two UNION ALL SELECT * FROM one WHERE "departDate" >= {RUN_SQL} - 60 AND _id NOT IN (SELECT _id FROM two))
SELECT * EXCLUDE ("departDate"), 2 AS states FROM kept WHERE "departDate" >= {RUN_SQL}""",
)
def published(t):
    """Two runs, sixty days apart: results replaced, departed ones gone, the first run's states expired."""
    root = work_dir(t.spark, "publication")
    scored = itineraries(t).withColumns({"city_code": F.concat_ws("_", "org", "dst"), "rawPred": F.datediff("departDate", "queryDate") / 50})
    best = materialize(_best(scored), "best")
    for back in _RUNS:
        one = best.filter(f"in{back}").select("fn", "city_code", "departDate", F.col(f"best{back}").alias("rawPred"))
        table = publication.publish_scores(root, one, RunContext(RUN.shift(-back)))
    states = len(manifests.Folder(t.spark, root).numbers())
    # The table was made by a state without a day, which stays.
    return table.read().withColumn("states", F.lit(states - 1))


@query(
    "q_publish_scores",
    f"""WITH {ITINERARIES_SQL}
SELECT fn || '_' || org || '_' || dst || '_' || "departDate" AS _id, fn, org, dst, {RUN_SQL} AS "queryDate",
  CAST(("departDate" - "queryDate") / 50.0::DOUBLE > 0.6 AS INT) AS trend
FROM itineraries""",
)
def publish_scores(t):
    scored = itineraries(t).withColumns(
        {
            "city_code": F.concat_ws("_", "org", "dst"),
            "rawPred": F.datediff("departDate", "queryDate") / 50,
        }
    )
    return forecast.publish_scores(scored, RUN.run_date)
