"""Labels and ordered windows over price histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import enrich, forecast, labels, windows
from ...operators.hot import HotPolicy
from .registry import HISTORY_KEYS, HISTORY_ORDER, HISTORY_SQL, RUN, RUN_SQL, history, query

_ORDER = "PARTITION BY l_partkey ORDER BY day, l_orderkey, l_linenumber"


def _label_sql(skip: int, min_group: int, label: str, keep: str) -> str:
    return f"""WITH {HISTORY_SQL}, seen AS (
  SELECT *, count(price) OVER (PARTITION BY l_partkey) AS n,
    min(price) OVER ({_ORDER} ROWS BETWEEN {skip} FOLLOWING AND UNBOUNDED FOLLOWING) AS "futureMinPrice",
    lead(price) OVER ({_ORDER}) AS nxt
  FROM history)
SELECT l_partkey, day, l_orderkey, l_linenumber, price, "futureMinPrice", CAST({label} AS INT) AS trend
FROM seen WHERE n >= {min_group} AND {keep}"""


@query(
    "q_trend_label",
    _label_sql(2, 15, 'CASE WHEN "futureMinPrice" / nxt BETWEEN 0 AND 0.96 THEN 1 ELSE 0 END', '"futureMinPrice" IS NOT NULL AND nxt IS NOT NULL'),
)
def trend_label(t):
    return labels.trend(history(t), HISTORY_KEYS, HISTORY_ORDER)


@query(
    "q_trend_label_own",
    _label_sql(2, 25, 'CASE WHEN "futureMinPrice" IS NULL THEN NULL WHEN (price - "futureMinPrice") / price > 0.04 THEN 1 ELSE 0 END', "true"),
)
def trend_label_own(t):
    return labels.trend_own_price(history(t), HISTORY_KEYS, HISTORY_ORDER, min_group=25)


@query(
    "q_trend_label_3class",
    _label_sql(
        1,
        25,
        'CASE WHEN (price - "futureMinPrice") / price > 0.1 THEN 2 WHEN abs(price - "futureMinPrice") / price <= 0.1 THEN 0 ELSE 1 END',
        '"futureMinPrice" IS NOT NULL',
    ),
)
def trend_label_3class(t):
    return labels.trend3(history(t), HISTORY_KEYS, HISTORY_ORDER, min_group=25)


@query(
    "q_trailing_mean",
    f"""WITH {HISTORY_SQL}
SELECT l_partkey, day, l_orderkey, l_linenumber,
  round(coalesce(avg(price) OVER ({_ORDER} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), price), 4) AS preceding3day_price
FROM history""",
)
def trailing_mean(t):
    seen = windows.trailing_mean(history(t), HISTORY_KEYS, HISTORY_ORDER, "price")
    return seen.select("l_partkey", *HISTORY_ORDER, F.round("preceding3day_price", 4).alias("preceding3day_price"))


# --- hot keys: all returned lines, a third of the table, are one key -------------------

#: Small enough that this key is cut into segments at every scale factor.
_SMALL_TASKS = HotPolicy(rows_per_task=1_500)
_HOT_ORDER = ["day", "l_orderkey", "l_linenumber", "l_partkey"]
_HOT_SQL = """history AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_partkey END AS series, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, l_partkey,
    l_extendedprice AS price FROM lineitem)"""
_HOT_WINDOW = "PARTITION BY series ORDER BY day, l_orderkey, l_linenumber, l_partkey"


def _hot_history(t):
    series = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.col("l_partkey")).alias("series")
    return t.lineitem.select(
        series, F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("price")
    )


@query(
    "q_trend_label_hot_key",
    f"""WITH {_HOT_SQL}, seen AS (
  SELECT *, count(price) OVER (PARTITION BY series) AS n, lead(price) OVER ({_HOT_WINDOW}) AS nxt,
    min(price) OVER ({_HOT_WINDOW} ROWS BETWEEN 2 FOLLOWING AND UNBOUNDED FOLLOWING) AS "futureMinPrice"
  FROM history)
SELECT series, day, l_orderkey, l_linenumber, l_partkey, price, "futureMinPrice",
  CAST("futureMinPrice" / nxt BETWEEN 0 AND 0.96 AS INT) AS trend
FROM seen WHERE n >= 15 AND "futureMinPrice" IS NOT NULL""",
)
def trend_label_hot_key(t):
    return labels.trend(_hot_history(t), ["series"], _HOT_ORDER, policy=_SMALL_TASKS)


@query(
    "q_trailing_mean_hot_key",
    f"""WITH {_HOT_SQL}
SELECT series, day, l_orderkey, l_linenumber, l_partkey, row_number() OVER ({_HOT_WINDOW}) - 1 AS position,
  round(coalesce(avg(price) OVER ({_HOT_WINDOW} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), price), 4) AS preceding3day_price
FROM history""",
)
def trailing_mean_hot_key(t):
    seen = windows.trailing_mean(_hot_history(t), ["series"], _HOT_ORDER, "price", policy=_SMALL_TASKS)
    numbered = windows.position(seen, ["series"], _HOT_ORDER, "position", _SMALL_TASKS)
    mean = F.round("preceding3day_price", 4).alias("preceding3day_price")
    return numbered.select("series", *_HOT_ORDER, "position", mean)


@query(
    "q_collect_series_hot_key",
    f"""WITH {_HOT_SQL} SELECT series, date_trunc('month', day)::DATE AS part,
  string_agg(day || '/' || l_orderkey || '/' || l_linenumber || '=' || CAST(round(price * 100) AS BIGINT), ',' ORDER BY {", ".join(_HOT_ORDER)}, price) AS content
FROM history GROUP BY ALL""",
)
def collect_series_hot_key(t):
    """One series holds a third of the rows; its parts are like those of the others."""
    found = forecast.series(_hot_history(t), ["series"], _HOT_ORDER, "price")
    text = F.transform(
        "content",
        lambda x: F.concat(
            x["day"].cast("string"), F.lit("/"), x["l_orderkey"], F.lit("/"), x["l_linenumber"], F.lit("="), F.round(x["price"] * 100).cast("long")
        ),
    )
    return found.withColumn("content", F.array_join(text, ","))


@query(
    "q_last_of_day",
    """SELECT user_id, CAST(ts AS DATE) AS "queryDate", max_by(event_id, ts) AS event_id, max_by(value, ts) AS value
FROM events GROUP BY ALL""",
)
def last_of_day(t):
    seen = t.events.select("user_id", "ts", "event_id", "value")
    return enrich.last_of_day(seen, ["user_id"], "ts").select("user_id", "queryDate", "event_id", "value")


@query(
    "q_last_of_day_ties",
    """SELECT event_type, CAST(ts AS DATE) AS "queryDate", event_id FROM events
QUALIFY rank() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY date_trunc('minute', ts) DESC) = 1""",
)
def last_of_day_ties(t):
    seen = t.events.select("event_type", "ts", "event_id")
    return enrich.last_of_day_all(seen, ["event_type"], "ts").select("event_type", "queryDate", "event_id")


def _orders(t):
    return t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")


def _nearest_sql(bound: str) -> str:
    return f"""SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) >= {RUN_SQL} {bound}
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_totalprice) = 1"""


@query("q_nearest_future", _nearest_sql(""))
def nearest_future(t):
    return enrich.nearest_future(_orders(t), ["o_custkey"], "day", RUN.run_date)


@query("q_nearest_future_bounded", _nearest_sql(f"AND CAST(o_orderdate AS DATE) <= {RUN_SQL} + 31"))
def nearest_future_bounded(t):
    return enrich.nearest_future(_orders(t), ["o_custkey"], "day", RUN.run_date, max_days=31)


@query(
    "q_latest_snapshot",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_snapshot(t):
    return enrich.latest_snapshot(_orders(t), ["o_custkey"], "day")


@query(
    "q_reference_price",
    f"""WITH {HISTORY_SQL}, top AS (
  SELECT * FROM history
  QUALIFY row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY day DESC, l_orderkey DESC) <= 3)
SELECT l_partkey, l_linenumber, round(avg(price), 4) AS preceding3day_price FROM top GROUP BY ALL""",
)
def reference_price(t):
    keys = ["l_partkey", "l_linenumber"]
    found = forecast.reference_price(history(t), keys, ["day", "l_orderkey"])
    return found.withColumn("preceding3day_price", F.round("preceding3day_price", 4))
