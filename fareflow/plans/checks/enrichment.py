"""Dimension joins and the complete feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fares
from ...operators import enrich, features, forecast, hot, labels, windows
from ...schemas import INDEXED, MODEL_COLUMNS
from .. import domestic
from .registry import (
    AIRPORTS_SQL,
    CALENDAR_SQL,
    ITINERARIES_SQL,
    LOW_PRICES_SQL,
    RUN,
    RUN_SQL,
    Tables,
    airports,
    calendar_columns_sql,
    date_parts_sql,
    holidays,
    itineraries,
    lead_times_sql,
    low_prices,
    query,
)

_LINE = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_SQL = "l_orderkey, l_partkey, l_linenumber"

# --- raw dimension tables -----------------------------------------------------------


def list_fares(t: Tables):
    """List fares from orders: carrier and ends by customer and order key."""
    route = [F.concat(F.lit("A"), F.col("o_custkey") % 25), F.concat(F.lit("A"), F.col("o_orderkey") % 25)]
    return t.orders.select(
        F.concat_ws("_", *route, F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("fd")).alias("orgPrice_id"),
        F.concat(F.lit("C"), F.col("o_custkey") % 5).alias("fc"),
        F.col("o_totalprice").cast("int").alias("orgPrice"),
    )


def seats(t: Tables):
    """Seat snapshots of returned lines, one or more hours into the query day."""
    i = itineraries(t).filter(F.col("l_returnflag") == "R")
    return i.select(
        F.expr("timestampadd(HOUR, l_linenumber, cast(queryDate AS timestamp))").alias("queryDatetime"),
        F.concat((F.col("l_discount") * 1000).cast("int"), F.lit("%")).alias("seatLeft"),
        F.concat_ws("_", "fn", "org", "dst", F.date_format("departDate", "MM-dd")).alias("seatLeft_id"),
    )


def flight_info(t: Tables):
    i = itineraries(t)
    at = lambda plus: F.concat(F.lpad((F.col("l_linenumber") + plus).cast("string"), 2, "0"), F.lit(":30"))
    return i.select(
        F.concat_ws("_", "org", "dst", "fn", F.date_format("departDate", "yyyy-MM-dd")).alias("infoBase_id"),
        at(0).alias("departTime"),
        at(3).alias("arriveTime"),
        F.when(F.col("l_returnflag") == "A", "True").when(F.col("l_returnflag") == "N", "False").alias("isShare"),
    )


def dimensions(t: Tables) -> domestic.Dimensions:
    return domestic.Dimensions(airports(t), list_fares(t), seats(t), flight_info(t), holidays(t))


DIMENSIONS_SQL = f"""{AIRPORTS_SQL}, list_fare AS (
  SELECT 'C' || (o_custkey % 5) AS fc, 'A' || (o_custkey % 25) AS org, 'A' || (o_orderkey % 25) AS dst,
    CAST(trunc(o_totalprice) AS INT) AS "orgPrice"
  FROM orders WHERE CAST(o_orderdate AS DATE) >= {RUN_SQL}
  QUALIFY row_number() OVER (PARTITION BY 1, 2, 3 ORDER BY o_orderdate, trunc(o_totalprice)) = 1),
seat AS (
  SELECT fn, org, dst, "departDate", "queryDate", CAST(trunc(l_discount * 1000) AS DOUBLE) AS "seatLeft"
  FROM itineraries WHERE l_returnflag = 'R' AND {RUN_SQL} - "queryDate" < 100
  QUALIFY row_number() OVER (PARTITION BY fn, org, dst, strftime("departDate", '%m-%d'), "queryDate"
    ORDER BY l_linenumber DESC, CAST(trunc(l_discount * 1000) AS INT) || '%' DESC) = 1),
info AS (
  SELECT fn, org, dst, lpad(l_linenumber::VARCHAR, 2, '0') || ':30' AS "departTime",
    lpad((l_linenumber + 3)::VARCHAR, 2, '0') || ':30' AS "arriveTime", CAST(l_returnflag = 'A' AS INT) AS "isShare"
  FROM itineraries WHERE "departDate" >= {RUN_SQL} AND l_returnflag IN ('A', 'N')
  QUALIFY row_number() OVER (PARTITION BY fn, org, dst ORDER BY "departDate", l_linenumber, CAST(l_returnflag = 'A' AS INT)) = 1)"""
DIMENSIONS_SQL = DIMENSIONS_SQL.replace("PARTITION BY 1, 2, 3", "PARTITION BY o_custkey % 5, o_custkey % 25, o_orderkey % 25")

_DISTANCE_SQL = """CAST(ceil(2 * asin(sqrt(least(pow(sin((radians({b}.latitude) - radians({a}.latitude)) / 2), 2)
    + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin((radians({b}.longitude) - radians({a}.longitude)) / 2), 2), 1.0::DOUBLE))) * 6371) AS INT)"""
DISTANCE_SQL = _DISTANCE_SQL.format(a="a", b="b")
_ENDS_SQL = """a.latitude AS org_latitude, a.longitude AS org_longitude, b.latitude AS dst_latitude, b.longitude AS dst_longitude"""


@query(
    "q_geo_enrich",
    f"""WITH {ITINERARIES_SQL}, {AIRPORTS_SQL}
SELECT {_LINE_SQL}, org, dst, {_ENDS_SQL}, {DISTANCE_SQL} AS distance
FROM itineraries JOIN airports a ON org = a.code JOIN airports b ON dst = b.code""",
)
def geo_enrich(t):
    return enrich.with_distance(itineraries(t).select(*_LINE, "org", "dst"), airports(t))


_EXACT_SQL = """2 * 6371 * asin(sqrt(least(1, pow(sin(radians(b.latitude - a.latitude) / 2), 2)
    + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2))))"""


@query(
    "q_distance_decimals",
    f"""WITH {ITINERARIES_SQL}, {AIRPORTS_SQL}, pairs AS (SELECT DISTINCT org, dst FROM itineraries)
SELECT org, dst, round({_EXACT_SQL}, 2) AS distance FROM pairs JOIN airports a ON org = a.code JOIN airports b ON dst = b.code""",
)
def distance_decimals(t):
    """Distances of all routes to two decimals."""
    located = enrich.with_distance(itineraries(t).select("org", "dst").distinct(), airports(t))
    ends = ("org_longitude", "org_latitude", "dst_longitude", "dst_latitude")
    return located.select("org", "dst", fares.distance_km(*ends, digits=2).alias("distance"))


def _enriched_sql(rows: str) -> str:
    return f"""SELECT r.*, {_ENDS_SQL}, {DISTANCE_SQL} AS distance, "orgPrice",
    CASE WHEN "orgPrice" <> 0 THEN CAST(round(CAST(CAST(price / "orgPrice" AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) END AS discount,
    "departTime", "arriveTime", "isShare", "seatLeft"
  FROM {rows} r JOIN airports a ON r.org = a.code JOIN airports b ON r.dst = b.code
  JOIN list_fare USING (fc, org, dst) JOIN info USING (fn, org, dst)
  LEFT JOIN seat USING (fn, org, dst, "departDate", "queryDate")"""


@query("q_fare_enrich", f"WITH {ITINERARIES_SQL}, {DIMENSIONS_SQL} {_enriched_sql('itineraries')}")
def fare_enrich(t):
    run = RUN.run_date
    return enrich.itinerary(
        itineraries(t),
        airports(t),
        enrich.list_fares(list_fares(t), run),
        enrich.seat_loads(features.fresh(seats(t), run, "queryDatetime")),
        enrich.flight_info(flight_info(t), run),
    )


# --- complete feature table -------------------------------------------------------------

_FEATURES_SQL = f"""enriched AS ({_enriched_sql('labelled')}),
attached AS (
  SELECT e.*, {calendar_columns_sql('depart', 'd')}, {calendar_columns_sql('query', 'q')}
  FROM enriched e LEFT JOIN calendar d ON d.date = "departDate" LEFT JOIN calendar q ON q.date = "queryDate"),
built AS (
  SELECT * EXCLUDE ("departTime", "arriveTime"), CAST(split_part("departTime", ':', 1) AS INT) AS "departTime",
    CAST(split_part("arriveTime", ':', 1) AS INT) AS "arriveTime",
    {date_parts_sql('"departDate"', 'depart')}, {date_parts_sql('"queryDate"', 'query')}, {lead_times_sql('"departDate"', '"queryDate"')},
    CAST(least(greatest(floor(CAST(round(CAST(CAST((1 - price / "orgPrice") * 100 AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)), -1), 99) + 1 AS DOUBLE) AS "discountOffBucket",
    CAST(least(floor(distance / 300), 20) AS DOUBLE) AS "distanceBucket",
    CAST(least(greatest(floor(coalesce("seatLeft", -999)), -1), 103) + 1 AS DOUBLE) AS "seatLeftBucket"
  FROM attached),
cells AS (UNPIVOT (SELECT {', '.join(INDEXED)} FROM built) ON COLUMNS(*) INTO NAME feature VALUE value),
ranks AS (
  SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) - 1 AS DOUBLE) AS idx
  FROM cells GROUP BY feature, value)"""


def _index_join(column: str) -> str:
    return f"LEFT JOIN (SELECT value, idx FROM ranks WHERE feature = '{column}') x_{column} ON x_{column}.value = built.{column}"


def _model_column(column: str) -> str:
    plain = column.removeprefix("stringIndexer_")
    return f'x_{plain}.idx AS "{column}"' if plain != column else f'built."{column}"'


_MODEL_SQL = f"""SELECT {', '.join(_model_column(c) for c in MODEL_COLUMNS)}
FROM built {' '.join(_index_join(c) for c in INDEXED)}"""


@query(
    "q_feature_table",
    f"""WITH {ITINERARIES_SQL}, {DIMENSIONS_SQL}, {CALENDAR_SQL}, seen AS (
  SELECT *, org || '_' || dst AS city_code, count(*) OVER (PARTITION BY l_partkey) AS n,
    min(price) OVER (PARTITION BY l_partkey ORDER BY "departDate", l_orderkey, l_linenumber ROWS BETWEEN 2 FOLLOWING AND UNBOUNDED FOLLOWING) AS "futureMinPrice",
    lead(price) OVER (PARTITION BY l_partkey ORDER BY "departDate", l_orderkey, l_linenumber) AS nxt
  FROM itineraries WHERE "departDate" - "queryDate" <= 30),
labelled AS (
  SELECT * EXCLUDE (n, nxt), CAST("futureMinPrice" / nxt BETWEEN 0 AND 0.96 AS INT) AS trend FROM seen
  WHERE n >= 15 AND "futureMinPrice" IS NOT NULL AND nxt IS NOT NULL), {_FEATURES_SQL} {_MODEL_SQL}""",
)
def feature_table(t):
    """History of parts instead of itineraries: those are long enough to label."""
    rows = features.within_lead(itineraries(t)).withColumn("city_code", F.concat_ws("_", "org", "dst"))
    labelled = labels.trend(rows, ["l_partkey"], ["departDate", "l_orderkey", "l_linenumber"], bound=t.lineitem)
    run = RUN.run_date
    enriched = enrich.itinerary(
        labelled,
        airports(t),
        enrich.list_fares(list_fares(t), run),
        enrich.seat_loads(features.fresh(seats(t), run, "queryDatetime")),
        enrich.flight_info(flight_info(t), run),
    )
    return domestic.feature_table(enriched, holidays(t))


_ONLINE_SQL = f"""latest AS (
  SELECT * FROM low_prices QUALIFY row_number() OVER (PARTITION BY id ORDER BY "queryDate" DESC, price DESC) = 1),
usable AS (
  SELECT *, split_part(id, '_', 1) AS fn, substr(id, 1, 2) AS fc, org || '_' || dst AS city_code,
    CAST(try_strptime((year("queryDate") + CASE WHEN strftime("queryDate", '%m-%d') > split_part(id, '_', 4) THEN 1 ELSE 0 END)
      || '-' || split_part(id, '_', 4), '%Y-%m-%d') AS DATE) AS "departDate"
  FROM latest WHERE price < 100000 AND {RUN_SQL} - "queryDate" <= 14),
online AS (
  SELECT CAST({RUN_SQL} - 1 AS DATE) AS "queryDate", price, org, dst, fn, fc, city_code, "departDate",
    CAST(NULL AS INT) AS "futureMinPrice", CAST(NULL AS INT) AS trend
  FROM usable WHERE "departDate" IS NOT NULL)"""


@query("q_online_frame", f"WITH {LOW_PRICES_SQL}, {_ONLINE_SQL} SELECT * FROM online")
def online_frame(t):
    return forecast.online_frame(low_prices(t), RUN.run_date)


@query(
    "q_online_features",
    f"""WITH {LOW_PRICES_SQL}, {DIMENSIONS_SQL}, {CALENDAR_SQL}, {_ONLINE_SQL},
labelled AS (SELECT * FROM online), {_FEATURES_SQL} {_MODEL_SQL}""",
)
def online_features(t):
    rows = domestic.online_rows(low_prices(t), dimensions(t), RUN)
    return domestic.feature_table(rows, holidays(t))


def _asof_sql(key: str) -> str:
    return f"""WITH o AS (SELECT o_orderkey, {key} AS customer, CAST(o_orderdate AS DATE) AS day FROM orders),
done AS (SELECT {key} AS customer, CAST(o_orderdate AS DATE) AS done_day, min(o_orderkey) AS done_order FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
found AS (SELECT o.*, d.done_day, d.done_order FROM o ASOF LEFT JOIN done d ON o.customer = d.customer AND o.day <= d.done_day)
SELECT o_orderkey, customer, day, CASE WHEN done_day - day <= 400 THEN done_day END AS done_day, CASE WHEN done_day - day <= 400 THEN done_order END AS done_order FROM found"""


def _as_of(t, key, policy):
    day, customer = F.to_date("o_orderdate"), F.expr(key).alias("customer")
    rows = t.orders.select("o_orderkey", customer, day.alias("day"))
    done = t.orders.filter("o_orderstatus = 'F'").select(customer, day.alias("done_day"), F.col("o_orderkey").alias("done_order"))
    return windows.as_of_next(rows, done, ["customer"], "day", "done_day", 400, policy)


@query("q_asof_forward", _asof_sql("o_custkey"))
def asof_forward(t):
    """Each order with its customer's next finished one, at most 400 days ahead."""
    return _as_of(t, "o_custkey", hot.DEFAULT)


@query("q_asof_forward_hot_key", _asof_sql("o_custkey % 3"))
def asof_forward_hot_key(t):
    """The same for three customers with all orders, each cut into segments."""
    return _as_of(t, "o_custkey % 3", hot.HotPolicy(rows_per_task=400))
