"""Registry of checked queries and the stand-ins for fare tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...context import RunContext
from ...schemas import HOLIDAYS, NAMED_DATES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The day the checked jobs run for, in the middle of the tables' dates.
RUN = RunContext.of("1998-06-01")
RUN_SQL = f"DATE '{RUN.run_date}'"


class Tables:
    """The driver's tables, read lazily by attribute: ``Tables(spark, dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` as a query, with its oracle if there is one."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# --- fare history: lineitem, one series per part --------------------------------

HISTORY_KEYS = ["l_partkey"]
HISTORY_ORDER = ["day", "l_orderkey", "l_linenumber"]


def history(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_partkey",
        F.to_date("l_shipdate").alias("day"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
    )


HISTORY_SQL = """history AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, l_extendedprice AS price
  FROM lineitem)"""

# --- itineraries: lineitem, ship date as departure, quantity as lead days ------------


def itineraries(t: Tables) -> DataFrame:
    depart = F.to_date("l_shipdate")
    return t.lineitem.select(
        F.concat(F.lit("C"), F.col("l_suppkey") % 5, F.col("l_suppkey")).alias("fn"),
        F.concat(F.lit("C"), F.col("l_suppkey") % 5).alias("fc"),
        F.concat(F.lit("A"), F.col("l_partkey") % 25).alias("org"),
        F.concat(F.lit("A"), F.col("l_suppkey") % 25).alias("dst"),
        depart.alias("departDate"),
        F.date_sub(depart, F.col("l_quantity").cast("int")).alias("queryDate"),
        F.col("l_extendedprice").cast("int").alias("price"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_returnflag",
        "l_discount",
    )


ITINERARIES_SQL = """itineraries AS (
  SELECT 'C' || (l_suppkey % 5) || l_suppkey AS fn, 'C' || (l_suppkey % 5) AS fc,
         'A' || (l_partkey % 25) AS org, 'A' || (l_suppkey % 25) AS dst,
         CAST(l_shipdate AS DATE) AS "departDate",
         CAST(l_shipdate AS DATE) - CAST(l_quantity AS INT) AS "queryDate",
         CAST(trunc(l_extendedprice) AS INT) AS price,
         l_orderkey, l_partkey, l_linenumber, l_returnflag, l_discount
  FROM lineitem)"""


def low_prices(t: Tables) -> DataFrame:
    """``queryDate, price, id, org, dst`` of the itineraries."""
    return itineraries(t).select(
        "queryDate",
        "price",
        F.concat_ws("_", "fn", "org", "dst", F.date_format("departDate", "MM-dd")).alias("id"),
        "org",
        "dst",
    )


LOW_PRICES_SQL = f"""{ITINERARIES_SQL}, low_prices AS (
  SELECT "queryDate", price, fn || '_' || org || '_' || dst || '_' || strftime("departDate", '%m-%d') AS id, org, dst
  FROM itineraries)"""


# --- airports: nations on a made-up graticule ---------------------------------------


def airports(t: Tables) -> DataFrame:
    return t.nation.select(
        F.concat(F.lit("A"), "n_nationkey").alias("Airport_code"),
        (F.col("n_nationkey") * 3.0 - 36).alias("latitude"),
        (F.col("n_nationkey") * 13.0 - 160).alias("longitude"),
    )


AIRPORTS_SQL = """airports AS (
  SELECT 'A' || n_nationkey AS code, n_nationkey * 3.0::DOUBLE - 36 AS latitude, n_nationkey * 13.0::DOUBLE - 160 AS longitude
  FROM nation)"""

# --- holidays and named dates: small lists shared with the SQL ------------------------

YEARS = range(1994, 2003)


def _holiday_rows() -> list[tuple]:
    rows = []
    for year in YEARS:
        for name, first, days in (("spring", date(year, 2, 5), 7), ("harvest", date(year, 10, 1), 10)):
            for i in range(days):
                day = first + timedelta(days=i)
                rows.append((day.strftime("%Y%m%d"), f"{name} day {i + 1}", name, "yes", days, i + 1))
        rows.append((f"{year}1101", "lights", "lights", None, None, None))
        rows.append((f"{year}0501", "free day", None, "yes", 1, 1))
    return rows


def holidays(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(_holiday_rows(), HOLIDAYS)


def _values(rows: list[tuple]) -> str:
    cell = lambda v: "NULL" if v is None else repr(v)
    return ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)


# The calendar stated by rule: a run of a festival ends where the next day is not in it.
CALENDAR_SQL = f"""holidays(calday, calday_ln, festival, is_vacation, vacation_days, day_of_vacation) AS (
  VALUES {_values(_holiday_rows())}),
days AS (
  SELECT CAST(strptime(calday, '%Y%m%d') AS DATE) AS date, calday_ln, festival, is_vacation, vacation_days, day_of_vacation
  FROM holidays),
after_days AS (
  SELECT date + 1 AS date FROM days d WHERE festival IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM days n WHERE n.festival = d.festival AND n.date = d.date + 1)),
before_days AS (SELECT date - 1 AS date FROM days WHERE day_of_vacation = 1),
all_days AS (SELECT date FROM days UNION SELECT date FROM after_days UNION SELECT date FROM before_days),
calendar AS (
  SELECT a.date, d.calday_ln, d.festival, d.is_vacation, d.vacation_days, d.day_of_vacation,
    CASE WHEN d.day_of_vacation IS NOT NULL THEN d.day_of_vacation
         WHEN a.date IN (SELECT date FROM after_days) THEN 1001
         WHEN a.date IN (SELECT date FROM before_days) THEN -1 END AS extend
  FROM all_days a LEFT JOIN days d ON a.date = d.date)"""


def calendar_columns_sql(prefix: str, alias: str) -> str:
    """Select list of the calendar columns of one date."""
    return f"""{alias}.calday_ln AS {prefix}_calday_ln,
    coalesce({alias}.festival, '-999') AS {prefix}_festival,
    CAST({alias}.is_vacation IS NOT NULL AS INT) AS "{prefix}_isVacation",
    coalesce({alias}.vacation_days, -999) AS "{prefix}_vacationDays",
    coalesce({alias}.day_of_vacation, -999) AS {prefix}_dayofvacation,
    coalesce({alias}.extend, -999) AS {prefix}_dayofvacation_extend,
    CAST({alias}.festival IS NOT NULL AS INT) AS "{prefix}_isFestival\""""


def date_parts_sql(column: str, prefix: str, bucket: bool = True) -> str:
    dow = f"isodow({column})"
    extra = f'CAST(CASE WHEN {dow} < 5 THEN 0 ELSE {dow} END AS INT) AS {prefix}_dayofweek_bucket,' if bucket else ""
    return f"""CAST(year({column}) AS INT) AS "{prefix}Year", CAST(month({column}) AS INT) AS "{prefix}Month",
    CAST(day({column}) AS INT) AS {prefix}_dayofmonth, CAST(week({column}) AS INT) AS {prefix}_weekofyear,
    CAST({dow} AS INT) AS {prefix}_dayofweek, {extra}
    CAST(quarter({column}) AS INT) AS "{prefix}Quarter\""""


def lead_times_sql(depart: str, query: str) -> str:
    months = f"(year({depart}) - year({query})) * 12 + month({depart}) - month({query})"
    whole = f"day({depart}) = day({query}) OR ({depart} = last_day({depart}) AND {query} = last_day({query}))"
    between = f"CASE WHEN {whole} THEN CAST({months} AS DOUBLE) ELSE {months} + (day({depart}) - day({query})) / 31.0::DOUBLE END"
    return f"""CAST({depart} - {query} AS INT) AS "intervalDays", round({between}) + 0.0::DOUBLE AS "intervalMonths",
    round(({depart} - {query}) / 7.0::DOUBLE) + 0.0::DOUBLE AS "intervalWeeks",
    round(({depart} - {query}) / 120.0::DOUBLE) + 0.0::DOUBLE AS "intervalQuarters\""""


def _named_rows() -> list[tuple]:
    return [(f"{y}-{name}-8", date(y, *md)) for y in YEARS for name, md in (("Spring", (2, 12)), ("Harvest", (10, 8)))]


def named_dates(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(_named_rows(), NAMED_DATES)


NAMED_DATES_SQL = f"""named(description, date) AS (
  SELECT d, CAST(t AS DATE) FROM (VALUES {_values([(d, str(t)) for d, t in _named_rows()])}) v(d, t))"""

# --- international history: lineitem with a route of five parts ------------------------


def intl_history(t: Tables) -> DataFrame:
    """``flineId, predictDate, price`` plus the line's own keys to break ties."""
    i = itineraries(t)
    cabin = F.when(F.col("l_returnflag") == "N", "Y").otherwise("F")
    tail = F.when(F.col("l_linenumber") == 1, "Spring-8").when(F.col("l_linenumber") == 2, "Harvest-8").otherwise(
        F.date_format("departDate", "MM-dd")
    )
    return i.select(
        F.concat_ws("_", "org", "fc", F.lit("OW"), cabin, F.lit("D"), tail).alias("flineId"),
        F.col("queryDate").alias("predictDate"),
        "price",
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
    )


INTL_SQL = f"""{ITINERARIES_SQL}, {NAMED_DATES_SQL}, raw_intl AS (
  SELECT org, fc AS dst, 'OW' AS "isReturn_type", CASE WHEN l_returnflag = 'N' THEN 'Y' ELSE 'F' END AS cabin, 'D' AS "isDirect_type",
    CASE WHEN l_linenumber = 1 THEN 'Spring-8' WHEN l_linenumber = 2 THEN 'Harvest-8' ELSE strftime("departDate", '%m-%d') END AS tail,
    "queryDate" AS "predictDate", price, l_orderkey, l_partkey, l_linenumber
  FROM itineraries),
described AS (
  SELECT *, (CASE WHEN tail > strftime("predictDate", '%m-%d') THEN year("predictDate") ELSE year("predictDate") + 1 END) || '-' || tail AS description
  FROM raw_intl WHERE cabin = 'Y' AND price > 0),
intl AS (
  SELECT d.* EXCLUDE (description, tail, cabin), org || '_' || dst || '_OW_Y_D' AS "flineId_noDate",
    coalesce(n.date, CAST(try_strptime(d.description, '%Y-%m-%d') AS DATE)) AS "departDate"
  FROM described d LEFT JOIN named n ON n.description = d.description)"""
