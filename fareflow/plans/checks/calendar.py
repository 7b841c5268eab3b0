"""Holiday calendar and the international feature history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import calendar as holiday_calendar
from ...operators import features
from .registry import (
    CALENDAR_SQL,
    INTL_SQL,
    ITINERARIES_SQL,
    calendar_columns_sql,
    date_parts_sql,
    holidays,
    intl_history,
    itineraries,
    lead_times_sql,
    named_dates,
    query,
)

_LINE = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_SQL = "l_orderkey, l_partkey, l_linenumber"


@query(
    "q_calendar_features",
    f"""WITH {ITINERARIES_SQL}, {CALENDAR_SQL}
SELECT {_LINE_SQL}, "departDate", "queryDate", {calendar_columns_sql('depart', 'd')}, {calendar_columns_sql('query', 'q')}
FROM itineraries LEFT JOIN calendar d ON d.date = "departDate" LEFT JOIN calendar q ON q.date = "queryDate\"""",
)
def calendar_features(t):
    calendar = holiday_calendar.build(holidays(t))
    rows = itineraries(t).select(*_LINE, "departDate", "queryDate")
    return holiday_calendar.attach(rows, calendar, {"departDate": "depart", "queryDate": "query"})


_INTL_COLUMNS = '"flineId_noDate", org, dst, "isReturn_type", "isDirect_type", "predictDate", "departDate", price'
INTL_FEATURES_SQL = f"""{INTL_SQL}, {CALENDAR_SQL}, known AS (
  SELECT {_INTL_COLUMNS}, {_LINE_SQL}, coalesce(c.is_vacation, 'no') AS is_vacation,
    coalesce(c.vacation_days, 0) AS vacation_days, coalesce(c.day_of_vacation, 0) AS day_of_vacation
  FROM intl LEFT JOIN calendar c ON c.date = "departDate" WHERE "departDate" IS NOT NULL)"""


@query("q_intl_features", f"WITH {INTL_FEATURES_SQL} SELECT * FROM known")
def intl_features(t):
    return features.international(intl_history(t), named_dates(t), holiday_calendar.build(holidays(t)))


_ROUTE_DAY = 'PARTITION BY "flineId_noDate", "intervalDays" ORDER BY "departDate", l_orderkey, l_partkey, l_linenumber'


@query(
    "q_intl_history",
    f"""WITH {INTL_FEATURES_SQL}, dated AS (
  SELECT *, {date_parts_sql('"departDate"', 'depart', bucket=False)}, {lead_times_sql('"departDate"', '"predictDate"')} FROM known)
SELECT *, round(coalesce(avg(price) OVER ({_ROUTE_DAY} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), price), 4) AS preceding3day_price
FROM dated""",
)
def intl_history_features(t):
    raw = intl_history(t)
    known = features.international(raw, named_dates(t), holiday_calendar.build(holidays(t)))
    past = features.international_history(known, _LINE, bound=raw)
    return past.withColumn("preceding3day_price", F.round("preceding3day_price", 4))
