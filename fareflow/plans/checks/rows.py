"""Keys, filters, missing values, scalar columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import dates, fares, keys as ids
from ...operators import calendar as holiday_calendar
from ...operators import features, metrics
from ...schemas import MISSING
from .registry import (
    ITINERARIES_SQL,
    LOW_PRICES_SQL,
    NAMED_DATES_SQL,
    RUN,
    RUN_SQL,
    date_parts_sql,
    itineraries,
    lead_times_sql,
    low_prices,
    named_dates,
    query,
)

_LINE = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_SQL = "l_orderkey, l_partkey, l_linenumber"


@query(
    "q_key_parse",
    f"""WITH {ITINERARIES_SQL}
SELECT {_LINE_SQL}, fn, fc, org || '_' || dst AS city_code, strftime("departDate", '%m-%d') AS depart_md,
  org, dst, "departDate", CAST(NULL AS VARCHAR) AS missing
FROM itineraries""",
)
def key_parse(t):
    i = itineraries(t)
    day = F.date_format("departDate", "yyyy-MM-dd")
    texts = i.select(
        *_LINE,
        ids.build("fn", "org", "dst", F.date_format("departDate", "MM-dd")).alias("id"),
        ids.build_list_fare("org", "dst", "departDate").alias("orgPrice_id"),
        ids.build("org", "dst", "fn", day).alias("infoBase_id"),
    )
    low = ids.parse_low_price(texts).drop("fn")
    listed = ids.parse_list_fare(low).drop("org", "dst")
    info = ids.parse_flight_info(listed.drop("departDate"))
    return info.select(
        *_LINE, "fn", "fc", "city_code", "depart_md", "org", "dst", "departDate", ids.part("id", 9).alias("missing")
    )


@query(
    "q_key_parse_route",
    f"""WITH {ITINERARIES_SQL}
SELECT {_LINE_SQL}, org, fc AS dst, 'OW' AS "isReturn_type", 'Y' AS cabin, 'D' AS "isDirect_type",
  org || '_' || fc || '_OW_Y_D' AS "flineId_noDate", strftime("departDate", '%m-%d') AS depart_text,
  org || '_' || fc || '_OW_D_' || strftime("departDate", '%m') AS route
FROM itineraries""",
)
def key_parse_route(t):
    texts = itineraries(t).select(
        *_LINE,
        "departDate",
        F.concat_ws("_", "org", "fc", F.lit("OW_Y_D"), F.date_format("departDate", "MM-dd")).alias("flineId"),
    )
    route = ids.route_without_cabin("flineId_noDate", F.date_format("departDate", "MM")).alias("route")
    return ids.parse_international(texts).select(
        *_LINE, "org", "dst", "isReturn_type", "cabin", "isDirect_type", "flineId_noDate", "depart_text", route
    )


@query(
    "q_key_build",
    f"""WITH {ITINERARIES_SQL}
SELECT {_LINE_SQL}, fn || '_' || org || '_' || dst || '_' || "departDate" AS _id,
  org || '_' || dst || '_' || "departDate" || '_fd' AS "orgPrice_id",
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE fn || '_' || l_returnflag END AS partial
FROM itineraries""",
)
def key_build(t):
    flag = F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))
    return itineraries(t).select(
        *_LINE,
        ids.build("fn", "org", "dst", F.date_format("departDate", "yyyy-MM-dd")).alias("_id"),
        ids.build_list_fare("org", "dst", "departDate").alias("orgPrice_id"),
        ids.build("fn", flag).alias("partial"),
    )


def _depart_year_sql(compare: str) -> str:
    resolved = f"""year("queryDate") + CASE WHEN strftime("queryDate", '%m-%d') {compare} md THEN 1 ELSE 0 END"""
    return f"""WITH {ITINERARIES_SQL}, parts AS (
  SELECT {_LINE_SQL}, "queryDate", strftime("departDate" + l_linenumber - 1, '%m-%d') AS md FROM itineraries)
SELECT {_LINE_SQL}, "queryDate", md, CAST(try_strptime(({resolved}) || '-' || md, '%Y-%m-%d') AS DATE) AS resolved FROM parts"""


def _depart_year(t, on_equal):
    shifted = F.expr("date_add(departDate, l_linenumber - 1)")
    i = itineraries(t).select(*_LINE, "queryDate", F.date_format(shifted, "MM-dd").alias("md"))
    return i.withColumn("resolved", ids.resolve_depart_date("queryDate", "md", on_equal))


@query("q_depart_year", _depart_year_sql(">"))
def depart_year(t):
    return _depart_year(t, "same")


@query("q_depart_year_next", _depart_year_sql(">="))
def depart_year_next(t):
    return _depart_year(t, "next")


@query(
    "q_symbolic_dates",
    f"""WITH {NAMED_DATES_SQL}, tails AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS seen,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Spring-8' WHEN '2-HIGH' THEN 'Harvest-8' WHEN '3-MEDIUM' THEN 'Nowhere-8'
      ELSE strftime(o_orderdate + INTERVAL 20 DAY, '%m-%d') END AS tail FROM orders),
described AS (
  SELECT *, (year(seen) + CASE WHEN tail > strftime(seen, '%m-%d') THEN 0 ELSE 1 END) || '-' || tail AS description FROM tails)
SELECT o_orderkey, seen, tail, coalesce(date, CAST(try_strptime(d.description, '%Y-%m-%d') AS DATE)) AS "departDate"
FROM described d LEFT JOIN named n ON d.description = n.description""",
)
def symbolic_dates(t):
    priority = F.col("o_orderpriority")
    tail = (
        F.when(priority == "1-URGENT", "Spring-8")
        .when(priority == "2-HIGH", "Harvest-8")
        .when(priority == "3-MEDIUM", "Nowhere-8")
        .otherwise(F.date_format(F.date_add("o_orderdate", 20), "MM-dd"))
    )
    seen = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("seen"), tail.alias("tail"))
    return holiday_calendar.resolve_symbolic(seen, named_dates(t), "tail", "seen")


@query(
    "q_percent_parse",
    """WITH texts AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
    CASE l_returnflag WHEN 'A' THEN CAST(l_quantity AS INT) || '%' WHEN 'N' THEN '%' ELSE '' END AS seat_text FROM lineitem)
SELECT *, TRY_CAST(split_part(seat_text, '%', 1) AS DOUBLE) AS seats FROM texts""",
)
def percent_parse(t):
    flag = F.col("l_returnflag")
    text = (
        F.when(flag == "A", F.concat(F.col("l_quantity").cast("int"), F.lit("%"))).when(flag == "N", "%").otherwise("")
    )
    return t.lineitem.select(*_LINE, text.alias("seat_text")).withColumn("seats", fares.percent("seat_text"))


def _rounded(ratio: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({ratio} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


@query(
    "q_discount",
    f"""SELECT l_orderkey, l_partkey, l_linenumber,
  {_rounded('l_extendedprice / nullif(p_size - 1, 0)', 2)} AS ratio,
  {_rounded('l_extendedprice / nullif(p_size - 1, 0) * 100', 1)} AS percent,
  {_rounded('l_extendedprice / p_retailprice * 100', 2)} AS percent2,
  {_rounded('(1 - l_extendedprice / p_retailprice) * 100', 2)} AS off
FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def discount(t):
    # p_size - 1 is 0 for some parts: no list price.
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    own, size, listed = "l_extendedprice", F.col("p_size") - 1, "p_retailprice"
    return lines.select(
        *_LINE,
        fares.discount(own, size).alias("ratio"),
        fares.discount(own, size, "percent").alias("percent"),
        fares.discount(own, listed, "percent2").alias("percent2"),
        fares.discount(own, listed, "off").alias("off"),
    )


@query(
    "q_date_parts",
    f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, {date_parts_sql('d', 'depart')} FROM o""",
)
def date_parts(t):
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return orders.withColumns(dates.date_parts("d", "depart")).drop("d")


@query(
    "q_leadtime_features",
    f"""WITH {ITINERARIES_SQL} SELECT {_LINE_SQL}, {lead_times_sql('"departDate"', '"queryDate"')} FROM itineraries""",
)
def leadtime_features(t):
    i = itineraries(t)
    return i.withColumns(dates.lead_times("departDate", "queryDate")).select(
        *_LINE, "intervalDays", "intervalMonths", "intervalWeeks", "intervalQuarters"
    )


@query(
    "q_hour_of_day",
    "SELECT event_id, strftime(ts, '%H:%M') AS at, CAST(hour(ts) AS INT) AS hour FROM events",
)
def hour_of_day(t):
    seen = t.events.select("event_id", F.date_format("ts", "HH:mm").alias("at"))
    return seen.withColumn("hour", dates.hour_of("at"))


_GRADED_SQL = "SELECT d.doc_id, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _graded(t):
    """Documents with their labels, which only some of them have."""
    return t.documents.select("doc_id", "source", "n_chars").join(t.labels, "doc_id", "left")


@query("q_dropna_subset", f"SELECT * FROM ({_GRADED_SQL}) WHERE quality IS NOT NULL")
def dropna_subset(t):
    return _graded(t).dropna(how="any", subset=["quality"])


@query(
    "q_na_fill",
    f"SELECT doc_id, source, n_chars, coalesce(quality, -999) AS quality, coalesce(toxic, -1) AS toxic FROM ({_GRADED_SQL})",
)
def na_fill(t):
    return _graded(t).na.fill({"quality": str(MISSING), "toxic": -1})


@query(
    "q_price_bounds",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice * 2 AS price FROM lineitem
WHERE l_extendedprice * 2 < 100000 AND l_extendedprice * 2 > 0""",
)
def price_bounds(t):
    doubled = t.lineitem.select(*_LINE, (F.col("l_extendedprice") * 2).alias("price"))
    return doubled.filter(fares.sane_price("price") & (F.col("price") > 0))


@query(
    "q_freshness",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS "queryDate" FROM orders WHERE {RUN_SQL} - CAST(o_orderdate AS DATE) < 100""",
)
def freshness(t):
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("queryDate"))
    return features.fresh(orders, RUN.run_date)


@query(
    "q_lead_window",
    f"""WITH {ITINERARIES_SQL} SELECT {_LINE_SQL}, "departDate", "queryDate" FROM itineraries WHERE "departDate" - "queryDate" <= 30""",
)
def lead_window(t):
    return features.within_lead(itineraries(t)).select(*_LINE, "departDate", "queryDate")


@query(
    "q_lookback_window",
    f"""WITH {ITINERARIES_SQL} SELECT {_LINE_SQL}, "departDate", "queryDate" FROM itineraries
WHERE "queryDate" > "departDate" - 40 AND "queryDate" <= "departDate\"""",
)
def lookback_window(t):
    return features.look_back(itineraries(t), 40, query="queryDate").select(*_LINE, "departDate", "queryDate")


@query(
    "q_domestic_history",
    f"""WITH {LOW_PRICES_SQL}, dated AS (
  SELECT *, CAST(try_strptime((year("queryDate") + CASE WHEN strftime("queryDate", '%m-%d') > split_part(id, '_', 4) THEN 1 ELSE 0 END)
    || '-' || split_part(id, '_', 4), '%Y-%m-%d') AS DATE) AS "departDate"
  FROM low_prices WHERE price < 100000 AND {RUN_SQL} - "queryDate" < 100)
SELECT "queryDate", price, org, dst, split_part(id, '_', 1) AS fn, substr(id, 1, 2) AS fc,
  split_part(id, '_', 2) || '_' || split_part(id, '_', 3) AS city_code, "departDate"
FROM dated WHERE "departDate" < {RUN_SQL} AND "departDate" - "queryDate" <= 30""",
)
def domestic_history(t):
    return features.domestic_history(low_prices(t), RUN.run_date)


@query(
    "q_to_json",
    """SELECT s_suppkey, '{"name":"' || s_name || '","nation":' || s_nationkey || ',"pair":[' || s_suppkey || ',' || s_nationkey || ']}' AS doc
FROM supplier""",
)
def to_json(t):
    pair = F.array("s_suppkey", F.col("s_nationkey").cast("long"))
    return t.supplier.select("s_suppkey", fares.document({"name": "s_name", "nation": "s_nationkey", "pair": pair}).alias("doc"))


@query("q_hash_bucket_rules", "SELECT p_name, 1::BIGINT AS buckets, true AS in_range FROM part GROUP BY p_name")
def hash_bucket_rules(t):
    """A name has one bucket, and it is in range."""
    bucket = fares.hash_bucket("p_name")
    return t.part.groupBy("p_name").agg(F.count_distinct(bucket).alias("buckets"), F.bool_and(bucket.between(0, 59)).alias("in_range"))


@query("q_hash_bucket")
def hash_bucket(t):
    return t.part.select("p_partkey", fares.hash_bucket("p_name").alias("nameHashBucket"))


@query(
    "q_mape",
    "SELECT round(avg(abs(l_quantity * 1500 - l_extendedprice) / l_extendedprice), 6) AS mape FROM lineitem",
)
def mape(t):
    lines = t.lineitem.withColumn("guess", F.col("l_quantity") * 1500)
    return metrics.mape(lines, "l_extendedprice", "guess").select(F.round("mape", 6).alias("mape"))


_GUESSED_SQL = "SELECT quality, CAST(n_chars > 800 AS INT) AS guess, n_chars FROM labels JOIN documents USING (doc_id)"


def _guessed(t):
    long = (F.col("n_chars") > 800).cast("int")
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").withColumn("guess", long)


def _confusion_sql(positive: int) -> str:
    return f"""WITH g AS ({_GUESSED_SQL}), c AS (
  SELECT count(*) FILTER (quality = {positive} AND guess = {positive}) AS tp, count(*) FILTER (quality <> {positive} AND guess = {positive}) AS fp,
    count(*) FILTER (quality = {positive} AND guess <> {positive}) AS fn, count(*) FILTER (quality <> {positive} AND guess <> {positive}) AS tn FROM g)
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
  round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c"""


def _confusion(t, positive):
    counted = metrics.confusion(_guessed(t), "quality", "guess", positive)
    return counted.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "accuracy")})


@query("q_confusion", _confusion_sql(1))
def confusion(t):
    return _confusion(t, 1)


@query("q_confusion_class0", _confusion_sql(0))
def confusion_class0(t):
    return _confusion(t, 0)


@query(
    "q_auc",
    f"""WITH g AS ({_GUESSED_SQL}), r AS (
  SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE AS mid FROM g)
SELECT round((sum(mid) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (quality = 1) * count(*) FILTER (quality <> 1)), 9) AS auc FROM r""",
)
def auc(t):
    return metrics.auc(_guessed(t), "quality", "n_chars").select(F.round("auc", 9).alias("auc"))
