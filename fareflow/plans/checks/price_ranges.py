"""Price ranges per route and month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ...context import materialize
from ...operators import calendar as holiday_calendar
from ...operators import features, ranges
from .. import price_ranges
from .registry import INTL_SQL, ITINERARIES_SQL, Tables, holidays, intl_history, itineraries, named_dates, query

_CUTS_SQL = "[" + ", ".join(str(c) for c in ranges.CUTS) + "]"
_P = [f"p{round(c * 100):02d}" for c in ranges.CUTS]


def fares_by_day(t: Tables):
    """``flineId, predictDate, price``: one id per carrier and departure day."""
    return itineraries(t).select(
        F.concat_ws("_", "fc", F.lit("AAA_BBB"), F.date_format("departDate", "MM-dd")).alias("flineId"),
        F.col("queryDate").alias("predictDate"),
        "price",
    )


def averages_by_day(t: Tables):
    """``flineId, departDate, avgPrice`` with two kinds of date text."""
    short = F.date_format("o_orderdate", "MM-dd")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(short)
    return t.orders.select(
        F.concat(F.lit("R"), F.col("o_custkey") % 40, F.lit("_BBB_OW")).alias("flineId"),
        text.alias("departDate"),
        F.col("o_totalprice").alias("avgPrice"),
    )


# The year rule matters only for days that do not exist: seen from the year
# before, a departure on 29 February cannot be resolved.
_BY_DAY_SQL = f"""{ITINERARIES_SQL}, by_day AS (
  SELECT fc || '_AAA_BBB_' || strftime("departDate", '%m-%d') AS id, fc || '_AAA_BBB_' || strftime("departDate", '%m') AS route,
    "queryDate" AS q, price, CAST(try_strptime((year("queryDate") + CASE WHEN strftime("queryDate", '%m-%d') >= strftime("departDate", '%m-%d') THEN 1 ELSE 0 END)
      || '-' || strftime("departDate", '%m-%d'), '%Y-%m-%d') AS DATE) AS d
  FROM itineraries),
in_window AS (SELECT * FROM by_day WHERE q > d - 50 AND q <= d)"""


def _average_sql(min_count: int) -> str:
    return f"""day_average AS (
  SELECT id, any_value(route) AS route, round(avg(price)) AS a FROM in_window GROUP BY id HAVING count(*) >= {min_count}),
range_avg AS (SELECT route AS _id, min(a) AS avg_low, max(a) AS avg_high FROM day_average GROUP BY route)"""


def _percentile_columns(source: str) -> str:
    return ", ".join(f"{source}[{i + 1}] AS {p}" for i, p in enumerate(_P))


def _flat_range(df):
    low, high = (F.get("priceRange_baseAvg", F.lit(i)) for i in (0, 1))
    return df.select("_id", low.alias("avg_low"), high.alias("avg_high"))


@query("q_range_avg", f"WITH {_BY_DAY_SQL}, {_average_sql(30)} SELECT * FROM range_avg")
def range_avg(t):
    return _flat_range(ranges.by_average(fares_by_day(t), min_count=30))


_MONTHLY_SQL = """monthly AS (
  SELECT 'R' || (o_custkey % 40) || '_BBB_OW_' || strftime(o_orderdate, '%m') AS _id,
    min(CAST(trunc(o_totalprice) AS INT)) AS avg_low, max(CAST(trunc(o_totalprice) AS INT)) AS avg_high
  FROM orders WHERE o_orderpriority <> '5-LOW' AND o_totalprice > 0 GROUP BY 1)"""


@query("q_range_month", f"WITH {_MONTHLY_SQL} SELECT * FROM monthly")
def range_month(t):
    return _flat_range(ranges.monthly(averages_by_day(t)))


@query(
    "q_percentiles",
    f"""SELECT l_partkey, {_percentile_columns('p')}
FROM (SELECT l_partkey, quantile_disc(l_extendedprice, {_CUTS_SQL}) AS p FROM lineitem GROUP BY l_partkey)""",
)
def percentiles(t):
    found = ranges.percentiles(t.lineitem, ["l_partkey"], "l_extendedprice")
    return found.select("l_partkey", *[F.get("percentArray", F.lit(i)).alias(p) for i, p in enumerate(_P)])


_LABELS_SQL = "[" + ", ".join(f"'{x}'" for x in ranges.LABELS) + "]"


@query(
    "q_percentile_zip",
    f"""WITH p AS (SELECT 'S' || l_suppkey AS _id, quantile_disc(l_extendedprice, {_CUTS_SQL}) AS values FROM lineitem GROUP BY 1)
SELECT _id, unnest({_LABELS_SQL}) AS label, unnest(values) AS value FROM p""",
)
def percentile_zip(t):
    found = ranges.by_percentile(t.lineitem, F.concat(F.lit("S"), "l_suppkey"), "l_extendedprice")
    return found.select("_id", F.inline("priceRange_basePercentile"))


_MERGED_SQL = f"""{_BY_DAY_SQL}, {_average_sql(40)}, range_pct AS (
  SELECT route AS _id, quantile_disc(price, {_CUTS_SQL}) AS p FROM in_window GROUP BY route),
merged AS (SELECT coalesce(a._id, p._id) AS _id, avg_low, avg_high, p FROM range_avg a FULL JOIN range_pct p ON a._id = p._id)"""


@query(
    "q_range_merge",
    f"""WITH {_MERGED_SQL} SELECT _id, avg_low, avg_high, {', '.join(f'CAST(p[{i + 1}] AS DOUBLE) AS {p}' for i, p in enumerate(_P))} FROM merged""",
)
def range_merge(t):
    merged = price_ranges.domestic(fares_by_day(t), min_count=40)
    low, high = (F.get("priceRange_baseAvg", F.lit(i)) for i in (0, 1))
    cells = [F.get("priceRange_basePercentile", F.lit(i))["value"].alias(p) for i, p in enumerate(_P)]
    return merged.select("_id", low.alias("avg_low"), high.alias("avg_high"), *cells)


@query(
    "q_range_export",
    f"""WITH {_MERGED_SQL}, wanted AS (SELECT DISTINCT 'C' || (o_custkey % 7) || '_AAA_BBB_' || strftime(o_orderdate, '%m') AS _id FROM orders)
SELECT _id, avg_low, avg_high, {', '.join(f'CAST(p[{i + 1}] AS INT) AS {p}' for i, p in enumerate(_P))}
FROM merged WHERE _id IN (SELECT _id FROM wanted)""",
)
def range_export(t):
    wanted = t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey") % 7, F.lit("_AAA_BBB_"), F.date_format("o_orderdate", "MM")).alias("_id")
    )
    return ranges.export(price_ranges.domestic(fares_by_day(t), min_count=40), wanted)


@query(
    "q_range_intl",
    f"""WITH {INTL_SQL}, {_MONTHLY_SQL}, pct AS (
  SELECT org || '_' || dst || '_OW_D_' || strftime("departDate", '%m') AS _id, quantile_disc(price, {_CUTS_SQL}) AS p
  FROM intl WHERE "departDate" IS NOT NULL AND "predictDate" > "departDate" - 180 AND "predictDate" <= "departDate" GROUP BY 1)
SELECT coalesce(m._id, pct._id) AS _id, avg_low, avg_high, {', '.join(f'CAST(p[{i + 1}] AS DOUBLE) AS {p}' for i, p in enumerate(_P))}
FROM monthly m FULL JOIN pct ON m._id = pct._id""",
)
def range_intl(t):
    past = features.international(intl_history(t), named_dates(t), holiday_calendar.build(holidays(t)))
    merged = price_ranges.international(past, averages_by_day(t))
    low, high = (F.get("priceRange_baseAvg", F.lit(i)) for i in (0, 1))
    cells = [F.get("priceRange_basePercentile", F.lit(i))["value"].alias(p) for i, p in enumerate(_P)]
    return merged.select("_id", low.alias("avg_low"), high.alias("avg_high"), *cells)


_SKETCHED = (date(1996, 1, 1), date(1996, 6, 28))


@query(
    "q_range_sketch",
    f"""WITH {_BY_DAY_SQL} SELECT route AS _id, count(*) AS prices, 10 AS within
FROM by_day WHERE q BETWEEN DATE '{_SKETCHED[0]}' AND DATE '{_SKETCHED[1]}' GROUP BY route""",
)
def range_sketch(t):
    """Ranges of 180 days from daily sketches: how many of the ten cut points lie within 3 % of their rank."""
    prices = fares_by_day(t).withColumn("_id", F.substring_index("flineId", "-", 1))
    sketches = materialize(ranges.daily_sketches(prices, ["_id"], "predictDate"), "sketches")
    found = ranges.percentiles_of_sketches(sketches, ["_id"], "predictDate", *_SKETCHED)
    asked = prices.filter(F.col("predictDate").between(*[F.lit(d) for d in _SKETCHED]))
    joined = asked.join(F.broadcast(materialize(found, "sketched")), "_id")
    at = [F.get("percentArray", F.lit(i)) for i in range(len(ranges.CUTS))]
    ranks = joined.groupBy("_id").agg(
        F.count("*").alias("prices"),
        *[F.avg((F.col("price") < v).cast("int")).alias(f"_below{i}") for i, v in enumerate(at)],
        *[F.avg((F.col("price") <= v).cast("int")).alias(f"_upto{i}") for i, v in enumerate(at)],
    )
    near = [((F.col(f"_below{i}") <= c + 0.03) & (F.col(f"_upto{i}") >= c - 0.03)).cast("int") for i, c in enumerate(ranges.CUTS)]
    return ranks.select("_id", "prices", sum(near[1:], near[0]).alias("within"))


@query(
    "q_text_pairs",
    f"""WITH p AS (SELECT 'S' || l_suppkey AS _id, quantile_disc(CAST(trunc(l_extendedprice) AS INT), {_CUTS_SQL}) AS values FROM lineitem GROUP BY 1)
SELECT _id, unnest({_LABELS_SQL}) AS label, CAST(unnest(values) AS VARCHAR) || '.0' AS value FROM p""",
)
def text_pairs(t):
    """The published form: pairs of texts."""
    prices = t.lineitem.withColumn("price", F.col("l_extendedprice").cast("int"))
    found = ranges.as_text_pairs(ranges.by_percentile(prices, F.concat(F.lit("S"), "l_suppkey")))
    pairs = found.select("_id", F.explode("priceRange_basePercentile").alias("p"))
    return pairs.select("_id", F.get("p", F.lit(0)).alias("label"), F.get("p", F.lit(1)).alias("value"))
