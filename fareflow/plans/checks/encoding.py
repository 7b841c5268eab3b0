"""Dictionaries, encodings, buckets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ... import sinks
from ...context import materialize, work_dir
from ...functions import fares
from ...operators import encoding, features
from ...operators.hot import HotPolicy
from .registry import Tables, query

_LINE = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_SQL = "l_orderkey, l_partkey, l_linenumber"


@query(
    "q_string_index",
    """WITH cells AS (UNPIVOT (SELECT l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR) AS l_partkey FROM lineitem) ON COLUMNS(*) INTO NAME feature VALUE value)
SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) - 1 AS DOUBLE) AS idx
FROM cells GROUP BY feature, value""",
)
def string_index(t):
    return encoding.string_index(t.lineitem, ["l_returnflag", "l_linestatus", "l_partkey"])


_CATEGORIES = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
_NUMBERS = ["l_extendedprice"]


def _index_sql(where: str = "") -> str:
    cells = " UNION ".join(
        f"SELECT '{c}' AS feature, {i} AS position, CAST({c} AS DOUBLE) AS value FROM lineitem {where}"
        for i, c in enumerate(_CATEGORIES)
    )
    return f"""cells AS ({cells} UNION ALL SELECT 'l_extendedprice', 4, NULL),
dictionary AS (SELECT *, row_number() OVER (ORDER BY position, value) - 1 AS idx FROM cells)"""


@query("q_feature_index", f"WITH {_index_sql()} SELECT * FROM dictionary")
def feature_index(t):
    return encoding.feature_index(t.lineitem, _CATEGORIES, _NUMBERS)


@query(
    "q_feature_index_stats",
    f"WITH {_index_sql()} SELECT count(DISTINCT feature) AS field_size, count(*) AS feature_size FROM dictionary",
)
def feature_index_stats(t):
    return encoding.index_stats(encoding.feature_index(t.lineitem, _CATEGORIES, _NUMBERS))


def _encoded_sql() -> str:
    joins = " ".join(
        f"LEFT JOIN (SELECT value, idx FROM dictionary WHERE feature = '{c}') d_{c} ON d_{c}.value = l.{c}" for c in _CATEGORIES
    )
    picks = ", ".join(f"d_{c}.idx AS {c}_idx, 1.0::DOUBLE AS {c}_val" for c in _CATEGORIES)
    slot = "(SELECT idx FROM dictionary WHERE feature = 'l_extendedprice')"
    return f"""WITH {_index_sql("WHERE l_quantity < 40")}
SELECT {_LINE_SQL}, {picks}, {slot} AS l_extendedprice_idx, l_extendedprice AS l_extendedprice_val FROM lineitem l {joins}"""


@query("q_feature_encode", _encoded_sql())
def feature_encode(t):
    """The dictionary knows only small quantities, so the others are unseen."""
    index = encoding.feature_index(t.lineitem.filter("l_quantity < 40"), _CATEGORIES, _NUMBERS)
    stored = sinks.write_dictionary(index, work_dir(t.spark, "dictionary"))
    lines = t.lineitem.withColumn("line", F.col("l_linenumber"))
    coded = encoding.encode(lines, stored, _CATEGORIES, _NUMBERS)
    wanted = [f"{c}_{kind}" for c in [*_CATEGORIES, *_NUMBERS] for kind in ("idx", "val")]
    return coded.select(*_LINE, *wanted)


_GROWN = ["l_quantity", "l_linenumber", "l_suppkey"]
_FIRST_DAY = "CASE WHEN l_quantity < 20 AND l_suppkey % 3 = 0 THEN 0 WHEN l_quantity < 35 THEN 1 ELSE 2 END"


def _grown_sql() -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS position, CAST({c} AS DOUBLE) AS value, {_FIRST_DAY} AS d FROM lineitem" for i, c in enumerate(_GROWN))
    return f"""WITH cells AS ({cells}), came AS (SELECT feature, position, value, min(d) AS d FROM cells GROUP BY ALL),
sizes AS (SELECT d, CAST(sum(count(*)) OVER (ORDER BY d) - count(*) AS BIGINT) AS since FROM came GROUP BY d)
SELECT feature, position, value, row_number() OVER (ORDER BY came.d, position, value) - 1 AS idx, since FROM came JOIN sizes ON sizes.d = came.d"""


@query("q_dictionary_grow", _grown_sql())
def dictionary_grow(t):
    """Three days of values, the second one run twice: numbers given stay, new ones follow."""
    root = work_dir(t.spark, "grown")
    rows = t.lineitem.withColumn("d", F.expr(_FIRST_DAY))
    for n, d in enumerate((0, 1, 1, 2)):
        found = encoding.grow_stored(root, rows.filter(F.col("d") == d), _GROWN, date(2019, 1, 1 + n))
    return found


@query(
    "q_sample_any_n",
    f"""SELECT {_LINE_SQL} FROM lineitem
ORDER BY md5(l_orderkey || '_' || l_partkey || '_' || l_linenumber), {_LINE_SQL} LIMIT 20000""",
)
def sample_any_n(t):
    """More rows than the 700 that one task may hold here."""
    return features.hash_sample(t.lineitem.select(*_LINE), _LINE, 20_000, HotPolicy(rows_per_task=700))


def _bucket_sql(name: str, value: str, low, high, step, below, above) -> str:
    """The same buckets as a search among the left borders."""
    borders = [low + i * step for i in range(round((high - low) / step) + (1 if above else 0))]
    borders = borders if below else borders[1:]
    return f'CAST({" + ".join(f"CAST({value} >= {b} AS INT)" for b in borders)} AS DOUBLE) AS "{name}Bucket"'


_BUCKET_INPUT = {
    "discountOff": "l_discount * 1200 - 10",
    "distance": "l_extendedprice / 12",
    "seatLeft": "l_quantity * 3 - 30",
    "discount": "l_quantity * 4 - 10",
    "intervalDays": "l_quantity - 5",
}


def _buckets(t: Tables, layout):
    lines = t.lineitem.select(*_LINE, *[F.expr(v).alias(n) for n, v in _BUCKET_INPUT.items() if n in layout])
    return lines.withColumns(fares.buckets(layout)).drop(*layout)


def _buckets_sql(layout) -> str:
    return f"SELECT {_LINE_SQL}, {', '.join(_bucket_sql(n, _BUCKET_INPUT[n], *spec) for n, spec in layout.items())} FROM lineitem"


@query("q_bucketize", _buckets_sql(fares.MODEL_BUCKETS))
def bucketize(t):
    return _buckets(t, fares.MODEL_BUCKETS)


@query("q_bucketize_analysis", _buckets_sql(fares.ANALYSIS_BUCKETS))
def bucketize_analysis(t):
    return _buckets(t, fares.ANALYSIS_BUCKETS)


@query("q_sample")
def sample(t):
    return features.sample_to(t.lineitem.select(*_LINE), 5_000, seed=7)


@query("q_sample_exact")
def sample_exact(t):
    return features.sample_exactly(t.lineitem.select(*_LINE), 10_000, seed=7)


@query("q_sample_bounds", "SELECT true AS about_as_many, true AS no_row_twice, true AS all_known")
def sample_bounds(t):
    """What holds for any sample of about 5,000 rows of a longer table."""
    lines = t.lineitem.select(*_LINE).distinct()
    drawn = materialize(features.sample_to(lines, 5_000, seed=7), "sample")
    target = F.least(F.lit(5_000), F.lit(lines.count()))
    found = drawn.join(lines.withColumn("_known", F.lit(1)), _LINE, "left")
    counted = found.agg(F.count("*").alias("n"), F.count_distinct(*_LINE).alias("different"), F.count("_known").alias("known"))
    return counted.select(
        (F.abs(F.col("n") - target) <= 400).alias("about_as_many"),
        (F.col("n") == F.col("different")).alias("no_row_twice"),
        (F.col("known") == F.col("n")).alias("all_known"),
    )


@query(
    "q_hash_sample",
    f"""SELECT {_LINE_SQL} FROM lineitem
ORDER BY md5(l_orderkey || '_' || l_partkey || '_' || l_linenumber), {_LINE_SQL} LIMIT 2000""",
)
def hash_sample(t):
    return features.hash_sample(t.lineitem.select(*_LINE), _LINE, 2_000)


@query("q_shuffle", f"SELECT {_LINE_SQL}, l_extendedprice FROM lineitem")
def shuffle(t):
    return features.shuffle(t.lineitem.select(*_LINE, "l_extendedprice"), seed=7)
