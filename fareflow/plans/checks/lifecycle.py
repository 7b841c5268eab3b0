"""Append, upsert, purge, retention, splits and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import sinks
from ...context import work_dir
from ...operators import features, lifecycle, stored
from ...sinks import manifests, snapshots
from ...sources import files
from .registry import ITINERARIES_SQL, RUN, RUN_SQL, Tables, itineraries, query

_LINE = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_SQL = "l_orderkey, l_partkey, l_linenumber"


def _orders(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price")
    )


_ORDERS_SQL = 'o AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price FROM orders)'


@query(
    "q_incremental_union",
    f"""WITH {_ORDERS_SQL} SELECT o_orderkey, o_orderstatus, day, CASE WHEN day >= {RUN_SQL} - 30 THEN price + 1 ELSE price END AS price FROM o
WHERE day < {RUN_SQL}""",
)
def incremental_union(t):
    """Yesterday's history, today's departures, and a rerun of the last month."""
    orders, run = _orders(t), F.lit(RUN.run_date)
    history = orders.filter(F.col("day") < F.date_sub(run, 1))
    delta = orders.filter(F.col("day").between(F.date_sub(run, 30), F.date_sub(run, 1))).withColumn(
        "price", F.col("price") + 1
    )
    once = lifecycle.append(history, delta, ["o_orderkey"])
    return lifecycle.append(once, delta, ["o_orderkey"])


@query(
    "q_incremental_stored",
    f"""WITH {_ORDERS_SQL}, h AS (
  SELECT * EXCLUDE (day), CASE WHEN o_orderkey % 50 <> 3 THEN date_trunc('month', day)::DATE END AS day FROM o WHERE day < {RUN_SQL})
SELECT o_orderkey, o_orderstatus, day,
  CASE WHEN (day >= {RUN_SQL} - 100 OR (day IS NULL AND o_orderkey % 100 = 3)) AND o_orderstatus = 'F' THEN price + 1 ELSE price END AS price
FROM h""",
)
def incremental_stored(t):
    """The same on a stored history of months, from its first day on.

    Some orders have no month; the second delta brings half of them again.
    """
    dated = F.when(F.col("o_orderkey") % 50 != 3, F.trunc("day", "month"))
    orders, run = _orders(t).withColumn("day", dated), F.lit(RUN.run_date)
    past = _orders(t).filter(F.col("day") < run).select("o_orderkey")
    known = orders.join(past, "o_orderkey", "left_semi")
    half = F.col("day").isNull() & (F.col("o_orderkey") % 100 == 3)
    recent = known.filter((F.col("day") >= F.date_sub(run, 100)) | half)
    path = work_dir(t.spark, "history")
    before = (F.col("day") < F.date_sub(run, 50)) | F.col("day").isNull()
    lifecycle.append_stored(path, known.filter(before), ["o_orderkey", "day"])  # the first day
    lifecycle.append_stored(path, recent, ["o_orderkey", "day"])
    closed = recent.filter(F.col("o_orderstatus") == "F").withColumn("price", F.col("price") + 1)
    return lifecycle.append_stored(path, closed, ["o_orderkey", "day"]).read().select(*orders.columns)


# Updates: one per order line, the newest ship date wins; keys are shifted by one, so not every order has one,
# and the field to set is empty for open lines.
_UPDATES_SQL = f"""{_ORDERS_SQL}, lines AS (
  SELECT l_orderkey + 1 AS o_orderkey, CAST(l_shipdate AS DATE) AS version,
    CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS price, l_partkey, l_linenumber
  FROM lineitem),
newest AS (
  SELECT * FROM lines
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC, price DESC NULLS LAST, l_partkey DESC, l_linenumber DESC) = 1)"""


def _updates(t: Tables):
    return t.lineitem.select(
        (F.col("l_orderkey") + 1).alias("o_orderkey"),
        F.to_date("l_shipdate").alias("version"),
        F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("price"),
        "l_partkey",
        "l_linenumber",
    )


@query(
    "q_upsert_set",
    f"""WITH {_UPDATES_SQL} SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o_orderstatus, day, coalesce(n.price, o.price) AS price
FROM o FULL JOIN newest n ON o.o_orderkey = n.o_orderkey""",
)
def upsert_set(t):
    return lifecycle.upsert_set(_orders(t), _updates(t), ["o_orderkey"], "version")


@query(
    "q_upsert_replace",
    f"""WITH {_UPDATES_SQL} SELECT o_orderkey, price FROM newest UNION ALL
SELECT o_orderkey, price FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM newest)""",
)
def upsert_replace(t):
    base = _orders(t).select("o_orderkey", "price")
    return lifecycle.upsert_replace(base, _updates(t), ["o_orderkey"], "version")


@query(
    "q_upsert_stored",
    """WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice AS price, CAST(NULL AS VARCHAR) AS note FROM orders),
lines AS (SELECT l_orderkey + 1 AS o_orderkey, l_linenumber, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
first AS (SELECT o_orderkey, price FROM lines WHERE l_linenumber = 1),
second AS (SELECT o_orderkey, 'line 2' AS note FROM lines WHERE l_linenumber = 2),
third AS (SELECT o_orderkey, 'N' AS o_orderstatus, price, CAST(NULL AS VARCHAR) AS note FROM lines WHERE l_linenumber = 6),
gone AS (SELECT o_orderkey FROM lines WHERE l_linenumber = 7),
set1 AS (SELECT coalesce(o.o_orderkey, f.o_orderkey) AS o_orderkey, o_orderstatus, coalesce(f.price, o.price) AS price, note
  FROM o FULL JOIN first f ON o.o_orderkey = f.o_orderkey),
set2 AS (SELECT coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey, o_orderstatus, price, coalesce(s.note, o.note) AS note
  FROM set1 o FULL JOIN second s ON o.o_orderkey = s.o_orderkey)
SELECT * FROM (SELECT * FROM third UNION ALL SELECT * FROM set2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM third))
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)""",
)
def upsert_stored(t):
    """A stored table after two deltas that set fields, one that replaces records and one that deletes."""
    base = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"), F.lit(None).cast("string").alias("note"))
    lines = t.lineitem.select((F.col("l_orderkey") + 1).alias("o_orderkey"), "l_linenumber", F.col("l_extendedprice").alias("price"))
    number = lambda n: lines.filter(F.col("l_linenumber") == n)
    table = stored.stored(t.spark, work_dir(t.spark, "published"), base, ["o_orderkey"], buckets=8)
    table.upsert(base, "replace")
    table.upsert(number(1).select("o_orderkey", "price"), "set", version="price")
    table.upsert(number(2).select("o_orderkey", F.lit("line 2").alias("note")), "set")
    renewed = number(6).select("o_orderkey", F.lit("N").alias("o_orderstatus"), "price", F.lit(None).cast("string").alias("note"))
    table.upsert(renewed, "replace", version="price")
    table.delete(number(7).select("o_orderkey"))
    return table.read()


_STATES_SQL = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"


def _publish_states(t: Tables, days: int) -> str:
    """One published state per day up to the run's: the orders known by then."""
    root = work_dir(t.spark, "states")
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    for back in range(days - 1, -1, -1):
        day = RUN.shift(-back)
        snapshots.publish(orders.filter(F.col("day") <= F.lit(day)), root, day)
    return root


@query(
    "q_snapshot_publish",
    f"""WITH o AS ({_STATES_SQL})
SELECT 'yesterday' AS state, * FROM o WHERE day <= {RUN_SQL} - 1 UNION ALL SELECT 'last', * FROM o WHERE day <= {RUN_SQL}""",
)
def snapshot_publish(t):
    """Readers of the last state and of an earlier one, after a writer died before it published."""
    root = _publish_states(t, 2)
    folder = manifests.Folder(t.spark, root)
    t.orders.select("o_orderkey").write.parquet(folder.data(folder.new_generation(folder.version())))
    state = lambda name, day: snapshots.read(t.spark, root, day).select(F.lit(name).alias("state"), "o_orderkey", "day")
    return state("yesterday", RUN.yesterday).unionByName(state("last", None))


@query(
    "q_retention_apply",
    f"""WITH o AS ({_STATES_SQL}), kept AS (SELECT {RUN_SQL} - CAST(i AS INT) AS state FROM range(4) r(i))
SELECT state, count(*) AS orders, 4 AS folders FROM kept, o WHERE day <= state GROUP BY state""",
)
def retention_apply(t):
    """Six daily states, of which the rule of four days leaves four, files and all."""
    root = _publish_states(t, 6)
    snapshots.expire(t.spark, root, RUN.run_date, keep=4)
    kept = [r["day"] for r in snapshots.catalog(t.spark, root).collect()]
    out = None
    for day in kept:
        counted = snapshots.read(t.spark, root, day).agg(F.count("*").alias("orders")).select(F.lit(day).alias("state"), "orders")
        out = counted if out is None else out.unionByName(counted)
    folders = len(manifests.Folder(t.spark, root).generations())
    return out.withColumn("folders", F.lit(folders))


@query(
    "q_stale_delete",
    f"""WITH {_ORDERS_SQL} SELECT 'K' || o_orderkey || '_AAA_BBB_' || day AS _id, day - 10 AS "queryDate", price FROM o
WHERE day >= {RUN_SQL} AND day - 10 >= {RUN_SQL} + 99""",
)
def stale_delete(t):
    published = _orders(t).select(
        F.concat_ws("_", F.concat(F.lit("K"), "o_orderkey"), F.lit("AAA_BBB"), "day").alias("_id"),
        F.date_sub("day", 10).alias("queryDate"),
        "price",
    )
    ahead = lifecycle.purge_departed(published, RUN.run_date)
    return lifecycle.purge_before(ahead, "queryDate", RUN.shift(99))


@query(
    "q_retention",
    f"""SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.parquet' AS name,
  'orders_' || strftime({RUN_SQL} - 4, '%Y%m%d') || '.parquet' AS oldest_kept_out
FROM orders WHERE CAST(o_orderdate AS DATE) <= {RUN_SQL} - 4""",
)
def retention(t):
    names = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".parquet"))
    catalog = t.orders.select(names.alias("name")).distinct()
    gone = lifecycle.expired_snapshots(catalog, RUN.run_date, keep=4)
    return gone.withColumn("oldest_kept_out", lifecycle.snapshot_name("name", RUN.shift(-4)))


@query(
    "q_train_online_split",
    f"""WITH {ITINERARIES_SQL} SELECT {_LINE_SQL}, "departDate", CASE WHEN "departDate" < {RUN_SQL} THEN 'train' ELSE 'online' END AS side
FROM itineraries WHERE "departDate" <> {RUN_SQL}""",
)
def train_online_split(t):
    train, online = features.split(itineraries(t).select(*_LINE, "departDate"), RUN.run_date)
    return train.withColumn("side", F.lit("train")).unionByName(online.withColumn("side", F.lit("online")))


@query(
    "q_time_split",
    f"""WITH {_ORDERS_SQL}
SELECT 'before' AS rule, o_orderkey, CAST(day >= {RUN_SQL} AS INT) AS held FROM o UNION ALL
SELECT 'on', o_orderkey, CAST(day = {RUN_SQL} AS INT) FROM o WHERE day <= {RUN_SQL} UNION ALL
SELECT 'after', o_orderkey, CAST(day <= {RUN_SQL} AS INT) FROM o""",
)
def time_split(t):
    sides = []
    for rule, holdout in (("before", ">="), ("on", "=="), ("after", "<=")):
        for held, side in enumerate(features.time_split(_orders(t), "day", RUN.run_date, holdout)):
            sides.append(side.select(F.lit(rule).alias("rule"), "o_orderkey", F.lit(held).alias("held")))
    out = sides[0]
    for side in sides[1:]:
        out = out.unionByName(side)
    return out


@query("q_split_by_day", "SELECT event_id, user_id, value, CAST(ts AS DATE) AS day FROM events")
def split_by_day(t):
    """One write makes a folder per day, each readable on its own."""
    events = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    path = work_dir(t.spark, "by-day")
    sinks.write_by_day(events, path, "day")
    return t.spark.read.schema(events.schema).parquet(path).select(*events.columns)


@query(
    "q_sink_roundtrip",
    f"""WITH {_ORDERS_SQL} SELECT kind, o.* FROM o, (VALUES ('csv'), ('csv_plain'), ('json'), ('parquet'), ('dated')) k(kind)""",
)
def sink_roundtrip(t):
    spark, orders = t.spark, _orders(t)
    root, schema = work_dir(spark, "sinks"), orders.schema
    sinks.write_csv(orders, f"{root}/csv")
    sinks.write_csv(orders, f"{root}/csv_plain", header=False)
    sinks.write_json(orders, f"{root}/json")
    sinks.write_parquet(orders, f"{root}/parquet", files=2)
    for _ in range(2):  # a rerun of the same day replaces it
        sinks.write_dated(orders, f"{root}/dated", RUN.run_date)
    back = {
        "csv": files.read_csv(spark, f"{root}/csv", schema),
        "csv_plain": files.read_csv(spark, f"{root}/csv_plain", schema, header=False),
        "json": spark.read.schema(schema).json(f"{root}/json"),
        "parquet": files.read_parquet(spark, f"{root}/parquet"),
        "dated": files.read_parquet(spark, f"{root}/dated").drop("run_date"),
    }
    out = None
    for kind, df in back.items():
        side = df.select(F.lit(kind).alias("kind"), *orders.columns)
        out = side if out is None else out.unionByName(side)
    return out
