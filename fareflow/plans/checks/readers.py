"""Price documents and typed readers.  Documents are JSON text made from table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import sinks
from ...context import work_dir
from ...functions import keys as ids
from ...schemas import MERGED_FARES, schema
from ...sources import documents, files, lookups, quarantine
from .registry import ITINERARIES_SQL, LOW_PRICES_SQL, RUN, RUN_SQL, Tables, itineraries, low_prices, query

_LINE = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_SQL = "l_orderkey, l_partkey, l_linenumber"


def _doc(*pairs):
    """JSON text of a map with the given key and value columns."""
    return F.to_json(F.create_map(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pairs])).alias("doc")


def low_price_docs(t: Tables):
    """Wide documents with two dated prices each."""
    next_day = F.date_add("queryDate", 1)
    return low_prices(t).select(
        _doc(
            "_id", F.col("id"), "dairport", F.col("org"), "aairport", F.col("dst"),
            F.col("queryDate"), F.col("price"), next_day, F.col("price") + 100,
        )
    )


_TWO_DAYS_SQL = f"""{LOW_PRICES_SQL}, long AS (
  SELECT "queryDate", price, id, org, dst FROM low_prices UNION ALL SELECT "queryDate" + 1, price + 100, id, org, dst FROM low_prices)"""


@query("q_doc_unpivot", f"WITH {_TWO_DAYS_SQL} SELECT * FROM long")
def doc_unpivot(t):
    return documents.low_prices(low_price_docs(t))


@query(
    "q_doc_latest",
    f"""WITH {_TWO_DAYS_SQL} SELECT * FROM long
QUALIFY row_number() OVER (PARTITION BY id ORDER BY "queryDate" DESC, price DESC) = 1""",
)
def doc_latest(t):
    return documents.latest_price(low_price_docs(t))


@query(
    "q_doc_seats",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M') AS at, (event_id % 100) || '%' AS "seatLeft", 'U' || user_id AS "seatLeft_id" FROM events""",
)
def doc_seats(t):
    at = F.date_format("ts", "yyyy-MM-dd HH:mm")
    inner = F.to_json(F.create_map(at, F.concat(F.col("event_id") % 100, F.lit("%"))))
    docs = t.events.select(
        F.concat(F.lit('{"_id":"U'), "user_id", F.lit('","fc":'), inner, F.lit("}")).alias("doc")
    )
    seen = documents.seat_snapshots(docs)
    return seen.select(F.date_format("queryDatetime", "yyyy-MM-dd HH:mm").alias("at"), "seatLeft", "seatLeft_id")


@query(
    "q_nested_unpivot",
    f"""WITH o AS (SELECT 'A' || (o_custkey % 25) || '_A' || (o_orderkey % 25) || '_' || strftime(o_orderdate, '%Y-%m-%d') || '_fd' AS id, * FROM orders
  WHERE CAST(o_orderdate AS DATE) >= {RUN_SQL})
SELECT id AS "orgPrice_id", 'C1' AS fc, CAST(o_custkey + 100 AS INT) AS "orgPrice" FROM o UNION ALL
SELECT id, 'C2', CAST(o_custkey + 200 AS INT) FROM o WHERE o_orderstatus <> 'P'""",
)
def nested_unpivot(t):
    """Carrier C1 has an economy price, C2 only in some documents, C3 never."""
    id_ = F.concat_ws(
        "_",
        F.concat(F.lit("A"), F.col("o_custkey") % 25),
        F.concat(F.lit("A"), F.col("o_orderkey") % 25),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("fd"),
    )
    price = lambda plus: F.struct((F.col("o_custkey") + plus).cast("string").alias("price"))
    second = F.when(F.col("o_orderstatus") != "P", price(200))
    docs = t.orders.select(
        F.to_json(
            F.struct(
                id_.alias("_id"),
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                F.lit("now").alias("ut"),
                F.lit("x").alias("src"),
                F.struct(price(100).alias("Y")).alias("C1"),
                F.struct(second.alias("Y"), price(900).alias("F")).alias("C2"),
                F.struct(price(900).alias("F")).alias("C3"),
            )
        ).alias("doc")
    )
    return documents.list_fares(docs, since=RUN.run_date)


@query(
    "q_flat_project",
    """SELECT s_name AS "Airport_code", s_acctbal / 100 AS latitude, CAST(s_nationkey AS DOUBLE) AS longitude FROM supplier
WHERE s_nationkey >= 5""",
)
def flat_project(t):
    """Airports of a fifth of the documents are unreadable: text for a number, or broken JSON."""
    broken = F.when(F.col("s_nationkey") < 3, "unknown").otherwise((F.col("s_acctbal") / 100).cast("string"))
    doc = F.to_json(F.struct(F.col("s_name").alias("_id"), broken.alias("latitude"), F.col("s_nationkey").cast("string").alias("longitude")))
    cut = F.when(F.col("s_nationkey").isin(3, 4), F.substring(doc, 1, 12)).otherwise(doc)
    return documents.airports(t.supplier.select(cut.alias("doc")))


@query(
    "q_flight_docs",
    f"""WITH {ITINERARIES_SQL} SELECT fn || '_' || l_orderkey AS "infoBase_id", lpad(l_linenumber::VARCHAR, 2, '0') || ':30' AS "departTime",
  lpad((l_linenumber + 3)::VARCHAR, 2, '0') || ':30' AS "arriveTime",
  CASE l_returnflag WHEN 'A' THEN 'True' WHEN 'N' THEN 'False' ELSE 'None' END AS "isShare"
FROM itineraries WHERE "departDate" >= {RUN_SQL} AND l_linenumber <> 7""",
)
def flight_docs(t):
    hour = lambda plus: F.concat(F.lpad((F.col("l_linenumber") + plus).cast("string"), 2, "0"), F.lit(":30"))
    shared = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "N", False)
    docs = itineraries(t).select(
        F.to_json(
            F.struct(
                F.concat_ws("_", "fn", "l_orderkey").alias("_id"),
                F.date_format("departDate", "yyyy-MM-dd").alias("date"),
                hour(0).alias("origindeparttime"),
                F.when(F.col("l_linenumber") != 7, hour(3)).alias("originarrivetime"),
                shared.alias("isshare"),
            )
        ).alias("doc")
    )
    return documents.flight_info(docs, since=RUN.run_date)


@query(
    "q_ticket_history",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS "queryDatetime", CAST(value > 50 AS VARCHAR) AS "hasTicket", 'U' || user_id AS id FROM events""",
)
def ticket_history(t):
    docs = t.events.select(
        _doc(
            "_id", F.concat(F.lit("U"), "user_id"), "ut", F.lit("now"), "noticket", F.lit("1"), "hasticket", F.lit("2"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("value") > 50,
        )
    )
    return documents.ticket_history(docs)


@query(
    "q_stations",
    """SELECT c_custkey::VARCHAR AS _id, 'j' AS jianpin, 'c' || c_custkey AS code, NULL::VARCHAR AS quanpin, c_name AS name, c_mktsegment AS citycn,
  c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude, c_nationkey::VARCHAR AS citycode, '{"a":1}' AS realdistancesmap, 's' AS site, '[]' AS distancesmap
FROM customer""",
)
def stations(t):
    distances = F.struct(F.lit(1).alias("a"))
    docs = t.customer.select(
        F.to_json(
            F.struct(
                F.col("c_custkey").cast("string").alias("_id"),
                F.lit("j").alias("jianpin"),
                F.concat(F.lit("c"), "c_custkey").alias("code"),
                F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("citycn"),
                F.col("c_acctbal").cast("string").alias("latitude"),
                F.col("c_nationkey").alias("longitude"),
                F.col("c_nationkey").cast("string").alias("citycode"),
                distances.alias("realdistancesmap"),
                F.lit("s").alias("site"),
                F.array().cast("array<int>").alias("distancesmap"),
            )
        ).alias("doc")
    )
    return documents.stations(docs)


@query(
    "q_posexplode_ordinal",
    """WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
SELECT 'T' || doc_id AS tn, lang AS "arriveTime", source AS "stationCode", NULL::VARCHAR AS "departTime", line AS "stationName", CAST(n AS INT) AS "orderNum"
FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n FROM lines) JOIN documents USING (doc_id)""",
)
def posexplode_ordinal(t):
    """Every line of a text is one stop."""
    stop = lambda line: F.struct(
        F.col("lang").alias("arriveTime"), F.col("source").alias("stationCode"), line.alias("stationName")
    )
    stops = F.transform(F.split("text", "\n"), stop)
    docs = t.documents.select(
        F.to_json(F.struct(F.concat(F.lit("T"), "doc_id").alias("_id"), stops.alias("array"))).alias("doc")
    )
    return documents.train_stops(docs)


@query(
    "q_monthday_filter",
    f"""WITH {LOW_PRICES_SQL}, wanted AS (
  SELECT DISTINCT strftime(d, '%m-%d') AS md FROM generate_series(CAST({RUN_SQL} - 1 AS TIMESTAMP), CAST({RUN_SQL} + 30 AS TIMESTAMP), INTERVAL 1 DAY) g(d))
SELECT * FROM low_prices WHERE split_part(id, '_', 4) IN (SELECT md FROM wanted) AND split_part(id, '_', 4) <> strftime({RUN_SQL}, '%m-%d')""",
)
def monthday_filter(t):
    days = documents.month_day_window(RUN.run_date, -1, 30, without_today=True)
    return documents.departing(low_prices(t), "id", days)


@query(
    "q_id_admission",
    """SELECT 'AAA_BBB_OW_Y_D_' || strftime(o_orderdate, '%m-%d') AS "flineId", CAST(o_orderdate AS DATE) AS "predictDate", CAST(o_custkey AS INT) AS price
FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')""",
)
def id_admission(t):
    """Ids of some priorities are not itineraries: no date, a detail page, a comma."""
    base = F.concat(F.lit("AAA_BBB_OW_Y_D_"), F.date_format("o_orderdate", "MM-dd"))
    id_ = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("AAA_BBB"))
        .when(F.col("o_orderpriority").startswith("4"), F.concat(base, F.lit("DETAIL")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("A,"), base))
        .otherwise(base)
    )
    docs = t.orders.select(_doc("_id", id_, "fn", F.lit("x"), "from", F.lit("y"), F.to_date("o_orderdate"), F.col("o_custkey")))
    return documents.international_prices(docs)


def _key_sql(month_day: bool) -> str:
    shown = "'%m-%d'" if month_day else "'%Y-%m-%d'"
    return f"""WITH o AS (SELECT 'K' || o_orderkey AS id, o_orderdate AS d, o_custkey AS price FROM orders)
SELECT id AS "flineId", strftime(d, {shown}) AS "predictDate", price::VARCHAR AS price FROM o UNION ALL
SELECT id, strftime(d, '%Y-%m-%d') || 'T00', (price + 1)::VARCHAR FROM o"""


def _keyed_docs(t: Tables, fmt: str):
    """Documents with a dated key, one with text behind its date, and one that is no date."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        _doc(
            "_id", F.concat(F.lit("K"), "o_orderkey"), "note-2", F.lit("0"),
            F.date_format("o_orderdate", fmt), F.col("o_custkey"), F.concat(day, F.lit("T00")), F.col("o_custkey") + 1,
        )
    )


@query("q_date_keys", _key_sql(False))
def date_keys(t):
    return documents.dated_prices(_keyed_docs(t, "yyyy-MM-dd"))


@query("q_month_day_keys", _key_sql(True))
def month_day_keys(t):
    return documents.dated_prices(_keyed_docs(t, "MM-dd"), month_day=True)


_LINES = schema(l_orderkey="long", l_linenumber="int", day="date", price="double", l_returnflag="string")
_LINES_SQL = 'SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day, l_extendedprice AS price, l_returnflag FROM lineitem'


def _lines(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("price"), "l_returnflag"
    )


@query("q_scan_csv", _LINES_SQL)
def scan_csv(t):
    path = work_dir(t.spark, "landing")
    sinks.write_csv(_lines(t), path)
    return files.read_csv(t.spark, path, _LINES)


@query(
    "q_scan_csv_headerless",
    f"""WITH {ITINERARIES_SQL} SELECT "queryDate", price, fn, "departDate", TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'null' ELSE '1' END AS INT) AS trend FROM itineraries""",
)
def scan_csv_headerless(t):
    """The 17-column landing file: all text, typed at the edge."""
    i = itineraries(t).withColumn("trend", F.when(F.col("l_returnflag") == "R", "null").otherwise("1"))
    landed = i.select(*[(F.col(c) if c in i.columns else F.lit(None).cast("string")).alias(c) for c in MERGED_FARES])
    path = work_dir(t.spark, "landing")
    sinks.write_csv(landed, path, header=False)
    text = files.read_csv(t.spark, path, files.text_schema(MERGED_FARES), header=False)
    wanted = schema(queryDate="date", price="int", fn="string", departDate="date", trend="int")
    return files.typed(text, wanted)


@query(
    "q_typed_ingest",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS day FROM lineitem""",
)
def typed_ingest(t):
    """Text columns with entries that do not parse."""
    text = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.when(F.col("l_returnflag") == "R", "null").otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise("n/a").alias("day"),
    )
    return files.typed(text, schema(l_orderkey="long", l_linenumber="int", price="double", day="date"))


@query("q_scan_documents", f"WITH {_TWO_DAYS_SQL} SELECT * FROM long")
def scan_documents(t):
    """JSON-lines files read back as documents."""
    path = work_dir(t.spark, "documents")
    low_price_docs(t).write.text(path)
    return documents.low_prices(files.read_documents(t.spark, path))


@query(
    "q_id_lookup",
    f"""WITH {LOW_PRICES_SQL} SELECT l.* FROM low_prices l WHERE split_part(id, '_', 1) IN (
  SELECT 'C' || (s_suppkey % 5) || s_suppkey FROM supplier WHERE s_acctbal > 5000)""",
)
def id_lookup(t):
    """Prices of a given list of flights."""
    rich = t.supplier.filter("s_acctbal > 5000")
    wanted = rich.select(F.concat(F.lit("C"), F.col("s_suppkey") % 5, F.col("s_suppkey")).alias("fn"))
    prices = low_prices(t).withColumn("fn", ids.part("id", 0))
    path = work_dir(t.spark, "by-flight")
    lookups.write_clustered(prices, path, "fn", buckets=16)
    return lookups.of_ids(t.spark, path, wanted, "fn").drop("fn")


_LANDED_SQL = """CASE WHEN l_linenumber = 7 THEN l_orderkey || ',' || l_linenumber
  ELSE l_orderkey || ',' || l_linenumber || ',' || CASE WHEN l_returnflag = 'R' THEN 'cheap' WHEN l_quantity = 1 THEN '' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END
    || ',' || CASE WHEN l_linestatus = 'F' AND l_quantity > 45 THEN '1998-13-01' ELSE strftime(l_shipdate, '%Y-%m-%d') END END"""


@query(
    "q_quarantine",
    f"""WITH r AS (SELECT *, {_LANDED_SQL} AS record, l_linenumber = 7 AS malformed, l_linenumber <> 7 AND l_returnflag = 'R' AS unfit,
    l_linenumber <> 7 AND l_returnflag <> 'R' AND l_quantity = 1 AS missing, l_linenumber <> 7 AND l_linestatus = 'F' AND l_quantity > 45 AS undated FROM lineitem),
n AS (SELECT count(*) AS records, count(*) FILTER (malformed OR unfit OR missing OR undated) AS bad, count(*) FILTER (malformed) AS malformed,
  count(*) FILTER (unfit OR missing) AS quantity, count(*) FILTER (undated) AS day FROM r)
SELECT 'good' AS kind, l_orderkey || ',' || l_linenumber || ',' || CAST(l_quantity AS INT) || ',' || strftime(l_shipdate, '%Y-%m-%d') AS record, '' AS reasons
FROM r WHERE NOT (malformed OR unfit OR missing OR undated) UNION ALL
SELECT 'bad', record, concat_ws('; ', CASE WHEN malformed THEN 'malformed' END, CASE WHEN unfit THEN 'quantity: not int' WHEN missing THEN 'quantity: missing' END,
  CASE WHEN undated THEN 'day: not date' END) FROM r WHERE malformed OR unfit OR missing OR undated UNION ALL
SELECT 'counts', records || ' ' || bad || ' ' || malformed || ' ' || quantity || ' ' || day, '' FROM n""",
)
def quarantined(t):
    """Landed lines with fields that do not parse, required ones that are empty, and lines cut short."""
    path = work_dir(t.spark, "landing")
    whole = F.concat_ws(
        ",",
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "cheap").when(F.col("l_quantity") == 1, "").otherwise(F.col("l_quantity").cast("int").cast("string")),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") > 45), "1998-13-01").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
    )
    t.lineitem.select(F.when(F.col("l_linenumber") == 7, F.concat_ws(",", "l_orderkey", "l_linenumber")).otherwise(whole)).write.text(path)
    fields = schema(l_orderkey="long", l_linenumber="int", quantity="int", day="date")
    found = quarantine.read_csv(t.spark, path, fields, required=["quantity"])
    good = found.good.select(F.lit("good").alias("kind"), F.concat_ws(",", *fields.names).alias("record"), F.lit("").alias("reasons"))
    bad = found.bad.select(F.lit("bad").alias("kind"), "record", F.concat_ws("; ", "reasons").alias("reasons"))
    text = " ".join(str(found.counts[c]) for c in ("records", "bad", "malformed", "quantity", "day"))
    counted = found.bad.limit(0).select(F.lit("counts").alias("kind"), F.col("record"), F.lit("").alias("reasons"))
    return good.unionByName(bad).unionByName(t.spark.createDataFrame([("counts", text, "")], counted.schema))
