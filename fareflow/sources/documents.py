"""Price documents: objects with fixed fields and dynamic date keys.

Documents arrive as JSON text.  A document is parsed once as a map of texts, so
unknown keys need no schema; nested values stay JSON text until asked for.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.fares import whole_number
from ..functions.keys import DATE_KEY, MONTH_DAY_KEY, admitted
from ..schemas import AIRPORT, FLIGHT_INFO, STATION
from ..operators import windows
from .files import typed

#: Non-price fields of each document kind.
LOW_PRICE_FIELDS = ["_id", "dairport", "aairport"]
LIST_FARE_FIELDS = ["_id", "date", "ut", "src"]
INTL_FIELDS = ["_id", "fn", "from"]
TICKET_FIELDS = ["_id", "ut", "noticket", "hasticket"]


def parse(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Replace the JSON text by a map of texts, NULL for a broken document."""
    return df.withColumn(doc, F.from_json(doc, "map<string,string>"))


def parse_as(df: DataFrame, fields: str, doc: str = "doc") -> DataFrame:
    """Columns of the JSON text by a struct definition.

    The struct goes through ``inline``, so filters on its fields stay above it
    and the text is parsed once.
    """
    return df.select(F.inline_outer(F.array(F.from_json(doc, f"struct<{fields}>"))))


def field(name: str, doc: str = "doc") -> Column:
    return F.try_element_at(F.col(doc), F.lit(name))


def unpivot(
    df: DataFrame,
    keep: dict[str, str],
    fixed: list[str],
    key: str,
    value: str,
    key_pattern: str | None = None,
    doc: str = "doc",
) -> DataFrame:
    """One row per dynamic key of a parsed document.

    ``keep`` maps fixed fields to output columns, ``fixed`` lists the fields that
    are not entries, ``key_pattern`` admits keys that start like it.  A document
    without entries gives no row.
    """
    carried = [field(src, doc).alias(out) for src, out in keep.items()]
    # The outer form: for the inner one Spark adds a size filter that parses the
    # text a second time.  The key filter drops its empty rows.
    rows = df.select(*carried, F.explode_outer(doc).alias(key, value)).filter(~F.col(key).isin(*fixed))
    return rows if key_pattern is None else rows.filter(F.col(key).rlike(key_pattern))


def since_day(df: DataFrame, since: date | None, doc: str = "doc") -> DataFrame:
    """Documents whose ``date`` is that day or later; only this field is read."""
    return df if since is None else df.filter(F.get_json_object(doc, "$.date") >= since.isoformat())


def low_prices(df: DataFrame) -> DataFrame:
    """``queryDate, price, id, org, dst`` from low-price documents."""
    rows = unpivot(
        parse(df), {"_id": "id", "dairport": "org", "aairport": "dst"}, LOW_PRICE_FIELDS, "queryDate", "price"
    )
    return rows.select(
        dates.iso_date("queryDate").alias("queryDate"),
        whole_number("price").alias("price"),
        "id",
        "org",
        "dst",
    )


def list_fares(df: DataFrame, since: date | None = None) -> DataFrame:
    """``orgPrice_id, fc, orgPrice`` from nested documents carrier → Y → price.

    Carriers without a full economy price are skipped; ``since`` keeps documents
    dated that day or later.
    """
    rows = unpivot(parse(since_day(df, since)), {"_id": "orgPrice_id"}, LIST_FARE_FIELDS, "fc", "_classes")
    price = whole_number(F.get_json_object("_classes", "$.Y.price"))
    return rows.select("orgPrice_id", "fc", price.alias("orgPrice")).filter(F.col("orgPrice").isNotNull())


def seat_snapshots(df: DataFrame) -> DataFrame:
    """``queryDatetime, seatLeft, seatLeft_id`` from the snapshot map in field ``fc``."""
    docs = parse_as(df, "_id: string, fc: map<string,string>")
    rows = docs.select(F.col("_id").alias("seatLeft_id"), F.explode_outer("fc").alias("_at", "seatLeft"))
    return rows.filter(F.col("_at").isNotNull()).select(
        F.col("_at").try_cast("timestamp").alias("queryDatetime"), "seatLeft", "seatLeft_id"
    )


def international_prices(df: DataFrame) -> DataFrame:
    """``flineId, predictDate, price`` from admitted international documents."""
    docs = df.filter(admitted(F.get_json_object("doc", "$._id")))
    rows = unpivot(parse(docs), {"_id": "flineId"}, INTL_FIELDS, "predictDate", "price")
    return rows.select(
        "flineId",
        dates.iso_date("predictDate").alias("predictDate"),
        whole_number("price").alias("price"),
    )


def dated_prices(df: DataFrame, key: str = "predictDate", month_day: bool = False) -> DataFrame:
    """``flineId, <key>, price`` of every key that starts like a date (or a month-day)."""
    pattern = MONTH_DAY_KEY if month_day else DATE_KEY
    return unpivot(parse(df), {"_id": "flineId"}, ["_id"], key, "price", pattern)


def ticket_history(df: DataFrame) -> DataFrame:
    """``queryDatetime, hasTicket, id`` from train-ticket documents."""
    rows = unpivot(parse(df), {"_id": "id"}, TICKET_FIELDS, "queryDatetime", "hasTicket")
    return rows.select("queryDatetime", "hasTicket", "id")


def _flat(df: DataFrame, renamed: dict[str, str], schema) -> DataFrame:
    """Typed columns of flat documents; a document without an id is broken."""
    docs = parse_as(df, ", ".join(f"`{src}`: string" for src in renamed.values()))
    named = docs.select(*[F.col(src).alias(out) for out, src in renamed.items()])
    return typed(named, schema).filter(F.col(next(iter(renamed))).isNotNull())


def airports(df: DataFrame) -> DataFrame:
    """``Airport_code, latitude, longitude``; incomplete documents are skipped."""
    names = {"Airport_code": "_id", "latitude": "latitude", "longitude": "longitude"}
    return _flat(df, names, AIRPORT).dropna()


def flight_info(df: DataFrame, since: date | None = None) -> DataFrame:
    """``infoBase_id, departTime, arriveTime, isShare``; incomplete documents are skipped."""
    names = {
        "infoBase_id": "_id",
        "departTime": "origindeparttime",
        "arriveTime": "originarrivetime",
        "isShare": "isshare",
    }
    info = _flat(since_day(df, since), names, FLIGHT_INFO).dropna(subset=["infoBase_id", "departTime", "arriveTime"])
    # JSON writes the flag in lower case, the landing files in title case.
    return info.withColumn("isShare", F.initcap(F.coalesce("isShare", F.lit("none"))))


def stations(df: DataFrame) -> DataFrame:
    return _flat(df, {f.name: f.name for f in STATION.fields}, STATION)


def train_stops(df: DataFrame) -> DataFrame:
    """One row per stop of a train, numbered from 1 in travel order."""
    stop = "arriveTime: string, stationCode: string, departTime: string, stationName: string"
    docs = parse_as(df, f"_id: string, array: array<struct<{stop}>>")
    stops = docs.select(F.col("_id").alias("tn"), F.posexplode_outer("array").alias("_pos", "_stop"))
    return stops.filter(F.col("_pos").isNotNull()).select("tn", "_stop.*", (F.col("_pos") + 1).alias("orderNum"))


def latest_price(df: DataFrame) -> DataFrame:
    """The newest ``queryDate`` and its price of every low-price id."""
    return windows.latest(low_prices(df).dropna(), ["id"], ["queryDate"])


def month_day_window(run_date: date, first: int, last: int, without_today: bool = False) -> list[str]:
    """``MM-dd`` texts of run_date+first … run_date+last."""
    start, end = run_date + timedelta(days=first), run_date + timedelta(days=last)
    return dates.month_days(start, end, run_date if without_today else None)


def departing(df: DataFrame, id_col: str, month_days: list[str]) -> DataFrame:
    """Rows whose id ends in one of the month-days."""
    return df.filter(F.substring_index(id_col, "_", -1).isin(*month_days))
