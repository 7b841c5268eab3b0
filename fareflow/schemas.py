"""Typed schemas, column lists and marker values."""

from __future__ import annotations

from pyspark.sql import types as T

#: Markers the trained models expect.
MISSING = -999
DAY_BEFORE_HOLIDAY = -1
DAY_AFTER_HOLIDAY = 1001
MAX_PRICE = 100_000


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def schema(**fields: str) -> T.StructType:
    """Schema from ``name="type"`` pairs; needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields.items()])


# Field names of the landing files and documents.
LOW_PRICE = schema(queryDate="date", price="int", id="string", org="string", dst="string")
LIST_FARE = schema(orgPrice_id="string", fc="string", orgPrice="int")
AIRPORT = schema(Airport_code="string", latitude="double", longitude="double")
SEAT_LEFT = schema(queryDatetime="timestamp", seatLeft="string", seatLeft_id="string")
FLIGHT_INFO = schema(infoBase_id="string", departTime="string", arriveTime="string", isShare="string")
HOLIDAYS = schema(
    calday="string",
    calday_ln="string",
    festival="string",
    is_vacation="string",
    vacation_days="int",
    day_of_vacation="int",
)
NAMED_DATES = schema(dateDesc="string", date="date")
INTL_HISTORY = schema(flineId="string", predictDate="date", price="int")
INTL_AVG_PRICE = schema(flineId="string", departDate="string", avgPrice="double")
TICKET_HISTORY = schema(queryDatetime="string", hasTicket="string", id="string")
STATION = schema(
    _id="string",
    jianpin="string",
    code="string",
    quanpin="string",
    name="string",
    citycn="string",
    latitude="double",
    longitude="double",
    citycode="string",
    realdistancesmap="string",
    site="string",
    distancesmap="string",
)
TRAIN_STOP = schema(
    tn="string",
    arriveTime="string",
    stationCode="string",
    departTime="string",
    stationName="string",
    orderNum="int",
)
#: The header-less landing file; every field is text, see ``sources.files.typed``.
MERGED_FARES = [
    "queryDate",
    "price",
    "fn",
    "org",
    "dst",
    "id",
    "fc",
    "departDate",
    "dayofweek",
    "futureMinPrice",
    "trend",
    "orgPrice",
    "discount",
    "distance",
    "seatLeft",
    "departTime",
    "isShare",
]

#: Columns that identify a sample, and its label.
BASE_COLUMNS = ["fn", "city_code", "departDate", "queryDate"]
LABEL = "trend"

#: Columns replaced by an index, and what the index column is called.
INDEXED = ["fn", "fc", "org", "dst", "depart_festival", "query_festival"]


def indexed_name(column: str) -> str:
    return f"stringIndexer_{column}"


_CALENDAR = ["isVacation", "vacationDays", "dayofvacation", "isFestival", "dayofvacation_extend"]


def _date_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{c}" for c in _CALENDAR] + [
        f"{prefix}Year",
        f"{prefix}Month",
        f"{prefix}_dayofmonth",
        f"{prefix}_weekofyear",
        f"{prefix}_dayofweek",
        f"{prefix}_dayofweek_bucket",
        f"{prefix}Quarter",
    ]


#: What the model reads beside identity and label: 40 columns.
FEATURE_COLUMNS = (
    ["departTime", "arriveTime", "isShare"]
    + _date_columns("depart")
    + ["intervalDays", "intervalMonths", "intervalWeeks", "intervalQuarters"]
    + _date_columns("query")
    + [indexed_name(c) for c in INDEXED]
    + ["discountOffBucket", "distanceBucket", "seatLeftBucket"]
)
MODEL_COLUMNS = BASE_COLUMNS + [LABEL] + FEATURE_COLUMNS
