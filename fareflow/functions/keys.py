"""Itinerary ids: ``_``-separated text that carries route, cabin and date.

==================  ================================================
id                  layout
==================  ================================================
low price / seats   ``fn_org_dst_MM-dd``
list fare           ``org_dst_yyyy-MM-dd_fd``
flight info         ``org_dst_fn_yyyy-MM-dd``
international       ``org_dst_return_cabin_direct_<MM-dd or name>``
published result    ``fn_org_dst_yyyy-MM-dd``
==================  ================================================

A part that is missing comes back as NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import iso_date


def part(id_col: Column | str, position: int) -> Column:
    """The 0-based ``position``-th part of an id, or NULL."""
    return F.get(F.split(id_col, "_"), F.lit(position))


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row, whatever is filtered on them later.

    They go through ``inline``: filters stay above it, where plain projections
    would be pasted into each of them.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(made)))


def _parsed(df: DataFrame, id_col: str, names: list[str | None], more=lambda at: {}) -> DataFrame:
    """Add the named parts of an id, which is split once; ``more`` makes further columns of the parts."""
    at = lambda i: F.get("_parts", F.lit(i))
    columns = {name: at(i) for i, name in enumerate(names) if name} | more(at)
    return once(df.withColumn("_parts", F.split(id_col, "_")), columns).drop("_parts")


def parse_low_price(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Add ``fn``, ``fc``, ``city_code`` and ``depart_md`` from a low-price id.

    ``fc`` is the two-letter carrier, ``city_code`` the middle two parts.
    """
    city = F.substring_index(F.substring_index(id_col, "_", 3), "_", -2)
    return _parsed(
        df, id_col, ["fn", None, None, "depart_md"], lambda at: {"fc": F.substring(at(0), 1, 2), "city_code": city}
    )


def parse_list_fare(df: DataFrame, id_col: str = "orgPrice_id") -> DataFrame:
    return _parsed(df, id_col, ["org", "dst"], lambda at: {"departDate": iso_date(at(2))})


def parse_seat(df: DataFrame, id_col: str = "seatLeft_id") -> DataFrame:
    return _parsed(df, id_col, ["fn", "org", "dst", "depart_md"])


def parse_flight_info(df: DataFrame, id_col: str = "infoBase_id") -> DataFrame:
    return _parsed(df, id_col, ["org", "dst", "fn"], lambda at: {"departDate": iso_date(at(3))})


def parse_international(df: DataFrame, id_col: str = "flineId") -> DataFrame:
    """Add the five route parts, ``flineId_noDate`` and the trailing ``depart_text``."""
    return _parsed(
        df,
        id_col,
        ["org", "dst", "isReturn_type", "cabin", "isDirect_type"],
        lambda at: {"flineId_noDate": F.substring_index(id_col, "_", 5), "depart_text": F.substring_index(id_col, "_", -1)},
    )


def parse_result(df: DataFrame, id_col: str = "_id") -> DataFrame:
    return _parsed(df, id_col, ["fn", "org", "dst", "departDate"])


def build(*parts: Column | str) -> Column:
    """Join parts to an id; NULL when any part is NULL."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.when(~F.greatest(*[c.isNull() for c in cols], F.lit(False)), F.concat_ws("_", *cols))


def build_list_fare(org, dst, depart: Column | str) -> Column:
    return build(org, dst, F.date_format(depart, "yyyy-MM-dd"), F.lit("fd"))


def route_without_cabin(fline_no_date: Column | str, month: Column) -> Column:
    """First three route parts, then direct flag and month: the cabin is dropped."""
    return F.concat_ws(
        "_",
        F.substring_index(fline_no_date, "_", 3),
        F.substring_index(fline_no_date, "_", -1),
        month,
    )


def resolve_depart_date(query: Column | str, month_day: Column | str, on_equal: str = "same") -> Column:
    """The departure date an ``MM-dd`` text stands for, seen from the query date.

    A month-day behind the query date belongs to the next year.  When both are
    the same day, ``on_equal='same'`` keeps the year (domestic rule) and
    ``on_equal='next'`` moves on (international and price-range rule).  A day
    that does not exist, such as 02-29 in a short year, gives NULL.
    """
    if on_equal not in ("same", "next"):
        raise ValueError("on_equal must be 'same' or 'next'")
    query = F.col(query) if isinstance(query, str) else query
    month_day = F.col(month_day) if isinstance(month_day, str) else month_day
    # Compared as numbers: formatting the query date would cost more than all the rest.
    seen = F.month(query) * 100 + F.dayofmonth(query)
    wanted = F.concat(F.substring(month_day, 1, 2), F.substring(month_day, 4, 2)).try_cast("int")
    rolls = seen > wanted if on_equal == "same" else seen >= wanted
    year = F.year(query) + F.when(rolls, 1).otherwise(0)
    return iso_date(F.concat(year.cast("string"), F.lit("-"), month_day))


def admitted(id_col: Column | str) -> Column:
    """International ids worth reading: a date part, no detail pages, no commas."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return c.contains("-") & ~c.contains("DETAIL") & ~c.contains(",")


#: Which document keys hold a price.  They match at the start only.
DATE_KEY = r"^\d{4}-\d{2}-\d{2}"
MONTH_DAY_KEY = r"^\d+-\d+"
