"""Calendar parts and lead times."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(d: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(d) + 1


def weekday_bucket(d: Column | str) -> Column:
    """Friday, Saturday and Sunday keep their number, the other days are 0."""
    dow = day_of_week(d)
    return F.when(dow < 5, 0).otherwise(dow)


def date_parts(d: str, prefix: str) -> dict[str, Column]:
    """The seven calendar columns of one date, named ``departYear``, ``depart_weekofyear``…"""
    return {
        f"{prefix}Year": F.year(d),
        f"{prefix}Month": F.month(d),
        f"{prefix}_dayofmonth": F.dayofmonth(d),
        f"{prefix}_weekofyear": F.weekofyear(d),
        f"{prefix}_dayofweek": day_of_week(d),
        f"{prefix}_dayofweek_bucket": weekday_bucket(d),
        f"{prefix}Quarter": F.quarter(d),
    }


def lead_times(depart: str, query: str) -> dict[str, Column]:
    """Days, months, weeks and 120-day spans from query to departure.

    ``intervalQuarters`` counts spans of 120 days; the model was trained on it.
    """
    days = F.datediff(depart, query)
    return {
        "intervalDays": days,
        "intervalMonths": F.round(F.months_between(depart, query)),
        "intervalWeeks": F.round(days / 7),
        "intervalQuarters": F.round(days / 120),
    }


def hour_of(text: Column | str) -> Column:
    """The hour in an ``HH:mm`` text."""
    return F.substring_index(text, ":", 1).try_cast("int")


def iso_date(text: Column | str) -> Column:
    """A ``yyyy-MM-dd`` text as a date, anything else NULL.

    The cast alone would also take ``2019`` or ``2019-3``.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(text) == 10, text.try_cast("date"))


def compact_date(text: Column | str) -> Column:
    """``yyyyMMdd`` text as a date."""
    return F.try_to_date(text, "yyyyMMdd")


def month_days(start: date, end: date, without: date | None = None) -> list[str]:
    """``MM-dd`` texts of every day in [start, end], optionally without one."""
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    texts = [d.strftime("%m-%d") for d in days]
    return [x for x in texts if without is None or x != without.strftime("%m-%d")]
