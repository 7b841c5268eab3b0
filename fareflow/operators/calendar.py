"""Holiday calendar as one row per date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import compact_date, iso_date
from ..schemas import DAY_AFTER_HOLIDAY, DAY_BEFORE_HOLIDAY, MISSING
from .joins import lookup_join, sized


def build(holidays: DataFrame) -> DataFrame:
    """Turn the raw holiday list into ``date``, its day data and ``day_of_vacation_extend``.

    Input: ``calday`` (yyyyMMdd), ``calday_ln``, ``festival``, ``is_vacation``,
    ``vacation_days``, ``day_of_vacation``.  The extended day number also marks
    the day before a holiday's first day and the day after its last.  A holiday
    is one run of a festival, so the same festival may come back every year.
    Day numbers compare as numbers: day 10 is later than day 9.
    """
    days = holidays.select(
        compact_date("calday").alias("date"),
        "calday_ln",
        "festival",
        "is_vacation",
        F.col("vacation_days").try_cast("int").alias("vacation_days"),
        F.col("day_of_vacation").try_cast("int").alias("day_of_vacation"),
    ).filter(F.col("date").isNotNull())
    own = [c for c in days.columns if c != "date"]

    def edge(dates, before: bool):
        nothing = [F.lit(None).cast(days.schema[c].dataType).alias(c) for c in own]
        return dates.select("date", *nothing, F.lit(before).alias("_before"), F.lit(not before).alias("_after"))

    run = F.coalesce(F.expr("date_sub(date, day_of_vacation)"), F.col("date"))
    after = (
        days.filter(F.col("festival").isNotNull())
        .groupBy("festival", run.alias("_run"))
        .agg(F.date_add(F.max("date"), 1).alias("date"))
    )
    before = days.filter(F.col("day_of_vacation") == 1).select(F.date_sub("date", 1).alias("date"))
    marked = (
        days.withColumns({"_before": F.lit(False), "_after": F.lit(False)})
        .unionByName(edge(before, True))
        .unionByName(edge(after, False))
    )
    return (
        marked.groupBy("date")
        .agg(*[F.max(c).alias(c) for c in [*own, "_before", "_after"]])
        .withColumn(
            "day_of_vacation_extend",
            F.coalesce(
                "day_of_vacation",
                F.when(F.col("_after"), DAY_AFTER_HOLIDAY),
                F.when(F.col("_before"), DAY_BEFORE_HOLIDAY),
            ),
        )
        .drop("_before", "_after")
    )


def attach(df: DataFrame, calendar: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """Left-join the calendar on each date column; absent days get the missing-value marks.

    ``prefixes`` maps a date column to the prefix of its calendar columns, for
    instance ``{"departDate": "depart", "queryDate": "query"}``.
    """
    calendar = sized(calendar)
    for date_col, prefix in prefixes.items():
        df = _attach_one(df, calendar, date_col, prefix)
    return df


def _attach_one(df: DataFrame, calendar: DataFrame, date_col: str, prefix: str) -> DataFrame:
    dim = calendar.select(
        F.col("date").alias("_date"),
        F.col("calday_ln").alias(f"{prefix}_calday_ln"),
        F.col("festival").alias(f"{prefix}_festival"),
        F.col("is_vacation").alias(f"{prefix}_isVacation"),
        F.col("vacation_days").alias(f"{prefix}_vacationDays"),
        F.col("day_of_vacation").alias(f"{prefix}_dayofvacation"),
        F.col("day_of_vacation_extend").alias(f"{prefix}_dayofvacation_extend"),
    )
    joined = df.join(dim, F.col(date_col) == F.col("_date"), "left").drop("_date")
    numbers = ["vacationDays", "dayofvacation", "dayofvacation_extend"]
    return joined.withColumns(
        {
            f"{prefix}_isFestival": F.col(f"{prefix}_festival").isNotNull().cast("int"),
            f"{prefix}_isVacation": F.col(f"{prefix}_isVacation").isNotNull().cast("int"),
        }
    ).na.fill({f"{prefix}_festival": str(MISSING), **{f"{prefix}_{n}": MISSING for n in numbers}})


def attach_international(df: DataFrame, calendar: DataFrame, date_col: str) -> DataFrame:
    """The international variant: own-day data only, filled with ``'no'`` and 0.

    Days next to a holiday are in the calendar without data of their own and are
    filled like any other day.
    """
    dim = calendar.select(F.col("date").alias("_date"), "is_vacation", "vacation_days", "day_of_vacation")
    joined = lookup_join(df, dim, F.col(date_col) == F.col("_date"), "left").drop("_date")
    return joined.na.fill({"is_vacation": "no", "vacation_days": 0, "day_of_vacation": 0})


def resolve_symbolic(
    df: DataFrame, names: DataFrame, text: str, query: str, out: str = "departDate"
) -> DataFrame:
    """Departure date of an id tail that is either ``MM-dd`` or a symbolic name.

    ``names(dateDesc, date)`` maps a year-qualified name (``2018-Spring-8``) to
    its date.  The year is put in front with the international rule first, the
    same way for both kinds of tail, so names compare as text with ``MM-dd``.
    """
    seen = F.date_format(query, "MM-dd")
    year = F.year(query) + F.when(F.col(text) > seen, 0).otherwise(1)
    described = df.withColumn("dateDesc", F.concat(year.cast("string"), F.lit("-"), F.col(text)))
    joined = lookup_join(described, names.select("dateDesc", F.col("date").alias("_named")), ["dateDesc"], "left")
    return joined.withColumn(
        out, F.coalesce("_named", iso_date("dateDesc"))
    ).drop("_named", "dateDesc")
