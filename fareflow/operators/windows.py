"""Ordered windows over groups of any size.

Each function is the usual one-shuffle window for ordinary groups.  Hot groups
take the segmented way of :mod:`fareflow.operators.hot` and give the same rows.
``order`` names columns sorted ascending; rows equal in them are sorted by their
other columns.
``bound`` is a table at least as long as ``df`` that is cheaper to count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import hot as hot_groups
from .hot import DEFAULT, SEGMENT, HotPolicy


def _latest_first(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])


def _summary_window(keys: list[str]):
    """Over segment summaries: one row per segment."""
    return Window.partitionBy(*keys).orderBy(SEGMENT)


def future_prices(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    price: str,
    skip: int = 2,
    policy: HotPolicy = DEFAULT,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Add ``group_count``, ``futureMinPrice`` and ``nextQueryPrice``.

    ``futureMinPrice`` is the lowest price from ``skip`` rows ahead to the end of
    the group, ``nextQueryPrice`` the price of the next row.  The rows are walked
    from the latest to the earliest, where the unbounded frame is a running
    minimum; walking forward would rescan the rest of the group for every row.
    """
    if skip not in (1, 2):
        raise ValueError("skip must be 1 or 2")
    parts = hot_groups.split(df, keys, order, policy, bound)

    def ahead(w, first: int) -> dict[str, Column]:
        return {
            "futureMinPrice": F.min(price).over(w.rowsBetween(Window.unboundedPreceding, -first)),
            "nextQueryPrice": F.lag(price, 1).over(w),
        }

    normal = parts.normal
    if normal is not None:
        # All three share one window and so one sort.
        w = _latest_first(keys, parts.plain)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        normal = normal.withColumns({"group_count": F.count(price).over(whole), **ahead(w, skip)})
    if parts.hot is None:
        return normal

    w = _latest_first([*keys, SEGMENT], parts.order)
    left = "_left"  # rows of the segment still ahead, 0 on its last row
    inside = parts.hot.withColumns(
        {
            **ahead(w, skip),
            left: F.row_number().over(w) - 1,
            "_size": F.count("*").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    first = F.col(left) == F.col("_size") - 1
    summary = inside.groupBy(*keys, SEGMENT).agg(
        F.count(price).alias("_priced"),
        F.min(price).alias("_min"),
        F.max(F.when(first, F.struct(F.col(price).alias("p")))).alias("_first"),
        F.min(F.when(~first, F.col(price))).alias("_min_but_first"),
    )
    sw = _summary_window(keys)
    later = sw.rowsBetween(1, Window.unboundedFollowing)
    after_next = sw.rowsBetween(2, Window.unboundedFollowing)
    summary = summary.select(
        *keys,
        SEGMENT,
        F.sum("_priced").over(Window.partitionBy(*keys)).alias("group_count"),
        F.min("_min").over(later).alias("_later_min"),
        # The rows of later segments without the very next row.
        F.least(F.lead("_min_but_first").over(sw), F.min("_min").over(after_next)).alias("_later_min_but_next"),
        F.lead("_first").over(sw).alias("_next"),
    )
    last = F.col(left) == 0
    beyond = F.col("_later_min") if skip == 1 else F.when(last, F.col("_later_min_but_next")).otherwise(F.col("_later_min"))
    names = [*df.columns, "group_count", "futureMinPrice", "nextQueryPrice"]
    hot = hot_groups.attach(inside, summary, keys).withColumns(
        {
            "futureMinPrice": F.least("futureMinPrice", beyond),
            "nextQueryPrice": F.when(last, F.col("_next.p")).otherwise(F.col("nextQueryPrice")),
        }
    )
    return hot_groups.merge(normal, hot.select(*names))


def trailing_mean(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    rows: int = 4,
    out: str = "preceding3day_price",
    policy: HotPolicy = DEFAULT,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Mean of the ``rows`` rows before each row; the row's own value where there are none."""
    parts = hot_groups.split(df, keys, order, policy, bound)

    def mean(over_keys, by):
        w = Window.partitionBy(*over_keys).orderBy(*by).rowsBetween(-rows, -1)
        return F.coalesce(F.avg(value).over(w), F.col(value).cast("double"))

    normal = parts.normal
    if normal is not None:
        normal = normal.withColumn(out, mean(keys, parts.plain))
    if parts.hot is None:
        return normal

    # Lend every segment the last rows before it.  No segment is empty, so the
    # last few segments hold them all.
    within = _latest_first([*keys, SEGMENT], parts.order)
    tail = (
        parts.hot.withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= rows)
        .groupBy(*keys, SEGMENT)
        .agg(F.sort_array(F.collect_list(F.struct(*parts.order, F.col(value).alias("_lent")))).alias("_tail"))
    )
    before = F.flatten(F.collect_list("_tail").over(_summary_window(keys).rowsBetween(-rows, -1)))
    lent = (
        tail.withColumn("_before", before)
        .withColumn("_before", F.slice("_before", F.greatest(F.size("_before") - rows + 1, F.lit(1)), rows))
        .select(*keys, SEGMENT, F.explode("_before").alias("_row"))
        .select(
            *keys,
            SEGMENT,
            *[F.col(f"_row.{c}").alias(c) for c in parts.order],
            *([] if value in [*keys, *parts.order] else [F.col("_row._lent").alias(value)]),
            F.lit(True).alias("_is_lent"),
        )
    )
    both = parts.hot.withColumn("_is_lent", F.lit(False)).unionByName(lent, allowMissingColumns=True)
    hot = both.withColumn(out, mean([*keys, SEGMENT], parts.order)).filter(~F.col("_is_lent"))
    return hot_groups.merge(normal, hot.select(*df.columns, out))


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column | str,
    out: str,
    policy: HotPolicy = DEFAULT,
) -> DataFrame:
    """Sum of ``value`` over the rows before each row, 0 on the first."""
    value = F.col(value) if isinstance(value, str) else value
    df = df.withColumn("_v", value)
    parts = hot_groups.split(df, keys, order, policy)

    def total(over_keys, by):
        w = Window.partitionBy(*over_keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_v").over(w), F.lit(0))

    normal = parts.normal
    if normal is not None:
        normal = normal.withColumn(out, total(keys, parts.plain))
    if parts.hot is None:
        return normal.drop("_v")

    sums = parts.hot.groupBy(*keys, SEGMENT).agg(F.sum("_v").alias("_sum"))
    before = _summary_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, SEGMENT, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = parts.hot.withColumn(out, total([*keys, SEGMENT], parts.order))
    hot = hot_groups.attach(inside, sums, keys).withColumn(out, F.col(out) + F.col("_before"))
    return hot_groups.merge(normal, hot.select(*df.columns, out)).drop("_v")


def position(
    df: DataFrame, keys: list[str], order: list[str], out: str, policy: HotPolicy = DEFAULT
) -> DataFrame:
    """0-based row number inside each group."""
    return running_total(df, keys, order, F.lit(1).cast("long"), out, policy)


def as_of_next(
    df: DataFrame,
    events: DataFrame,
    keys: list[str],
    at: str,
    time: str,
    max_days: int | None = None,
    policy: HotPolicy = DEFAULT,
) -> DataFrame:
    """Each row with the columns of the first event of its key at or after the row's own time.

    ``at`` is a date of ``df`` and ``time`` one of ``events``; the event's columns but
    the keys are added, NULL where no event follows within ``max_days``.  Rows and
    events are sorted together once and walked from the latest to the earliest, so
    no row meets more than one event.  Of events at one time the smallest in the
    other columns counts.  A key or time that is NULL has no event.
    """
    brought = [c for c in events.columns if c not in keys]
    clash = set(brought) & set(df.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    usable = events.filter(F.col(time).isNotNull())
    for k in keys:
        usable = usable.filter(F.col(k).isNotNull())
    first = earliest(usable, [*keys, time], [])
    row, event = F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*[F.col(f"`{c}`") for c in brought])
    names = [f"_k{i}" for i in range(len(keys))]
    on = [F.col(k).alias(n) for k, n in zip(keys, names)]
    # Going backwards, the events of a time come before its rows.
    asking = df.select(*on, F.col(at).alias("_t"), F.lit(0).alias("_side"), row.alias("_row"))
    told = first.select(*on, F.col(time).alias("_t"), F.lit(1).alias("_side"), event.alias("_event"))
    both = asking.unionByName(told, allowMissingColumns=True)
    parts = hot_groups.split(both, names, ["_t", "_side"], policy)

    def following(over: list[str], by: list[str]) -> Column:
        return F.last("_event", ignorenulls=True).over(_latest_first(over, by).rowsBetween(Window.unboundedPreceding, 0))

    normal, hot = parts.normal, None
    if normal is not None:
        normal = normal.withColumn("_found", following(names, ["_t", "_side"]))
    if parts.hot is not None:
        inside = parts.hot.withColumn("_found", following([*names, SEGMENT], parts.order))
        nearest = parts.hot.groupBy(*names, SEGMENT).agg(F.min_by("_event", F.when(F.col("_event").isNotNull(), F.col("_t"))).alias("_first"))
        later = F.first("_first", ignorenulls=True).over(_summary_window(names).rowsBetween(1, Window.unboundedFollowing))
        summary = nearest.select(*names, SEGMENT, later.alias("_later"))
        hot = hot_groups.attach(inside, summary, names).withColumn("_found", F.coalesce("_found", "_later")).drop("_later")
    found = hot_groups.merge(normal, hot).filter("_side = 0")
    near = F.col("_t").isNotNull()
    if max_days is not None:
        near &= F.datediff(F.col(f"_found.`{time}`"), F.col("_t")) <= max_days
    return found.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in df.columns],
        *[F.when(near, F.col(f"_found.`{c}`")).alias(c) for c in brought],
    )


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key: the largest in ``by``, ties broken by the remaining columns.

    A maximum over a struct combines before the shuffle, so a hot key costs one
    row per task.
    """
    return _extreme(df, keys, by, F.max)


def _extreme(df, keys, by, pick):
    rest = [c for c in df.columns if c not in keys and c not in by]
    if not by + rest:
        return df.distinct()
    top = df.groupBy(*keys).agg(pick(F.struct(*by, *rest)).alias("_top"))
    return top.select(*[F.col(c if c in keys else f"_top.{c}").alias(c) for c in df.columns])


def earliest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key: the smallest in ``by``, ties broken by the remaining columns."""
    return _extreme(df, keys, by, F.min)


def latest_rows(df: DataFrame, keys: list[str], by: list[str], n: int) -> DataFrame:
    """The ``n`` latest rows per key.

    Spark keeps only ``n`` rows per key and task before the shuffle
    (WindowGroupLimit, for ``n`` up to 1000), so a hot key stays small.
    """
    rank = F.row_number().over(_latest_first(keys, by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
