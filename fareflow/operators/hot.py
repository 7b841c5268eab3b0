"""Hot groups: groups too large for the single task an ordered window gives them.

Plain aggregations combine before the shuffle and joins are split by AQE, but
``Window.partitionBy(keys).orderBy(...)`` sorts a whole group in one task.  If
one key holds a third of all rows, that task never ends.  Here such groups are
cut into *segments*: consecutive pieces of the group's order, each small enough
for one task.  An operator then works inside (keys, segment) and brings over
from the neighbouring segments a summary of one row per segment.

Segments are not tasks: however short the policy makes them, they are cut by as
many tasks as the rows ask for, since each task samples, writes and reports.

Hot keys and summaries are tables: they are broadcast only where their size is
checked, and joined by shuffle beyond that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from .joins import sized

SEGMENT = "_segment"
TIE = "_tie"
#: The bits of Spark's increasing ids that count the rows of a partition.
_WITHIN = (1 << 33) - 1


@dataclass(frozen=True)
class HotPolicy:
    """Groups of up to ``rows_per_task`` rows are left to one task."""

    rows_per_task: int = 4_000_000


DEFAULT = HotPolicy()


@dataclass(frozen=True)
class Parts:
    """A table split in two: groups for plain windows, and segmented hot groups.

    ``plain`` and ``order`` are the columns to sort the two halves by.
    """

    normal: DataFrame | None
    hot: DataFrame | None
    plain: list[str]
    order: list[str]


def total_order(df: DataFrame, keys: list[str], order: list[str]) -> list[str]:
    """``order`` and then the remaining columns, so that only equal rows tie."""
    used = {*keys, *order}
    rest = [f.name for f in df.schema.fields if f.name not in used and "map<" not in f.dataType.simpleString()]
    return [*order, *rest]


def split(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    policy: HotPolicy = DEFAULT,
    bound: DataFrame | None = None,
) -> Parts:
    """Separate the hot groups of ``df`` and cut them into segments.

    ``bound`` is a table with at least as many rows that is cheaper to count,
    such as the scan ``df`` was made from.  A table that fits one task needs no
    more than that count.  A larger one is counted per key, combined before the
    shuffle.  Only where a hot group exists are the rows written down once, so what
    ``df`` is made of runs twice, and those of hot groups range-partitioned by
    (keys, order), sorted, cut every ``rows_per_task`` rows and written to the
    shared work folder with their segment number, so that a lost executor cannot
    shift a segment border later.  Segment numbers rise with the order; they have gaps.
    With no ``keys`` the whole table is the group.  Rows equal in ``order`` are
    told apart by their other columns, whatever the size of the table.
    """
    order = total_order(df, keys, order)
    total = (df if bound is None else bound).count()
    if total <= policy.rows_per_task:
        return Parts(df, None, order, order)
    if keys:
        heat = _hot_keys(df, keys, policy)
        size = heat.agg(F.sum("_n")).first()[0]
        if size is None:
            return Parts(df, None, order, order)
        # Both halves and the sampling of the order read the rows: from here on they read them as written.
        df = materialize(df, "rows")
        few = sized(heat.drop("_n"))
        match = [df[k].eqNullSafe(few[k]) for k in keys]
        normal = df.join(few, match, "left_anti")
        hot = df.join(few, match, "left_semi")
    else:
        normal, hot, size = None, df, total
    by = [*keys, *order, TIE]
    # Inside a task's range the rows are sorted, so every rows_per_task of them are a segment.
    at = F.monotonically_increasing_id()
    within = at.bitwiseAND(F.lit(_WITHIN))
    cut = (
        hot.withColumn(TIE, F.monotonically_increasing_id())
        .repartitionByRange(_tasks(df, size, policy), *by)
        .sortWithinPartitions(*by)
        .withColumn(SEGMENT, at - within % policy.rows_per_task)
    )
    return Parts(normal, materialize(cut, "segments"), order, [*order, TIE])


def _tasks(df: DataFrame, size: int, policy: HotPolicy) -> int:
    """Tasks to cut ``size`` rows in: one per segment, but no more than a shuffle has unless they would get too many rows."""
    enough = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // DEFAULT.rows_per_task))
    return max(2, min(-(-size // policy.rows_per_task), enough))


def _hot_keys(df: DataFrame, keys: list[str], policy: HotPolicy) -> DataFrame:
    """All groups above ``rows_per_task`` with their rows ``_n``, written down."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > policy.rows_per_task)
    return materialize(counts, "hot-keys")


def attach(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Join a table of one row per segment to the segments' rows."""
    names = {k: f"_on{i}" for i, k in enumerate([*keys, SEGMENT])}
    summary = materialize(summary.withColumnsRenamed(names), "segment-summary")
    on = [F.col(k).eqNullSafe(F.col(renamed)) for k, renamed in names.items()]
    return rows.join(sized(summary), on).drop(*names.values())


def merge(normal: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    """Put the two halves back together without the helper columns."""
    if hot is None:
        return normal
    hot = hot.drop(SEGMENT, TIE)
    return hot if normal is None else normal.unionByName(hot)
