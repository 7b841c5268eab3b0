"""Value dictionaries: string indexes and the model's global feature index."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import materialize
from ..sinks import snapshots
from ..sinks.manifests import Folder
from . import windows
from .hot import DEFAULT, HotPolicy
from .joins import sized, small_groups


def long_form(df: DataFrame, columns: list[str], as_type: str) -> DataFrame:
    """One (feature, position, value) row per cell."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), F.col(c).cast(as_type).alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    return df.select(F.explode(cells).alias("_cell")).select("_cell.*")


def string_index(df: DataFrame, columns: list[str], policy: HotPolicy = DEFAULT) -> DataFrame:
    """``feature, value, idx``: 0 for the most frequent value, ties alphabetical.

    One pass counts the values of all columns before the shuffle; the dictionary
    stays a table, written once because ranking reads it more than once.
    """
    counts = materialize(
        long_form(df, columns, "string")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg((-F.count(F.lit(1))).alias("_rarity")),
        "counts",
    )
    ranked = windows.position(counts, ["feature"], ["_rarity", "value"], "idx", policy)
    return ranked.select("feature", "value", F.col("idx").cast("double").alias("idx"))


def feature_index(
    df: DataFrame, categorical: list[str], numeric: list[str] = (), policy: HotPolicy = DEFAULT
) -> DataFrame:
    """``feature, position, value, idx``: every value of every column gets one global number.

    Columns are numbered in the given order, categorical values ascending.  A
    numeric column takes one slot with a NULL value.
    """
    numeric = list(numeric)
    distinct = long_form(df, categorical, "double").groupBy("feature", "position", "value").count().drop("count")
    # A column without any value keeps its slot, so the numeric part is the same for all data.
    slots = [(c, len(categorical) + i, None) for i, c in enumerate(numeric)]
    if slots:
        fixed = df.sparkSession.createDataFrame(slots, "feature string, position int, value double")
        distinct = distinct.filter(F.col("value").isNotNull()).unionByName(fixed)
    else:
        distinct = distinct.filter(F.col("value").isNotNull())
    distinct = materialize(distinct, "values")
    ranked = windows.position(distinct, ["feature", "position"], ["value"], "_rank", policy)
    sizes = distinct.groupBy("position").agg(F.count(F.lit(1)).alias("_size"))
    # One row per column: a bounded table, so one task may order it.
    before = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("position", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return ranked.join(F.broadcast(offsets), "position").select(
        "feature", "position", "value", (F.col("_offset") + F.col("_rank")).alias("idx")
    )


def grow(known: DataFrame | None, df: DataFrame, categorical: list[str], policy: HotPolicy = DEFAULT) -> DataFrame:
    """A dictionary with the values that ``df`` brings; numbers that are given never change.

    ``feature, position, value, idx, since``; ``known`` is the dictionary so far, None
    on the first day.  New values are numbered behind the largest number, by column
    and value, so the numbers stay dense; ``since`` is the number of entries there
    were before the value came, so it tells the growths apart.
    """
    found = long_form(df, categorical, "double").filter(F.col("value").isNotNull()).groupBy("feature", "position", "value").count().drop("count")
    if known is not None:
        names = {"feature": "_f", "value": "_v"}
        there = known.select(*[F.col(c).alias(n) for c, n in names.items()])
        found = found.join(sized(there), [F.col(c) == F.col(n) for c, n in names.items()], "left_anti")
    found = materialize(found, "new-values")
    size = 0 if known is None else known.count()
    numbered = windows.position(found, [], ["position", "value"], "_rank", policy)
    fresh = numbered.select(
        "feature", "position", "value", (F.lit(size) + F.col("_rank")).cast("long").alias("idx"), F.lit(size).cast("long").alias("since")
    )
    return fresh if known is None else known.unionByName(fresh)


def grow_stored(root: str, df: DataFrame, categorical: list[str], day: date, policy: HotPolicy = DEFAULT) -> DataFrame:
    """:func:`grow` on a stored dictionary, published as the state of ``day``.

    Every state stays readable until it expires, so a model finds the dictionary it
    was trained with.  A run of a day again finds nothing new and changes no number.
    """
    spark = df.sparkSession
    known = snapshots.read(spark, root) if Folder(spark, root).version() else None
    snapshots.publish(grow(known, df, categorical, policy), root, day)
    return snapshots.read(spark, root)


def index_stats(index: DataFrame) -> DataFrame:
    """``field_size`` (columns) and ``feature_size`` (slots) of a feature index."""
    return index.agg(
        F.count_distinct("feature").alias("field_size"), F.count(F.lit(1)).alias("feature_size")
    )


def attach_index(
    df: DataFrame, index: DataFrame, columns: list[str], name=lambda c: f"{c}_idx", default=None
) -> DataFrame:
    """Add the index of each column's value; a value not in the dictionary gives NULL.

    ``index`` should be a written table (see :func:`fareflow.sinks.write_dictionary`):
    one lookup per column reads it again.  One pass measures all columns' parts, to
    see which can be broadcast.
    """
    type_ = index.schema["value"].dataType
    small = small_groups(index.select("feature", "value", "idx"), "feature", columns)
    for c in columns:
        dim = index.filter(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("idx").alias(name(c)))
        dim = F.broadcast(dim) if c in small else dim
        df = df.join(dim, F.col(c).cast(type_) == F.col("_value"), "left").drop("_value")
        if default is not None:
            df = df.na.fill({name(c): default})
    return df


def encode(df: DataFrame, index: DataFrame, categorical: list[str], numeric: list[str] = ()) -> DataFrame:
    """Index and weight of every model column: ``<c>_idx`` and ``<c>_val``.

    A category weighs 1 at its value's index; a number weighs its own value at
    the column's one slot.
    """
    df = attach_index(df, index, categorical)
    out = {f"{c}_val": F.lit(1.0) for c in categorical}
    if numeric:
        slots = {r["feature"]: r["idx"] for r in index.filter(F.col("feature").isin(*numeric)).collect()}
        for c in numeric:  # one dictionary row per numeric column
            out[f"{c}_idx"] = F.lit(slots[c]).cast("long")
            out[f"{c}_val"] = F.col(c).cast("double")
    return df.withColumns(out)
