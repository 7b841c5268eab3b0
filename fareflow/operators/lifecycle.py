"""Daily upkeep: append, upsert, purge, retention."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from ..functions.dates import compact_date, iso_date
from . import windows
from .joins import sized
from .stored import KeyedTable, stored


def _without(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``; NULL is a key like another.

    A day's worth of keys is broadcast when a count proves it small, so the long
    history is not shuffled for it.
    """
    names = {k: f"_on{i}" for i, k in enumerate(on)}
    known = sized(keys.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct())
    return df.join(known, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], "left_anti")


def append(state: DataFrame, delta: DataFrame, on: list[str]) -> DataFrame:
    """History plus today's rows.  A key that is already there is replaced, so a
    rerun of the same day changes nothing.

    Today's rows are written down first: they are counted, taken out of the
    history and added to it.
    """
    today = materialize(windows.latest(delta, on, []), "today")
    return _without(state, today, on).unionByName(today, allowMissingColumns=True)


def append_stored(path: str, delta: DataFrame, on: list[str], day: date | None = None) -> KeyedTable:
    """:func:`append` to a stored history, see :class:`~fareflow.operators.stored.KeyedTable`.

    The first day makes the history.  Only the buckets the delta's keys fall into
    get files, nothing is read, and a key that comes back replaces its row, whatever
    else has changed in it.  The run is published in one step: a run that died
    before left the history as it was, and may be run again, as may one that did not.
    """
    today = materialize(delta, "delta")
    table = stored(delta.sparkSession, path, today, on)
    table.upsert(today, "replace", day=day)
    return table


def upsert_replace(base: DataFrame, updates: DataFrame, on: list[str], version: str) -> DataFrame:
    """Whole-record upsert: the update with the highest ``version`` replaces the record."""
    newest = materialize(windows.latest(updates, on, [version]), "updates")
    return _without(base, newest, on).unionByName(newest.select(*base.columns))


def upsert_set(base: DataFrame, updates: DataFrame, on: list[str], version: str) -> DataFrame:
    """Field-wise upsert: non-NULL fields of the newest update overwrite, the others stay.

    ``updates`` may carry fewer columns than ``base``.
    """
    newest = windows.latest(updates, on, [version])
    fields = [c for c in base.columns if c not in on]
    brought = {c: f"_new_{c}" for c in newest.columns if c in fields}
    joined = base.join(newest.select(*on, *[F.col(c).alias(n) for c, n in brought.items()]), on, "full_outer")
    merged = [F.coalesce(brought[c], c).alias(c) if c in brought else F.col(c) for c in fields]
    return joined.select(*on, *merged).select(*base.columns)


def purge_before(df: DataFrame, column: str | Column, day: date) -> DataFrame:
    """Drop records dated before ``day``; undated records stay."""
    c = F.col(column) if isinstance(column, str) else column
    return df.filter(c.isNull() | (c >= F.lit(day)))


def purge_departed(df: DataFrame, run_date: date, id_col: str = "_id") -> DataFrame:
    """Drop published results whose id ends in a date before the run date."""
    return purge_before(df, iso_date(F.substring_index(id_col, "_", -1)), run_date)


#: Fixed value: the date inside a snapshot's name.
SNAPSHOT_DATE = r"\d{8}"


def snapshot_name(name: str | Column, day: date) -> Column:
    """The name a snapshot has on another day: its 8-digit date is rewritten."""
    return F.regexp_replace(name, SNAPSHOT_DATE, day.strftime("%Y%m%d"))


def expired_snapshots(catalog: DataFrame, run_date: date, keep: int = 4, name: str = "name") -> DataFrame:
    """Catalog rows whose name carries a date at least ``keep`` days before the run."""
    dated = compact_date(F.regexp_extract(F.col(name), f"({SNAPSHOT_DATE})", 1))
    return catalog.filter(dated <= F.lit(run_date - timedelta(days=keep)))
