"""Whole tables published as one dated state each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import write_parquet
from .manifests import Folder, Generation, Version, oldest_kept


def publish(df: DataFrame, root: str, day: date, files: int | None = None) -> Version:
    """Write a table aside and make it the state of ``day``.

    Readers follow the published version, so they never see half a table; a run
    of the same day again is a new version.
    """
    folder = Folder(df.sparkSession, root)
    last = folder.version()
    name = folder.new_generation(last)
    write_parquet(df, folder.data(name), files=files)
    return folder.publish(last, [Generation(name, [0], 1)], {"schema": df.schema.jsonValue()}, day)


def read(spark: SparkSession, root: str, day: date | None = None) -> DataFrame:
    """The last published state, or the last one of a day."""
    folder = Folder(spark, root)
    found = folder.version() if day is None else next((v for v in _newest_first(folder) if v.day == day.isoformat()), None)
    if found is None:
        raise LookupError(f"no state of {day or 'any day'} in {root}")
    return _data(folder, found)


def _newest_first(folder: Folder):
    return (folder.version(n) for n in reversed(folder.numbers()))


def _data(folder: Folder, version: Version) -> DataFrame:
    schema = T.StructType.fromJson(version.about["schema"])
    return folder.spark.read.schema(schema).parquet(folder.data(version.generations[0].name))


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """``number, day`` of the published states."""
    folder = Folder(spark, root)
    rows = [(v.number, date.fromisoformat(v.day)) for v in _newest_first(folder)]
    return spark.createDataFrame(rows, "number long, day date").select("number", F.col("day"))


def expire(spark: SparkSession, root: str, run_date: date, keep: int = 4) -> list[str]:
    """Delete states dated at least ``keep`` days before the run, files and all; the last state stays."""
    return Folder(spark, root).expire(oldest_kept(run_date, keep))
