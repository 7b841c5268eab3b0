"""Writers.

None of them repartitions rows by a key alone: a key that holds most rows would
become one task and one file.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keeps a single file readable in one go, whatever the partition holds.
MAX_RECORDS_PER_FILE = 5_000_000


def _writer(df: DataFrame, mode: str, files: int | None, partition_by: list[str] | None):
    if files is not None:
        df = df.repartition(files)
    elif partition_by:
        # Few files per day, and a day too large for one task is split by AQE.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None, partition_by: list[str] | None = None
) -> None:
    """Parquet table; with ``partition_by`` an overwrite replaces only the partitions written."""
    writer = _writer(df, mode, files, partition_by)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_dated(df: DataFrame, path: str, run_date: date, files: int | None = None) -> None:
    """The snapshot of one run; running it again replaces that day only."""
    write_parquet(df.withColumn("run_date", F.lit(run_date)), path, files=files, partition_by=["run_date"])


def write_csv(df: DataFrame, path: str, header: bool = True, files: int | None = None) -> None:
    _writer(df, "overwrite", files, None).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, files: int | None = None) -> None:
    _writer(df, "overwrite", files, None).json(path)


def write_by_day(df: DataFrame, path: str, day_col: str) -> None:
    """One folder per day instead of one filtered export per day."""
    write_parquet(df, path, partition_by=[day_col])


def write_format(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "append") -> None:
    """Any connector the cluster carries, such as a document store."""
    df.write.format(fmt).options(**options).mode(mode).save()


def write_dictionary(index: DataFrame, path: str) -> DataFrame:
    """Store a value dictionary and return a reader of it, whose size Spark then knows."""
    write_parquet(index, path)
    return read_dictionary(index.sparkSession, path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
