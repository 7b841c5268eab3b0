"""Run context, session settings and the shared work folder."""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings the operators are tuned for.  None of them changes a result.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even where the split costs one more exchange afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Shuffle data one task should get.
BYTES_PER_TASK = 256 * 1024 * 1024


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply :data:`SETTINGS` to a session and return it.

    ``shuffle_bytes``, the largest amount one shuffle will move, sizes the
    shuffle for it: shuffles start with that many partitions and AQE joins the
    small ones.  Without it the session's own setting stays.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_bytes is not None:
        tasks = max(spark.sparkContext.defaultParallelism, -(-shuffle_bytes // BYTES_PER_TASK))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(tasks))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(BYTES_PER_TASK))
    return spark


#: The part of the work folder that tables are written to just now, see :func:`scope`.
_SCOPE: ContextVar[str] = ContextVar("scope", default="")


def work_dir(spark: SparkSession, purpose: str = "run") -> str:
    """A fresh folder for intermediate tables that every executor can reach.

    The parent is the application's own folder in ``spark.checkpoint.dir``, or in the
    warehouse where that is not set.  A warehouse on a machine's own disk serves only
    a session whose tasks run inside the driver.
    """
    return "/".join(filter(None, [_own_root(spark), _SCOPE.get(), f"fareflow-{purpose}-{uuid.uuid4().hex}"]))


def _own_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
        own_disk = root.startswith(("file:", "/"))
        if own_disk and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root.rstrip('/')}/fareflow-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _forget(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that are gone, which it does when the JVM notices."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Intermediate tables written inside go to a part of the work folder that is emptied first.

    For the steps of a job: each writes its result elsewhere, and the next one starts
    without what the last one left.
    """
    _delete(spark, f"{_own_root(spark)}/{name}")
    _forget(spark)
    token = _SCOPE.set(name)
    try:
        yield
    finally:
        _SCOPE.reset(token)


def clean_up(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, at the end of a job.

    Results that were not written elsewhere cannot be read afterwards.
    """
    _delete(spark, _own_root(spark))


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared work folder and return a reader of it.

    Cuts the lineage, survives the loss of an executor, and gives later plans a
    true size.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove intermediate tables that :func:`materialize` wrote and nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        own = f"/{_own_root(spark).rsplit('/', 1)[1]}/"
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if own in folder:
                _delete(spark, folder)
    if tables:
        _forget(tables[0].sparkSession)


@dataclass(frozen=True)
class RunContext:
    """The date a job runs for.  Nothing in the package reads the clock."""

    run_date: date

    @classmethod
    def of(cls, text: str) -> "RunContext":
        return cls(date.fromisoformat(text))

    def shift(self, days: int) -> date:
        return self.run_date + timedelta(days=days)

    @property
    def yesterday(self) -> date:
        return self.shift(-1)
