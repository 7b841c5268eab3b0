"""Look-ups by a list of ids in a long table that is stored for them.

The table lies in folders by a hash of the id, sorted by id inside and with bloom
filters of it.  A list of ids reads only the folders its ids fall into; a short
list also reaches the files as a filter that skips row groups and pages.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import materialize
from ..operators.joins import sized
from ..sinks.manifests import Folder, Generation

#: Up to so many ids are named in the filter that reaches the files; more are joined.
NAMED_IDS = 1_000

_BUCKET = "_bucket"


def _bucket(id_col: str, kind: T.DataType, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast(kind)), F.lit(buckets)).cast("int")


def write_clustered(df: DataFrame, root: str, id_col: str, buckets: int = 64, day: date | None = None) -> None:
    """Store a table for look-ups by ``id_col``; an id may have many rows.

    The new state replaces the old one in one step.  A bucket too large for one task,
    for the sake of one frequent id too, is written as several files.
    """
    if _BUCKET in df.columns:
        raise ValueError(f"a column is named {_BUCKET}")
    folder = Folder(df.sparkSession, root)
    last = folder.version()
    name = folder.new_generation(last)
    dealt = df.withColumn(_BUCKET, _bucket(id_col, df.schema[id_col].dataType, buckets)).hint("rebalance", _BUCKET)
    writer = dealt.sortWithinPartitions(_BUCKET, F.col(f"`{id_col}`")).write.option(f"parquet.bloom.filter.enabled#{id_col}", "true")
    writer.partitionBy(_BUCKET).parquet(folder.data(name))
    there = folder.parts(name, _BUCKET)
    about = {"schema": df.schema.jsonValue(), "id": id_col, "buckets": buckets}
    folder.publish(last, [Generation(name, there, len(there))], about, day)


def of_ids(spark: SparkSession, root: str, wanted: DataFrame, wanted_col: str) -> DataFrame:
    """All rows whose id is among the values of ``wanted_col``; NULL is an id like another."""
    folder = Folder(spark, root)
    version = folder.version()
    if version is None:
        raise LookupError(f"no table in {root}")
    schema, id_col, buckets = T.StructType.fromJson(version.about["schema"]), version.about["id"], version.about["buckets"]
    kind = schema[id_col].dataType
    ids = materialize(wanted.select(F.col(f"`{wanted_col}`").cast(kind).alias("_wanted")).distinct(), "wanted-ids")
    hit = {r[0] for r in ids.select(_bucket("_wanted", kind, buckets)).distinct().collect()}  # one row per bucket at most
    generation = version.generations[0]
    paths = [f"{folder.data(generation.name)}/{_BUCKET}={b}" for b in generation.live if b in hit]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*paths)
    named = [r[0] for r in ids.limit(NAMED_IDS + 1).collect()]
    if len(named) > NAMED_IDS:
        return rows.join(sized(ids), rows[id_col].eqNullSafe(ids["_wanted"]), "left_semi")
    some = F.col(f"`{id_col}`").isin(*[n for n in named if n is not None])
    return rows.filter(some | F.col(f"`{id_col}`").isNull() if None in named else some)
