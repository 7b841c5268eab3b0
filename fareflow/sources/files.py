"""Typed readers.  Nothing infers a schema: landing text is converted at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fares import whole_number


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV with declared types; a field that does not parse is NULL.

    With a header, columns are taken by name, whatever their order and case, and
    further columns are left out.  A missing column is an error, and so is a file
    whose header differs from that of the others.  Without a header, columns are
    taken by position.
    """
    if not header:
        return typed(spark.read.schema(text_schema(schema.names)).csv(path), schema)
    names = spark.read.option("header", True).csv(path).columns
    found = {n.lower(): n for n in names}
    missing = [n for n in schema.names if n.lower() not in found]
    if missing:
        raise ValueError(f"no such columns in the header of {path}: {missing}")
    # Read as text by the files' own header, which Spark then compares for every file.
    text = spark.read.schema(text_schema(names)).options(header=True, enforceSchema=False).csv(path)
    return typed(text.select(*[F.col(f"`{found[n.lower()]}`").alias(n) for n in schema.names]), schema)


def text_schema(names: list[str]) -> T.StructType:
    """All-text schema of a header-less landing file."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines documents, one unparsed ``doc`` text per row."""
    return spark.read.text(path).withColumnRenamed("value", "doc")


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Convert text columns to a schema; what does not parse becomes NULL."""

    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        whole = isinstance(field.dataType, (T.IntegerType, T.LongType))
        return whole_number(column, field.dataType) if whole else column.try_cast(field.dataType)

    return df.select(*[convert(f).alias(f.name) for f in schema.fields])
