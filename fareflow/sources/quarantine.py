"""Records that do not fit their schema, kept aside with the reasons.

Every record is judged once.  Good ones come back typed; bad ones keep their text
and say what is wrong with each field; how many there were of which kind is
counted in the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import materialize
from ..functions.fares import whole_number
from .files import text_schema

#: Fixed value: the reason given for a record whose text cannot be taken apart.
MALFORMED = "malformed"

_CORRUPT, _RECORD, _REASONS = "_corrupt_record", "_record", "_reasons"


@dataclass(frozen=True)
class Judged:
    """``good`` has the schema's columns; ``bad`` has ``record`` and ``reasons``.

    ``counts`` has ``records``, ``bad``, ``malformed`` and a number for each field.
    """

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def _typed(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    whole = isinstance(field.dataType, (T.IntegerType, T.LongType))
    return whole_number(column, field.dataType) if whole else column.try_cast(field.dataType)


def _judge(text: DataFrame, schema: T.StructType, required: list[str]) -> Judged:
    """``text`` has the schema's fields as text, ``_corrupt_record`` and ``_record``."""
    taken = {_CORRUPT, _RECORD, _REASONS} & set(schema.names)
    if taken:
        raise ValueError(f"names that are used here: {sorted(taken)}")
    whole = F.col(_CORRUPT).isNull()
    wrong: dict[str, Column] = {}
    reasons = [F.when(~whole, F.lit(MALFORMED))]
    for field in schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        given = column.isNotNull() & (F.trim(column) != "")
        unfit = whole & given & _typed(field).isNull()
        reason = F.when(unfit, F.lit(f"{field.name}: not {kind}"))
        if field.name in required:
            reason = reason.when(whole & ~given, F.lit(f"{field.name}: missing"))
        wrong[field.name] = reason
        reasons.append(reason)
    judged = text.select(
        F.col(_RECORD), F.array_compact(F.array(*reasons)).alias(_REASONS), *[_typed(f).alias(f.name) for f in schema.fields]
    )
    # Counted while the judged records are written.
    seen = Observation()
    has = lambda prefix: F.count(F.when(F.exists(_REASONS, lambda r: r.startswith(prefix)), 1))
    judged = judged.observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(F.size(_REASONS) > 0, 1)).alias("bad"),
        has(MALFORMED).alias(MALFORMED),
        *[has(f"{name}: ").alias(f"field {name}") for name in schema.names],
    )
    stored = materialize(judged, "judged")
    counts = {k.removeprefix("field "): v for k, v in seen.get.items()}
    good = stored.filter(F.size(_REASONS) == 0).select(*[F.col(f"`{c}`") for c in schema.names])
    bad = stored.filter(F.size(_REASONS) > 0).select(F.col(_RECORD).alias("record"), F.col(_REASONS).alias("reasons"))
    return Judged(good, bad, counts)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, required: list[str] = (), header: bool = False) -> Judged:
    """CSV records by position.

    A record with too few or too many fields is malformed.  A field that is given but
    does not parse is unfit, and an empty one in ``required`` is missing; other
    empty fields are NULL.
    """
    fields = text_schema([*schema.names, _CORRUPT])
    options = {"header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = spark.read.schema(fields).options(**options).csv(path)
    # The text of a whole record is put together again from its fields.
    record = F.coalesce(F.col(_CORRUPT), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in schema.names])))
    return _judge(text.withColumn(_RECORD, record), schema, list(required))


def read_documents(docs: DataFrame, schema: T.StructType, required: list[str] = (), doc: str = "doc") -> Judged:
    """Flat JSON documents, one text per row; one that is no JSON object is malformed, NULL too."""
    fields = text_schema([*schema.names, _CORRUPT])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = docs.select(F.coalesce(F.col(doc), F.lit("")).alias(_RECORD)).select(_RECORD, F.from_json(_RECORD, fields, options).alias("_d"))
    broken = F.when(F.col("_d").isNull() | (F.trim(_RECORD) == ""), F.col(_RECORD)).otherwise(F.col(f"_d.{_CORRUPT}"))
    named = [F.col(f"_d.`{c}`").alias(c) for c in schema.names]
    return _judge(text.select(_RECORD, *named, broken.alias(_CORRUPT)), schema, list(required))
