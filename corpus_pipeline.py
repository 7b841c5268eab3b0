"""From raw documents to packed training sequences: five stages, each written down before the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir).  All
but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.context import discard, materialize, scope
from fareflow.llm import common, lines, packing, passages, simhash, toxicity
from fareflow.llm.queries import TOXIC, toxicity_model
from fareflow.operators.joins import sized


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, with ``n_chars`` counted anew."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity_model(docs, labels), TOXIC)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points that five documents hold stay in the last of them.  No document goes."""
    return _counted(lines.drop_repeated(docs, min_chars=40, min_docs=5), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: of its smallest id the text with the smallest hash.

    Rows that share an id are judged each by its own text.  Rows without id stay.
    """
    key = ["doc_id", "_version"]
    found = simhash.near_duplicates(docs, shingle_words=3, max_bits=2, versions=True).withColumnRenamed("version", "_version")
    found = materialize(found.filter("doc_id is not null"), "near-duplicates")
    gone = found.filter("doc_id <> component_id or _version <> first_version").select(*key).distinct()
    gone = materialize(gone, "gone")
    left = docs.withColumn("_version", F.xxhash64("text")).join(sized(gone), key, "left_anti")
    twice = found.filter("doc_id = component_id and _version = first_version").groupBy(*key).count().filter("count > 1").select(*key)
    twice = materialize(twice, "twice")
    if twice.isEmpty():
        return left.select(*docs.columns)
    once = left.join(sized(twice), key, "left_anti").select(*docs.columns)
    again = left.join(sized(twice), key, "left_semi").dropDuplicates(key)
    return once.unionByName(again.select(*docs.columns))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages stay in the document with the smallest id that holds them.  No document goes."""
    found = materialize(passages.repeated(docs), "passages")
    return _counted(passages.remove(docs, found), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _tidy(stage):
    """The stage, starting without the intermediate tables of the one before, whose result is written by then."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release()
        with scope(spark, "pipeline"):
            return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _tidy(drop_toxic)),
    ("line dedup", _tidy(drop_lines)),
    ("SimHash near-dedup", _tidy(drop_near_duplicates)),
    ("substring dedup", _tidy(drop_passages)),
    ("packing", _tidy(pack)),
]

#: A trained model, components and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written to the shared work folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(*before)
        before = [docs]
    return docs
