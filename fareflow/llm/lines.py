"""Lines that many documents repeat, by levelled sorted runs (operator 7).

Documents come in batches, the largest ids first.  The keys of their lines are
held in *runs*: tables with one row per key, sorted and bucketed by it, so that
a new batch meets them in a merge join without moving them.  A batch's keys
that no run knows yet are found by anti-join; the largest id in the batch is
then the largest of all, and keeps the line.  The batch becomes a run of its
own.  Runs of one level are merged into one of the next when there are
``FAN_IN`` of them, so a key is rewritten once per level.

When all batches are in, the runs tell how many documents hold each key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import materialize, work_dir
from ..operators.joins import sized

#: Runs of a level that make one of the next.
FAN_IN = 4
#: Columns that :func:`drop_repeated` adds.
ADDED = ("n_lines", "n_dropped")
#: Fixed value: the white space that is stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"


def key(line: Column) -> Column:
    """The line without outer white space and with A-Z lowered."""
    bare = F.btrim(line, F.lit(BLANKS))
    # For ASCII, lower() touches A-Z only; translate() is right for the rest, and slow.
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, letters, letters.lower()))


def _digest(text: Column) -> Column:
    """128 bits of a key, as two numbers; the second hash starts from another seed, so neither follows from the other."""
    return F.struct(F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2"))


class Runs:
    """Line keys seen so far: ``k1, k2, docs, keeper``, one row per key and run.

    ``docs`` counts documents.  ``keeper`` is set in the run that met the key
    first.  Runs lie in the shared work folder as bucketed tables of the session
    catalog and are dropped from the catalog by :meth:`close`.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self._spark = spark
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._levels: list[list[str]] = []
        self._paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self._paths[name] = work_dir(self._spark, "line-run")
        writer = rows.write.bucketBy(self._buckets, "k1", "k2").sortBy("k1", "k2")
        writer.option("path", self._paths[name]).saveAsTable(name)
        return name

    def tables(self) -> list[DataFrame]:
        return [self._spark.table(name) for level in self._levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Take in ``k1, k2, doc_id`` of a batch whose ids all lie below those of earlier batches.

        The anti-join is written as outer merge joins: the rows that no run
        matches are new, and the others are still needed for their counts.
        """
        rows = batch.distinct().groupBy("k1", "k2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
        new = F.lit(True)
        for i, run in enumerate(self.tables()):
            known = run.filter("keeper is not null").select("k1", "k2", F.lit(True).alias(f"known{i}"))
            rows = rows.join(known, ["k1", "k2"], "left")
            new &= F.col(f"known{i}").isNull()
        self._place(self._write(rows.select("k1", "k2", "docs", F.when(new, F.col("keeper")).alias("keeper"))), 0)

    def _place(self, name: str, level: int) -> None:
        while len(self._levels) <= level:
            self._levels.append([])
        self._levels[level].append(name)
        if len(self._levels[level]) == FAN_IN:
            merged = self._write(self._merged(self._levels[level]))
            self._drop(self._levels[level])
            self._levels[level] = []
            self._place(merged, level + 1)

    def _merged(self, names: list[str]) -> DataFrame:
        # Read as plain files: Spark 4.1 takes a union of bucketed tables for bucketed and leaves out the
        # exchange, though the union does not bring their buckets together.
        schema = self._spark.table(names[0]).schema
        rows = self._spark.read.schema(schema).parquet(*(self._paths[n] for n in names))
        return rows.groupBy("k1", "k2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def totals(self) -> DataFrame:
        return self._merged([name for level in self._levels for name in level])

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        for level in self._levels:
            self._drop(level)
        self._levels = []


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows with ``text`` without repeated lines, and ``n_lines, n_dropped``.

    A line goes if its key has ``min_chars`` code points, ``min_docs`` documents
    hold the key, and the document is not the largest id among them.  All columns
    stay.  A NULL or empty text is one empty line and comes back empty.  Rows
    that repeat an id are one document: a key is counted once for them, and each
    row loses the same lines.  Columns of the caller named like the added ones
    are replaced.  A row without an id is no document: it is not
    counted and loses nothing.  An empty table gives none.
    """
    spark = docs.sparkSession
    # Names of the helper columns cannot clash with the caller's: those are kept in one struct.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col(f"row.`{id_col}`").alias("doc_id"), F.col(f"row.`{text_col}`").alias("text"))
    one = rows.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("version"))
    exploded = one.select("doc_id", "version", F.posexplode(split_lines(F.col("text"))).alias("line", "words"))
    keyed = exploded.select("doc_id", "version", "line", key(F.col("words")).alias("key"))
    long = keyed.filter(F.char_length("key") >= min_chars).select("doc_id", "version", "line", _digest(F.col("key")).alias("d"))
    long = long.select("d.k1", "d.k2", "doc_id", "version", "line")
    long = materialize(long, "long-lines")
    edges = long.agg(F.expr(f"percentile_approx(doc_id, array({', '.join(str(i / batches) for i in range(1, batches))}))")).first()[0] if batches > 1 else []
    runs = Runs(spark)
    top = None
    for edge in [*sorted(set(edges or []), reverse=True), None]:
        part = long if top is None else long.filter(F.col("doc_id") < top)
        runs.add((part if edge is None else part.filter(F.col("doc_id") >= edge)).select("k1", "k2", "doc_id"))
        top = edge
    frequent = materialize(runs.totals().filter(F.col("docs") >= min_docs).select("k1", "k2", "keeper"), "frequent-lines")
    runs.close()
    gone = long.join(sized(frequent), ["k1", "k2"]).filter("doc_id <> keeper")
    gone = gone.groupBy("doc_id", "version").agg(F.collect_set("line").alias("gone"))
    joined = rows.withColumn("version", F.xxhash64("text")).join(
        gone.withColumnRenamed("doc_id", "gone_id").withColumnRenamed("version", "gone_version"),
        (F.col("doc_id") == F.col("gone_id")) & (F.col("version") == F.col("gone_version")),
        "left",
    )
    lines = joined.withColumn("lines", split_lines(F.col("text")))
    stay = F.expr("transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i])")
    kept = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(stay, "\n"))
    return lines.select(
        *[(kept if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in ADDED],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
