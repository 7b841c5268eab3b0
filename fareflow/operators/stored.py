"""A stored table with a key: upserts, deletes and look-ups that touch only the buckets they hit.

Rows are dealt into buckets by a hash of their key.  A write adds a *delta*, a
generation of files in the buckets its keys fall into, and publishes it (see
:mod:`fareflow.sinks.manifests`); it reads nothing.  A bucket's generations are
merged when it is read.  Where a bucket has gathered more than ``max_deltas``,
a compaction rewrites that bucket alone.

Files are sorted by key and carry bloom filters of it, so a look-up of a few
keys reads few pages of few files.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import BYTES_PER_TASK, materialize
from ..sinks.manifests import Folder, Generation, Version
from . import windows
from .joins import sized, table_bytes

#: What a stored row does to its key.
SET, REPLACE, DELETE = 0, 1, 2
#: Up to so many keys are named in the filter that reaches the files; more are joined.
NAMED_KEYS = 1_000

_SEQ, _KIND, _BUCKET, _GEN = "_seq", "_kind", "_bucket", "_gen"


class KeyedTable:
    """One row per key; NULL is a key like another."""

    def __init__(self, spark: SparkSession, root: str, max_deltas: int = 8):
        self._folder, self._max = Folder(spark, root), max_deltas
        self.spark = spark

    # --- what is there -----------------------------------------------------------

    def exists(self) -> bool:
        return self._folder.version() is not None

    def create(self, schema: T.StructType, keys: list[str], buckets: int, day: date | None = None) -> "KeyedTable":
        """An empty table; a table that is there already stays as it is."""
        taken = {_SEQ, _KIND, _BUCKET, _GEN} & set(schema.names)
        if taken:
            raise ValueError(f"names that the table uses itself: {sorted(taken)}")
        if not self.exists():
            self._folder.publish(None, [], {"schema": schema.jsonValue(), "keys": keys, "buckets": buckets}, day)
        return self

    def _last(self) -> Version:
        found = self._folder.version()
        if found is None:
            raise LookupError(f"no table in {self._folder.root}")
        return found

    @property
    def keys(self) -> list[str]:
        return self._last().about["keys"]

    @property
    def buckets(self) -> int:
        return self._last().about["buckets"]

    @staticmethod
    def _schema(version: Version) -> T.StructType:
        return T.StructType.fromJson(version.about["schema"])

    def _bucket(self, version: Version) -> Column:
        # Keys as the table's own types, so that 1 as int and as long are one key.
        kinds = {f.name: f.dataType for f in self._schema(version).fields}
        hashed = F.xxhash64(*[F.col(f"`{k}`").cast(kinds[k]) for k in version.about["keys"]])
        return F.pmod(hashed, F.lit(version.about["buckets"])).cast("int")

    def read(self, number: int | None = None) -> DataFrame:
        """All rows, of the last version or of another one that was not expired."""
        version = self._last() if number is None else self._folder.version(number)
        return self._rows(version, None)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows of the keys in ``wanted``; only the buckets they fall into are read.

        A short list reaches the files as a filter, where sorted pages and bloom
        filters skip what cannot match.
        """
        version = self._last()
        keys = version.about["keys"]
        kinds = {f.name: f.dataType for f in self._schema(version).fields}
        wanted = wanted.select(*[F.col(f"`{k}`").cast(kinds[k]).alias(k) for k in keys]).distinct()
        wanted = materialize(wanted, "wanted-keys")
        hit = [r[0] for r in wanted.select(self._bucket(version)).distinct().collect()]  # at most one row per bucket
        only = None
        if len(keys) == 1:
            named = [r[0] for r in wanted.limit(NAMED_KEYS + 1).collect()]
            if len(named) <= NAMED_KEYS:
                only = F.col(f"`{keys[0]}`").isin(*[n for n in named if n is not None])
                if None in named:
                    only |= F.col(f"`{keys[0]}`").isNull()
        rows = self._rows(version, set(hit), only)
        return rows if only is not None else rows.join(sized(wanted), [rows[k].eqNullSafe(wanted[k]) for k in keys], "left_semi")

    def _rows(self, version: Version, buckets: set[int] | None, only: Column | None = None) -> DataFrame:
        """Merged rows of some buckets.  Buckets with one generation need no merge and no shuffle."""
        count: dict[int, int] = {}
        for g in version.generations:
            for b in g.live:
                count[b] = count.get(b, 0) + 1
        wanted = set(count) if buckets is None else buckets & set(count)
        once = {b for b in wanted if count[b] == 1}
        columns = self._schema(version).names
        clean = self._files(version, once, only).filter(F.col(_KIND) != DELETE).select(*[F.col(f"`{c}`") for c in columns])
        if once == wanted:
            return clean
        return clean.unionByName(self._merged(version, self._files(version, wanted - once, only)))

    def _files(self, version: Version, buckets: set[int], only: Column | None) -> DataFrame:
        schema = self._schema(version).add(_SEQ, T.LongType()).add(_KIND, T.IntegerType())
        paths = []
        for g in version.generations:
            live = [b for b in g.live if b in buckets]
            folder = self._folder.data(g.name)
            paths += [folder] if len(live) == g.written else [f"{folder}/{_BUCKET}={b}" for b in live]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self._folder.root}/data").parquet(*paths)
        rows = rows.select(*[F.col(f"`{c}`") for c in schema.names])
        return rows if only is None else rows.filter(only)

    @staticmethod
    def _merged(version: Version, rows: DataFrame) -> DataFrame:
        """One row per key: the fields as the generations set them, one after the other.

        A row that replaces or deletes ends what came before.  A key has at most one
        row in each generation, so none is hot.
        """
        keys = version.about["keys"]
        columns = KeyedTable._schema(version).names
        every = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
        begun = F.max(F.when(F.col(_KIND) != SET, F.col(_SEQ))).over(every)
        rows = rows.withColumn("_begun", begun).filter(F.col("_begun").isNull() | (F.col(_SEQ) >= F.col("_begun")))
        newest = lambda c: F.expr(f"max_by(`{c}`, {_SEQ}) filter (where `{c}` is not null)").alias(c)
        found = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
            *[newest(c) for c in columns if c not in keys], F.max_by(_KIND, _SEQ).alias(_KIND)
        )
        return found.filter(F.col(_KIND) != DELETE).select(*[F.col(f"`{c}`") for c in columns])

    # --- changes -----------------------------------------------------------------

    def upsert(self, updates: DataFrame, mode: str = "replace", version: str | None = None, day: date | None = None) -> None:
        """Bring in rows by key.

        ``replace`` puts a whole record in the place of the old one; ``set`` overwrites
        with the fields that are not NULL and may carry fewer columns.  Of updates
        with one key the largest ``version`` counts (then the largest in the other
        columns); ``version`` itself is stored only if the table has it.
        """
        if mode not in ("replace", "set"):
            raise ValueError("mode is replace or set")
        last = self._last()
        schema, keys = self._schema(last), last.about["keys"]
        missing = [c for c in schema.names if c not in updates.columns]
        if mode == "replace" and missing:
            raise ValueError(f"a record needs all columns: {missing}")
        brought = [c for c in schema.names if c in updates.columns]
        if version and version not in brought:
            brought.append(version)
        newest = windows.latest(updates.select(*[F.col(f"`{c}`") for c in brought]), keys, [version] if version else [])
        filled = [(F.lit(None) if f.name in missing else F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in schema.fields]
        self._add(last, newest.select(*filled), REPLACE if mode == "replace" else SET, day)

    def delete(self, gone: DataFrame, day: date | None = None) -> None:
        """Take the rows of some keys out."""
        last = self._last()
        schema, keys = self._schema(last), last.about["keys"]
        rows = gone.select(*[F.col(f"`{k}`") for k in keys]).distinct()
        filled = [(F.col(f"`{f.name}`") if f.name in keys else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        self._add(last, rows.select(*filled), DELETE, day)

    def _add(self, last: Version, rows: DataFrame, kind: int, day: date | None) -> None:
        made = self._write(last, rows, kind)
        last = self._folder.publish(last, [*last.generations, made] if made else last.generations, last.about, day)
        if self._crowded(last):
            self.compact(day)

    def _write(self, last: Version, rows: DataFrame, kind: int) -> Generation | None:
        """Put rows aside in a generation of their own; which buckets it has is seen from its folders."""
        name = self._folder.new_generation(last)
        keys = last.about["keys"]
        dealt = rows.withColumns({_SEQ: F.lit(last.number + 1).cast("long"), _KIND: F.lit(kind), _BUCKET: self._bucket(last)})
        writer = dealt.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, *[F.col(f"`{k}`") for k in keys]).write
        for k in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        writer.partitionBy(_BUCKET).parquet(self._folder.data(name))
        hit = self._folder.parts(name, _BUCKET)
        return Generation(name, hit, len(hit)) if hit else None

    def _crowded(self, version: Version) -> set[int]:
        count: dict[int, int] = {}
        for g in version.generations:
            for b in g.live:
                count[b] = count.get(b, 0) + 1
        return {b for b, n in count.items() if n > self._max + 1}

    def compact(self, day: date | None = None, everything: bool = False) -> None:
        """Rewrite the buckets that have gathered many generations, or all that have more than one."""
        last = self._last()
        buckets = {b for g in last.generations for b in g.live} if everything else self._crowded(last)
        if not buckets:
            return
        made = self._write(last, self._rows(last, buckets), REPLACE)
        left = [Generation(g.name, [b for b in g.live if b not in buckets], g.written) for g in last.generations]
        self._folder.publish(last, [*[g for g in left if g.live], *([made] if made else [])], last.about, day)

    def resize(self, buckets: int | None = None, day: date | None = None) -> None:
        """Deal all rows anew, into a given number of buckets or as many as their size asks for."""
        last = self._last()
        rows = self.read()
        changed = Version(last.number, last.day, last.about | {"buckets": buckets or buckets_for(rows)}, [])
        made = self._write(changed, rows, REPLACE)
        self._folder.publish(last, [made] if made else [], changed.about, day)

    def expire(self, before: date) -> list[str]:
        """Delete versions dated before a day and the files only they name; the last version stays."""
        return self._folder.expire(before)


def buckets_for(rows: DataFrame, each: int = BYTES_PER_TASK) -> int:
    """Buckets of about ``each`` bytes; a power of two."""
    return 1 << max(0, (-(-table_bytes(rows) // each) - 1).bit_length())


def stored(spark: SparkSession, root: str, like: DataFrame, keys: list[str], buckets: int | None = None) -> KeyedTable:
    """The table in a folder; where there is none yet, an empty one with the columns of ``like``."""
    table = KeyedTable(spark, root)
    return table if table.exists() else table.create(like.schema, keys, buckets or max(8, buckets_for(like)))
