"""Sharding by extendible hashing (operator 6).

A directory is indexed by the leading bits of a row's hash.  A bucket that holds
more bytes than a shard may is split on one more bit; the others stay as they
are.  Each round looks ``AHEAD`` bits further into the buckets that are still too
large: one pass sums the bytes of their cells, from which all splits of these
bits follow, so a row is read once per round and leaves when its bucket fits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import materialize
from ..operators.joins import sized

#: Bits of directory that a round can add.
AHEAD = 8
#: Hash bits.  The first 64 come from the id; rows that share all of them are told apart by the others.
BITS = 128


def _bits(at: int) -> str:
    """``AHEAD`` hash bits from bit ``at`` on, as a number."""
    word, shift = ("h1", 64 - AHEAD - at) if at < 64 else ("h2", BITS - AHEAD - at)
    return f"cast(shiftrightunsigned({word}, {shift}) & {(1 << AHEAD) - 1} as int)"


def _split(cells: DataFrame, limit: int, depth: int) -> DataFrame:
    """``prefix, cell, added``: how many bits each cell's bucket needs; NULL where all ``AHEAD`` are not enough.

    ``cells`` has bytes and rows of each cell of each oversized ``prefix``, at
    most ``2 ** AHEAD`` of them.
    """
    found = cells.repartition("prefix")
    needed = F.lit(AHEAD if depth + AHEAD >= BITS else None).cast("int")
    for added in range(AHEAD, 0, -1):  # the first bucket on the way down that fits is found last
        bucket = Window.partitionBy("prefix", F.shiftright("cell", AHEAD - added))
        fits = (F.sum("bytes").over(bucket) <= limit) | (F.sum("n").over(bucket) == 1)
        found = found.withColumn(f"fits{added}", fits)
        needed = F.when(F.col(f"fits{added}"), added).otherwise(needed)
    return found.select("prefix", "cell", needed.alias("added"))


def assign(
    docs: DataFrame, max_bytes: int, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, bytes, shard, depth`` of every row, and ``carried``, a struct of the columns ``carry``.

    ``bytes`` are those of the text in UTF-8.  ``shard`` is the string of the
    ``depth`` leading hash bits that all its rows share and no other shard's rows
    have.  A shard has at most ``max_bytes``, but for a single row that is larger
    by itself.  Rows that share an id begin with the same 64 bits and are told
    apart by the others, which come from their place in the input, so copies can
    be split too; NULL is an id like another.  NULL and empty texts have no
    bytes.  If everything fits in one shard, its name is empty; an empty table
    has none.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("bytes"),
        F.xxhash64(id_col).alias("h1"),
        F.xxhash64(F.monotonically_increasing_id(), F.lit("place")).alias("h2"),
        F.lit("").alias("prefix"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    # The place in the input is settled here, once.
    rows = materialize(rows, "shard-rows")
    kept = ["doc_id", "bytes", *(["carried"] if carry else [])]
    total, count = rows.agg(F.sum("bytes"), F.count("*")).first()
    done = rows.select(*kept, F.col("prefix").alias("shard"), F.lit(0).alias("depth"))
    if count <= 1 or total <= max_bytes:
        return done
    done = done.limit(0)
    for depth in range(0, BITS, AHEAD):
        keyed = rows.withColumn("cell", F.expr(_bits(depth)))
        cells = keyed.groupBy("prefix", "cell").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        found = materialize(_split(cells, max_bytes, depth), "shard-directory")
        bits = F.expr(f"substring(lpad(bin(cell), {AHEAD}, '0'), 1, coalesce(added, {AHEAD}))")
        placed = keyed.join(sized(found), ["prefix", "cell"]).select(
            *kept, "h1", "h2", F.concat("prefix", bits).alias("prefix"), F.col("added").isNotNull().alias("settled")
        )
        placed = materialize(placed, "shard-rows")
        done = done.unionByName(
            placed.filter("settled").select(*kept, F.col("prefix").alias("shard"), F.length("prefix").alias("depth"))
        )
        rows = placed.filter("not settled").drop("settled")
        if rows.isEmpty():
            break
    return done


def directory(assigned: DataFrame) -> DataFrame:
    """``shard, depth, rows, bytes`` of every shard."""
    return assigned.groupBy("shard", "depth").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))

