"""SimHash near-duplicates by multi-index hashing (operator 3).

A fingerprint is cut into two halves.  Two fingerprints that differ in at most
two bits differ in at most one bit of the first half or in none of the second.
So each fingerprint looks up, in a table by halves, the 33 values around its
first half and its own second half, and complete distances are verified.

A half that many fingerprints share would pair them all.  Its fingerprints are
linked through the 65 complete values around each instead: two fingerprints are
within two bits exactly if some value is within one bit of both.  That finds the
same links with work in proportion to the fingerprints.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from . import common
from .components import components

BITS = 64
HALF = 32
#: Fixed value: the seed of the shingle hashes.
SEED = 42
#: A half with more fingerprints than this is linked through complete values.
#: Below it, the pairs of a looked-up half are at most this many.
SHARED = 16


def fingerprint(text: bytes | None, shingle_words: int) -> int:
    """Bits set in over half the shingles' XXH64; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    size = shingle_words
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
    bits = np.unpackbits(np.frombuffer(digests, "u1")).reshape(-1, BITS)
    majority = bits.sum(axis=0, dtype="u4") * 2 > len(bits)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


def _fingerprints(part, shingle_words: int) -> list:
    return [part.column("_id"), [fingerprint(t, shingle_words) for t in part.column("_text").to_pylist()]]


def _versions(part, shingle_words: int) -> list:
    return [*_fingerprints(part, shingle_words), part.column("_version")]


def fingerprints(
    docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text", versions: bool = False
) -> DataFrame:
    """``doc_id, bits`` (a signed 64-bit integer) of every row, and ``version``, the xxhash64 of its text, if asked for."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"), F.xxhash64(text_col).alias("_version")
    )
    if versions:
        return common.map_slices(rows, _versions, "doc_id long, bits long, version long", shingle_words)
    rows = rows.drop("_version")
    return common.map_slices(rows, _fingerprints, "doc_id long, bits long", shingle_words)


def _halves(values: DataFrame) -> DataFrame:
    """``half, value, bits``: two rows for each fingerprint."""
    both = F.array(
        F.struct(F.lit(0).alias("half"), F.expr(f"shiftrightunsigned(bits, {HALF})").alias("value")),
        F.struct(F.lit(1).alias("half"), F.expr("bits & 4294967295").alias("value")),
    )
    return values.select("bits", F.explode(both).alias("h")).select("h.half", "h.value", "bits")


def _around(column: str, bits: int, radius: int):
    """The values within ``radius`` (0 or 1) bits of a column."""
    flips = ", ".join(f"{column} ^ shiftleft(1L, {b})" for b in range(bits)) if radius else ""
    return F.expr(f"array({column}{', ' + flips if flips else ''})")


def links(values: DataFrame, max_bits: int = 2, shared: int = SHARED) -> DataFrame:
    """``a, b``: links that connect all distinct ``bits`` within ``max_bits`` (0 to 2) of each other.

    Every pair is linked directly or through common neighbours that are links too.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("halves with balls of one bit find distances of at most two")
    if max_bits == 0:
        return values.select(F.col("bits").alias("a"), F.col("bits").alias("b")).limit(0)
    table = _halves(values)
    crowded = table.groupBy("half", "value").count().filter(F.col("count") > shared).select("half", "value")
    crowded = materialize(crowded, "crowded")
    sparse = table.join(crowded, ["half", "value"], "left_anti")
    # Distance 2: one bit at most in the first half, or none in the second.  Distance 1: none in either.
    reach = _around("value", HALF, 1) if max_bits == 2 else _around("value", HALF, 0)
    asked = table.select(
        "half", F.explode(F.when(F.col("half") == 0, reach).otherwise(_around("value", HALF, 0))).alias("value"), F.col("bits").alias("b")
    )
    pairs = (
        asked.join(sparse.withColumnRenamed("bits", "a"), ["half", "value"])
        .filter(f"a < b and bit_count(a ^ b) <= {max_bits}")
        .select("a", "b")
    )
    if crowded.isEmpty():
        return pairs
    near = crowded.filter("half = 0").select("half", F.explode(_around("value", HALF, 1)).alias("value"))
    touching = table.join(near.unionByName(crowded).distinct(), ["half", "value"], "left_semi").select("bits").distinct()
    touching = materialize(touching, "crowded")
    if max_bits == 2:
        meet = touching.select("bits", F.explode(_around("bits", BITS, 1)).alias("at"))
        first = meet.groupBy("at").agg(F.min("bits").alias("a"), F.max("bits").alias("top")).filter("a < top").select("at", "a")
        stars = meet.join(first, "at").select("a", F.col("bits").alias("b")).filter("a < b")
    else:
        meet = touching.select(F.explode(_around("bits", BITS, 1)).alias("a"), F.col("bits").alias("b")).filter("a < b")
        stars = meet.join(touching.withColumnRenamed("bits", "a"), "a", "left_semi")
    return pairs.unionByName(stars)


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 3,
    max_bits: int = 2,
    shared: int = SHARED,
    id_col: str = "doc_id",
    text_col: str = "text",
    versions: bool = False,
) -> DataFrame:
    """``doc_id, bits, component_id`` of every row.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits.  Equal fingerprints are one node with its
    smallest id, so copies are never paired.  NULL and empty texts have
    fingerprint 0 and are linked like any other; a NULL id is never the
    smallest, and a component of NULL ids alone has none.  Repeated rows give
    repeated results; an empty table gives none.

    With ``versions``, ``version`` is the xxhash64 of the text and ``first_version``
    the smallest one that ``component_id`` has in the component: rows may share an id.
    """
    rows = materialize(fingerprints(docs, shingle_words, id_col, text_col, versions), "fingerprints")
    smallest = F.min(F.expr("if(doc_id is null, null, struct(doc_id, version))")) if versions else F.min("doc_id")
    nodes = materialize(rows.groupBy("bits").agg(smallest.alias("low")), "nodes")
    roots = components(links(nodes.select("bits"), max_bits, shared))
    placed = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        "bits", "low", F.coalesce("root", "bits").alias("root")
    )
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(placed.join(lowest, "root").select("bits", "component_id"), "named")
    if versions:
        first = ["component_id.doc_id as component_id", "component_id.version as first_version"]
        return rows.join(named, "bits").selectExpr("doc_id", "bits", "version", *first)
    return rows.join(named, "bits").select("doc_id", "bits", "component_id")
