"""I-Match fingerprints from terms of middling document frequency (operator 8).

A term is a word, known by a 64-bit hash.  The documents that hold each term are
counted exactly; terms held by a share of the documents within a band form the
lexicon.  A term in the band is in a fixed share of all documents, so a lexicon
has at most (distinct terms of a document) / (that share) terms, whatever the
corpus; it is broadcast where it is measured to be small and shuffled otherwise.

A text's distinct lexicon terms are sorted and hashed once for each of several
random subsets of the lexicon.  Subsets of several densities serve short and long
texts: dense ones tell short texts apart, thin ones let long texts agree.  Terms
are rows here: each meets the lexicon, goes to its subsets, and is gathered again
by text and subset, all within the one partition its text was dealt to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import discard, materialize
from ..operators.joins import sized

#: The band: a term belongs to the lexicon if this share of the documents, at least and at most, holds it.
BAND = (0.0002, 0.05)
#: Subsets: of 2 ** bits parts of the lexicon, how many are fingerprinted.  The first level's hold the whole lexicon.
SUBSETS = ((3, 8), (6, 24), (8, 32), (10, 32))
#: The number that stands for no subset but for all terms of a text, in the lexicon or not.
EVERY = 255
#: Where rows without id stand in the order: before all others.
LEAST = -(1 << 63)
#: Fixed value: words are what stands between these.
SPACE = r"[ \t\n\x0B\f\r]+"


def terms(text: Column) -> Column:
    """Hashes of the distinct words of a text, lowered, without outer signs."""
    words = F.split(F.lower(text), SPACE)
    bare = F.transform(words, lambda w: F.xxhash64(F.btrim(w, F.lit(".,;:!?\"'()[]{}*&%$#"))))
    return F.array_distinct(bare)


def lexicon(rows: DataFrame, documents: int, band: tuple[float, float] = BAND) -> DataFrame:
    """``lexicon_term``: the terms held by a share of all ``documents`` documents within the band."""
    held = rows.select(F.explode(terms(F.col("text"))).alias("lexicon_term"))
    low, high = (share * documents for share in band)
    counted = held.groupBy("lexicon_term").agg(F.count("*").alias("n"))
    return counted.filter((F.col("n") >= low) & (F.col("n") <= max(high, 1.0))).select("lexicon_term")


def _subsets(term: Column) -> Column:
    """Numbers of the subsets a lexicon term is in, one of a level at most; each level has bits of the hash of its own."""
    found, below, before = [], 0, 0
    for bits, count in SUBSETS:
        part = F.shiftrightunsigned(term, below).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        found.append(F.when(part < count, part + before))
        below, before = below + bits, before + count
    return F.array_compact(F.array(*found))


def fingerprints(rows: DataFrame, on: list[str], texts: dict[str, str], known: DataFrame) -> DataFrame:
    """``on`` and, for each text column, a struct of that name: ``whole`` and the sorted ``marks`` of its subsets.

    ``whole`` stands for all lexicon terms, as the hash of the first level's hashes, or
    is the hash of all terms where a text has none in the lexicon.  A mark is a subset's number, then 31 bits of the hash of its
    terms.  ``rows`` has one row for each ``on`` and should be dealt by it: then
    nothing is shuffled here but a lexicon too large to broadcast.  ``texts`` maps
    result names to columns.
    """
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("text")) for i, c in enumerate(texts.values())])
    each = rows.select(*on, F.inline(sides)).select(*on, "side", F.sort_array(terms(F.col("text"))).alias("terms"))
    # Behind the terms stands the hash of them all.
    every = each.select(*on, "side", F.size("terms").alias("n"), F.concat("terms", F.array(F.xxhash64("terms"))).alias("terms"))
    long = every.select(*on, "side", "n", F.posexplode("terms").alias("at", "term"))
    last = F.col("at") == F.col("n")
    met = long.join(sized(known), (F.col("term") == F.col("lexicon_term")) & ~last, "left").filter(last | F.col("lexicon_term").isNotNull())
    dealt = met.select(*on, "side", "term", F.explode(F.when(last, F.array(F.lit(EVERY))).otherwise(_subsets(F.col("term")))).alias("subset"))
    hashed = dealt.groupBy(*on, "side", "subset").agg(F.sort_array(F.collect_list("term")).alias("members"))
    value = F.when(F.col("subset") == EVERY, F.get("members", F.lit(0))).otherwise(F.xxhash64("members"))
    hashed = hashed.select(*on, "side", "subset", value.alias("hash"))
    mark = F.shiftleft(F.col("subset").cast("long"), 32).bitwiseOR(F.col("hash").bitwiseAND(F.lit(0x7FFFFFFF)))
    made = []
    for i, name in enumerate(texts):
        of = F.col("side") == i
        whole = F.sort_array(F.collect_list(F.when(of & (F.col("subset") < SUBSETS[0][1]), F.col("hash"))))
        every_ = F.max(F.when(of & (F.col("subset") == EVERY), F.col("hash")))
        marks = F.sort_array(F.collect_list(F.when(of & (F.col("subset") < EVERY), mark)))
        made.append(F.struct(F.when(F.size(whole) > 0, F.xxhash64(whole)).otherwise(every_).alias("whole"), marks.alias("marks")).alias(name))
    return hashed.groupBy(*on).agg(*made)


def written(print_: Column) -> Column:
    """A fingerprint as text."""
    marks = F.transform(print_["marks"], lambda m: F.lpad(F.lower(F.hex(m)), 10, "0"))
    return F.concat(F.lpad(F.lower(F.hex(print_["whole"])), 16, "0"), F.lit(":"), F.array_join(marks, ""))


def likeness(a: Column, b: Column) -> Column:
    """1 where all terms agree; else the share of the subsets with terms in either text that agree."""
    subsets = lambda p: F.transform(p["marks"], lambda m: F.shiftright(m, 32))
    same = F.size(F.array_intersect(a["marks"], b["marks"]))
    either = F.size(F.array_union(subsets(a), subsets(b)))
    return F.when(a["whole"] == b["whole"], 1.0).when(either == 0, 0.0).otherwise(same / either)


def _neighbours(keys: DataFrame) -> DataFrame:
    """``doc_key, version`` of every document with its next one's, and with the one before and its length, in a ring.

    Order is by id, then by hash of the text.  Only keys move here: each sorted
    range is linked inside, and one row per range links the ranges.
    """
    ranged = materialize(keys.repartitionByRange("doc_key", "version").withColumn("range", F.spark_partition_id()), "ring")
    own = F.struct("doc_key", "version", "n")
    ends = ranged.groupBy("range").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    ring, all_ranges = Window.orderBy("range"), Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "range",
        F.coalesce(F.lead("first").over(ring), F.first("first").over(all_ranges)).alias("after"),
        F.coalesce(F.lag("last").over(ring), F.last("last").over(all_ranges)).alias("before"),
    )
    inside = Window.partitionBy("range").orderBy("doc_key", "version")
    linked = ranged.select("*", F.lead(own).over(inside).alias("up"), F.lag(own).over(inside).alias("down"))
    linked = linked.join(sized(ends), "range")
    after, before = F.coalesce("up", "after"), F.coalesce("down", "before")
    return linked.select(
        "doc_key",
        "version",
        after["doc_key"].alias("next_key"),
        after["version"].alias("next_version"),
        before["doc_key"].alias("last_key"),
        before["version"].alias("last_version"),
        before["n"].alias("last_n"),
    )


def compare_with_edited(
    docs: DataFrame, band: tuple[float, float] = BAND, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    A text is edited by putting the first half-length of the next document's text
    in the place of its last half.  Documents follow each other by id; the first
    follows the last.  NULL is an empty text; a text without words has the hash
    of no terms.  Rows equal in id and text are one document and give a result
    each; rows that share an id follow each other by hash of their texts; NULL
    ids come first, as if they were the smallest of all numbers, which stands for them.  A single document follows itself; an empty table gives none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own_key = F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("doc_key")
    rows = docs.select(own_key, text.alias("text"), F.xxhash64(text).alias("version"))
    # The corpus: what every document holds.
    documents = rows.count()
    known = materialize(lexicon(rows, documents, band), "lexicon")
    keys = rows.select("doc_key", "version", F.char_length("text").alias("n")).distinct()
    ring = materialize(_neighbours(keys), "ring")
    repeats = ring.count() < documents
    on = ["doc_key", "version"]
    # Texts move once: both sides of the second join read the same columns, so Spark uses one exchange for both.
    placed = rows.join(ring, on)
    heads = placed.select(
        F.col("last_key").alias("doc_key"),
        F.col("last_version").alias("version"),
        F.expr("substring(text, 1, cast(last_n div 2 as int))").alias("head"),
    )
    if repeats:
        heads = heads.groupBy(*on).agg(F.min("head").alias("head"))
    edited = F.expr("concat(substring(text, 1, char_length(text) - cast(char_length(text) div 2 as int)), head)")
    made = placed.join(heads, on).select(*on, "next_key", "next_version", "text", edited.alias("edited"))
    one = made.dropDuplicates(on) if repeats else made
    prints = fingerprints(one, on, {"print": "text", "edited_print": "edited"}, known)
    made = made.select(*on, "next_key", "next_version", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    made = materialize(made.join(prints, on), "fingerprints")
    discard(known, ring)  # and the shuffled texts with them
    after = made.select(F.col("doc_key").alias("next_key"), F.col("version").alias("next_version"), F.col("print").alias("next_print"))
    if repeats:
        after = after.dropDuplicates(["next_key", "next_version"])
    met = made.join(after, ["next_key", "next_version"])
    return met.select(
        F.nullif("doc_key", F.lit(LEAST)).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        written(F.col("print")).alias("fingerprint"),
        written(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
