"""Vector code compression with exact slice-and-intersect search (operator 13).

A vector is cut into equal parts and each part is replaced by the index of the
nearest of a few codebook entries.  To find it without comparing all entries,
their coordinates are sorted in each dimension, and every place in that order
carries a *prefix mask*: one bit for each entry before it.  The distance to the
nearest of a few entries, neighbours in the widest dimensions, is the initial
radius.  In each dimension the entries within the radius are a slice of the sorted coordinates,
and two prefix masks give the slice as one uint64; all dimensions' masks ANDed
leave exactly the entries of a box that holds the ball, so the nearest entry and
all its ties are among them.  Only these are compared.

Codebooks are refined in rounds: each task assigns its rows and adds up parts by
entry, and a shuffle adds the tasks' sums, so what reaches the driver is one
codebook.  All arithmetic is on whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from ..context import materialize
from ..operators.joins import sized
from . import common

#: Entries a codebook can have: the bits of a mask.
MAX_ENTRIES = 64
#: Columns that :func:`compress` adds.
ADDED = ("codes", "errors")
#: Dimensions in which a near entry is looked for, for the initial radius.
GUESSES = 3
#: Rows a task turns into numbers at a time.
ROWS = 4096


@dataclass(frozen=True)
class Slices:
    """One part's codebook, sorted by each dimension."""

    entries: np.ndarray  # (entries, width)
    order: np.ndarray  # coordinates ascending, (width, entries)
    masks: np.ndarray  # prefix masks, (width, entries + 1), uint64
    widest: list[int]  # the dimensions in which the entries are spread most

    @staticmethod
    def of(entries: np.ndarray) -> "Slices":
        places = np.argsort(entries, axis=0, kind="stable").T
        bits = np.uint64(1) << places.astype(np.uint64)
        masks = np.concatenate([np.zeros((len(bits), 1), np.uint64), np.bitwise_or.accumulate(bits, axis=1)], axis=1)
        spread = entries.max(axis=0) - entries.min(axis=0)
        return Slices(entries, np.sort(entries, axis=0).T, masks, np.argsort(-spread, kind="stable")[:GUESSES].tolist())

    def first_guess(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An entry near each part and its squared distance: the best of its neighbours in the widest dimensions."""
        best = error = None
        for d in self.widest:
            order = np.argsort(self.entries[:, d], kind="stable")
            at = np.searchsorted(self.order[d], parts[:, d])
            guess = order[np.minimum(at, len(order) - 1)].astype(np.int64)
            found = _distance(parts, self.entries[guess])
            if best is None:
                best, error = guess, found
            else:
                better = found < error
                best[better], error[better] = guess[better], found[better]
        return best, error

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that lie within ``radius`` in every dimension."""
        found = np.full(len(parts), (1 << len(self.entries)) - 1, np.uint64)
        for axis, masks, values in zip(self.order, self.masks, parts.T):
            low, high = np.searchsorted(axis, values - radius, "left"), np.searchsorted(axis, values + radius, "right")
            found &= masks[low] ^ masks[high]
        return found

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the smaller one of ties, and its squared distance."""
        if not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), parts.dtype)
        best, error = self.first_guess(parts)
        masks = self.candidates(parts, _root(error))
        for entry in range(len(self.entries)):
            rows = np.flatnonzero(masks >> np.uint64(entry) & np.uint64(1))
            if not len(rows):
                continue
            found = _distance(parts[rows], self.entries[entry])
            better = (found < error[rows]) | ((found == error[rows]) & (entry < best[rows]))
            best[rows[better]], error[rows[better]] = entry, found[better]
        return best, error


def _distance(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    apart = parts - entries
    return (apart * apart).sum(axis=1)


def _root(squares: np.ndarray) -> np.ndarray:
    """Whole numbers whose squares are not below ``squares``."""
    if squares.dtype == object:
        return np.array([math.isqrt(x) + 1 for x in squares], object)
    return np.ceil(np.sqrt(squares.astype(np.float64))).astype(np.int64) + 1


def _fits(most: int, width: int) -> bool:
    """Whether squared distances of ``width`` components up to ``most`` fit an int64."""
    return max(width, 1) * (2 * most) ** 2 < 1 << 62


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: int64, or Python integers where a number is too large for exact squares."""
    scaled = np.floor(vectors * scale)
    if np.isfinite(scaled).all() and _fits(int(np.abs(scaled).max(initial=0)), vectors.shape[-1]):
        return scaled.astype(np.int64)
    exact = [math.floor(Fraction(x) * scale) for x in vectors.ravel().tolist()]
    return np.array([*exact, None], object)[:-1].reshape(vectors.shape)


def _parts(vectors: pa.Array, parts: int, scale: int) -> np.ndarray:
    """Vectors of one length as whole numbers: (rows, parts, width of a part)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return whole(flat.reshape(len(vectors), -1) if len(flat) else np.zeros((len(vectors), 0)), scale).reshape(len(vectors), parts, -1 if len(flat) else 0)


def _matched(values: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances of all parts."""
    if values.dtype == object or any(b.dtype == object for b in books):
        values, books = values.astype(object), [b.astype(object) for b in books]
    found = [Slices.of(book).nearest(values[:, i]) for i, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _tight(book: list[list[int]]) -> np.ndarray:
    """A codebook of int64, or of Python integers where it must be."""
    most = max((abs(x) for entry in book for x in entry), default=0)
    made = np.array([*[x for entry in book for x in entry], None], object)[:-1].reshape(len(book), -1 if book[0] else 0)
    return made.astype(np.int64) if _fits(most, len(book[0])) else made


_SUMS = "part int, entry int, n long, sums array<string>"


def _refined(rows: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """The codebooks after one round; what reaches the driver is one number for each of theirs."""
    schema = common.arrow_schema(_SUMS)

    def add(batches):
        totals: dict[tuple[int, int], list] = {}
        for batch in common.slices(batches, ROWS):
            values = _parts(batch.column("_vector"), len(books), scale)
            codes, _ = _matched(values, books)
            for part in range(len(books)):
                for entry in np.unique(codes[:, part]).tolist():
                    chosen = values[codes[:, part] == entry, part]
                    sums = chosen.sum(axis=0).tolist()
                    n, before = totals.get((part, entry), (0, [0] * len(sums)))
                    totals[part, entry] = n + len(chosen), [a + b for a, b in zip(before, sums)]
        flat = [(p, e, n, [str(x) for x in sums]) for (p, e), (n, sums) in totals.items()]
        yield common.arrow_batch([list(c) for c in zip(*flat)] if flat else [[], [], [], []], schema)

    long = rows.select("_vector").mapInArrow(add, _SUMS).select("part", "entry", "n", F.posexplode("sums").alias("at", "sum"))
    sums = long.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).cast("string").alias("sum"))
    lists = [book.tolist() for book in books]
    for r in sums.collect():
        lists[r["part"]][r["entry"]][r["at"]] = int(r["sum"]) // r["n"]
    return [_tight(book) for book in lists]


@dataclass(frozen=True)
class Compressed:
    """``rows`` has the caller's columns and ``codes, errors`` (arrays by part); ``books`` all entries by part."""

    rows: DataFrame
    books: list[list[list[int]]]

    def digest(self) -> str:
        """sha256 of all entries' components by part, entry and position, as decimal text joined by commas."""
        numbers = (str(x) for book in self.books for entry in book for x in entry)
        return hashlib.sha256(",".join(numbers).encode("ascii")).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Compressed:
    """Codebooks over all usable vectors, and the codes of each.

    Used are vectors whose components are all finite numbers and that are as long
    as the one of the smallest such id; the rest is left out.  The codebook of a
    part begins as that part of the ``entries`` smallest ids (of all, if there are
    fewer; rows that share an id by their vectors, rows without an id last).  A
    vector length that ``parts`` does not divide is refused, and so is a sum of
    components of more than 38 digits.  A component x is ``floor(scale * x)``, exact
    for every float; a squared distance that fits no long is NULL.  Columns of the
    caller named like the added ones are replaced.  An empty table gives no rows
    and no entries.
    """
    if not 1 <= entries <= MAX_ENTRIES:
        raise ValueError(f"a codebook has 1 to {MAX_ENTRIES} entries")
    common.ship(vectors.sparkSession, ROWS)
    named = [c for c in vectors.columns if c not in ADDED]
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("_vector"),
        F.struct(*[F.col(f"`{c}`") for c in named]).alias("_row"),
    )
    good = F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.filter(F.col("_vector").isNotNull() & good)
    order = [F.asc_nulls_last("_id"), F.asc("_vector")]
    smallest = usable.orderBy(*order).select("_vector").first()
    if smallest is None:
        none = F.array().cast("array<long>")
        return Compressed(usable.select("_row.*", none.alias("codes"), none.alias("errors")), [])
    width = len(smallest[0])
    if width % parts:
        raise ValueError(f"{parts} equal parts of vectors of length {width}")
    usable = usable.filter(F.size("_vector") == width)
    seeds = usable.orderBy(*order).select("_vector").limit(entries).collect()
    first = whole(np.array([r[0] for r in seeds], float).reshape(len(seeds), width), scale).reshape(len(seeds), parts, width // parts)
    books = [_tight(first[:, p].tolist()) for p in range(parts)]
    for _ in range(rounds):
        books = _refined(usable, books, scale)
    made = StructType([f for f in usable.schema.fields if f.name == "_row"]).add("codes", ArrayType(LongType())).add("errors", ArrayType(LongType()))

    def assign(batches):
        kind = pa.list_(pa.int64())
        for batch in common.slices(batches, ROWS):
            codes, errors = _matched(_parts(batch.column("_vector"), parts, scale), books)
            fit = [[int(x) if x < 1 << 63 else None for x in row] for row in errors.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(codes.tolist(), kind), pa.array(fit, kind)], names=["_row", "codes", "errors"])

    coded = usable.select("_vector", "_row").mapInArrow(assign, made)
    return Compressed(coded.select("_row.*", "codes", "errors"), [b.tolist() for b in books])


def total_by(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` over all rows with the same ``key``; NULLs are one key.

    Sums are combined before the shuffle, so a key may hold most rows.
    """
    sums = rows.groupBy(F.col(key).alias("_of")).agg(F.sum(value).alias(out))
    return rows.join(sized(materialize(sums, "totals")), F.col(key).eqNullSafe(F.col("_of")), "left").drop("_of")
