"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 10).

Each table projects a unit vector on a few Gaussian directions and cuts the line
into cells, shifted at random; the cells together are its bucket.  A query knows
how far it lies from the borders of its cells, so it can say how likely a
neighbour at a given distance fell into each bucket around.  It visits buckets
in the order of that probability until it has enough of it.  Candidates of all
tables are merged and ranked by their exact cosine.

Vectors and queries travel in packed blocks, one row for a bucket and a batch of
input rows, so a crowded bucket is many blocks of bounded size and Spark may
split it over tasks.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import materialize
from . import common

#: Queries a task holds results for before it passes them on.
HELD = 50_000
#: Scores closer than this are told apart by the exact measure.
CLOSE = 1e-9

BLOCK = "bucket long, ids binary, vectors binary, dim int"


@dataclass(frozen=True)
class Index:
    """What fixes the buckets.

    ``similarity`` is the cosine of the neighbours that are to be found and
    ``success`` the probability to visit the bucket of such a neighbour in one
    table; over ``tables`` the misses multiply.
    """

    tables: int = 2
    functions: int = 4
    width: float = 2.0
    similarity: float = 0.3
    success: float = 0.82
    seed: int = 11

    def positions(self, units: np.ndarray, table: int) -> np.ndarray:
        """Where vectors lie on each line, in cells."""
        random = np.random.default_rng([self.seed, table, units.shape[1]])
        lines = random.normal(size=(units.shape[1], self.functions))
        return (units @ lines) / self.width + random.uniform(size=self.functions)

    def bucket(self, cells, table: int, dim: int) -> int:
        return xxhash.xxh64_intdigest(np.array([table, dim, *cells], "<i8").tobytes()) - (1 << 63)

    def visits(self, position: np.ndarray) -> list[tuple]:
        """Cells of the buckets to visit, the most promising first."""
        spread = math.sqrt(2 - 2 * self.similarity) / self.width
        reach = math.ceil(4 * spread) + 1
        cells, chances = [], []
        for at in position:
            home = math.floor(at)
            edges = [0.5 * (1 + math.erf((home + d - at) / spread / math.sqrt(2))) for d in range(-reach, reach + 2)]
            found = sorted(((b - a, home + d) for a, b, d in zip(edges, edges[1:], range(-reach, reach + 1))), reverse=True)
            chances.append([c for c, _ in found])
            cells.append([cell for _, cell in found])
        # Ranks per line; each set of ranks is made once, from the one with its last raised rank lowered.
        start = (0,) * len(cells)
        todo = [(-math.prod(c[0] for c in chances), start)]
        out, got = [], 0.0
        while todo and got < self.success:
            chance, ranks = heapq.heappop(todo)
            got -= chance
            out.append(tuple(c[r] for c, r in zip(cells, ranks)))
            last = max((i for i, r in enumerate(ranks) if r), default=0)
            for i in range(last, len(ranks)):
                if ranks[i] + 1 < len(chances[i]):
                    next_ = (*ranks[:i], ranks[i] + 1, *ranks[i + 1 :])
                    heapq.heappush(todo, (-math.prod(c[r] for c, r in zip(chances, next_)), next_))
        return out


def _blocks(batch: pa.RecordBatch, index: Index, visiting: bool) -> list:
    """Packed blocks of a batch: by home bucket, or by every bucket that is visited."""
    buckets, ids_out, vectors_out, dims = [], [], [], []
    ids = batch.column("_id").to_numpy()
    lists = batch.column("_vector")
    sizes = np.asarray(lists.value_lengths())
    flat, begin = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))[:-1]
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        vectors = flat[begin[rows][:, None] + np.arange(dim)]
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        members: dict[int, list[int]] = {}
        for table in range(index.tables):
            for i, position in enumerate(index.positions(units, table)):
                visited = index.visits(position) if visiting else [np.floor(position).astype(int)]
                for cells in visited:
                    members.setdefault(index.bucket(cells, table, int(dim)), []).append(i)
        for bucket, some in members.items():
            buckets.append(bucket)
            ids_out.append(ids[rows[some]].astype("<i8").tobytes())
            vectors_out.append(np.ascontiguousarray(vectors[some], "<f8").tobytes())
            dims.append(int(dim))
    return [buckets, ids_out, vectors_out, dims]


def _packed(rows: DataFrame, index: Index, visiting: bool) -> DataFrame:
    schema = common.arrow_schema(BLOCK)

    def run(batches):
        for part in common.slices(batches, 2048 if visiting else 16384):
            yield common.arrow_batch(_blocks(part, index, visiting), schema)

    return rows.mapInArrow(run, BLOCK)


class _Best:
    """The nearest candidates of each query, as a task meets them."""

    def __init__(self, k: int):
        self._k = k
        self._found: dict[int, dict[int, float]] = {}

    def __len__(self) -> int:
        return len(self._found)

    def meet(self, query_ids, queries, ids, vectors) -> None:
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        query_lengths = np.sqrt((queries * queries).sum(axis=1))
        rough = (queries / query_lengths[:, None]) @ (vectors / lengths[:, None]).T
        rough[query_ids[:, None] == ids[None, :]] = -np.inf
        k = self._k
        # Rows of one id lie side by side, and the best of them counts.
        by_id = np.argsort(ids, kind="stable")
        begin = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[:1]] - 1))
        repeated = len(begin) < len(ids)
        for row, query in enumerate(query_ids.tolist()):
            scores = rough[row]
            most = np.maximum.reduceat(scores[by_id], begin) if repeated else scores
            least = np.partition(most, -k)[-k] if len(most) > k else -np.inf
            close = np.flatnonzero((scores >= least - CLOSE) & np.isfinite(scores))
            # The exact measure, summed in one way wherever a pair meets.
            exact = (vectors[close] * queries[row]).sum(axis=1) / (lengths[close] * query_lengths[row])
            order = np.lexsort((ids[close], -exact))
            if repeated:
                order = order[np.sort(np.unique(ids[close][order], return_index=True)[1])]
            best = self._found.setdefault(query, {})
            for at in order[:k].tolist():
                key, score = int(ids[close[at]]), float(exact[at])
                best[key] = max(score, best.get(key, score))
            if len(best) > 4 * k:
                self._found[query] = dict(self._top(best))

    def _top(self, best: dict[int, float]) -> list[tuple[int, float]]:
        return heapq.nsmallest(self._k, best.items(), key=lambda x: (-x[1], x[0]))

    def take(self) -> list:
        rows = [(q, i, s) for q, best in self._found.items() for i, s in self._top(best)]
        self._found = {}
        return list(zip(*rows)) if rows else [[], [], []]


def _meet(batches, k: int, schema: pa.Schema):
    best = _Best(k)
    for batch in common.slices(batches, 16):
        for r in batch.to_pylist():
            best.meet(
                np.frombuffer(r["query_ids"], "<i8"),
                np.frombuffer(r["queries"], "<f8").reshape(-1, r["dim"]),
                np.frombuffer(r["ids"], "<i8"),
                np.frombuffer(r["vectors"], "<f8").reshape(-1, r["dim"]),
            )
        if len(best) > HELD:
            yield common.arrow_batch(best.take(), schema)
    yield common.arrow_batch(best.take(), schema)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``_id, _vector`` (doubles) of the rows that have an id and a finite vector other than zero."""
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector"))
    good = F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("_id").isNotNull() & F.col("_vector").isNotNull() & good & F.exists("_vector", lambda x: x != 0))


#: An index is fitted on so many rows and queries, those whose ids have the least hashes.
SAMPLE_ROWS, SAMPLE_QUERIES = 2048, 128
#: Rows that a bucket has on average, as far as the number of lines goes.
BUCKET_ROWS = 512
#: Lines of a table: fewer do not part the rows, more would have more buckets than can be visited.
LINES = (4, 8)


def fitted(rows: DataFrame, is_query: Column, k: int) -> Index:
    """The index for a table: how near neighbours are is seen from a bounded sample, how many lines there are from the rows.

    In a sample of m of n rows the nearest ``k * m / n`` stand for the ``k`` nearest of
    all; nine of ten queries have theirs at the chosen similarity or nearer.  The
    nearer they are, the fewer buckets have to be visited.
    """
    n = rows.count()
    order = [F.xxhash64("_id", F.lit("sample")), "_id"]
    some = [(r["_id"], r["_vector"]) for r in rows.orderBy(*order).limit(SAMPLE_ROWS).collect()]
    asked = [(r["_id"], r["_vector"]) for r in rows.filter(is_query).orderBy(*order).limit(SAMPLE_QUERIES).collect()]
    at = max(1, round(k * len(some) / max(n, 1)))
    found = []
    for dim in {len(v) for _, v in asked}:
        there = [(i, v) for i, v in some if len(v) == dim]
        ids = np.array([i for i, _ in there])
        vectors = np.array([v for _, v in there], float).reshape(len(there), dim)
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        for i, v in asked:
            if len(v) == dim:
                cosines = (units @ (np.array(v) / np.linalg.norm(v)))[ids != i]
                if len(cosines) >= at:
                    found.append(float(np.partition(cosines, -at)[-at]))
    lines = int(math.log(max(n / BUCKET_ROWS, 1)) / math.log(3.2))  # a line parts the rows into about so many cells of width 2
    lines = min(max(lines, LINES[0]), LINES[1])
    return Index(functions=lines, similarity=min(max(float(np.quantile(found, 0.1)), 0.05), 0.98) if found else Index.similarity)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    index: Index | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, by cosine.

    ``is_query`` is a condition on ``_id``; without an ``index``, one is :func:`fitted`.  Candidates are all rows but the
    query's own.  Ties go to the smaller id.  Rows without id, and vectors that
    are NULL, empty, zero or hold NULL or a number that is not finite, take no
    part; vectors of other lengths never meet.  Rows that share an id count as one
    candidate, with the better score.  A query whose buckets held fewer than ``k``
    candidates is compared with all rows, in blocks, so it misses one only if there
    are fewer; one without any candidate has no rows, and so has an empty table.
    Columns of the caller are left behind, whatever their names.
    """
    common.ship(vectors.sparkSession, 16384)
    rows = usable(vectors, id_col, vector_col)
    index = index or fitted(rows, is_query, k)
    blocks = _packed(rows, index, False)
    asked = _packed(rows.filter(is_query), index, True).select(
        "bucket", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"), F.col("dim").alias("query_dim")
    )
    merged = materialize(_met(blocks, asked, k), "neighbours")
    full = merged.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k).select(F.col("query_id").alias("_id"))
    short = materialize(rows.filter(is_query).join(full, "_id", "left_anti"), "short-queries")
    if not short.isEmpty():
        merged = merged.unionByName(_compared_with_all(rows, short, k)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _met(blocks: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score`` of the best candidates of each query in the buckets that both have."""
    met = blocks.join(asked.hint("shuffle_merge"), "bucket").filter("dim = query_dim").select("ids", "vectors", "query_ids", "queries", "dim")
    schema = common.arrow_schema("query_id long, vec_id long, score double")
    found = met.mapInArrow(lambda batches: _meet(batches, k, schema), "query_id long, vec_id long, score double")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


#: Queries of one block when all rows are compared.
ALL_BLOCK = 1024


def _compared_with_all(rows: DataFrame, short: DataFrame, k: int) -> DataFrame:
    """:func:`_met` of some queries and all rows: every block of queries is a bucket that every block of rows is in."""
    blocks = max(1, -(-short.count() // ALL_BLOCK))
    schema = common.arrow_schema(BLOCK)

    def pack(batches):
        for part in common.slices(batches, 4096):
            yield common.arrow_batch(_packed_by(part.column("_bucket").to_numpy(), part), schema)

    asked = short.withColumn("_bucket", F.pmod(F.xxhash64("_id"), F.lit(blocks))).mapInArrow(pack, BLOCK)
    asked = asked.select("bucket", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"), F.col("dim").alias("query_dim"))
    every = rows.withColumn("_bucket", F.lit(0).cast("long")).mapInArrow(pack, BLOCK)
    every = every.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return _met(every, asked, k)


def _packed_by(buckets: np.ndarray, batch: pa.RecordBatch) -> list:
    """Packed blocks of a batch, one for each bucket and length."""
    sizes = np.asarray(batch.column("_vector").value_lengths())
    ids, out = batch.column("_id").to_numpy(), []
    for bucket, dim in sorted(set(zip(buckets.tolist(), sizes.tolist()))):
        rows = np.flatnonzero((buckets == bucket) & (sizes == dim))
        flat = batch.column("_vector").take(pa.array(rows)).flatten().to_numpy()
        out.append((bucket, ids[rows].astype("<i8").tobytes(), flat.astype("<f8").tobytes(), dim))
    return list(zip(*out)) if out else [[], [], [], []]


