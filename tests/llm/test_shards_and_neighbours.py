"""Shards by invariants and a brute-force directory; neighbours by recall and exactness."""

import math
from collections import defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, awkward, prose
from pyspark.sql import functions as F

from fareflow.llm import neighbours, shards


def directory(rows, limit):
    """Bit by bit: only what is too large is split."""
    out, todo = {}, [("", rows)]
    while todo:
        prefix, some = todo.pop()
        if sum(b for _, b in some) <= limit or len(some) <= 1:
            out.update({h: prefix for h, _ in some})
            continue
        for bit in "01":
            part = [(h, b) for h, b in some if f"{h % (1 << 64):064b}"[len(prefix)] == bit]
            todo += [(prefix + bit, part)] if part else []
    return out


def test_directory_equals_bit_by_bit(spark):
    rows = [(i, prose(i, 1 + i % 70)) for i in range(400)] + [(1000, prose(7, 900)), (1001, None), (1002, "")]
    docs = awkward(spark, rows)
    found = shards.assign(docs, 3000, carry=("label",))
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    sizes = {i: len((t or "").encode()) for i, t in rows}
    expected = directory([(hashes[i], sizes[i]) for i in sizes], 3000)
    got = found.collect()
    assert {r.doc_id: r.shard for r in got} == {i: expected[hashes[i]] for i in sizes}
    assert all(r.depth == len(r.shard) and r.bytes == sizes[r.doc_id] and r.carried.label == "x" for r in got)
    assert max(r.depth for r in got) > 3


def test_copies_of_one_id_are_split_too(spark):
    rows = [(7, "x" * 100)] * 300 + [(None, "y" * 50)] * 40 + AWKWARD
    got = shards.assign(awkward(spark, rows).repartition(4), 1500).collect()
    assert len(got) == len(rows)
    held = defaultdict(list)
    for r in got:
        held[r.shard].append(r.bytes)
    assert all(sum(b) <= 1500 or len(b) == 1 for b in held.values())
    names = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert sum(r.rows for r in shards.directory(shards.assign(awkward(spark, rows), 1500)).collect()) == len(rows)


def test_small_and_empty_tables(spark):
    (only,) = {(r.shard, r.depth) for r in shards.assign(awkward(spark, AWKWARD), 1 << 30).collect()}
    assert only == ("", 0)
    assert shards.assign(awkward(spark, []), 10).count() == 0


def brute(vectors, queries, k):
    out = {}
    for q in queries:
        a = np.array(vectors[q])
        scored = []
        for i, v in vectors.items():
            if i != q and len(v) == len(a):
                b = np.array(v)
                scored.append((-float(a @ b) / math.sqrt(a @ a) / math.sqrt(b @ b), i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, bucket string, dim int")


@pytest.mark.parametrize("clustered", [True, False])
def test_recall_against_brute_force(spark, clustered):
    random = np.random.default_rng(3)
    centres = random.normal(size=(40, 32))
    rows = random.normal(size=(3000, 32)) * (0.5 if clustered else 1) + (centres[np.arange(3000) % 40] if clustered else 0)
    vectors = {i: v.astype("f4").astype(float).tolist() for i, v in enumerate(rows)}
    found = neighbours.nearest(table(spark, vectors.items()), F.col("_id") % 50 == 0).collect()
    expected = brute(vectors, range(0, 3000, 50), 5)
    hits = sum(r.vec_id in expected[r.query_id] for r in found)
    assert hits / (5 * len(expected)) >= 0.9
    for r in found:
        a, b = np.array(vectors[r.query_id]), np.array(vectors[r.vec_id])
        assert r.score == pytest.approx(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b), abs=1e-14)


def test_ties_bad_vectors_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0]
    rows = [(i, one) for i in range(0, 12)] + [(50, one), (50, one), (51, None), (52, []), (53, [0.0] * 3), (54, [1.0, None, 2.0])]
    rows += [(55, [nan, 1.0, 1.0]), (56, [inf, 1.0, 1.0]), (None, one), (57, [1.0, 2.0]), (100, [1.0, 2.0])]
    everything = neighbours.Index(success=0.9999)
    found = neighbours.nearest(table(spark, rows).repartition(3), F.col("_id") % 50 == 0, k=5, index=everything).collect()
    by = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by[r.query_id].append((r.rank, r.vec_id))
    assert by == {0: [(i, i) for i in range(1, 6)], 50: [(i + 1, i) for i in range(5)], 100: [(1, 57)]}
    assert neighbours.nearest(table(spark, []), F.col("_id") % 50 == 0).count() == 0


def test_visits_come_in_order_and_once():
    index = neighbours.Index(functions=3, success=0.9)
    visits = index.visits(np.array([0.1, 2.5, -1.9]))
    assert visits[0] == (0, 2, -2) and len(set(visits)) == len(visits)


@pytest.mark.parametrize("equal", [True, False])
def test_an_id_with_many_rows_is_one_candidate(spark, equal):
    """Id 50 has 40 rows nearer to the query than any other; the others rank behind its best one."""
    random = np.random.default_rng(6)
    query = random.normal(size=8)
    rows = [(0, query.tolist())]
    rows += [(50, (query + (0.01 if equal else 0.002 * (i + 1)) * np.eye(8)[0]).tolist()) for i in range(40)]
    rows += [(i, (query + 0.3 * random.normal(size=8)).tolist()) for i in range(1, 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    scores = {}
    for i, v in rows[1:]:
        score = np.dot(query, v) / np.linalg.norm(query) / np.linalg.norm(v)
        scores[i] = max(score, scores.get(i, -1.0))
    best = sorted(scores, key=lambda i: -scores[i])[:5]
    for index in (neighbours.Index(success=0.9999), neighbours.Index(tables=1, functions=1, width=1e6)):
        found = neighbours.nearest(vectors, F.col("_id") == 0, index=index).orderBy("rank").collect()
        assert [r.vec_id for r in found] == best
        assert [r.score for r in found] == pytest.approx([scores[i] for i in best], abs=1e-12)


def test_few_candidates_are_all_found(spark, monkeypatch):
    """Vectors of 30 lengths, four of each, one a query: the three others of its length are its answer."""
    monkeypatch.setattr(neighbours, "ALL_BLOCK", 7)
    r = np.random.default_rng(5)
    rows = [(100 * d + i, [float(x) for x in r.normal(size=d)]) for d in range(1, 31) for i in (0, 1, 2, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("_id") % 100 == 0, k=5).collect()
    of = dict(rows)
    assert len(found) == 90
    for q in range(100, 3100, 100):
        cosine = {i: np.dot(of[q], of[i]) / np.linalg.norm(of[q]) / np.linalg.norm(of[i]) for i in (q + 1, q + 2, q + 3)}
        got = sorted((x for x in found if x.query_id == q), key=lambda x: x["rank"])
        assert [x.vec_id for x in got] == sorted(cosine, key=lambda i: (-round(cosine[i], 12), i))


def test_a_clustered_table_is_visited_in_part(spark, monkeypatch):
    """On near neighbours the fitted index visits few rows, and fewer of a larger table."""
    monkeypatch.setattr(neighbours, "BUCKET_ROWS", 32)  # more lines for few rows
    r = np.random.default_rng(8)
    shares = []
    for n in (1500, 15_000):
        centres = r.normal(size=(n // 50, 32))
        vectors = centres[r.integers(0, len(centres), n)] + 0.25 * r.normal(size=(n, 32))
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        rows = neighbours.usable(df, "vec_id", "embedding")
        index = neighbours.fitted(rows, F.col("_id") % 100 == 0, 5)
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        seen, queries = 0, range(0, n, n // 15)
        for table in range(index.tables):
            cells = np.floor(index.positions(units, table)).astype(int)
            for q in queries:
                visited = set(index.visits(index.positions(units[q : q + 1], table)[0]))
                seen += sum(tuple(c) in visited for c in cells.tolist())
        shares.append(seen / n / len(queries) / index.tables)
        found = defaultdict(set)
        for x in neighbours.nearest(df, F.col("_id") % 100 == 0, 5).collect():
            found[x.query_id].add(x.vec_id)
        right = 0
        for q in found:
            scores = units @ units[q]
            scores[q] = -2
            right += len(found[q] & set(np.argsort(-scores)[:5].tolist()))
        assert right >= 0.9 * 5 * len(range(0, n, 100))
    assert shares[0] < 0.3 and shares[1] < shares[0]
