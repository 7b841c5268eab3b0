"""Vector codes against plain comparison of every part with every entry."""

import hashlib
import math
import os
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from fareflow.llm import codes
from fareflow.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.01"
COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, vector, label) to the query's rows."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not rows:
        return []
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    width = len(rows[0][1]) // parts
    whole = [[math.floor(Fraction(float(np.float32(x))) * 4096) for x in r[1]] for r in rows]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for v in cut:
                members[nearest(p, v[p])[1]].append(v[p])
            books[p] = [tuple(sum(x) // len(members[k]) for x in zip(*members[k])) if k in members else e for k, e in enumerate(books[p])]
    found = [[nearest(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(e for e, _ in f) for f in found]
    by_label = defaultdict(int)
    for r, e in zip(rows, errors):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], digest) for r, f, e in zip(rows, found, errors)), key=str)


def asked(spark, folder):
    found = QUERIES["op13_vector_codes"](spark, str(folder))
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


def stored(spark, folder, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, codes string")
    df.write.parquet(str(folder / "embeddings.parquet"))
    return [(r.vec_id, r.embedding, r.label) for r in df.collect()]


def vectors(n, dim, seed=1, clusters=5):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dim))
    return [[float(x) for x in (centres[i % clusters] + 0.2 * r.normal(size=dim)).astype(np.float32)] for i in range(n)]


def test_query_on_awkward_rows(spark, tmp_path):
    rows = [(i, v, i % 3 if i % 7 else None, "x") for i, v in enumerate(vectors(200, 16))]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None, 1, "x"), (301, [], 1, "x"), (302, [nan] * 16, 1, "x"), (303, [1.0] * 15 + [inf], 2, "x"), (304, [None] + [1.0] * 15, 2, "x"), (305, [0.0] * 16, None, "x"), (306, [1.0] * 8, 1, "x")]
    rows += [(5, rows[9][1], 1, "x"), (5, rows[5][1], 1, "x"), (5, rows[5][1], 1, "x"), (None, rows[3][1], 1, "x"), (-2, [-0.00001] * 16, 0, "x")]
    random.Random(3).shuffle(rows)
    stored(spark, tmp_path, rows)
    assert asked(spark, tmp_path) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 3, 17])
def test_few_vectors(spark, tmp_path, n):
    rows = [(i, v, None, "x") for i, v in enumerate(vectors(n, 8, seed=n))]
    stored(spark, tmp_path, rows)
    assert asked(spark, tmp_path) == plain(rows)


def test_equal_vectors_take_the_smaller_index(spark, tmp_path):
    rows = [(i, [float(i // 4)] * 8, 0, "x") for i in range(40)]
    stored(spark, tmp_path, rows)
    assert asked(spark, tmp_path) == plain(rows)


def test_numbers_beyond_an_int64_square(spark, tmp_path):
    rows = [(i, [x * 1e12 for x in v], 0, "x") for i, v in enumerate(vectors(30, 8))]
    rows = stored(spark, tmp_path, rows)
    found = codes.compress(spark.read.parquet(str(tmp_path / "embeddings.parquet")), entries=4, rounds=2)
    expected = {i: c for i, c, *_ in plain(rows, entries=4, rounds=2)}
    assert {r.vec_id: "".join(f"{k:02x}" for k in r.codes) for r in found.rows.collect()} == expected
    assert found.rows.filter("exists(errors, e -> e is null)").count() > 0


def test_width_that_parts_do_not_divide(spark):
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1.0] * 9)], "vec_id long, embedding array<float>"))


@pytest.mark.parametrize("entries", [1, 2, 16, 64])
def test_masks_hold_the_box_and_the_nearest(entries):
    r = np.random.default_rng(entries)
    for width in (1, 3, 8):
        book = r.integers(-40, 40, size=(entries, width))
        parts = r.integers(-60, 60, size=(500, width))
        slices = codes.Slices.of(book)
        radius = r.integers(0, 50, size=500)
        inside = (np.abs(parts[:, None] - book[None]) <= radius[:, None, None]).all(axis=2)
        masks = slices.candidates(parts, radius)
        assert all(int(m) == sum(1 << int(k) for k in np.flatnonzero(row)) for m, row in zip(masks, inside))
        squares = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
        best, error = slices.nearest(parts)
        assert (best == squares.argmin(axis=1)).all() and (error == squares.min(axis=1)).all()


def test_few_entries_are_compared():
    r = np.random.default_rng(2)
    centres = r.integers(-4000, 4000, size=(16, 8))
    parts = centres[r.integers(0, 16, 2000)] + r.integers(-300, 300, size=(2000, 8))
    slices = codes.Slices.of(centres)
    masks = slices.candidates(parts, codes._root(slices.first_guess(parts)[1]))
    assert sum(int(m).bit_count() for m in masks) / len(masks) < 6


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert asked(spark, DATA) == plain(rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_sql_says_the_same_as_the_plain_version(spark):
    db = pytest.importorskip("duckdb").connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    cursor = db.execute(ORACLE["op13_vector_codes"])
    names = [c[0] for c in cursor.description]
    order = [names.index(n) for n in [*COLUMNS]]
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    expected = plain([(r.vec_id, r.embedding, r.label) for r in rows])
    assert sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str) == expected
