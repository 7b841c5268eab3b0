"""Line dedup against plain Python and, on the driver's tables, against SQL."""

import hashlib
import os
import random
from collections import defaultdict

import pytest
from helpers import AWKWARD, awkward, prose

from fareflow.llm import lines
from fareflow.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None:
                holders[line.strip(" \t\n\x0b\x0c\r").translate(LOWER)].add(i)
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        keys = [p.strip(" \t\n\x0b\x0c\r").translate(LOWER) for p in parts]
        gone = [i is not None and len(k) >= min_chars and len(holders[k]) >= min_docs and max(holders[k]) != i for k in keys]
        out.append((i, "\n".join(p for p, g in zip(parts, gone) if not g), len(parts), sum(gone)))
    return sorted(out, key=str)


def repeating(n, seed=0):
    r = random.Random(seed)
    common = [prose(s, 6) for s in range(8)] + ["ÉTÉ " + prose(9, 5), "short"]
    rows = []
    for i in range(n):
        parts = [r.choice(common) if r.random() < 0.6 else prose(1000 * i + k, 6) for k in range(r.randint(1, 8))]
        rows.append((i, "\n".join(r.choice(["", " ", "\t"]) + (p.upper() if r.random() < 0.2 else p) + r.choice(["", "  ", "\r"]) for p in parts)))
    return rows


@pytest.mark.parametrize("batches", [1, 4, 11])
def test_against_plain_python(spark, batches):
    rows = repeating(150) + [(i and i + 1000, t) for i, t in AWKWARD] + [(0, prose(0, 6))]
    docs = awkward(spark, rows)
    found = lines.drop_repeated(docs, min_chars=20, min_docs=3, batches=batches)
    assert found.columns == [c for c in docs.columns if c != "n_dropped"] + ["n_lines", "n_dropped"]
    got = sorted((tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    assert got == plain(rows, 20, 3)
    assert sum(r[3] for r in got) > 50


def test_compaction_keeps_one_run_in_each_level(spark):
    runs = lines.Runs(spark, buckets=2)
    batch = lambda ids: spark.createDataFrame([(k, k, i) for i in ids for k in (1, 2, i)], "k1 long, k2 long, doc_id long")
    for b in range(9, 0, -1):
        runs.add(batch([10 * b, 10 * b + 1]))
    assert [len(level) for level in runs._levels] == [1, 2]
    totals = {r.k1: (r.docs, r.keeper) for r in runs.totals().collect()}
    assert totals[1] == totals[2] == (18, 91) and totals[10] == (1, 10)
    runs.close()


def test_empty_table(spark):
    assert lines.drop_repeated(awkward(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_query_equals_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    expected = sorted(db.execute(ORACLE["op7_line_dedup"]).fetchall())
    found = QUERIES["op7_line_dedup"](spark, DATA)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(map(tuple, found.collect())) == expected


def test_no_python_in_the_plan(spark, capsys):
    lines.drop_repeated(awkward(spark, repeating(20)), 20, 3).explain()
    text = capsys.readouterr().out
    assert "Python" not in text and "Arrow" not in text


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
