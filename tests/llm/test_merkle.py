"""The Merkle manifest against a plain recursive one."""

import hashlib
import os
import zlib
from collections import defaultdict

import pytest
from helpers import AWKWARD, CLASHING, awkward, prose
from pyspark.sql import functions as F

from fareflow.llm import merkle
from fareflow.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Root and, for each leaf, its siblings left and right on each level."""
    paths = [([], []) for _ in leaves]
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k, (_, below) in enumerate(run):
                for i in below:
                    paths[i][0].append("".join(d for d, _ in run[:k]))
                    paths[i][1].append("".join(d for d, _ in run[k + 1 :]))
            above.append((sha("".join(d for d, _ in run)), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], paths


def plain(rows):
    """(id, group, leaf, payload) to (id, group, leaf, subroot, root, lefts, rights, payload)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    trees = [tree([r[2] for r in groups[g]]) for g in order]
    root, tops = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), top in zip(order, trees, tops):
        out += [(r[0], g, r[2], subroot, root, [*p[0], *top[0]], [*p[1], *top[1]], r[3]) for r, p in zip(groups[g], paths)]
    return out


@pytest.fixture(params=[1, 6])
def levels(request, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", request.param)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FAN**request.param)


def test_against_a_plain_tree(spark, levels):
    sizes = {"one": 1, "two": 2, "three": 3, "é": 4, "z": 28, "src": 60, None: 10, "": 5, "A": 81}
    rows = [(i, g, sha(f"{g} {i}"), f"p{i}") for g, n in sizes.items() for i in range(n)]
    rows += [(None, "A", sha("none"), "x"), (7, "A", sha("again"), "y"), (7, "A", sha("again"), "y")]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string, payload string")
    found = merkle.manifest(df, F.col("leaf"), keep={"payload": F.col("payload")})
    names = ["doc_id", "source", "leaf", "subroot", "root", "lefts", "rights", "payload"]
    assert found.columns == names
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, plain(rows)))
    held = found.select((merkle.fold("leaf") == F.col("root")).alias("ok"), merkle.siblings().alias("all"), "lefts", "rights").collect()
    assert all(r.ok for r in held)
    assert all(r["all"] == "".join(a + b for a, b in zip(r.lefts, r.rights)) for r in held)


@pytest.mark.parametrize("rows", [[(1, "a", sha("x"), "")], [(1, "a", sha("x"), ""), (1, "b", sha("y"), "")], [(1, None, sha("x"), ""), (2, None, sha("y"), "")]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string, payload string")
    found = merkle.manifest(df, F.col("leaf"), keep={"payload": F.col("payload")})
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, plain(rows)))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, leaf string")
    found = merkle.manifest(df, F.col("leaf"))
    assert found.columns == ["doc_id", "source", "leaf", "subroot", "root", "lefts", "rights"] and found.count() == 0


def expected_query(docs):
    """The contract of the query, by the plain tree."""
    leaf = lambda d, text: sha("".join(map(framed, (d["doc_id"], d["source"], d["lang"], d["n_chars"], text))))
    rows = [(d["doc_id"], d["source"], leaf(d, d["text"]), d) for d in docs]
    out = []
    for i, _, first, subroot, root, lefts, rights, d in plain(rows):
        held = first
        if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and d["text"] is not None:
            held = leaf(d, d["text"].replace("\n", ""))
        folded = held
        for a, b in zip(lefts, rights):
            folded = sha(a + folded + b)
        proof = sha("".join(a + b for a, b in zip(lefts, rights)))
        out.append((i, first, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def asked(spark, folder):
    found = QUERIES["op12_merkle_manifest"](spark, folder)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.columns == names
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_query(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = asked(spark, DATA)
    assert got == expected_query(docs)
    assert 0.2 < sum(not r[-1] for r in got) / len(got) < 0.5


def test_query_on_awkward_rows(spark, tmp_path):
    sources = [None, "", "é", "A", "A", "a\nb"]
    rows = [(i, t, None if k % 4 == 0 else "en", sources[k % 6], None if k % 5 == 0 else k, "x") for k, (i, t) in enumerate([*AWKWARD, (30, "a\n\nb"), (31, "\n"), (32, prose(3, 9000))])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert asked(spark, str(tmp_path)) == expected_query([r.asDict() for r in df.collect()])


def test_clashing_names(spark):
    docs = awkward(spark, AWKWARD).withColumns({c: F.lit("x") for c in ("source", "tree", "place", "digest", "block", "lefts", "_piece", "_local")})
    found = merkle.manifest(docs, merkle.digest(merkle.framed(F.col("text"))), keep={c: F.col(c) for c in ("digest", "tree", *CLASHING.split()[:2])})
    assert found.count() == len(AWKWARD) and found.select("tree", "digest").distinct().collect() == [("x", "x")]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_sql_says_the_same_as_the_plain_version(spark):
    db = pytest.importorskip("duckdb").connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    cursor = db.execute(ORACLE["op12_merkle_manifest"])
    names = [c[0] for c in cursor.description]
    order = [names.index(n) for n in ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]]
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    expected = expected_query([r.asDict() for r in rows])
    assert sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str) == expected
