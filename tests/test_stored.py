"""Published states, stored tables with a key, and look-ups by id."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from fareflow.operators import stored
from fareflow.sinks import manifests, snapshots
from fareflow.sources import lookups

SCHEMA = "k string, n int, a int, b string"


def table_of(spark, path, buckets=4, max_deltas=8):
    like = spark.createDataFrame([], SCHEMA)
    return stored.KeyedTable(spark, str(path), max_deltas).create(like.schema, ["k", "n"], buckets)


def applied(state, ops):
    """What a list of (mode, rows) leaves of a dict."""
    for mode, rows in ops:
        for k, n, a, b in rows:
            if mode == "replace":
                state[k, n] = (a, b)
            elif mode == "set":
                old = state.get((k, n), (None, None))
                state[k, n] = (old[0] if a is None else a, old[1] if b is None else b)
            else:
                state.pop((k, n), None)
    return sorted(((k, n, a, b) for (k, n), (a, b) in state.items()), key=str)


@pytest.mark.parametrize("max_deltas", [1, 20])
def test_many_writes_against_a_dict(spark, tmp_path, max_deltas):
    r, ops = random.Random(max_deltas), []
    table = table_of(spark, tmp_path / "t", max_deltas=max_deltas)
    state = {}
    for step in range(7):
        mode = r.choice(["replace", "set", "delete"]) if step else "replace"
        keys = {(r.choice(["x", "y", None, "é"]), r.choice([None, *range(6)])) for _ in range(9)}
        rows = [(*k, r.choice([None, step]), r.choice([None, f"s{step}"])) for k in keys]
        df = spark.createDataFrame(rows, SCHEMA)
        table.delete(df) if mode == "delete" else table.upsert(df, mode)
        ops = [(mode, rows)]
        expected = applied(state, ops)
        assert sorted((tuple(x) for x in table.read().collect()), key=str) == expected
    wanted = spark.createDataFrame([("x", 1), ("x", None), (None, None), ("none", 5)], "k string, n long")
    known = {("x", 1), ("x", None), (None, None)}
    assert sorted((tuple(x) for x in table.lookup(wanted).collect()), key=str) == [e for e in expected if e[:2] in known]
    table.compact(everything=True)
    table.resize(2)
    assert table.buckets == 2 and sorted((tuple(x) for x in table.read().collect()), key=str) == expected


def test_updates_of_one_key_and_missing_columns(spark, tmp_path):
    table = table_of(spark, tmp_path / "t")
    table.upsert(spark.createDataFrame([("x", 1, 1, "old"), ("x", 1, 2, "new"), ("y", 1, 1, "y")], SCHEMA), version="a")
    table.upsert(spark.createDataFrame([("x", 1, "late", 5), ("x", 1, "early", 4)], "k string, n int, b string, v int"), "set", version="v")
    assert sorted(map(tuple, table.read().collect())) == [("x", 1, 2, "late"), ("y", 1, 1, "y")]
    with pytest.raises(ValueError, match="all columns"):
        table.upsert(spark.createDataFrame([("x", 1)], "k string, n int"))
    with pytest.raises(ValueError, match="uses itself"):
        stored.KeyedTable(spark, str(tmp_path / "u")).create(spark.createDataFrame([], "_seq long").schema, ["_seq"], 2)


def files_read(df):
    return {f.split("_gen=")[1] for f in df.inputFiles() if "_gen=" in f}


def test_a_write_touches_only_the_buckets_it_hits(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", buckets=16, max_deltas=2)
    table.upsert(spark.createDataFrame([("k", i, i, "x" * 50) for i in range(400)], SCHEMA))
    before = {f: os.path.getmtime(f) for f in files_on(tmp_path / "t")}
    one = spark.createDataFrame([("k", 7, 70, "new")], SCHEMA)
    for _ in range(4):  # the third one compacts the bucket
        table.upsert(one)
    after = files_on(tmp_path / "t")
    assert all(f in after and os.path.getmtime(f) == t for f, t in before.items())
    assert len({f.split("_bucket=")[1].split("/")[0] for f in after - set(before)}) == 1
    found = table.lookup(one.select("k", "n"))
    assert [tuple(r) for r in found.collect()] == [("k", 7, 70, "new")]
    assert len({f.split("_bucket=")[1].split("/")[0] for f in files_read(found)}) == 1
    assert len(files_read(table.read())) >= 16 and table.read().count() == 400


def files_on(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder / "data") for f in names if f.endswith(".parquet")}


def test_a_stop_between_write_and_publish_leaves_the_old_state(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path / "t")
    table.upsert(spark.createDataFrame([("x", 1, 1, "a")], SCHEMA))
    with monkeypatch.context() as m:
        m.setattr(manifests.Folder, "publish", lambda *a, **k: (_ for _ in ()).throw(SystemError("lost")))
        with pytest.raises(SystemError):
            table.upsert(spark.createDataFrame([("x", 1, 2, "b"), ("y", 1, 2, "b")], SCHEMA))
    assert [tuple(r) for r in table.read().collect()] == [("x", 1, 1, "a")]
    for _ in range(2):
        table.upsert(spark.createDataFrame([("x", 1, 2, "b"), ("y", 1, 2, "b")], SCHEMA))
    assert sorted(map(tuple, table.read().collect())) == [("x", 1, 2, "b"), ("y", 1, 2, "b")]
    # The files of the lost run are nobody's: they go with the next clean-up.
    there = len(table._folder.generations())
    assert len(table.expire(date(1990, 1, 1))) == 1 and len(table._folder.generations()) == there - 1
    assert table.read().count() == 2


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    folder = manifests.Folder(spark, str(tmp_path / "t"))
    first = folder.publish(None, [], {})
    folder.publish(first, [], {"by": "one"})
    with pytest.raises(manifests.Conflict):
        folder.publish(first, [], {"by": "two"})
    assert folder.numbers() == [1, 2] and folder.version().about == {"by": "one"}
    assert [n for n in os.listdir(tmp_path / "t" / "versions") if n.startswith("_")] == []


def test_retention_keeps_the_last_state_and_what_it_names(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", buckets=1, max_deltas=1)
    for i in range(5):
        table.upsert(spark.createDataFrame([("x", i, i, "a")], SCHEMA), day=date(2019, 1, 1 + i))
    table.expire(date(2019, 1, 4))
    days = [table._folder.version(n).day for n in table._folder.numbers()]
    assert table.read().count() == 5 and min(d for d in days if d) == "2019-01-04"
    table.expire(date(2020, 1, 1))
    assert table.read().count() == 5 and len([d for d in table._folder.numbers()]) == 2  # the undated first one and the last


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "s")
    with pytest.raises(LookupError):
        snapshots.read(spark, root)
    for i in range(1, 5):
        snapshots.publish(spark.range(i), root, date(2019, 1, i))
    snapshots.publish(spark.range(30), root, date(2019, 1, 3))
    assert snapshots.read(spark, root).count() == 30 and snapshots.read(spark, root, date(2019, 1, 4)).count() == 4
    reader = snapshots.read(spark, root, date(2019, 1, 2))
    gone = snapshots.expire(spark, root, date(2019, 1, 5), keep=3)
    assert len(gone) == 2 and [r.number for r in snapshots.catalog(spark, root).collect()] == [5, 4, 3]
    assert reader is not None and len(os.listdir(tmp_path / "s" / "data")) == 3
    with pytest.raises(LookupError):
        snapshots.read(spark, root, date(2019, 1, 2))


def scanned(df):
    """Bytes and rows that the scans of a collected query gave."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString() or "Scan parquet" in leaves.apply(i).toString()]
    value = lambda s, name: s.metrics().apply(name).value()
    return rows, sum(value(s, "filesSize") for s in scans), sum(value(s, "numOutputRows") for s in scans)


def test_a_lookup_reads_the_files_of_its_ids(spark, tmp_path):
    rows = [(f"id{i % 2000}" if i % 3 else "hot", i) for i in range(12_000)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "id string, v int")
    root = str(tmp_path / "l")
    lookups.write_clustered(df, root, "id", buckets=16)
    total = sum(os.path.getsize(f) for f in files_on(tmp_path / "l"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for names in (["id7"], ["id7", "nobody"], [None], ["hot"], [f"id{i}" for i in range(1500)]):
            found = lookups.of_ids(spark, root, spark.createDataFrame([(n,) for n in names], "w string"), "w")
            got, size, _ = scanned(found)
            assert sorted(map(tuple, got), key=str) == sorted((r for r in rows if r[0] in set(names)), key=str)
            assert size < total / 3 or len(names) > 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert lookups.of_ids(spark, root, df.filter("false"), "id").count() == 0
    lookups.write_clustered(df.filter(F.col("v") < 10), root, "id", buckets=2)
    assert lookups.of_ids(spark, root, df.select("id"), "id").count() == len([r for r in rows if r[1] < 10])
