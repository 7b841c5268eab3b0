"""Segmented windows of hot groups must equal brute force over the plain rows."""

import random

import pytest
from pyspark.sql import functions as F

from fareflow.operators import encoding, forecast, hot, labels, metrics, windows
from fareflow.operators.hot import HotPolicy

#: Far below the group sizes used here, so the segmented way is taken.
TINY = HotPolicy(rows_per_task=20)
SCHEMA = "k string, day int, seq int, price double"


def history(seed):
    """One key holds a third of the rows, one is NULL, many are small; some prices are NULL."""
    rng = random.Random(seed)
    out = []
    for key, size in [("hot", 150), (None, 60), *[(f"k{i}", rng.randint(1, 15)) for i in range(30)]]:
        for seq in range(size):
            price = None if rng.random() < 0.05 else float(rng.randint(1, 40))
            out.append((key, rng.randint(1, 12), seq, price))
    rng.shuffle(out)
    return out


def grouped(data):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in groups.items()}


def low(values):
    values = [v for v in values if v is not None]
    return min(values) if values else None


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("skip", [1, 2])
@pytest.mark.parametrize("policy", [hot.DEFAULT, TINY])
def test_future_prices(spark, rows, seed, skip, policy):
    data = history(seed)
    expected = []
    for key, group in grouped(data).items():
        prices = [r[3] for r in group]
        for i, (_, day, seq, price) in enumerate(group):
            nxt = prices[i + 1] if i + 1 < len(group) else None
            expected.append((key, day, seq, price, sum(p is not None for p in prices), low(prices[i + skip :]), nxt))
    df = spark.createDataFrame(data, SCHEMA)
    found = windows.future_prices(df, ["k"], ["day", "seq"], "price", skip=skip, policy=policy)
    assert rows(found) == rows(spark.createDataFrame(expected, found.schema))


@pytest.mark.parametrize("policy", [hot.DEFAULT, TINY])
def test_trailing_mean(spark, rows, policy):
    data = [(k, d, s, p or 1.0) for k, d, s, p in history(3)]
    expected = []
    for key, group in grouped(data).items():
        for i, (_, day, seq, price) in enumerate(group):
            before = [r[3] for r in group[max(0, i - 4) : i]]
            expected.append((key, day, seq, price, round(sum(before) / len(before) if before else price, 6)))
    df = spark.createDataFrame(data, SCHEMA)
    found = windows.trailing_mean(df, ["k"], ["day", "seq"], "price", out="m", policy=policy)
    found = found.withColumn("m", F.round("m", 6))
    assert rows(found) == rows(spark.createDataFrame(expected, found.schema))


@pytest.mark.parametrize("policy", [hot.DEFAULT, TINY])
def test_running_total_and_position(spark, rows, policy):
    data = [(k, d, s, p or 1.0) for k, d, s, p in history(4)]
    expected = []
    for key, group in grouped(data).items():
        for i, (_, day, seq, price) in enumerate(group):
            expected.append((key, day, seq, price, i, float(sum(r[3] for r in group[:i]))))
    df = spark.createDataFrame(data, SCHEMA)
    found = windows.position(df, ["k"], ["day", "seq"], "n", policy)
    found = windows.running_total(found, ["k"], ["day", "seq"], "price", "total", policy)
    assert rows(found) == rows(spark.createDataFrame(expected, found.schema))


def test_running_total_without_keys(spark, rows):
    data = [(i, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(data, "i int, v double")
    found = windows.running_total(df, [], ["i"], "v", "total", TINY)
    assert rows(found) == [(i, v, float(sum(x for _, x in data[:i]))) for i, v in data]


def test_one_group_of_copies_is_split_too(spark):
    """Rows equal in every column cannot be told apart, but still fill several segments."""
    df = spark.createDataFrame([("hot", 1, 1, 5.0)] * 400, SCHEMA)
    parts = hot.split(df, ["k"], ["day", "seq"], TINY)
    sizes = [r["count"] for r in parts.hot.groupBy(hot.SEGMENT).count().collect()]
    assert sum(sizes) == 400 and len(sizes) > 5 and max(sizes) < 150
    found = windows.future_prices(df, ["k"], ["day", "seq"], "price", policy=TINY)
    assert found.filter("futureMinPrice IS NULL").count() == 2
    assert found.filter("nextQueryPrice IS NULL").count() == 1


def test_split_leaves_normal_groups_alone(spark):
    df = spark.createDataFrame(history(5), SCHEMA)
    parts = hot.split(df, ["k"], ["day", "seq"], TINY)
    assert {r["k"] for r in parts.hot.select("k").distinct().collect()} == {"hot", None}
    assert parts.normal.count() + parts.hot.count() == df.count()
    assert hot.split(df, ["k"], ["day", "seq"]).hot is None


@pytest.mark.parametrize("label", [labels.trend, labels.trend_own_price, labels.trend3])
def test_labels_do_not_depend_on_the_split(spark, rows, label):
    df = spark.createDataFrame(history(6), SCHEMA)
    plain = label(df, ["k"], ["day", "seq"])
    split = label(df, ["k"], ["day", "seq"], policy=TINY)
    assert rows(plain) == rows(split) and plain.count() > 100


def test_series_have_one_shape_at_every_size(spark):
    data = [(k, d, s, p or 1.0) for k, d, s, p in history(7)]
    df = spark.createDataFrame(data, SCHEMA)
    found = forecast.series(df, ["k"], ["day", "seq"], "price", part=F.expr("day div 4")).collect()
    joined = {}
    for r in sorted(found, key=lambda r: r["part"]):
        joined.setdefault(r["k"], []).extend((x["day"], x["seq"], x["price"]) for x in r["content"])
    assert joined == {k: [r[1:] for r in g] for k, g in grouped(data).items()}
    assert {(r["k"], r["part"]) for r in found} == {(k, d // 4) for k, d, _, _ in data}
    months = forecast.series(spark.sql("SELECT 1 AS k, explode(sequence(date'2020-01-30', date'2020-02-02')) AS day, 2 AS v"), ["k"], ["day"], "v")
    assert sorted((str(r["part"]), len(r["content"])) for r in months.collect()) == [("2020-01-01", 2), ("2020-02-01", 2)]


def test_every_hot_key_is_split(spark):
    """However many there are; no segment is much larger than asked for."""
    data = [(f"k{k}", d % 28, d, float(d)) for k in range(30) for d in range(100)]
    parts = hot.split(spark.createDataFrame(data, SCHEMA), ["k"], ["day"], HotPolicy(rows_per_task=25))
    assert parts.normal.count() == 0 and parts.hot.select("k").distinct().count() == 30
    sizes = [r["count"] for r in parts.hot.groupBy(hot.SEGMENT).count().collect()]
    assert max(sizes) <= 60 and len(sizes) >= 80


def test_short_segments_do_not_make_more_tasks(spark):
    """The tasks that cut a hot group follow its rows; a segment is no longer than asked for, however few they are."""
    data = [("hot", d % 28, d, float(d)) for d in range(3_000)]
    parts = hot.split(spark.createDataFrame(data, SCHEMA), ["k"], ["day", "seq"], HotPolicy(rows_per_task=25))
    assert len(parts.hot.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = parts.hot.groupBy(hot.SEGMENT).agg(F.min(F.struct("day", "seq")).alias("a"), F.max(F.struct("day", "seq")).alias("b"), F.count("*").alias("n"))
    found = segments.orderBy(hot.SEGMENT).collect()
    assert max(r["n"] for r in found) <= 25 and 120 <= len(found) <= 124
    assert all(before["b"] < after["a"] for before, after in zip(found, found[1:]))


def test_ties_fall_alike_at_every_size(spark, rows):
    data = [("k", 1, s, float(s * 7 % 60)) for s in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    plain = windows.future_prices(df.repartition(5), ["k"], ["day"], "price")
    assert rows(plain) == rows(windows.future_prices(df, ["k"], ["day"], "price", policy=TINY))


def test_auc_and_indexes_do_not_depend_on_the_split(spark, rows):
    rng = random.Random(8)
    data = [(rng.randint(0, 1), rng.randint(0, 80) / 7.0, f"v{rng.randint(0, 90)}") for _ in range(500)]
    df = spark.createDataFrame(data, "y int, score double, word string")
    wins = sum((a > b) + (a == b) / 2 for y, a, _ in data if y for z, b, _ in data if not z)
    pairs = sum(y for y, _, _ in data) * sum(1 - y for y, _, _ in data)
    for policy in (hot.DEFAULT, TINY):
        assert metrics.auc(df, "y", "score", policy).first()["auc"] == pytest.approx(wins / pairs, abs=1e-12)
    assert rows(encoding.string_index(df, ["word", "y"])) == rows(encoding.string_index(df, ["word", "y"], TINY))
    assert rows(encoding.feature_index(df, ["score", "y"])) == rows(encoding.feature_index(df, ["score", "y"], policy=TINY))
