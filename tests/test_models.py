"""Encoders and tests without a bound on the number of values."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, UnivariateFeatureSelector
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from fareflow.operators import encoding, factorisation, forest, ml


def test_sparse_vectors_without_python(spark, capsys):
    rows = [([(3, 0.1), (0, 2.5)],), ([(None, 1.0), (7, 1.0), (1, None), (2, 0.0)],), ([],), (None,)]
    df = spark.createDataFrame(rows, "p array<struct<idx: int, val: double>>")
    made = df.withColumn("v", ml.sparse_vector(F.coalesce("p", F.array().cast("array<struct<idx: int, val: double>>")), 5))
    made.explain()
    assert "Python" not in capsys.readouterr().out
    found = [r.v for r in made.collect()]
    assert [v.size for v in found] == [5] * 4
    assert [v.toArray().tolist() for v in found] == [[2.5, 0, 0, 0.1, 0], [0.0] * 5, [0.0] * 5, [0.0] * 5]
    back = made.select(ml.vector_parts("v").alias("x")).first().x
    assert (back["size"], back["indices"], back["values"]) == (5, [0, 3], [2.5, 0.1])


def test_a_column_of_120_000_values_is_encoded(spark, tmp_path):
    wide = spark.range(120_000).select(F.concat(F.lit("v"), "id").alias("wide"), (F.col("id") % 3).alias("few"), F.col("id").cast("double").alias("n"))
    model = ml.price_pipeline(["wide", "few"], ["n"]).fit(wide)
    ml.save_model(model, str(tmp_path / "m"))
    ml.save_model(model, str(tmp_path / "m"))  # a second time too
    loaded = ml.load_pipeline(str(tmp_path / "m"))
    asked = spark.createDataFrame([("v5", 0, 1.0), ("never seen", 1, 2.0), (None, None, 3.0)], "wide string, few int, n double")
    rows = {r.n: r for r in loaded.transform(asked).select("n", "_categories", "features").collect()}
    known = {r.value: int(r.idx) for r in loaded.stages[0].index.filter("feature = 'few'").collect()}
    assert all(r.features.size == 120_006 for r in rows.values())
    assert rows[2.0]._categories.indices.tolist() == [120_000, 120_001 + known["1"]]
    assert rows[3.0]._categories.indices.tolist() == [120_000, 120_004]
    before = {r.n: r.features for r in model.transform(asked).select("n", "features").collect()}
    assert {n: r.features for n, r in rows.items()} == before


def test_the_machine_is_that_of_spark(spark, tmp_path):
    """Dense, sparse and empty vectors; rows dealt to several tasks; a stored model says the same."""
    from pyspark.ml.classification import FMClassificationModel, FMClassifier

    slots = F.transform(F.array(F.col("id") % 5, 5 + F.col("id") % 7, F.lit(12)), lambda i: F.struct(i.cast("int").alias("idx"), F.when(i < 12, 1.0).otherwise(F.sin("id")).alias("val")))
    rows = spark.range(3_000).select((F.col("id") % 5 * (F.col("id") % 7) > 8).cast("int").alias("y"), ml.sparse_vector(F.when(F.col("id") % 97 == 0, F.array().cast("array<struct<idx:int,val:double>>")).otherwise(slots), 13).alias("features"))
    model = ml.fit_trend(rows, "y", factors=3, iterations=12)
    theirs = FMClassifier(labelCol="y", factorSize=3, maxIter=12, stepSize=0.05, seed=42).fit(rows)
    assert model.factors.toArray() == pytest.approx(theirs.factors.toArray(), abs=1e-8)
    assert model.linear.toArray() == pytest.approx(theirs.linear.toArray(), abs=1e-8)
    assert model.intercept == pytest.approx(theirs.intercept, abs=1e-8)
    ml.save_model(model, str(tmp_path / "fm"))
    known = ml.score_trend(FMClassificationModel.load(str(tmp_path / "fm")), rows).select("rawPred", "prediction").collect()
    assert known == ml.score_trend(model, rows).select("rawPred", "prediction").collect()
    with pytest.raises(Exception, match="(?i)labels"):
        ml.fit_trend(rows.withColumn("y", F.col("y") * 2), "y", iterations=1)


def _votes(spark, n=9_000, classes=2):
    """Rows of several partitions whose label depends on some features: few and many values, zeros, a constant."""
    noise = lambda m: F.pmod(F.xxhash64("id", F.lit(m)), F.lit(m))
    rows = spark.range(0, n, 1, 5).select(
        (F.col("id") % 7).alias("few"), (F.col("id") % 90 / 9).alias("many"), F.when(F.col("id") % 5 == 0, F.col("id") % 11).otherwise(0).alias("zeros"), F.lit(3).alias("one"), noise(50).alias("noise"), noise(9).alias("_n")
    )
    label = F.pmod((F.col("few") * F.col("many") + F.col("noise") / 9 + F.col("zeros") + F.col("_n") / 3).cast("int"), F.lit(3))
    return ml.assemble(rows.withColumn("y", F.least(label, F.lit(classes - 1)).cast("double")), ["few", "many", "zeros", "one", "noise"]).select("y", "features")


@pytest.mark.parametrize("classes", [2, 3])
def test_the_forest_is_that_of_spark_where_nothing_is_drawn(spark, classes):
    rows = _votes(spark, classes=classes)
    one = RandomForestClassifier(numTrees=1, maxDepth=6, bootstrap=False, seed=5, labelCol="y")
    ours, theirs = forest.fit(one, rows, rows_per_task=1_000), one.fit(rows)
    tree = lambda m: m.toDebugString.split("\n")[1:]
    assert tree(ours) == tree(theirs) and len(tree(ours)) > 20
    assert ours.featureImportances == theirs.featureImportances
    said = lambda m: m.transform(rows).select("probability", "rawPrediction", "prediction").collect()
    assert said(ours) == said(theirs)


def test_a_drawn_forest_is_as_near_to_spark_as_another_seed(spark, tmp_path, monkeypatch):
    rows = _votes(spark, 6_000).withColumn("id", F.monotonically_increasing_id())
    many = RandomForestClassifier(numTrees=30, maxDepth=4, subsamplingRate=0.8, seed=5, labelCol="y")
    said = lambda m: [r.rawPred for r in ml.score_trend(m, rows).orderBy("id").select("rawPred").collect()]
    apart = lambda a, b: sum(abs(x - y) for x, y in zip(a, b)) / len(a)
    model = forest.fit(many, rows, rows_per_task=1_000)
    ours, theirs, other = said(model), said(many.fit(rows)), said(many.copy({many.seed: 6}).fit(rows))
    assert 0 < apart(ours, theirs) < 2 * apart(theirs, other) < 0.1
    ml.save_model(model, str(tmp_path / "forest"))
    assert said(RandomForestClassificationModel.load(str(tmp_path / "forest"))) == ours
    # Nodes whose counts do not fit at once are counted one after another.
    monkeypatch.setattr(forest, "SUMS", 8 * 3 * 32 * 2 * 100)
    assert said(forest.fit(many, rows, rows_per_task=1_000)) == ours
    with pytest.raises(Exception, match="(?i)labels"):
        forest.fit(many, rows.withColumn("y", F.col("y") - 1), rows_per_task=1_000)


def test_drawn_rows():
    counts = np.bincount(forest._drawn(np.random.default_rng(1), 50_000, 0.8, True), minlength=50_000)
    assert [np.mean(counts == k) for k in range(4)] == pytest.approx([math.exp(-0.8) * 0.8**k / math.factorial(k) for k in range(4)], abs=0.01)
    once = forest._drawn(np.random.default_rng(1), 50_000, 0.8, False)
    assert len({*once}) == len(once) and len(once) == pytest.approx(40_000, rel=0.02)
    assert len(forest._drawn(np.random.default_rng(1), 50, 1.0, False)) == 50


def test_categories_are_left_to_spark(spark):
    rows = spark.range(20).select(F.concat(F.lit("v"), F.col("id") % 3).alias("v"), F.col("id").alias("binary"), (F.col("id") % 2).alias("y"))
    coded = StringIndexer(inputCol="v", outputCol="i").fit(rows).transform(rows)
    assert forest._nominal(ml.assemble(coded, ["i", "binary"]), "features") and forest._nominal(coded, "i")
    assert not forest._nominal(ml.assemble(coded, ["binary"]), "features") and not forest._nominal(coded, "y")


def test_many_training_rows_are_not_kept_one_by_one(spark, monkeypatch):
    """Rows beyond one task's are not trained on as objects, which take many times their size and are walked for each tree."""
    n = factorisation.ROWS_PER_TASK + 20_000
    rows = spark.range(n).select(F.col("id"), (F.col("id") % 10).alias("tell"), (F.col("id") % 3).alias("noise"), (F.col("id") % 10 > 3).cast("int").alias("y"))

    def never(*_):
        raise AssertionError("trained row by row")

    monkeypatch.setattr(RandomForestClassifier, "fit", never)
    model = ml.fit_forest(ml.assemble(rows, ["tell", "noise"]), "y", "wide")
    assert model.getNumTrees == 50 and ml.importances(model, ["tell", "noise"])[0][0] == "tell"
    assert ml.score_trend(model, ml.assemble(rows, ["tell", "noise"])).filter(F.col("y") != F.col("prediction")).count() == 0


def test_training_rows_are_dealt_by_their_number(spark):
    """However small the files are, no task trains on more rows than one should."""
    rows = spark.range(1000).coalesce(1)
    sizes = lambda df: [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
    dealt = sizes(factorisation.spread(rows, 100))
    assert len(dealt) == 10 and sum(dealt) == 1000 and max(dealt) <= 130
    assert sizes(factorisation.spread(rows, 1000)) == [1000]


def test_p_values_of_many_values(spark):
    df = spark.range(60_000).select((F.col("id") % 12_000).alias("wide"), (F.xxhash64("id") % 2 == 0).cast("int").alias("y"), (F.col("id") % 2).alias("even"), F.lit(1).alias("one"))
    found = {r.feature: r for r in ml.rank_by_chi_square(df, ["wide", "even", "one"], "y").collect()}
    assert found["wide"].degreesOfFreedom == 11_999 and 0 < found["wide"].pValue < 1
    # Wilson and Hilferty's approximation is close for so many degrees of freedom.
    k, x = 11_999, found["wide"].statistic
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    assert found["wide"].pValue == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=1e-4)
    assert (found["one"].pValue, found["one"].degreesOfFreedom) == (1.0, 0)


@pytest.mark.parametrize("a,x,q", [(0.5, 0.5, 0.31731050786291415), (1, 1, math.exp(-1)), (1, 50, math.exp(-50)), (2, 3, 4 * math.exp(-3)), (3, 0.0, 1.0), (5, 40, math.exp(-40) * sum(40**k / math.factorial(k) for k in range(5))), (100, 100, 0.4867012017166245)])
def test_upper_gamma(spark, a, x, q):
    found = spark.range(1).select(ml.upper_gamma(F.lit(float(a)), F.lit(float(x))).alias("q")).first().q
    assert found == pytest.approx(q, rel=1e-9, abs=1e-12)


def test_selection_agrees_with_spark(spark):
    leaning = {"a": (5, 0.15), "b": (7, 0.0), "c": (4, 0.05), "d": (2, 0.1)}
    rows = spark.range(3000).withColumn("y", F.col("id") % 2)
    df = rows.withColumns({c: F.floor(F.rand(i) * n + F.col("y") * w) for i, (c, (n, w)) in enumerate(leaning.items())})
    columns = ["a", "b", "c", "d"]
    for share in (0.25, 0.5, 0.8, 1.0):
        selector = UnivariateFeatureSelector(featuresCol="features", labelCol="y", selectionMode="percentile").setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(share)
        theirs = selector.fit(ml.assemble(df.withColumn("y", F.col("y").cast("double")), columns)).selectedFeatures
        assert ml.select_features(df, columns, "y", share) == [columns[i] for i in sorted(theirs)]


def test_dictionary_vectors(spark):
    train = spark.createDataFrame([(1.0, 10.0, 0.5), (2.0, 10.0, 0.0), (None, 20.0, 1.0)], "a double, b double, n double")
    index = encoding.feature_index(train, ["a", "b"], ["n"])
    rows = spark.createDataFrame([(2.0, 20.0, 7.0), (9.0, None, 0.0), (1.0, 10.0, None)], "a double, b double, n double")
    found = [r.features for r in ml.dictionary_vectors(rows, index, ["a", "b"], ["n"]).collect()]
    assert sorted(DenseVector(v.toArray()).values.tolist() for v in found) == sorted([[0, 1, 0, 1, 7], [0, 0, 0, 0, 0], [1, 0, 1, 0, 0]])


def test_a_growing_dictionary(spark, tmp_path, rows):
    from datetime import date

    day = lambda values: spark.createDataFrame([(v, w) for v, w in values], "a double, b double")
    root = str(tmp_path / "d")
    first = rows(encoding.grow_stored(root, day([(5.0, 1.0), (3.0, None), (5.0, 1.0)]), ["a", "b"], date(2019, 1, 1)))
    assert first == [("a", 0, 3.0, 0, 0), ("a", 0, 5.0, 1, 0), ("b", 1, 1.0, 2, 0)]
    second = rows(encoding.grow_stored(root, day([(4.0, 1.0), (1.0, 0.0)]), ["a", "b"], date(2019, 1, 2)))
    assert set(first) < set(second) and sorted(r[3] for r in second) == list(range(6))
    assert [r for r in second if r not in first] == [("a", 0, 1.0, 3, 3), ("a", 0, 4.0, 4, 3), ("b", 1, 0.0, 5, 3)]
    assert rows(encoding.grow_stored(root, day([(4.0, 1.0)]), ["a", "b"], date(2019, 1, 2))) == second
