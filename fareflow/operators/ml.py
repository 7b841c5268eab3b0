"""Models: distributed ``pyspark.ml`` pipelines of the fare jobs."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import FMClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import ChiSquareTest
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import materialize
from . import encoding, factorisation, forest

#: Columns of the international price model.
CATEGORIES = ["org", "dst", "isReturn_type", "isDirect_type", "departYear", "is_vacation", "vacation_days", "day_of_vacation"]
NUMBERS = [
    "departMonth",
    "depart_dayofmonth",
    "depart_weekofyear",
    "depart_dayofweek",
    "departQuarter",
    "intervalDays",
    "intervalMonths",
    "intervalWeeks",
    "intervalQuarters",
    "preceding3day_price",
]
#: Columns the chi-square ranking looks at.
RANKED = [
    "fnHashBucket",
    "fcHashBucket",
    "dayofweek",
    "discountBucket",
    "distanceBucket",
    "seatLeftBucket",
    "departTimeBucket",
    "isShare",
    "intervalDays",
    "intervalDaysBucket",
]

def sparse_vector(slots: Column, size: Column | int) -> Column:
    """An ML vector of ``size`` from an array of structs (index, weight), without Python.

    Pairs without an index or weight, or with an index outside the vector, count as
    zero, and zeros are left out; an index may stand once.
    """
    size = F.lit(size).cast("int") if isinstance(size, int) else size.cast("int")
    known = F.sort_array(F.filter(slots, lambda p: p["idx"].isNotNull() & (p["idx"] >= 0) & (p["idx"] < size) & (p["val"] != 0)))
    # A vector is stored as this struct; reading it from JSON makes it a vector again.
    parts = F.struct(
        F.lit(0).cast("byte").alias("type"),
        size.alias("size"),
        F.transform(known, lambda p: p["idx"].cast("int")).alias("indices"),
        F.transform(known, lambda p: p["val"].cast("double")).alias("values"),
    )
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def vector_parts(vector: Column | str) -> Column:
    """``size, indices, values`` of a sparse vector, without Python."""
    text = F.to_json(F.struct((F.col(vector) if isinstance(vector, str) else vector).alias("v")))
    return F.from_json(text, "v struct<size: int, indices: array<int>, values: array<double>>")["v"]


class DictionaryOneHot(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot encoding of columns with any number of values.

    The values are a dictionary table, looked up by joins, so no list of labels goes
    through the driver.  Each column has a slot per value, the most frequent first,
    and one more for values the dictionary does not know and for NULL.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "DictionaryOneHotModel":
        columns = self.getInputCols()
        index = materialize(encoding.string_index(dataset, columns), "one-hot-dictionary")
        counted = {r[0]: r[1] for r in index.groupBy("feature").count().collect()}  # one row per column
        model = DictionaryOneHotModel(inputCols=columns, outputCol=self.getOutputCol(), sizes=[counted.get(c, 0) for c in columns])
        model.index = index
        return self._copyValues(model)


class DictionaryOneHotModel(Model, HasInputCols, HasOutputCol, MLReadable, MLWritable):
    """A fitted :class:`DictionaryOneHot`; ``index`` is the dictionary, stored with the model."""

    sizes = Param(Params._dummy(), "sizes", "number of known values of each column", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, sizes=None):
        super().__init__()
        self.index: DataFrame | None = None
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, sizes = self.getInputCols(), self.getOrDefault(self.sizes)
        slot = {c: f"_{c}_slot" for c in columns}
        coded = encoding.attach_index(dataset, self.index, columns, name=slot.__getitem__)
        pairs, before = [], 0
        for c, n in zip(columns, sizes):
            at = F.lit(before) + F.coalesce(F.col(slot[c]), F.lit(n)).cast("int")
            pairs.append(F.struct(at.alias("idx"), F.lit(1.0).alias("val")))
            before += n + 1
        return coded.withColumn(self.getOutputCol(), sparse_vector(F.array(*pairs), before)).drop(*slot.values())

    def write(self) -> "_DictionaryWriter":
        return _DictionaryWriter(self)

    @classmethod
    def read(cls) -> "_DictionaryReader":
        return _DictionaryReader(cls)


class _DictionaryWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.index.write.parquet(f"{path}/dictionary")


class _DictionaryReader(DefaultParamsReader):
    def load(self, path: str) -> DictionaryOneHotModel:
        model = super().load(path)
        model.index = SparkSession.active().read.parquet(f"{path}/dictionary")
        return model


def price_pipeline(categories: list[str] = CATEGORIES, numbers: list[str] = NUMBERS) -> Pipeline:
    """One-hot categories and standardised numbers, assembled into ``features``.

    A category first seen at prediction time gets its column's own slot for such.
    """
    onehot = DictionaryOneHot(inputCols=categories, outputCol="_categories")
    numeric = VectorAssembler(inputCols=numbers, outputCol="_numbers")
    scaler = StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True)
    joined = VectorAssembler(inputCols=["_categories", "_scaled"], outputCol="features")
    return Pipeline(stages=[onehot, numeric, scaler, joined])


def fit_price_encoder(history: DataFrame, categories=CATEGORIES, numbers=NUMBERS) -> PipelineModel:
    return price_pipeline(categories, numbers).fit(history)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_price(history: DataFrame, label: str = "price"):
    """Linear price model on ``features``."""
    return LinearRegression(maxIter=100, standardization=False, featuresCol="features", labelCol=label).fit(history)


def predict_price(model, frame: DataFrame) -> DataFrame:
    """``_id, predictDate, prediction`` with whole-number predictions."""
    return model.transform(frame).select(
        F.concat_ws("_", "flineId_noDate", F.date_format("departDate", "yyyy-MM-dd")).alias("_id"),
        "predictDate",
        F.col("prediction").cast("int").alias("prediction"),
    )


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """Feature vector of numeric columns; rows with a missing value are skipped."""
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="skip").transform(df)


def fit_forest(train: DataFrame, label: str = "trend", variant: str = "wide", seed: int = 42):
    """Random-forest trend model: ``wide`` (50 trees on 80 % of the rows) or
    ``shallow`` (100 trees of depth 6).

    The model of ``RandomForestClassifier``, trained in blocks of rows where they are
    more than one task's, see :mod:`fareflow.operators.forest`.
    """
    if variant == "wide":
        classifier = RandomForestClassifier(numTrees=50, featureSubsetStrategy="auto", subsamplingRate=0.8)
    else:
        classifier = RandomForestClassifier(numTrees=100, maxDepth=6)
    return forest.fit(classifier.setSeed(seed).setLabelCol(label), train.select(label, "features"))


def importances(model, columns: list[str]) -> list[tuple[str, float]]:
    """Feature importances, largest first."""
    scored = zip(columns, (float(v) for v in model.featureImportances.toArray()))
    return sorted(scored, key=lambda p: -p[1])


def fit_trend(train: DataFrame, label: str = "trend", factors: int = 8, iterations: int = 50, seed: int = 42):
    """Factorisation-machine trend model: first and second order feature terms.

    The model of ``FMClassifier``, trained in blocks of rows, see :mod:`fareflow.operators.factorisation`.
    """
    machine = FMClassifier(labelCol=label, factorSize=factors, maxIter=iterations, stepSize=0.05, seed=seed)
    return factorisation.fit(machine, train)


def score_trend(model, df: DataFrame) -> DataFrame:
    """Add ``rawPred``, the probability that waiting pays."""
    return model.transform(df).withColumn("rawPred", vector_to_array("probability")[1])


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<c>_scaled``: mean 0 and sample standard deviation 1."""
    vector = VectorAssembler(inputCols=columns, outputCol="_vector").transform(df)
    scaler = StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True, withStd=True).fit(vector)
    scaled = scaler.transform(vector).withColumn("_scaled", vector_to_array("_scaled"))
    return scaled.withColumns({f"{c}_scaled": F.col("_scaled")[i] for i, c in enumerate(columns)}).drop("_vector", "_scaled")


def chi_square(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``feature, statistic, degreesOfFreedom`` of every column against the label.

    All contingency tables come out of one unpivot and one count, combined before
    the shuffle; the rest works on counted cells.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.explode(cells).alias("_cell"), F.col(label).cast("double").alias("_label"))
    observed = (
        long.select("_cell.*", "_label").dropna().groupBy("feature", "value", "_label").agg(F.count(F.lit(1)).alias("_n"))
    )
    by_value = observed.groupBy("feature", "value").agg(
        F.sum("_n").alias("_row"), F.map_from_entries(F.collect_list(F.struct("_label", "_n"))).alias("_by_label")
    )
    by_label = observed.groupBy("feature", "_label").agg(F.sum("_n").alias("_col"))
    totals = by_label.groupBy("feature").agg(
        F.sum("_col").alias("_total"), F.collect_list(F.struct("_label", "_col")).alias("_labels")
    )
    # Every value meets every label, also where no row has both.  There is one
    # row of totals per column, so it is safe to broadcast.
    full = by_value.join(F.broadcast(totals), "feature").select(
        "feature", "value", "_row", "_total", "_by_label", F.explode("_labels").alias("_l")
    )
    seen = F.coalesce(F.try_element_at("_by_label", F.col("_l._label")), F.lit(0))
    expected = F.col("_row") * F.col("_l._col") / F.col("_total")
    return (
        full.withColumns({"_expected": expected, "_seen": seen})
        .groupBy("feature")
        .agg(
            F.sum(F.pow(F.col("_seen") - F.col("_expected"), 2) / F.col("_expected")).alias("statistic"),
            ((F.count_distinct("value") - 1) * (F.count_distinct("_l._label") - 1)).cast("int").alias("degreesOfFreedom"),
        )
    )


def _log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for z > 0: Stirling's series beyond 10, reached by the recurrence."""
    y = z + 10
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    steps = sum((F.log(z + i) for i in range(1, 10)), F.log(z))
    return (y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + series - steps


def upper_gamma(a: Column, x: Column) -> Column:
    """The regularised upper incomplete gamma function Q(a, x).

    Its power series for small x, its continued fraction for large x, with as many
    terms as ``a`` asks for.
    """
    front = F.exp(a * F.log(x) - x - _log_gamma(a))
    terms = F.sequence(F.lit(1), (F.lit(100) + 12 * F.ceil(F.sqrt(a))).cast("int"))

    def add(state, i):
        term = state["term"] * x / (a + i)
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"))

    one = (F.lit(1.0) / a).cast("double")
    lower = front * F.aggregate(terms, F.struct(one.alias("term"), one.alias("sum")), add, lambda s: s["sum"])

    # b + a1/(b1 + a2/(b2 + ...)) from the front: c and d are ratios of neighbouring numerators and denominators.
    def turn(state, i):
        above, below = -i * (i - a), x + 1 - a + 2 * i
        d = 1 / (above * state["d"] + below)
        c = below + above / state["c"]
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    begin = 1 / (x + 1 - a)
    start = F.struct(F.lit(1e300).alias("c"), begin.alias("d"), begin.alias("h"))
    upper = front * F.aggregate(terms, start, turn, lambda s: s["h"])
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, 1 - lower).otherwise(upper)


def rank_by_chi_square(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``feature, pValue, degreesOfFreedom, statistic`` of columns with any number of values.

    Rows with a missing value are skipped.  A column with one value says nothing: its
    p-value is 1.
    """
    tested = chi_square(df.dropna(subset=[*columns, label]), columns, label)
    half = F.col("degreesOfFreedom") / F.lit(2.0)
    p = F.when(F.col("degreesOfFreedom") < 1, F.lit(1.0)).otherwise(upper_gamma(half, F.col("statistic") / 2))
    return tested.select("feature", F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("pValue"), "degreesOfFreedom", "statistic")


def spark_chi_square(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """The same columns from Spark's own test, which takes up to 10,000 values of a column."""
    vectors = assemble(df.withColumn("_y", F.col(label).cast("double")), columns)
    tested = ChiSquareTest.test(vectors, "features", "_y", flatten=True)
    names = F.array(*[F.lit(c) for c in columns])
    return tested.select(F.get(names, F.col("featureIndex")).alias("feature"), "pValue", "degreesOfFreedom", "statistic")


def select_features(df: DataFrame, columns: list[str], label: str, share: float = 1.0) -> list[str]:
    """The most label-dependent share of categorical columns, in their own order; of equal p-values the earlier column."""
    ranked = {r["feature"]: r["pValue"] for r in rank_by_chi_square(df, columns, label).collect()}
    known = sorted((c for c in columns if c in ranked), key=ranked.__getitem__)
    chosen = set(known[: int(len(columns) * share)])
    return [c for c in columns if c in chosen]


def dictionary_vectors(df: DataFrame, index: DataFrame, categorical: list[str], numeric: list[str] = (), out: str = "features") -> DataFrame:
    """Add the model's sparse vector: a one at the dictionary number of each category, each number at its column's slot.

    The vector is as wide as the dictionary; a value it does not know is a zero.
    """
    coded = encoding.encode(df, index, categorical, numeric)
    names = [*categorical, *numeric]
    pairs = F.array(*[F.struct(F.col(f"{c}_idx").cast("int").alias("idx"), F.col(f"{c}_val").cast("double").alias("val")) for c in names])
    width = (index.agg(F.max("idx")).first()[0] or 0) + 1
    return coded.withColumn(out, sparse_vector(pairs, int(width))).drop(*[f"{c}_{kind}" for c in names for kind in ("idx", "val")])
