"""Model pipelines.  Fitted models have no SQL twin; where a part of one has, it is checked."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ...context import RunContext, materialize, work_dir
from ...functions import fares
from ...operators import encoding, labels, ml
from .. import international
from .calendar import INTL_FEATURES_SQL
from .registry import HISTORY_KEYS, HISTORY_ORDER, Tables, holidays, intl_history, itineraries, named_dates, query

_LINE = ["l_orderkey", "l_partkey", "l_linenumber"]
_LINE_SQL = "l_orderkey, l_partkey, l_linenumber"
_RUN = RunContext.of("1998-06-01")


@query(
    "q_standardize",
    f"""SELECT {_LINE_SQL}, round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) + 0.0::DOUBLE AS l_quantity_scaled,
  round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER (), 6) + 0.0::DOUBLE AS l_extendedprice_scaled
FROM lineitem""",
)
def standardize(t):
    columns = ["l_quantity", "l_extendedprice"]
    scaled = ml.standardize(t.lineitem.select(*_LINE, *columns), columns)
    return scaled.select(*_LINE, *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in columns])


@query(
    "q_linear_price",
    """WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS m, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, CAST(trunc(m * l_quantity + b) AS INT) AS prediction FROM lineitem, fit""",
)
def linear_price(t):
    lines = ml.assemble(t.lineitem.select(*_LINE, "l_quantity", F.col("l_extendedprice").alias("price")), ["l_quantity"])
    fitted = ml.fit_price(lines).transform(lines)
    return fitted.select(*_LINE, F.col("prediction").cast("int").alias("prediction"))


_CHI_FEATURES = ["l_linenumber", "l_quantity", "l_discount"]


def _chi_sql() -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem" for c in _CHI_FEATURES
    )
    return f"""WITH cells AS ({cells}),
vals AS (SELECT feature, value, count(*) AS r FROM cells GROUP BY ALL), ys AS (SELECT feature, y, count(*) AS c FROM cells GROUP BY ALL),
tot AS (SELECT feature, count(*) AS n FROM cells GROUP BY ALL), seen AS (SELECT feature, value, y, count(*) AS o FROM cells GROUP BY ALL),
grid AS (SELECT v.feature, v.value, ys.y, r * c / n AS e FROM vals v JOIN ys USING (feature) JOIN tot USING (feature))
SELECT feature, round(sum(pow(coalesce(o, 0) - e, 2) / e), 6) AS statistic,
  CAST((count(DISTINCT value) - 1) * (count(DISTINCT y) - 1) AS INT) AS "degreesOfFreedom"
FROM grid LEFT JOIN seen USING (feature, value, y) GROUP BY feature"""


def _returned(t: Tables):
    return t.lineitem.withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))


@query("q_chi2", _chi_sql())
def chi2(t):
    tested = ml.chi_square(_returned(t), _CHI_FEATURES, "returned")
    return tested.withColumn("statistic", F.round("statistic", 6))


@query("q_chi2_spark", _chi_sql())
def chi2_spark(t):
    """Spark's own test of the same contingency tables."""
    tested = ml.spark_chi_square(_returned(t), _CHI_FEATURES, "returned")
    return tested.select(
        "feature", F.round("statistic", 6).alias("statistic"), F.col("degreesOfFreedom").cast("int").alias("degreesOfFreedom")
    )


@query("q_chi2_rank")
def chi2_rank(t):
    """The ten ranked columns of the analysis job, on labelled part histories."""
    lines = _ranking_frame(t)
    return ml.rank_by_chi_square(lines, ml.RANKED, "trend").select("feature", "pValue", "degreesOfFreedom", "statistic")


def _ranking_frame(t: Tables):
    rows = itineraries(t).withColumn("day", F.col("departDate"))
    labelled = labels.trend(rows, HISTORY_KEYS, HISTORY_ORDER)
    raw = labelled.withColumns(
        {
            "fnHashBucket": fares.hash_bucket("fn"),
            "fcHashBucket": fares.hash_bucket("fc"),
            "dayofweek": F.weekday("departDate") + 1,
            "discount": F.col("price") / 700,
            "distance": F.col("l_discount") * 90_000,
            "seatLeft": F.col("l_linenumber") * 14.0,
            "departTimeBucket": F.col("l_linenumber") * 3,
            "isShare": (F.col("l_returnflag") == "A").cast("int"),
            "intervalDays": F.datediff("departDate", "queryDate").cast("double"),
        }
    )
    frame = raw.withColumns(fares.buckets(fares.ANALYSIS_BUCKETS))
    return materialize(frame.select("l_partkey", "departDate", *ml.RANKED, "trend"), "ranking")


def _past(t: Tables):
    """International feature history of the tables."""
    return international.history(intl_history(t), named_dates(t), holidays(t), _LINE)


@query("q_chi2_agrees", " UNION ALL ".join(f"SELECT '{c}' AS feature, true AS agrees" for c in ml.RANKED))
def chi2_agrees(t):
    """Our p-values and those of Spark's test, on the ten ranked columns."""
    lines = _ranking_frame(t)
    theirs = ml.spark_chi_square(lines, ml.RANKED, "trend").select("feature", F.col("pValue").alias("_p"), F.col("statistic").alias("_s"))
    both = ml.rank_by_chi_square(lines, ml.RANKED, "trend").join(theirs, "feature")
    near = (F.abs(F.col("pValue") - F.col("_p")) < 1e-9) & (F.abs(F.col("statistic") - F.col("_s")) < 1e-6 * (1 + F.col("_s")))
    return both.select("feature", near.alias("agrees"))


_ONEHOT = ["l_linestatus", "l_suppkey", "l_partkey"]
_ONEHOT_DAY = "1996-01-01"


def _onehot_sql() -> str:
    cells = " UNION ALL ".join(f"SELECT {i} AS f, CAST({c} AS VARCHAR) AS value FROM past" for i, c in enumerate(_ONEHOT))
    slot = lambda i, c: f"""(SELECT before FROM offsets WHERE f = {i}) + coalesce(d{i}.idx, (SELECT n FROM offsets WHERE f = {i}))"""
    joins = " ".join(f"LEFT JOIN dict d{i} ON d{i}.f = {i} AND d{i}.value = CAST(l.{c} AS VARCHAR)" for i, c in enumerate(_ONEHOT))
    slots = " || ',' || ".join(f"CAST({slot(i, c)} AS VARCHAR)" for i, c in enumerate(_ONEHOT))
    return f"""WITH past AS (SELECT * FROM lineitem WHERE CAST(l_shipdate AS DATE) < DATE '{_ONEHOT_DAY}' AND l_suppkey % 10 <> 3), cells AS ({cells}),
dict AS (SELECT f, value, CAST(row_number() OVER (PARTITION BY f ORDER BY count(*) DESC, value) - 1 AS BIGINT) AS idx FROM cells GROUP BY f, value),
sizes AS (SELECT f, count(*) AS n FROM dict GROUP BY f),
offsets AS (SELECT f, n, CAST(coalesce(sum(n + 1) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM sizes)
SELECT {_LINE_SQL}, CAST((SELECT sum(n + 1) FROM sizes) + 1 AS INT) AS width, {slots} AS slots FROM lineitem l {joins}"""


@query("q_onehot_table", _onehot_sql())
def onehot_table(t):
    """An encoder fitted on the lines before a day, stored, loaded, and applied to all lines."""
    lines = t.lineitem.withColumn("quantity", F.col("l_quantity").cast("double"))
    past = lines.filter((F.to_date("l_shipdate") < _ONEHOT_DAY) & (F.col("l_suppkey") % 10 != 3))
    path = work_dir(t.spark, "encoder")
    ml.save_model(ml.price_pipeline(_ONEHOT, ["quantity"]).fit(past), path)
    coded = ml.load_pipeline(path).transform(lines)
    parts = ml.vector_parts("_categories")
    # The one number stands behind the categories.
    return coded.select(*_LINE, (parts["size"] + 1).alias("width"), F.concat_ws(",", parts["indices"].cast("array<string>")).alias("slots"))


_AHEAD_SQL = f"""{INTL_FEATURES_SQL}, led AS (SELECT *, "departDate" - "predictDate" AS days FROM known),
top AS (SELECT * FROM led QUALIFY row_number() OVER (
  PARTITION BY "flineId_noDate", days ORDER BY "departDate" DESC, l_orderkey DESC, l_partkey DESC, l_linenumber DESC) <= 3),
reference AS (SELECT "flineId_noDate", days, avg(price) AS preceding3day_price FROM top GROUP BY ALL),
pairs AS (SELECT DISTINCT "flineId_noDate", "departDate" FROM known WHERE "departDate" > DATE '{_RUN.run_date}' AND "departDate" <= DATE '{_RUN.run_date}' + 90),
grid AS (SELECT *, CAST(unnest(generate_series(TIMESTAMP '{_RUN.shift(1)}', CAST("departDate" AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS "predictDate" FROM pairs),
ahead AS (SELECT g.*, preceding3day_price FROM grid g JOIN reference r ON r."flineId_noDate" = g."flineId_noDate" AND r.days = g."departDate" - g."predictDate")"""


def _width_sql() -> str:
    of = {c: f'"{c}"' for c in ml.CATEGORIES} | {"departYear": 'year("departDate")'}
    return " + ".join(f"count(DISTINCT {of[c]}) + 1" for c in ml.CATEGORIES) + f" + {len(ml.NUMBERS)}"


@query(
    "q_onehot_predict",
    f"""WITH {_AHEAD_SQL}, width AS (SELECT CAST({_width_sql()} AS INT) AS width FROM known)
SELECT "flineId_noDate", "departDate", "predictDate", round(preceding3day_price, 4) AS preceding3day_price, width FROM ahead, width""",
)
def onehot_predict(t):
    """Encoder fitted on the history, stored, loaded and applied to the grid with its reference prices."""
    past = _past(t)
    path = work_dir(t.spark, "encoder")
    ml.save_model(ml.fit_price_encoder(past), path)
    frame = international.prediction_frame(past, holidays(t), _RUN, _LINE)
    coded = ml.load_pipeline(path).transform(frame)
    return coded.select(
        "flineId_noDate",
        "departDate",
        "predictDate",
        F.round("preceding3day_price", 4).alias("preceding3day_price"),
        F.size(vector_to_array("features")).alias("width"),
    )


@query("q_intl_forecast")
def intl_forecast(t):
    """History to low, high and departure-day predictions in one plan."""
    return international.forecast_summary(_past(t), holidays(t), _RUN, _LINE)


@query(
    "q_intl_forecast_rules",
    f"""WITH {_AHEAD_SQL}
SELECT "flineId_noDate" || '_' || "departDate" AS _id, max("predictDate") FILTER ("predictDate" = "departDate") AS "departDate",
  true AS in_order, true AS days_known FROM ahead GROUP BY "flineId_noDate", ahead."departDate" ORDER BY 1""",
)
def intl_forecast_rules(t):
    """Which forecasts there are, and what holds for each whatever the model says."""
    past = materialize(_past(t), "past")
    found = international.forecast_summary(past, holidays(t), _RUN, _LINE)
    depart = F.coalesce("departPrice", "lowPrice")
    last = F.substring_index("_id", "_", -1).cast("date")
    known = [F.col(c).between(F.lit(_RUN.shift(1)), last) for c in ("lowPriceDate", "highPriceDate")]
    return found.select(
        "_id",
        "departDate",
        (depart.between(F.col("lowPrice"), F.col("highPrice")) & F.col("lowPrice").isNotNull()).alias("in_order"),
        (known[0] & known[1]).alias("days_known"),
    )


def _holdout(scored, label: str, name: str):
    """One row: does a model beat saying the more frequent class, on rows it has not seen?"""
    right = F.sum((F.col(label) == F.col("prediction")).cast("int"))
    ones = F.sum(F.col(label).cast("int"))
    return scored.agg(
        F.lit(name).alias("model"), F.count("*").alias("rows"), (right > F.greatest(ones, F.count("*") - ones)).alias("beats_majority")
    )


_DEAR = "l_quantity + l_extendedprice / 5000 > 35"
_DEAR_COLUMNS = ["l_quantity", "l_linenumber", "supplier_group"]
_DEAR_DAY = "1997-01-01"


def _dear(t: Tables):
    """Lines, labelled by what their quantity says in part; some groups come up late."""
    groups = F.when(F.to_date("l_shipdate") < _DEAR_DAY, F.col("l_suppkey") % 7).otherwise(F.col("l_suppkey") % 8)
    return t.lineitem.select(
        *_LINE, "l_quantity", "l_discount", groups.alias("supplier_group"), F.to_date("l_shipdate").alias("day"), F.expr(_DEAR).cast("int").alias("dear")
    )


def _before_and_after(t: Tables, index: bool):
    rows = _dear(t)
    past = rows.filter(F.col("day") < _DEAR_DAY)
    if index:
        known = materialize(encoding.feature_index(past, _DEAR_COLUMNS, ["l_discount"]), "dictionary")
        rows = materialize(ml.dictionary_vectors(rows, known, _DEAR_COLUMNS, ["l_discount"]), "vectors")
    else:
        rows = ml.assemble(rows, [*_DEAR_COLUMNS, "l_discount"])
    return rows.filter(F.col("day") < _DEAR_DAY), rows.filter(F.col("day") >= _DEAR_DAY)


def _dear_sql() -> str:
    cells = " UNION ".join(f"SELECT {i} AS p, CAST({c} AS DOUBLE) AS value FROM past" for i, c in enumerate(_DEAR_COLUMNS))
    picks = ", ".join(f"(SELECT idx FROM dict WHERE p = {i} AND value = CAST({c} AS DOUBLE))" for i, c in enumerate(_DEAR_COLUMNS))
    return f"""WITH lines AS (SELECT {_LINE_SQL}, l_quantity, l_discount, CAST(l_shipdate AS DATE) AS day,
    CASE WHEN CAST(l_shipdate AS DATE) < DATE '{_DEAR_DAY}' THEN l_suppkey % 7 ELSE l_suppkey % 8 END AS supplier_group FROM lineitem),
past AS (SELECT * FROM lines WHERE day < DATE '{_DEAR_DAY}'), cells AS ({cells}),
dict AS (SELECT p, value, row_number() OVER (ORDER BY p, value) - 1 AS idx FROM cells),
width AS (SELECT count(*) AS n FROM dict),
coded AS (SELECT {_LINE_SQL}, [{picks}, CASE WHEN l_discount <> 0 THEN (SELECT n FROM width) END] AS slots, l_discount FROM lines WHERE day >= DATE '{_DEAR_DAY}')
SELECT {_LINE_SQL}, CAST((SELECT n + 1 FROM width) AS INT) AS width, array_to_string(list_sort([x FOR x IN slots IF x IS NOT NULL]), ',') AS slots, l_discount AS discount,
  true AS scored FROM coded"""


@query("q_fm_dictionary", _dear_sql())
def fm_dictionary(t):
    """Dictionary and factorisation machine from the lines before a day; vectors and scores of the later ones."""
    past, later = _before_and_after(t, index=True)
    scored = ml.score_trend(ml.fit_trend(past, "dear", iterations=20), later)
    parts = ml.vector_parts("features")
    last = F.when(F.col("l_discount") != 0, F.element_at(parts["values"], -1)).otherwise(F.lit(0.0))
    return scored.select(
        *_LINE,
        parts["size"].alias("width"),
        F.concat_ws(",", parts["indices"].cast("array<string>")).alias("slots"),
        last.alias("discount"),
        F.col("rawPred").between(0, 1).alias("scored"),
    )


_HOLDOUT_SQL = f"""SELECT model, (SELECT count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '{_DEAR_DAY}') AS rows, true AS beats_majority
FROM (VALUES {{}}) m(model)"""


@query("q_fm_holdout", _HOLDOUT_SQL.format("('fm')"))
def fm_holdout(t):
    past, later = _before_and_after(t, index=True)
    return _holdout(ml.score_trend(ml.fit_trend(past, "dear", iterations=60), later), "dear", "fm")


@query("q_forest_holdout", _HOLDOUT_SQL.format("('wide'), ('shallow')"))
def forest_holdout(t):
    """Both forests, fitted before a day and judged after it."""
    past, later = _before_and_after(t, index=False)
    past = materialize(past, "past")
    judged = [_holdout(ml.score_trend(ml.fit_forest(past, "dear", variant), later), "dear", variant) for variant in ("wide", "shallow")]
    return judged[0].unionByName(judged[1])


@query("q_forest_trend")
def forest_trend(t):
    rows = ml.assemble(_ranking_frame(t), ml.RANKED)
    train, held = rows.filter("departDate < '1999-01-01'"), rows.filter("departDate >= '1999-01-01'")
    model = ml.fit_forest(train, variant="shallow")
    return ml.score_trend(model, held).select("l_partkey", "departDate", "trend", "prediction", "rawPred")


@query("q_fm_trend")
def fm_trend(t):
    columns = ["dayofweek", "discountBucket", "distanceBucket", "seatLeftBucket", "isShare", "intervalDays"]
    frame = _ranking_frame(t)
    coded = ml.price_pipeline(columns[:1] + columns[4:5], columns[1:4] + columns[5:]).fit(frame).transform(frame)
    coded = materialize(coded.select("l_partkey", "departDate", "trend", "features"), "coded")
    model = ml.fit_trend(coded, iterations=20)
    return ml.score_trend(model, coded).select("l_partkey", "departDate", "trend", "prediction", "rawPred")
