"""Model quality as one-row DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from . import windows
from .hot import DEFAULT, HotPolicy


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error as a share of the actual value."""
    error = F.try_divide(F.abs(F.col(predicted) - F.col(actual)), F.col(actual))
    return df.agg(F.try_divide(F.sum(error), F.count(F.lit(1))).alias("mape"))


def confusion(df: DataFrame, label: str, predicted: str, positive: int = 1) -> DataFrame:
    """Confusion counts, precision, recall and accuracy for one class, in one pass."""
    is_label, is_pred = F.col(label) == positive, F.col(predicted) == positive
    counts = df.agg(
        F.count_if(is_label & is_pred).alias("tp"),
        F.count_if(~is_label & is_pred).alias("fp"),
        F.count_if(is_label & ~is_pred).alias("fn"),
        F.count_if(~is_label & ~is_pred).alias("tn"),
        F.count_if(F.col(label) == F.col(predicted)).alias("_right"),
        F.count(F.lit(1)).alias("_all"),
    )
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
        F.try_divide("_right", "_all").alias("accuracy"),
    )


def auc(df: DataFrame, label: str, score: str, policy: HotPolicy = DEFAULT) -> DataFrame:
    """Area under the ROC curve, exact, equal scores counted half.

    Rows shrink to one per distinct score before anything is ordered; the order
    itself is segmented when there are many scores.
    """
    tallies = materialize(
        df.groupBy(F.col(score).alias("_score")).agg(
            F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
        ),
        "scores",
    )
    ranked = windows.running_total(tallies, [], ["_score"], "_neg", "_below", policy)
    wins = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return ranked.agg(F.try_divide(wins, pairs).alias("auc"))
