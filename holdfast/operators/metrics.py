"""Classification metrics from (label, probability) columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import ratio
from holdfast.functions.ordering import with_running_sums


def _cells(label: str, probability: str, threshold: float) -> list[Column]:
    y, p = F.col(label) == 1, F.col(probability) >= threshold
    return [
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    ]


def confusion_matrix(
    df: DataFrame, label: str = "churned", probability: str = "churn_probability", threshold: float = 0.5
) -> DataFrame:
    return df.agg(*_cells(label, probability, threshold))


def classification_metrics(
    df: DataFrame, label: str = "churned", probability: str = "churn_probability", threshold: float = 0.5
) -> DataFrame:
    """Accuracy, precision, recall and F1; an undefined ratio is 0."""
    cells = confusion_matrix(df, label, probability, threshold)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def or_zero(a: Column, b: Column) -> Column:
        return F.coalesce(ratio(a, b), F.lit(0.0))

    return cells.select(
        or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        or_zero(tp, tp + fp).alias("precision"),
        or_zero(tp, tp + fn).alias("recall"),
        or_zero(tp * 2, tp * 2 + fp + fn).alias("f1_score"),
    )


def score_steps(
    df: DataFrame,
    label: str = "churned",
    probability: str = "churn_probability",
    partitions: int | None = None,
) -> DataFrame:
    """Per distinct score: positives and negatives at it, and cumulatively from the highest score down."""
    y = F.col(label)
    steps = df.groupBy(F.col(probability).alias("score")).agg(
        F.sum(y.cast("bigint")).alias("positives"), F.sum((1 - y).cast("bigint")).alias("negatives")
    )
    return with_running_sums(
        steps,
        [F.col("score").desc()],
        {"true_positives": "positives", "false_positives": "negatives"},
        partitions,
    )


def roc_auc(
    df: DataFrame, label: str = "churned", probability: str = "churn_probability", partitions: int | None = None
) -> DataFrame:
    """Exact area: share of (positive, negative) pairs in the right order, ties counting one half."""
    steps = score_steps(df, label, probability, partitions)
    # wide decimals: pair counts of a large table exceed 64 bits
    tied = F.col("positives").cast("decimal(19,0)") * F.col("negatives").cast("decimal(18,0)")
    above = F.col("positives").cast("decimal(19,0)") * (
        F.col("false_positives") - F.col("negatives")
    ).cast("decimal(18,0)")
    total = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    lost = F.sum(above).cast("double") + F.sum(tied).cast("double") / 2
    return steps.agg(F.try_divide(total - lost, total).alias("roc_auc"))


def pr_curve(
    df: DataFrame, label: str = "churned", probability: str = "churn_probability", partitions: int | None = None
) -> DataFrame:
    """Precision, recall and false-positive rate at every distinct score taken as the threshold.

    ``recall`` against ``false_positive_rate`` is the ROC curve.
    """
    steps = score_steps(df, label, probability, partitions)
    totals = steps.agg(F.struct(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))).scalar()
    tp, fp = F.col("true_positives"), F.col("false_positives")
    return steps.select(
        F.col("score").alias("threshold"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, totals.getField("p")).alias("recall"),
        ratio(fp, totals.getField("n")).alias("false_positive_rate"),
    )
