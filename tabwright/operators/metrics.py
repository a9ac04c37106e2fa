"""Counts and class-level metrics; each operator is one pass with one small result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import guarded_ratio

PROBABILITY_FLOOR = 1e-15


def _cells(label: str, prediction: str, pos_label: int) -> dict[str, Column]:
    """Conditional counts of the four cells; rows with a null fall in none of them."""
    pos, neg = F.lit(pos_label), F.lit(1 - pos_label)
    y, p = F.col(label), F.col(prediction)
    return {
        "tp": F.count_if((y == pos) & (p == pos)),
        "fp": F.count_if((y == neg) & (p == pos)),
        "fn": F.count_if((y == pos) & (p == neg)),
        "tn": F.count_if((y == neg) & (p == neg)),
    }


def _ratios(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision = guarded_ratio(tp, tp + fp)
    recall = guarded_ratio(tp, tp + fn)
    f1 = guarded_ratio(F.lit(2.0) * precision * recall, precision + recall)
    return precision, recall, f1


def class_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    pos_label: int = 0,
    by: Sequence[str] = (),
) -> DataFrame:
    """``precision, recall, f1`` of one class; 0.0 where a denominator is empty.

    With ``by`` there is one row per group, otherwise exactly one row.
    """
    cells = _cells(label, prediction, pos_label)
    counted = df.groupBy(*by).agg(*[cells[c].alias(f"_{c}") for c in ("tp", "fp", "fn")])
    ratios = _ratios(F.col("_tp"), F.col("_fp"), F.col("_fn"))
    return counted.select(
        *by, *[r.alias(n) for r, n in zip(ratios, ("precision", "recall", "f1"))]
    )


def compare_predictions(
    df: DataFrame, label: str, predictions: Mapping[str, str], pos_label: int = 0
) -> DataFrame:
    """Class metrics of several prediction columns of the same rows, in one pass.

    ``predictions`` maps a name to a column; the result has one row per name.
    """
    counts = []
    for name, column in predictions.items():
        cells = _cells(label, column, pos_label)
        counts.append(
            F.struct(F.lit(name).alias("name"), *[cells[c].alias(c) for c in ("tp", "fp", "fn")])
        )
    ratios = _ratios(F.col("tp"), F.col("fp"), F.col("fn"))
    return (
        df.agg(F.array(*counts).alias("_all"))
        .select(F.inline("_all"))
        .select("name", *[r.alias(n) for r, n in zip(ratios, ("precision", "recall", "f1"))])
    )


def classifier_evaluation(
    df: DataFrame, label: str, prediction: str, pos_label: int = 0
) -> DataFrame:
    """The nine figures of a binary classifier's evaluation, in one row."""
    cells = _cells(label, prediction, pos_label)
    counted = df.agg(
        cells["tn"].alias("true_negatives"),
        cells["fp"].alias("false_positives"),
        cells["fn"].alias("false_negatives"),
        cells["tp"].alias("true_positives"),
        F.count_if(F.col(label).isNotNull() & F.col(prediction).isNotNull()).alias("example_count"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    precision, recall, f1 = _ratios(tp, fp, fn)
    return counted.select(
        "*",
        guarded_ratio(tp + tn, F.col("example_count")).alias("accuracy_score"),
        recall.alias("recall_score"),
        precision.alias("precision_score"),
        f1.alias("f1_score"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Row counts of the (prediction, label) cells that occur, in order."""
    return (
        df.groupBy(prediction, label)
        .agg(F.count("*").alias("rows"))
        .orderBy(prediction, label)
    )


def probability_of_one(probability: str = "probability") -> Column:
    """The probability of label 1 out of a classifier's probability vector."""
    return vector_to_array(F.col(probability)).getItem(1)


def log_loss(df: DataFrame, label: str, p_one: Column) -> DataFrame:
    """Mean negative log likelihood; rows with a null label or probability are left out."""
    p_true = F.when(F.col(label) == 1, p_one).when(F.col(label) == 0, F.lit(1.0) - p_one)
    floored = F.when(p_true < PROBABILITY_FLOOR, PROBABILITY_FLOOR).otherwise(p_true)
    return df.agg(F.avg(-F.ln(floored)).alias("log_loss"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows of every split in one pass."""
    return df.groupBy(split).agg(F.count("*").alias("rows"))


def max_version(df: DataFrame, version: str) -> DataFrame:
    """The highest version of a text column, compared as numbers."""
    return df.agg(F.max(F.col(version).cast("bigint")).alias("max_version"))
