"""Projections: which columns go on to the next step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.spec import FeatureSpec


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def exclude_columns(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """All columns but the excluded ones, order kept; every excluded name must exist."""
    unknown = set(excluded) - set(df.columns)
    if unknown:
        raise ValueError(f"cannot exclude unknown columns: {sorted(unknown)}")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in set(excluded)])


def feature_projection(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Numeric then categorical columns of the spec, in its order."""
    return df.select(*spec.features)


def inputs_and_prediction(
    scored: DataFrame, inputs: Sequence[str], prediction: str = "prediction"
) -> DataFrame:
    return scored.select(*inputs, prediction)


def label_and_prediction(
    scored: DataFrame, label: str, prediction: str = "prediction"
) -> DataFrame:
    return scored.select(label, prediction)


def where_equal(df: DataFrame, **values: object) -> DataFrame:
    """Rows where every named column equals its value; a null never does."""
    condition = F.lit(True)
    for name, value in values.items():
        condition = condition & (F.col(name) == F.lit(value))
    return df.filter(condition)
