"""From columns to a feature vector: category index, one-hot, missing numbers, assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.impute import MedianImputer
from tabwright.functions import as_number
from tabwright.spec import FeatureSpec

def category_indexer(columns: Sequence[str], ending: str = "") -> StringIndexer:
    """Most frequent value first, ties by value; null and unseen values share the last index.

    ``ending`` is that of the input columns, if they are prepared ones."""
    return StringIndexer(
        inputCols=[f"{c}{ending}" for c in columns],
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns],
        outputCols=[f"{c}_ohe" for c in columns],
        handleInvalid="keep",
        dropLast=True,
    )


def categories_as_text(columns: Sequence[str]) -> SQLTransformer:
    """Adds ``{c}_txt``, the column as text: the index takes no booleans otherwise."""
    added = ", ".join(f"CAST(`{c}` AS STRING) AS `{c}_txt`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def numbers_and_flags(columns: Sequence[str]) -> SQLTransformer:
    """Adds ``{c}_num``, the column as double, and ``{c}_missing``, 1.0 where it is missing."""
    added = []
    for c in columns:
        number = f"CAST(`{c}` AS DOUBLE)"
        added.append(f"{number} AS `{c}_num`")
        added.append(f"CAST({number} IS NULL OR isnan({number}) AS DOUBLE) AS `{c}_missing`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(added)} FROM __THIS__")


def number_imputer(columns: Sequence[str], strategy: str = "mean") -> Imputer | MedianImputer:
    """``{c}_imp``: mean, most frequent value, or exact median where the number is missing."""
    if strategy == "median":
        return MedianImputer(inputCols=[f"{c}_num" for c in columns], outputCols=[f"{c}_imp" for c in columns])
    return Imputer(
        inputCols=[f"{c}_num" for c in columns],
        outputCols=[f"{c}_imp" for c in columns],
        strategy=strategy,
    )


def zeros(columns: Sequence[str]) -> SQLTransformer:
    """Adds ``{c}_imp`` as 0.0: for columns that have no value to impute from."""
    added = ", ".join(f"CAST(0 AS DOUBLE) AS `{c}_imp`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def preprocessing_stages(
    spec: FeatureSpec,
    impute: str | None = "mean",
    missing_flags: bool = True,
    empty: Sequence[str] = (),
) -> list:
    """Unfitted stages for a ``Pipeline``, ending in a ``features`` vector.

    The vector has the numbers, then the one-hot slots, then the missing flags. With
    ``impute=None`` missing numbers stay NaN in the vector, for learners that take it.
    ``empty`` names number columns without any value; they become 0.
    """
    stages: list = []
    if spec.categorical:
        stages += [
            categories_as_text(spec.categorical),
            category_indexer(spec.categorical, "_txt"),
            one_hot_encoder(spec.categorical),
        ]
    numbers, flags = list(spec.numeric), []
    if impute and spec.numeric:
        stages.append(numbers_and_flags(spec.numeric))
        filled = [c for c in spec.numeric if c not in set(empty)]
        stages += [number_imputer(filled, impute)] if filled else []
        stages += [zeros(empty)] if empty else []
        numbers = [f"{c}_imp" for c in spec.numeric]
        flags = [f"{c}_missing" for c in spec.numeric] if missing_flags else []
    assembler = VectorAssembler(
        inputCols=[*numbers, *[f"{c}_ohe" for c in spec.categorical], *flags],
        outputCol="features",
        handleInvalid="keep",
    )
    return [*stages, assembler]


def helper_columns(spec: FeatureSpec) -> list[str]:
    """Columns that preprocessing adds on the way and that a scored table need not keep."""
    numbers = [f"{c}{end}" for c in spec.numeric for end in ("_num", "_missing", "_imp")]
    return [*numbers, *[f"{c}_txt" for c in spec.categorical]]


def never_present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Number columns without a single value."""
    if not columns:
        return []
    present = df.agg(
        *[F.count(F.nanvl(as_number(F.col(f"`{c}`")), F.lit(None))).alias(f"c{i}") for i, c in enumerate(columns)]
    ).first()
    return [c for i, c in enumerate(columns) if not present[i]]


def check_levels(df: DataFrame, spec: FeatureSpec, max_levels: int | None = None) -> None:
    """With ``max_levels``, refuses category columns of more distinct values (an exact count):
    an index of all levels lives in the fitted model."""
    if not spec.categorical or max_levels is None:
        return
    counts = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in spec.categorical]).first()
    wide = {c: counts[c] for c in spec.categorical if counts[c] > max_levels}
    if wide:
        raise ValueError(f"more than {max_levels} levels in category columns: {wide}")


def index_counts(indexed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, idx, n``: how often each value occurs and the index it got."""
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.col(f"{c}_idx").alias("idx")
        )
        for c in columns
    ]
    return (
        indexed.select(F.inline(F.array(*entries)))
        .groupBy("column", "value", "idx")
        .agg(F.count("*").alias("n"))
    )


def one_hot_slots(encoded: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One-hot vectors in long form: per row and column the slot that is set."""
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            (F.array_position(vector_to_array(F.col(f"{c}_ohe")), F.lit(1.0)) - 1).alias("slot"),
        )
        for c in columns
    ]
    return encoded.select(*keys, F.inline(F.array(*entries)))


def vector_elements(df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
    """The elements of a vector column that are not zero, one row each."""
    return (
        df.select(*keys, F.posexplode(vector_to_array(F.col(vector))).alias("slot", "value"))
        .filter((F.col("value") != 0) | F.isnan("value"))
    )
