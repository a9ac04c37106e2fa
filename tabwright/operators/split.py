"""Row splits that do not depend on partitioning, and the union that undoes them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import hash_uniform


def split_label(
    weights: Sequence[float], seed: int, keys: Sequence[str], names: Sequence[str]
) -> Column:
    """The name of the split a row falls in, from a salted hash of its keys.

    The seed salts the hash: splits under different seeds are independent, and a part
    that is to be split again needs another seed. Rows with equal keys share a split.
    """
    if len(weights) != len(names) or not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be one non-negative number per split name")
    if not keys:
        raise ValueError("a hash split needs at least one key column")
    total, upto = float(sum(weights)), 0.0
    draw = hash_uniform(F.lit(str(seed)), *[F.col(k) for k in keys])
    label: Column | None = None
    for weight, name in zip(weights[:-1], names[:-1]):
        upto += weight
        inside = draw < F.lit(upto / total)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return F.lit(names[-1]) if label is None else label.otherwise(names[-1])


def with_split(
    df: DataFrame,
    weights: Sequence[float],
    seed: int,
    keys: Sequence[str],
    names: Sequence[str],
    column: str = "split",
) -> DataFrame:
    """``df`` with one more column naming each row's split; no shuffle."""
    return df.withColumn(column, split_label(weights, seed, keys, names))


def hash_split(
    df: DataFrame, weights: Sequence[float], seed: int, keys: Sequence[str]
) -> list[DataFrame]:
    """One frame per weight; together they hold every row of ``df`` once."""
    names = [str(i) for i in range(len(weights))]
    label = split_label(weights, seed, keys, names)
    return [df.filter(label == name) for name in names]


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own seeded split.

    It draws per partition: the same rows in other partitions are split otherwise.
    Prefer :func:`hash_split` where a split has to be the same again later.
    """
    return df.randomSplit([float(w) for w in weights], seed=seed)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept, columns matched by name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
