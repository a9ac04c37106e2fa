"""Feature lookups: the feature row each fact row could have known at its time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions import seconds_of
from tabwright.operators.slices import ROWS_PER_SLICE, add_slices, cut_points, slice_count
from tabwright.sources.tables import stage
from tabwright.spec import FeatureLookup

_TIED = "feature rows share key and time; name a tie_break column"


def _present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _moments(facts: DataFrame, lookup: FeatureLookup) -> DataFrame:
    """One narrow row per (key, time) of either table: ``_fact`` where a fact asks,
    ``_rows`` for how many feature rows answer, ``_tie`` for the winning tie value."""
    at = [*lookup.keys, lookup.timestamp_lookup_key]
    points = facts.select(*at).filter(_present(at)).withColumn("_fact", F.lit(True))
    if not lookup.tie_break:
        marks = lookup.features.select(*at).filter(_present(at)).withColumn("_fact", F.lit(False))
        return (
            points.unionByName(marks)
            .groupBy(*at)
            .agg(F.bool_or("_fact").alias("_fact"), F.count_if(~F.col("_fact")).alias("_rows"))
        )
    marks = (
        lookup.features.select(*at, F.struct(F.col(lookup.tie_break).alias("v")).alias("_tie"))
        .filter(_present(at))
        .groupBy(*at, "_tie")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_fact", F.lit(False))
    )
    return (
        points.unionByName(marks, allowMissingColumns=True)
        .groupBy(*at)
        .agg(
            F.bool_or("_fact").alias("_fact"),
            F.max("_tie").alias("_tie"),
            F.coalesce(F.max_by("_rows", "_tie"), F.lit(0)).alias("_rows"),
        )
    )


def _hot_keys(moments: DataFrame, keys: Sequence[str], rows_per_slice: int) -> DataFrame:
    """Keys with more moments than one slice takes: at most moments / rows_per_slice rows."""
    return (
        moments.groupBy(*keys)
        .agg(F.count("*").alias("_moments"))
        .filter(F.col("_moments") > rows_per_slice)
    )


def _resolve(moments: DataFrame, lookup: FeatureLookup, rows_per_slice: int | None) -> DataFrame:
    """For each fact moment the time (and tie rank) of the feature row that applies.

    ``rows_per_slice`` is what a key may have before its time is cut; None: no limit.
    """
    keys, ts = lookup.keys, lookup.timestamp_lookup_key
    found = F.when(F.col("_rows") > 1, F.raise_error(F.lit(_TIED)).cast("boolean")).otherwise(
        F.col("_rows") == 1
    )
    tie = ["_tie"] if lookup.tie_break else []
    moments = moments.select(
        *keys, ts, "_fact", F.when(found, F.struct(F.col(ts).alias("ts"), *tie)).alias("_match")
    )
    hot_count, hot_moments = 0, 0
    if rows_per_slice is not None:
        hot = _hot_keys(moments, keys, rows_per_slice)
        sizes = hot.agg(F.count("*"), F.coalesce(F.sum("_moments"), F.lit(0))).first()
        hot_count, hot_moments = sizes[0], sizes[1]

    if hot_count == 0:
        so_far = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
        resolved = moments.withColumn("_match", F.last("_match", ignorenulls=True).over(so_far))
    else:
        # The steps ahead read the narrow moments several times.
        moments = stage(moments, "lookup-moments")
        hot = _hot_keys(moments, keys, rows_per_slice)
        resolved = _resolve_hot(moments, lookup, hot, slice_count(hot_moments, rows_per_slice))
    return resolved.filter("_fact").select(
        *keys,
        ts,
        F.col("_match.ts").alias("_feature_ts"),
        *[F.col("_match._tie").alias("_feature_tie") for _ in tie],
    )


def _resolve_hot(
    moments: DataFrame, lookup: FeatureLookup, hot: DataFrame, slices: int
) -> DataFrame:
    """As above where some keys are too big for one task: their time is cut in slices,
    and the last match of the slices before is carried into each slice."""
    keys, ts = lookup.keys, lookup.timestamp_lookup_key
    when = seconds_of(ts, moments.schema[ts].dataType)
    # The hot keys are few by construction, so sending them to every task is safe.
    flagged = (
        moments.join(F.broadcast(hot), keys, "left")
        .withColumn("_hot", F.col("_moments").isNotNull())
        .withColumn("_when", when)
        .drop("_moments")
    )
    cuts = cut_points(flagged.filter("_hot"), {"_when": F.col("_when")}, slices)
    sliced = add_slices(flagged, cuts, "_slice").withColumn(
        "slice", F.when(F.col("_hot"), F.col("_slice_when")).otherwise(F.lit(0))
    )
    so_far = Window.partitionBy(*keys, "slice").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    earlier = (
        Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        sliced.groupBy(*keys, "slice")
        .agg(F.max("_match").alias("_last"), F.bool_or("_hot").alias("_was_hot"))
        .filter("_was_hot")
        .select(*keys, "slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    )
    inside = sliced.withColumn("_match", F.last("_match", ignorenulls=True).over(so_far))
    # `carried` holds at most slices rows per hot key.
    return inside.join(carried, [*keys, "slice"], "left").withColumn(
        "_match", F.coalesce("_match", "_carry")
    )


def point_in_time_lookup(
    facts: DataFrame,
    lookup: FeatureLookup,
    matched_ts: str | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Every fact row once, with the latest feature row of its key not after its time.

    No such row, or a null key or time, gives null features. The whole feature row is
    taken, nulls included. ``matched_ts`` adds the time of the feature row.

    Which row applies is settled on (key, time) alone, each pair once; the feature
    columns move only in the last join, where they meet the facts that use them. Both
    joins keep the facts on the left, so a hot key can be split by adaptive execution;
    keys with more than ``rows_per_slice`` moments are cut in time before that. None
    leaves out the search for such keys, for tables known to have none.
    """
    keys, ts, tie = lookup.keys, lookup.timestamp_lookup_key, lookup.tie_break
    added = _added_names(facts, lookup)
    resolved = _resolve(_moments(facts, lookup), lookup, _hot_bound(facts, lookup, rows_per_slice))
    with_time = facts.join(resolved, [*keys, ts], "left")
    right = lookup.features.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col(ts).alias("_at"),
        *([F.struct(F.col(tie).alias("v")).alias("_tie")] if tie else []),
        *[F.col(c).alias(f"_value{i}") for i, c in enumerate(lookup.feature_names)],
    )
    on = [F.col(k) == F.col(f"_key{i}") for i, k in enumerate(keys)]
    on.append(F.col("_feature_ts") == F.col("_at"))
    if tie:
        on.append(F.col("_feature_tie").eqNullSafe(F.col("_tie")))
    return with_time.join(right, on, "left").select(
        *facts.columns,
        *[F.col(f"_value{i}").alias(name) for i, name in enumerate(added)],
        *([F.col("_feature_ts").alias(matched_ts)] if matched_ts else []),
    )


def _hot_bound(facts: DataFrame, lookup: FeatureLookup, rows_per_slice: int | None) -> int | None:
    """The bound, or None where the tables together are too small to exceed it."""
    if rows_per_slice is None:
        return None
    rows = facts.count()
    if rows <= rows_per_slice:
        rows += lookup.features.count()
    return rows_per_slice if rows > rows_per_slice else None


def _added_names(facts: DataFrame, lookup: FeatureLookup) -> list[str]:
    added = [lookup.rename.get(c, c) for c in lookup.feature_names]
    clash = set(added) & set(facts.columns)
    if clash or len(set(added)) < len(added):
        raise ValueError(f"looked-up columns would not be unique, rename them: {sorted(clash)}")
    return added


def exact_lookup(facts: DataFrame, lookup: FeatureLookup, check_unique: bool = True) -> DataFrame:
    """Every fact row once, with the feature row of the same key.

    ``check_unique`` looks for a repeated key first, on the key columns alone; turn it
    off for tables already known to be keyed.
    """
    keys, added = lookup.keys, _added_names(facts, lookup)
    narrow = lookup.features.filter(_present(keys)).groupBy(*keys).agg(F.count("*").alias("_copies"))
    if check_unique and not narrow.filter("_copies > 1").isEmpty():
        raise ValueError(f"feature rows share the lookup key {keys}")
    named = [F.col(c).alias(name) for c, name in zip(lookup.feature_names, added)]
    return facts.join(lookup.features.select(*keys, *named), keys, "left").select(
        *facts.columns, *added
    )


def training_set(facts: DataFrame, lookups: Sequence[FeatureLookup], label: str) -> DataFrame:
    """Fact columns, then the features of each lookup in order; one row per fact row."""
    if label not in facts.columns:
        raise ValueError(f"the label {label!r} is not a fact column")
    for lookup in lookups:
        join = point_in_time_lookup if lookup.timestamp_lookup_key else exact_lookup
        facts = join(facts, lookup)
    return facts


def join_late_labels(
    predictions: DataFrame, labels: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Stored predictions whose label has arrived, with the label columns."""
    return predictions.join(labels, list(keys), "inner")
