"""A table's profile as tables: overview, column figures, patterns, samples, alerts.

Everything is aggregated where the rows are; only figures per column come out.
Missing means null, or NaN in a floating-point column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import as_number, guarded_ratio, is_missing, seconds_of
from tabwright.operators.correlate import (
    auto_correlation,
    cramers_v,
    kendall,
    missing_correlation,
    pearson,
    phi_k,
    spearman,
)
from tabwright.operators.pairs import all_pairs, equal_width_bins, pair_name, pair_rows
from tabwright.operators.split import union_by_name
from tabwright.operators.values import NumberCounts, value_counts

QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


def column_kinds(df: DataFrame) -> dict[str, str]:
    """Each column's kind, from the schema alone."""
    kinds = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.BooleanType):
            kind = "boolean"
        elif isinstance(f.dataType, T.NumericType):
            kind = "numeric"
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kind = "datetime"
        elif isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType)):
            kind = "categorical"
        else:
            kind = "other"
        kinds[f.name] = kind
    return kinds


def _column_rows(df: DataFrame, rows: Sequence[Sequence[Column]]) -> DataFrame:
    """One aggregate over the table, laid out as one row per given tuple of columns."""
    return df.agg(F.array(*[F.struct(*r) for r in rows]).alias("_all")).select(F.inline("_all"))


def duplicate_groups(df: DataFrame, count_name: str = "copies") -> DataFrame:
    """Every group of equal rows that has more than one, with its size.

    One grouping by all columns: equal rows are added up before the shuffle, and every
    other row is shuffled once.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    counted = df.toDF(*names).groupBy(*names).agg(F.count("*").alias("n")).filter("n > 1")
    return counted.toDF(*df.columns, count_name)


def top_duplicates(df: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent groups of equal rows; ties by the row's columns."""
    found = duplicate_groups(df)
    names = [f"c{i}" for i in range(len(found.columns))]
    ordered = found.toDF(*names).orderBy(F.desc(names[-1]), *[F.col(c).asc_nulls_first() for c in names[:-1]])
    return ordered.limit(n).toDF(*found.columns)


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells, duplicate rows and columns per kind, in one row.

    A duplicate is a row equal to an earlier one: rows less distinct rows.
    """
    kinds = column_kinds(df)
    renamed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    surplus = duplicate_groups(renamed).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("d"))
    missing = sum((F.count_if(is_missing(df, c)) for c in df.columns), F.lit(0))
    counted = df.agg(F.count("*").alias("rows"), missing.alias("missing_cells"))
    width = len(df.columns)
    return (
        counted.withColumn("duplicate_rows", surplus.scalar())
        .select(
            "rows",
            F.lit(width).cast("bigint").alias("columns"),
            "missing_cells",
            guarded_ratio(F.col("missing_cells"), F.col("rows") * width).alias("missing_share"),
            "duplicate_rows",
            guarded_ratio(F.col("duplicate_rows"), F.col("rows")).alias("duplicate_share"),
            *[
                F.lit(sum(k == kind for k in kinds.values())).cast("bigint").alias(f"{kind}_columns")
                for kind in ("numeric", "categorical", "datetime", "boolean", "other")
            ],
        )
    )


def numeric_stats(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> DataFrame:
    """One row of figures per number column; skewness and kurtosis are of the population.

    Moments come from one pass. The distinct count, the median and the median absolute
    deviation (mad) come from the counts of distinct values and are exact.
    """
    entries = [
        F.struct(F.lit(c).alias("column"), as_number(F.col(c)).alias("x")) for c in columns
    ]
    moments = (
        df.select(F.inline(F.array(*entries)))
        .groupBy("column")
        .agg(
            F.count("x").alias("count"),
            F.count_if(F.col("x").isNull()).alias("missing"),
            F.count_if(F.col("x") == 0).alias("zeros"),
            F.count_if(F.col("x") < 0).alias("negatives"),
            F.avg("x").alias("mean"),
            F.stddev_samp("x").alias("std"),
            F.var_samp("x").alias("variance"),
            F.min("x").alias("min"),
            F.max("x").alias("max"),
            F.sum("x").alias("sum"),
            F.skewness("x").alias("skewness"),
            F.kurtosis("x").alias("kurtosis"),
        )
    )
    numbers = NumberCounts(df, {c: F.col(c) for c in columns}, slices)
    # One row per column comes to the driver.
    middles = numbers.quantiles({"median": 0.5}).collect()
    from_median = {
        r["column"]: F.abs(as_number(F.col(r["column"])) - F.lit(r["median"])) for r in middles
    }
    counted = df.sparkSession.createDataFrame(
        [(r["column"], r["distinct"]) for r in middles], "column string, distinct bigint"
    )
    joined = moments.join(F.broadcast(counted), "column", "left")
    if from_median:
        apart = NumberCounts(df, from_median, slices).quantiles({"mad": 0.5})
        joined = joined.join(apart.select("column", "mad"), "column", "left")
    else:
        joined = joined.withColumn("mad", F.lit(None).cast("double"))
    return joined.select(
        "column",
        "count",
        "missing",
        F.coalesce("distinct", F.lit(0)).alias("distinct"),
        "zeros",
        "negatives",
        "mean",
        "std",
        "variance",
        F.try_divide(F.col("std"), F.col("mean")).alias("cv"),
        "min",
        "max",
        (F.col("max") - F.col("min")).alias("range"),
        "sum",
        "mad",
        "skewness",
        "kurtosis",
    )


def numeric_quantiles(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> DataFrame:
    """5, 25, 50, 75 and 95 per cent quantiles and the interquartile range, exact."""
    found = NumberCounts(df, {c: F.col(c) for c in columns}, slices).quantiles(QUANTILES)
    return found.select("column", *QUANTILES, (F.col("q75") - F.col("q25")).alias("iqr"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """``column, bin, n`` of equal-width bins; empty bins have no row."""
    binned = equal_width_bins(df, columns, bins)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"b{i}").alias("bin")) for i, c in enumerate(columns)
    ]
    return (
        binned.select(F.inline(F.array(*entries)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count("*").alias("n"))
    )


def categorical_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct, mode (ties: smallest) and imbalance of each category column.

    Imbalance is 1 less the entropy's share of its maximum: 0 when all values are
    equally frequent, towards 1 when one value dominates, 0 for a single value.
    """
    counts = value_counts(df, {c: F.col(c) for c in columns})
    n = F.col("n").cast("double")
    found = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("distinct"),
        F.min(F.struct((-F.col("n")).alias("less"), "value")).alias("_mode"),
        F.sum(n * F.ln(n)).alias("_n_log_n"),
    )
    total = F.col("count").cast("double")
    entropy = F.ln(total) - F.col("_n_log_n") / total
    balance = F.try_divide(entropy, F.ln(F.col("distinct").cast("double")))
    return found.select(
        "column",
        "count",
        "distinct",
        F.col("_mode.value").alias("mode"),
        (-F.col("_mode.less")).alias("mode_count"),
        F.when(F.col("distinct") > 1, 1 - balance).otherwise(F.lit(0.0)).alias("imbalance"),
    )


def top_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each column with their share of present values."""
    counts = value_counts(df, {c: F.col(c) for c in columns})
    by_size = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    totals = counts.groupBy("column").agg(F.sum("n").alias("_total"))
    return (
        counts.withColumn("place", F.row_number().over(by_size))
        .filter(F.col("place") <= k)
        .join(totals, "column")
        .select(
            "column", "place", "value", "n", guarded_ratio(F.col("n"), F.col("_total")).alias("share")
        )
    )


def text_lengths(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> DataFrame:
    """Shortest, mean, median and longest length of each text column, in characters."""
    lengths = {c: F.length(F.col(c)) for c in columns}
    ends = _column_rows(
        df,
        [
            [
                F.lit(c).alias("column"),
                F.min(n).alias("min_length"),
                F.avg(n).alias("mean_length"),
                F.max(n).alias("max_length"),
            ]
            for c, n in lengths.items()
        ],
    )
    middle = NumberCounts(df, lengths, slices).quantiles({"median_length": 0.5})
    return ends.join(middle.select("column", "median_length"), "column", "left").select(
        "column", "min_length", "mean_length", "median_length", "max_length"
    )


def datetime_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, missing, earliest, latest and range in seconds of each time column."""
    rows = []
    for c in columns:
        seconds = seconds_of(c, df.schema[c].dataType)
        rows.append(
            [
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.count_if(F.col(c).isNull()).alias("missing"),
                F.min(c).cast("timestamp_ntz").alias("min"),
                F.max(c).cast("timestamp_ntz").alias("max"),
                (F.max(seconds) - F.min(seconds)).alias("range_seconds"),
            ]
        )
    return _column_rows(df, rows)


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values of each column and their share of all rows."""
    names = list(columns or df.columns)
    return _column_rows(
        df,
        [
            [
                F.lit(c).alias("column"),
                F.count_if(is_missing(df, c)).alias("missing"),
                guarded_ratio(F.count_if(is_missing(df, c)), F.count("*")).alias("share"),
            ]
            for c in names
        ],
    )


def interactions(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Row counts of the 2-D bins of every pair of number columns."""
    pairs = all_pairs(columns)
    binned = equal_width_bins(df, columns, bins)
    bin_of = {c: F.col(f"b{i}") for i, c in enumerate(columns)}
    return (
        pair_rows(binned, bin_of, pairs)
        .withColumnsRenamed({"x": "x_bin", "y": "y_bin"})
        .groupBy("pair", "x_bin", "y_bin")
        .agg(F.count("*").alias("n"))
        .select(
            pair_name(pairs, 0).alias("x_col"), pair_name(pairs, 1).alias("y_col"), "x_bin", "y_bin", "n"
        )
    )


def head_and_tail(df: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The first and the last ``n`` rows by key; a column ``part`` tells which."""
    first = df.orderBy(*[F.asc(k) for k in keys]).limit(n).withColumn("part", F.lit("head"))
    last = df.orderBy(*[F.desc(k) for k in keys]).limit(n).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


@dataclass(frozen=True)
class AlertThresholds:
    """From where on a figure is worth an alert; shares are of all rows."""

    missing_share: float = 0.05
    zero_share: float = 0.1
    skewness: float = 20.0
    high_cardinality: int = 50
    imbalance: float = 0.5
    correlation: float = 0.5


def alerts(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    thresholds: AlertThresholds = AlertThresholds(),
    correlations: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``column, alert, value`` for each figure past its threshold.

    ``correlations`` may hand in the result of ``auto_correlation`` when it exists.
    """
    t = thresholds
    missing = missing_counts(df, [*numeric, *categorical])
    pairs = correlations
    if pairs is None:
        pairs = auto_correlation(df, numeric, categorical, slices=slices)
    rows = F.col("count") + F.col("missing")

    def found(frame: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
        raised = [
            F.when(hit, F.struct(F.lit(name).alias("alert"), value.cast("double").alias("value")))
            for name, (hit, value) in checks.items()
        ]
        return frame.select("column", F.inline(F.filter(F.array(*raised), lambda a: a.isNotNull())))

    zero_share = guarded_ratio(F.col("zeros"), rows)
    distinct = F.col("distinct")
    unique = (distinct == F.col("count")) & (F.col("count") > 1)
    raised = [
        found(missing, {"missing": (F.col("share") > t.missing_share, F.col("share"))}),
        pairs.filter(F.abs("value") > t.correlation).select(
            F.concat_ws(" x ", "left_col", "right_col").alias("column"),
            F.lit("high_correlation").alias("alert"),
            "value",
        ),
    ]
    if numeric:
        raised.append(
            found(
                numeric_stats(df, numeric, slices),
                {
                    "constant": (distinct == 1, distinct),
                    "unique": (unique, distinct),
                    "zeros": (zero_share > t.zero_share, zero_share),
                    "skewed": (F.abs("skewness") > t.skewness, F.col("skewness")),
                },
            )
        )
    if categorical:
        raised.append(
            found(
                categorical_stats(df, categorical),
                {
                    "constant": (distinct == 1, distinct),
                    "unique": (unique, distinct),
                    "high_cardinality": (distinct > t.high_cardinality, distinct),
                    "imbalance": (F.col("imbalance") > t.imbalance, F.col("imbalance")),
                },
            )
        )
    return union_by_name(*raised)



def report(
    df: DataFrame,
    keys: Sequence[str],
    thresholds: AlertThresholds = AlertThresholds(),
    slices: int | None = None,
) -> dict[str, DataFrame]:
    """The whole profile of a table, one frame per section.

    Columns are treated by the kind their type gives them; ``keys`` order the sample
    and take no part in the correlations. The table is read many times: pass one that is
    stored.
    """
    kinds = column_kinds(df)
    of_kind = {k: [c for c in df.columns if kinds[c] == k] for k in set(kinds.values())}
    numeric, texts = of_kind.get("numeric", []), of_kind.get("categorical", [])
    measured = [c for c in numeric if c not in set(keys)]
    leveled = [c for c in texts if c not in set(keys)]
    times = of_kind.get("datetime", [])
    sections = {"overview": overview(df), "missing": missing_counts(df)}
    sections["missing_correlation"] = missing_correlation(df, df.columns)
    if numeric:
        sections["numbers"] = numeric_stats(df, numeric, slices)
        sections["quantiles"] = numeric_quantiles(df, numeric, slices)
        sections["histogram"] = histogram(df, numeric)
    if texts:
        sections["categories"] = categorical_stats(df, texts)
        sections["top_values"] = top_values(df, texts)
        sections["text_lengths"] = text_lengths(df, texts, slices)
    if times:
        sections["times"] = datetime_stats(df, times)
    sections["duplicates"] = top_duplicates(df)
    sections["sample"] = head_and_tail(df, keys)
    auto = auto_correlation(df, measured, leveled, slices=slices)
    sections["auto"] = auto
    sections["pearson"] = pearson(df, measured)
    sections["spearman"] = spearman(df, measured, slices)
    sections["kendall"] = kendall(df, measured, slices)
    sections["cramers"] = cramers_v(df, leveled, measured)
    sections["phi_k"] = phi_k(df, measured, leveled)
    if len(measured) > 1:
        sections["interactions"] = interactions(df, measured)
    sections["alerts"] = alerts(df, numeric, texts, thresholds, auto, slices)
    return sections
