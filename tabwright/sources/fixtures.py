"""Labelled tables built out of the test data's star schema and event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions import hash_bucket, logistic
from tabwright.spec import FeatureSpec

ORDERS_SPEC = FeatureSpec(
    numeric=(
        "o_totalprice",
        "c_acctbal",
        "n_lines",
        "sum_qty",
        "avg_discount",
        "avg_tax",
        "avg_size",
        "avg_retail",
    ),
    categorical=(
        "o_orderstatus",
        "o_orderpriority",
        "c_mktsegment",
        "n_name",
        "r_name",
        "ptype",
        "rflag",
        "lstat",
    ),
    label="label",
    keys=("o_orderkey",),
    ts="ts",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with 8 numeric and 8 categorical features and a learnable 0/1 label.

    Averages are rounded so that equal ones stay equal whatever the order of the sum. The lines of
    an order are few and meet before they are summed: with text among the sums Spark sorts its input,
    and sums made beforehand would only have to be sorted a second time.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    per_order = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.round(F.avg("l_discount"), 6).alias("avg_discount"),
            F.round(F.avg("l_tax"), 6).alias("avg_tax"),
            F.round(F.avg("p_size"), 6).alias("avg_size"),
            F.round(F.avg("p_retailprice"), 6).alias("avg_retail"),
            F.min("p_type").alias("ptype"),
            F.max("l_returnflag").alias("rflag"),
            F.min("l_linestatus").alias("lstat"),
        )
    )
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    )
    score = (
        F.coalesce("sum_qty", F.lit(0.0))
        + F.when(F.col("o_orderstatus") == "F", 40).otherwise(0)
        - F.col("o_totalprice") / 10000
        + hash_bucket(F.col("o_orderkey")) % 40
    )
    return joined.select(
        "o_orderkey",
        F.col("o_custkey").alias("entity_id"),
        F.col("o_orderdate").alias("ts"),
        *ORDERS_SPEC.features,
        F.when(score > 80, 1).otherwise(0).alias("label"),
    )


def purchase_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select("event_id", "user_id", "ts")
    )


def view_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "view")
        .select("user_id", "ts", F.col("value").alias("last_value"), F.col("props").alias("last_props"))
    )


def rule_scored(events: DataFrame) -> DataFrame:
    """Events with a label, a fixed logistic score and two rule predictions."""
    return events.select(
        "*",
        F.when(F.col("event_type") == "purchase", 0).otherwise(1).alias("label"),
        logistic((F.col("value") - 50) / 50).alias("p_one"),
        F.when(F.col("value") > 50, 1).otherwise(0).alias("prediction"),
        F.when(F.col("value") > 20, 1).otherwise(0).alias("rival_prediction"),
    )


def rule_scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_scored(table(spark, sf_dir, "events"))
