"""The driver's parquet tables seen as an interaction log, profiles and pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.sources.schemas import LOG_COLUMNS

LABEL_CUT = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One action per order line: customer = user, supplier = merchant, part = item."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    brand = F.when(
        F.col("p_brand") != "Brand#1", F.substring("p_brand", 7, 10).cast("long")
    )
    action = (
        F.when(F.col("l_returnflag") == "N", "click")
        .when(F.col("l_returnflag") == "R", "purchase")
        .when(F.col("l_linestatus") == "F", "add-to-cart")
        .otherwise("add-to-favorite")
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_suppkey").alias("merchant_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("p_size").cast("long").alias("cat_id"),
            F.coalesce(brand, F.lit(0).cast("long")).alias("brand_id"),
            F.col("l_shipdate").cast("date").alias("dt"),
            action.alias("action_type"),
            F.col("l_orderkey").alias("seq1"),
            F.col("l_linenumber").cast("long").alias("seq2"),
        )
        .select(*LOG_COLUMNS)
    )


def users_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_nationkey") % 10).cast("int").alias("age_range"),
        F.when(segment == "AUTOMOBILE", 0)
        .when(segment == "BUILDING", 1)
        .when(segment == "FURNITURE", 2)
        .cast("int")
        .alias("gender"),
    )


def pairs_view(log: DataFrame, cut: str = LABEL_CUT) -> DataFrame:
    """Pairs with a purchase before the cut; label = bought again from the cut on.

    Even users are the labelled half, odd users the half to score.
    """
    late = F.col("dt") >= F.lit(cut).cast("date")
    early = F.col("dt") < F.lit(cut).cast("date")
    train = F.col("user_id") % 2 == 0
    return (
        log.filter(F.col("action_type") == "purchase")
        .groupBy("user_id", "merchant_id")
        .agg(F.count_if(late).alias("_late"), F.count_if(early).alias("_early"))
        .filter(F.col("_early") > 0)
        .select(
            "user_id",
            "merchant_id",
            F.when(train, "train").otherwise("test").alias("origin"),
            F.when(train, (F.col("_late") > 0).cast("double")).alias("label"),
        )
    )
