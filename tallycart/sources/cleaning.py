"""From file columns to the cleaned log, profile and pair tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.functions import decode
from tallycart.sources.schemas import LOG_COLUMNS


def clean_log(raw: DataFrame, year: int = decode.LOG_YEAR, lenient: bool = False) -> DataFrame:
    """Rename, decode, fill and type the interaction log.

    ``raw`` must carry ``seq1`` and ``seq2``, the order of rows within a day.
    """
    renamed = raw.withColumnRenamed("seller_id", "merchant_id").fillna({"brand_id": 0})
    ids = [F.col(c).cast("long").alias(c) for c in ("user_id", "merchant_id", "item_id", "cat_id")]
    return renamed.select(
        *ids,
        F.col("brand_id").cast("long").alias("brand_id"),
        decode.parse_day(F.col("time_stamp"), year, lenient).alias("dt"),
        decode.action_name(F.col("action_type")).alias("action_type"),
        F.col("seq1").cast("long").alias("seq1"),
        F.col("seq2").cast("long").alias("seq2"),
    ).select(*LOG_COLUMNS)


def tag_origin(pairs: DataFrame, origin: str) -> DataFrame:
    return pairs.withColumn("origin", F.lit(origin))


def clean_pairs_to_score(raw: DataFrame) -> DataFrame:
    return tag_origin(raw.drop("prob"), "test")


def clean_labelled_pairs(raw: DataFrame) -> DataFrame:
    return tag_origin(raw, "train")


def retype(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast columns by name; under ANSI mode a value that does not fit raises."""
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})
