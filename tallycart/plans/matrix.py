"""The pair matrix: union of both halves, profile, decoded and typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.functions.decode import age_name, gender_name
from tallycart.sources.cleaning import retype

# Types of the matrix columns.
MATRIX_TYPES = {
    "user_id": "long",
    "merchant_id": "long",
    "label": "double",
    "origin": "string",
    "age_range": "string",
    "gender": "string",
}


def union_pairs(labelled: DataFrame, to_score: DataFrame) -> DataFrame:
    """Both halves in one table; the half without a label gets a null one."""
    return labelled.unionByName(to_score, allowMissingColumns=True)


def add_profile(pairs: DataFrame, users: DataFrame) -> DataFrame:
    return pairs.join(users.select("user_id", "age_range", "gender"), "user_id", "left")


def decode_profile(matrix: DataFrame) -> DataFrame:
    """Names for the profile codes; the codes stay as ``age_code``, ``gender_code``."""
    return matrix.withColumns(
        {
            "age_code": F.col("age_range").cast("int"),
            "gender_code": F.col("gender").cast("int"),
            "age_range": age_name(F.col("age_range")),
            "gender": gender_name(F.col("gender")),
        }
    )


def init_matrix(pairs: DataFrame, users: DataFrame, keep_codes: bool = False) -> DataFrame:
    matrix = retype(decode_profile(add_profile(pairs, users)), MATRIX_TYPES)
    return matrix if keep_codes else matrix.drop("age_code", "gender_code")
