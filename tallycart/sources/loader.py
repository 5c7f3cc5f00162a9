"""File readers and the prediction writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycart.functions.decode import LOG_YEAR
from tallycart.sources import cleaning, schemas


class DataLoader:
    """The input files below one folder, as lazily read DataFrames."""

    def __init__(self, spark: SparkSession, data_path: str, year: int = LOG_YEAR):
        self.spark = spark
        self.data_path = data_path.rstrip("/")
        self.year = year

    def _csv(self, name: str, schema: T.StructType | None) -> DataFrame:
        reader = self.spark.read.option("header", True)
        # Without a schema every column is text: no extra pass to infer types.
        reader = reader.schema(schema) if schema is not None else reader
        return reader.csv(f"{self.data_path}/{schemas.FILES[name]}")

    def raw_log(self) -> DataFrame:
        """File rows plus their order in the file."""
        return self._csv("log", schemas.LOG_FILE).withColumns(
            {"seq1": F.monotonically_increasing_id(), "seq2": F.lit(0).cast("long")}
        )

    def log(self, lenient: bool = False) -> DataFrame:
        return cleaning.clean_log(self.raw_log(), self.year, lenient)

    def users(self) -> DataFrame:
        return self._csv("users", schemas.USER_FILE)

    def labelled_pairs(self) -> DataFrame:
        return cleaning.clean_labelled_pairs(self._csv("train", schemas.TRAIN_FILE))

    def pairs_to_score(self) -> DataFrame:
        return cleaning.clean_pairs_to_score(self._csv("test", schemas.TEST_FILE))

    def prejoined(self, part: str, schema: T.StructType | None = None) -> DataFrame:
        """The pre-joined files; ``part`` is ``train`` or ``test``."""
        return self._csv(f"{part}_prejoined", schema)

    def ingest_log(self, path: str, lenient: bool = False) -> DataFrame:
        """Convert the log to parquet once; later scans prune columns and push filters.

        The row order becomes a stored column here, so it cannot change between
        the scans of different features.
        """
        self.log(lenient).write.parquet(path)
        return self.spark.read.parquet(path)


def save_predictions(scores: DataFrame, pairs: DataFrame, path: str) -> None:
    """Write (user_id, merchant_id, prob) as CSV, matched to the pairs by key."""
    keys = ["user_id", "merchant_id"]
    (
        pairs.select(*keys)
        .join(scores.select(*keys, "prob"), keys, "left")
        .write.option("header", True)
        .csv(path)
    )
