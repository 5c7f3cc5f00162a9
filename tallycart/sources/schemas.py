"""Input schemas. Ids are long: Spark has no unsigned types and a narrow cast wraps."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


LONG, INT, DOUBLE, TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

# Column names and order of the input files.
LOG_FILE = _fields(
    ("user_id", LONG),
    ("item_id", LONG),
    ("cat_id", LONG),
    ("seller_id", LONG),
    ("brand_id", LONG),
    ("time_stamp", TEXT),
    ("action_type", INT),
)
USER_FILE = _fields(("user_id", LONG), ("age_range", INT), ("gender", INT))
TRAIN_FILE = _fields(("user_id", LONG), ("merchant_id", LONG), ("label", DOUBLE))
TEST_FILE = _fields(("user_id", LONG), ("merchant_id", LONG), ("prob", DOUBLE))

# File layout below the data folder.
FILES = {
    "log": "data_format1/user_log_format1.csv",
    "users": "data_format1/user_info_format1.csv",
    "train": "data_format1/train_format1.csv",
    "test": "data_format1/test_format1.csv",
    "train_prejoined": "data_format2/train_format2.csv",
    "test_prejoined": "data_format2/test_format2.csv",
}

# The cleaned log every operator works on. Rows of one day are ordered by
# (seq1, seq2, item_id, merchant_id); the source has to provide that order.
LOG_COLUMNS = (
    "user_id",
    "merchant_id",
    "item_id",
    "cat_id",
    "brand_id",
    "dt",
    "action_type",
    "seq1",
    "seq2",
)
