"""Arrow batches of bounded size for the steps that see whole texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BYTES = 8 << 20


def map_batches(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: StructType | str,
) -> DataFrame:
    """``df.mapInArrow``, with batches of at most some 8 MB of text.

    By number of rows alone, a batch of long texts takes several times its size twice over,
    in the executor and in its Python worker. The session's limit is only ever lowered.
    """
    conf = df.sparkSession.conf
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", conf.get(SETTING).lower()).groups()
    if not 0 < int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit] <= BYTES:
        conf.set(SETTING, str(BYTES))
    return df.mapInArrow(run, schema)
