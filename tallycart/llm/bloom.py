"""A Bloom filter of fixed size, to let through only rows that a join can need.

Its bits are gathered by Spark (bitmaps of 32,768 bits, combined before the shuffle), so
at most ``2**LOG_BITS / 8`` bytes reach the driver and are broadcast, however many keys
there are. It never turns a key away: with more keys than it has room for, it only lets
more rows through, and the join behind it drops them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W

LOG_BITS = 26
SHIFTS = (0, 19, 38)  # each place is LOG_BITS bits of the key from here on


class Bloom:
    def __init__(self, keys: DataFrame, column: str):
        """``column`` holds the keys: longs that are hashes already. Nulls are left out."""
        mask = (1 << LOG_BITS) - 1
        places = [F.shiftrightunsigned(column, s).bitwiseAND(F.lit(mask)) for s in SHIFTS]
        bits = (
            keys.filter(F.col(column).isNotNull())
            .select(F.explode(F.array(*places)).alias("place"))
            # Spark counts a bitmap's bits from one.
            .groupBy(F.bitmap_bucket_number(F.col("place") + 1).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits"))
        )
        data = np.zeros((1 << LOG_BITS) // 8, np.uint8)
        for row in bits.collect():  # 2**LOG_BITS / 32768 rows at most
            part = np.frombuffer(bytes(row.bits), np.uint8)
            data[(row.bucket - 1) * 4096 :][: len(part)] = part
        self.shared = keys.sparkSession.sparkContext.broadcast(data)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys (unsigned) may be among those gathered."""
        data, found = self.shared.value, np.ones(len(keys), bool)
        for shift in SHIFTS:
            place = (keys >> np.uint64(shift)) & np.uint64((1 << LOG_BITS) - 1)
            found &= (data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return found


Batches = Iterator[pa.RecordBatch]


def only_maybe(
    df: DataFrame,
    column: str,
    keys: Bloom,
    wanted: bool = True,
    then: Callable[[Batches], Batches] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """The rows of ``df`` whose key may be among ``keys`` (or those whose key is surely not).

    ``then`` is applied to them in the same worker; ``schema`` is what it gives.
    """
    at = df.columns.index(column)

    def chosen(batches: Batches) -> Batches:
        for batch in W.pieces(batches):
            own = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            rows = batch.filter(pa.array(keys.has(own) == wanted))
            if rows.num_rows:
                yield rows

    run = chosen if then is None else lambda batches: then(chosen(batches))
    return map_batches(df, run, schema or df.schema)


def without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone``, a stored table with the column
    key (longs that are hashes already). Only rows that may be among them are shuffled."""
    mark = "_key"
    while mark in docs.columns:
        mark += "_"
    marked, keys = docs.withColumn(mark, key), Bloom(gone, "key")
    stays = only_maybe(marked, mark, keys, wanted=False)
    named = gone.select(F.col("key").alias(f"{mark}_gone")).distinct()
    rest = only_maybe(marked, mark, keys).join(named, F.col(mark) == F.col(f"{mark}_gone"), "left_anti")
    return stays.unionByName(rest).drop(mark)
