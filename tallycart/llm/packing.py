"""Packing: documents cut into pieces and laid into sequences of fixed length.

Documents are dealt into groups by a hash of id and text. A document's full-length
pieces are sequences of their own; the rest of each document is packed, within its
group, by first-fit decreasing: longest first, each into the first bin with room. A
tournament tree over the bins' free room finds that bin in logarithmic time. A group
holds at most one rest a document, shorter than a sequence, so its size is bounded
however long the documents are.

Defined results. A row without ``doc_id`` can't be named and is left out. A null or empty
text is its end id alone. Rows that repeat a ``doc_id`` are separate documents. Equal
lengths are packed in the order of id and hash of text. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W
from tallycart.llm.encoder import END, encoder

LENGTH = 1024
GROUP = 4096  # documents of a group, on average


class FirstFit:
    """Bins of equal room. The tree's nodes hold the most free room below them."""

    def __init__(self, most: int, room: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.free = [room] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Lay ``size`` into the first bin with room for it; its number and the room there before."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        room = free[node]
        free[node] = room - size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
        return bin_, room


def pack(sizes: list[int], room: int) -> list[tuple[int, int]]:
    """First-fit decreasing: bin and offset within it of each size, in the order given."""
    bins = FirstFit(len(sizes), room)
    found = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        number, left = bins.put(sizes[i])
        found[i] = number, room - left
    return found


def padded_length(used: int, length: int = LENGTH) -> int:
    """A sequence's length after padding: one that has a power of two stays as it is."""
    return used if used & (used - 1) == 0 else length


_PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def pack_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces: doc_id, start, length, ids (32-bit little-endian), doc_tokens, sequence_id, offset."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    groups = max(1, -(-texts.count() // GROUP))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        stop = np.array([end], code.kind)
        group, full, rests = None, 0, []
        for batch in W.pieces(batches):
            rows = []
            numbers, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for number, doc, found in zip(numbers, ids, code.encode(batch.column(2).to_pylist())):
                if number != group:
                    rows += close(group, full, rests)
                    group, full, rests = number, 0, []
                tokens = np.concatenate([found, stop]).astype("<u4")
                cut = len(tokens) - len(tokens) % length
                for start in range(0, cut, length):
                    piece = tokens[start : start + length].tobytes()
                    rows.append((doc, start, length, piece, len(tokens), (group << 32) + full, 0))
                    full += 1
                if cut < len(tokens):
                    rests.append((doc, cut, tokens[cut:].tobytes(), len(tokens)))
            yield batch_of(rows)
        yield batch_of(close(group, full, rests))

    def close(group: int | None, full: int, rests: list[tuple]) -> list[tuple]:
        """The rests of a group, in bins numbered after its full pieces."""
        places = pack([len(r[2]) // 4 for r in rests], length)
        return [
            (doc, start, len(piece) // 4, piece, total, (group << 32) + full + number, offset)
            for (doc, start, piece, total), (number, offset) in zip(rests, places)
        ]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.binary() if i == 3 else pa.int64() for i in range(7)]
        names = [p.split()[0] for p in _PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    dealt = F.pmod(F.xxhash64("doc_id", "text", F.lit(groups)), F.lit(groups)).alias("group")
    return (
        texts.select(dealt, "doc_id", "text")
        .repartition("group")
        .sortWithinPartitions("group", "doc_id", F.xxhash64("text"))
        .transform(map_batches, run, _PIECES)
    )
