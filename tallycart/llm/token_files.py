"""Token files: flat unsigned ids with 64-bit document offsets, to be memory-mapped.

A folder holds numbered parts in ascending ``doc_id`` order. ``part-N.bin`` has the ids
of its documents and nothing else, little-endian, two bytes each if the vocabulary fits,
else four. ``part-N.idx`` has the byte width of an id and the number n of documents, the
n document ids, then n + 1 global offsets, all 64-bit: document i of the part has ids
``offsets[i] - offsets[0]`` to ``offsets[i + 1] - offsets[0]`` of the part, and
``offsets[i]`` ids lie before it in the whole folder.

The texts are range-partitioned by id, encoded where they land, and written as a
stream. A part's length is known only then, so the offsets follow in a second small pass:
each part's base is the prefix sum of the lengths of the parts before it.

Defined results. A row without ``doc_id`` can't be named and is left out. A null or empty
text has the end id alone. Rows that repeat a ``doc_id`` are separate documents, ordered by
a hash of their text. An empty table writes no part. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W
from tallycart.llm.encoder import END, encoder
from tallycart.llm.files import array, written
from tallycart.session import stage

_PARTS = "part int, path string, width int, n_tokens long, doc_ids array<long>, lengths array<long>"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end: int = END) -> DataFrame:
    """Write all documents; gives one row for each part: part, path, n_docs, n_tokens, base."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:05d}"
        code = encoder(vocabulary)
        stop = np.array([end], code.kind).tobytes()
        ids, lengths = [], []
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        with written(f"{path}.bin") as stream:
            while batch is not None:
                for some in W.pieces([batch]):
                    ids += some.column(0).to_pylist()
                    for found in code.encode(some.column(1).to_pylist()):
                        stream.write(found.tobytes() + stop)
                        lengths.append(len(found) + 1)
                batch = next(batches, None)
        row = [[part], [path], [code.kind.itemsize], [sum(lengths)], [ids], [lengths]]
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [p.split()[0] for p in _PARTS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

    texts = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")
    parts = stage(
        texts.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .transform(map_batches, fill, _PARTS),
        "token-parts",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One short row for each file.
    bases = parts.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("base"))
    placed = parts.join(bases, "part")
    return stage(placed.transform(map_batches, _index, "part int, path string, n_docs long, n_tokens long, base long"), "token-index")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            offsets = row["base"] + np.cumsum([0, *row["lengths"]], dtype=np.int64)
            head = np.array([row["width"], len(row["doc_ids"])], "<i8")
            with written(f"{row['path']}.idx") as stream:
                stream.write(b"".join(x.astype("<i8").tobytes() for x in (head, np.array(row["doc_ids"]), offsets)))
            values = [row["part"], row["path"], len(row["doc_ids"]), row["n_tokens"], row["base"]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["part", "path", "n_docs", "n_tokens", "base"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


class TokenPart:
    """One part of a folder, mapped into memory."""

    def __init__(self, path: str):
        index = array(f"{path}.idx", "<i8")
        width, n = (int(x) for x in index[:2])
        self.doc_ids, self.offsets = index[2 : 2 + n], index[2 + n :]
        self.tokens = array(f"{path}.bin", f"<u{width}")

    def __len__(self) -> int:
        return len(self.doc_ids)

    def __getitem__(self, i: int) -> np.ndarray:
        base = self.offsets[0]
        return self.tokens[self.offsets[i] - base : self.offsets[i + 1] - base]


def read_documents(parts: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit numbers), read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                part = TokenPart(path)
                for start in range(0, len(part), 10_000):
                    some = range(start, min(start + 10_000, len(part)))
                    sums = [zlib.crc32(part[i].astype("<u4").tobytes()) for i in some]
                    columns = [
                        pa.array(part.doc_ids[some.start : some.stop]),
                        pa.array(part.offsets[some.start : some.stop]),
                        pa.array(np.diff(part.offsets[some.start : some.stop + 1])),
                        pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (
        parts.select("path")
        .repartition(F.col("path"))
        .transform(map_batches, run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
