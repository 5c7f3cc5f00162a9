"""Benchmark decontamination by greedy string tiling.

Words are compared lower-cased (ASCII) and without ASCII punctuation. A tile is a run of
at least ``MIN_TILE`` words that a benchmark item and a document have in common, no word
of either being in two tiles; tiles are marked longest first, so passages whose parts
were reordered are covered all the same. A document is contaminated by an item if tiles
cover at least ``COVERAGE`` percent of the item's words (an item of fewer than
``MIN_TILE`` words has to be there whole, as one tile).

* Seeds: hashes of all ``MIN_TILE``-word runs of the benchmark, and of its short items.
  Documents are read once; a Bloom filter of fixed size lets the seeds through that may
  be shared, and only documents that have one go on.
* The seeds of those documents are joined with the benchmark's. A document and an item
  with a common seed are a candidate; the rest can't have a tile.
* Each candidate document meets its items, and running Karp-Rabin matching tiles them:
  the runs of a search length are looked up by hash, grown while words agree and marked
  from the longest down; then the length is halved until ``MIN_TILE``.

Defined results. A row without ``doc_id`` can't be named and is left out; so is an item
without ``item_id``. Null or empty texts share nothing. Rows that repeat an id are separate
documents (kept apart by a hash of the text), or separate items with one number. Ties
between items go to the smallest ``item_id``, between tiles to the earliest. An empty
benchmark contaminates nothing. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W
from tallycart.llm.bloom import Bloom, without
from tallycart.session import stage

MIN_TILE = 5
COVERAGE = 50  # percent of an item's words
FIRST_SEARCH = 20
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(None, PUNCTUATION).split()


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (place in item, in text, length).

    Every common run of at least ``least`` words that is left unmarked gives a tile; of
    overlapping ones the longer wins, then the one earlier in the item, then in the text.
    """
    least = min(least, len(item))
    if not least:
        return []
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    found: list[tuple[int, int, int]] = []
    search = max(least, min(FIRST_SEARCH, len(item)))
    while True:
        runs = _common_runs(item, text, free_item, free_text, search)
        longest = max((n for _, _, n in runs), default=0)
        if longest > 2 * search:
            search = longest
            continue
        for i, t, n in sorted(runs, key=lambda r: (-r[2], r[0], r[1])):
            if not (free_item[i : i + n].all() and free_text[t : t + n].all()):
                break  # it overlaps a longer tile; a part of it may still be long enough
            free_item[i : i + n] = free_text[t : t + n] = False
            found.append((i, t, n))
        else:
            if search == least:
                return found
            search = max(least, search // 2)


def _common_runs(
    item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, length: int
) -> list[tuple[int, int, int]]:
    """Maximal common runs of free words that have at least ``length``."""

    def open_windows(values: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[length:] == taken[:-length]) if len(values) >= length else np.empty(0, int)
        return at, W.rolling(values, length)[at]

    at_item, item_hash = open_windows(item, free_item)
    at_text, text_hash = open_windows(text, free_text)
    shared = np.isin(text_hash, item_hash)
    at_text, text_hash = at_text[shared], text_hash[shared]
    order = np.argsort(item_hash, kind="stable")
    ordered = item_hash[order]
    lo = np.searchsorted(ordered, text_hash, "left")
    hi = np.searchsorted(ordered, text_hash, "right")
    runs: dict[tuple[int, int], int] = {}
    grown: dict[int, list[tuple[int, int]]] = {}
    for t, first, last in zip(at_text.tolist(), lo.tolist(), hi.tolist()):
        for i in at_item[order[first:last]].tolist():
            # A run already grown over this diagonal place needs no second look.
            spans = grown.setdefault(t - i, [])
            if spans and spans[-1][0] <= t < spans[-1][1]:
                continue
            if not np.array_equal(item[i : i + length], text[t : t + length]):
                continue
            n = length
            most = min(len(item) - i, len(text) - t)
            while n < most and free_item[i + n] and free_text[t + n] and item[i + n] == text[t + n]:
                n += 1
            runs[i, t] = n
            spans.append((t, t + n - length + 1))
    return [(i, t, n) for (i, t), n in runs.items()]


def _item_seeds(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            sizes, found = [], []
            for text in W.utf8(batch.column(1)):
                hashes = W.HASHES.of(normal_words(text))
                sizes.append(len(hashes))
                runs = W.rolling(hashes, min(least, len(hashes))) if len(hashes) else hashes
                found.append(W.signed(np.unique(runs)))
            columns = [*batch.columns, pa.array(sizes, pa.int32()), W.lists_of(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "item", "size", "seeds"])

    return run


def _seeded(keys: Bloom, lengths: list[int]):
    """(doc_id, version, text) to the documents with seeds that may be shared, and these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            chosen, found = [], []
            for row, text in enumerate(W.utf8(batch.column(2))):
                hashes = W.HASHES.of(normal_words(text))
                own = np.concatenate([W.rolling(hashes, n) for n in lengths])
                own = np.unique(own[keys.has(own)])
                if len(own):
                    chosen.append(row)
                    found.append(W.signed(own))
            if chosen:
                rows = batch.take(pa.array(chosen))
                columns = [*rows.columns, W.lists_of(found, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "text", "seeds"])

    return run


_FOUND = (
    "doc_id long, version long, n_items long, item_id long, covered long, size long"
)


def _tiled(least: int, coverage: int):
    """(doc_id, version, text, items) to the contaminated documents and their most covered item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, 500):
            rows = []
            for key, version, text, items in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                W.utf8(batch.column(2)),
                batch.column(3).to_pylist(),
            ):
                words = W.HASHES.of(normal_words(text))
                hits = []
                for item in items:
                    own = W.HASHES.of(normal_words(item["item"].encode()))
                    covered = sum(n for _, _, n in tiles(own, words, least))
                    if 100 * covered >= coverage * len(own):
                        hits.append((-covered / len(own), item["item_id"], covered, len(own)))
                if hits:
                    _, name, covered, size = min(hits)
                    rows.append((key, version, len({h[1] for h in hits}), name, covered, size))
            columns = list(zip(*rows)) if rows else [()] * 6
            names = [p.split()[0] for p in _FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text")
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: int = COVERAGE
) -> DataFrame:
    """The contaminated documents: doc_id, version (xxhash64 of the text), number of items found,
    and of the most covered item its item_id, words covered and size. One row for each
    (doc_id, version)."""
    items = stage(
        benchmark.select(F.col("item_id").cast("long"), F.col("text").alias("item"))
        .filter("item_id is not null")
        .transform(map_batches, _item_seeds(least), "item_id long, item string, size int, seeds array<long>")
        .filter("size > 0"),
        "items",
    )
    short = items.filter(F.col("size") < least).select("size").distinct().collect()  # fewer than least
    keyed = items.select("item_id", "item", F.explode("seeds").alias("seed"))
    hits = stage(
        _texts(docs).transform(
            map_batches,
            _seeded(Bloom(keyed, "seed"), sorted({least, *(r.size for r in short)})),
            "doc_id long, version long, text string, seeds array<long>",
        ),
        "seeded",
    )
    same = F.col("h.version").eqNullSafe(F.col("c.version")) & F.col("h.doc_id").eqNullSafe(F.col("c.doc_id"))
    candidates = (
        hits.select("doc_id", "version", F.explode("seeds").alias("seed"))
        .join(keyed, "seed")
        .groupBy("doc_id", "version")
        .agg(F.collect_set(F.struct("item_id", "item")).alias("items"))
    )
    return (
        hits.dropDuplicates(["doc_id", "version"])
        .alias("h")
        .join(candidates.alias("c"), same)
        .select("h.doc_id", "h.version", "text", "items")
        .transform(map_batches, _tiled(least, coverage), _FOUND)
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: int = COVERAGE) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    # The verdict depends on the text alone.
    found = contaminated(docs, benchmark, least, coverage).select(F.col("version").alias("key"))
    return without(docs, F.xxhash64("text"), stage(found, "contaminated"))
