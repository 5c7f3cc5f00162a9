"""Substring dedup: remove passages that a document with a smaller id has already.

Every window of ``window`` successive words gets a Rabin-Karp hash. A window is
repeated if the same word sequence also starts in a document with a smaller
``doc_id``; repeated windows merge into maximal removal intervals.

How it stays small. These steps keep the counted rows few without losing a window:

* Documents with the same word sequence form a class. Only its smallest id takes part;
  the others repeat it and are removed whole. This also takes the heat out of a large
  group of copies.
* Each window names an anchor, the least hash among the ``gram``-word grams within it.
  Equal windows have equal anchors, and neighbouring windows mostly share one, so the
  anchors are some sixteen times fewer than the windows. Only windows whose anchor
  occurs in two documents can repeat.
* The texts that hold such windows are picked out by a Bloom filter of fixed size, so that
  only they are shuffled.
* Those windows alone are written as rows (hash, document, position), and counted by
  Spark. The least document of each hash is an aggregate that combines before its
  shuffle; the join back on the hash carries no state, so adaptive execution can
  split a passage that a third of all documents have.

Defined results. A row without ``doc_id`` can't be named and is left out. Null or empty
text has no words. Texts shorter than the window have nothing to remove. Rows that
repeat a ``doc_id`` are separate rows of the result, kept apart by a hash of the text; as
windows are compared by smaller id only, they don't remove each other's words. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W
from tallycart.llm.bloom import Bloom, only_maybe
from tallycart.session import stage

WINDOW = 50
GRAM = 20
KEY = ["doc_id", "version"]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("version"),
        F.col("text"),
    ).filter("doc_id is not null")


def _profile(window: int, gram: int):
    """(doc_id, version, text) to one row a document with its anchors, each with its first window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            counts, digests, anchors, starts = [], [], [], []
            for text in W.utf8(batch.column(2)):
                hashes = W.HASHES.of((text or b"").split())
                least = W.sliding_min(W.rolling(hashes, gram), window - gram + 1)
                first = np.flatnonzero(np.diff(least, prepend=~least[:1]))
                counts.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                anchors.append(W.signed(least[first]))
                starts.append(first)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    W.lists_of(anchors, pa.int64()),
                    W.lists_of(starts, pa.int32()),
                ],
                [*KEY, "n_words", "sequence", "anchors", "starts"],
            )

    return run


_PROFILE = "doc_id long, version long, n_words long, sequence binary, anchors array<long>, starts array<int>"


def _windows(window: int, most: int = 500_000):
    """(doc_id, version, text, ranges of window numbers) to one row a window in the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, 500):
            rows, held = [], 0
            ranges = batch.column(3).to_pylist()
            keys = zip(*(batch.column(i).to_pylist() for i in (0, 1)))
            for key, text, parts in zip(keys, W.utf8(batch.column(2)), ranges):
                values = W.rolling(W.HASHES.of((text or b"").split()), window)
                at = np.unique(np.concatenate([np.arange(r["first"], r["last"]) for r in parts]))
                doc, version = (np.full(len(at), x, np.int64) for x in key)
                rows.append((W.signed(values[at]), doc, version, at.astype(np.int32)))
                held += len(at)
                if held >= most:
                    yield together(rows)
                    rows, held = [], 0
            if held:
                yield together(rows)

    def together(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(x)) for x in zip(*rows)]
        return pa.RecordBatch.from_arrays(columns, ["hash", *KEY, "place"])

    return run


def removal_intervals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, version, n_words and ``intervals``: (first, end) word numbers to remove.

    One row for each input row that has a doc_id; ``intervals`` is null if nothing repeats.
    """
    texts = _texts(docs)
    profile = stage(texts.transform(map_batches, _profile(window, gram), _PROFILE), "profile")

    long = profile.filter(F.col("n_words") >= window)
    firsts = stage(long.groupBy("sequence").agg(F.min("doc_id").alias("first")), "firsts")
    chosen = long.join(
        firsts, (long["sequence"] == firsts["sequence"]) & (long["doc_id"] == firsts["first"]), "left_semi"
    )
    end = F.expr(f"coalesce(get(starts, i + 1), cast(n_words as int) - {window} + 1)")
    anchors = chosen.select(
        *KEY, "n_words", "starts", F.posexplode("anchors").alias("i", "anchor")
    ).select(*KEY, "anchor", F.expr("get(starts, i)").alias("first"), end.alias("last"))
    # Stored, as adaptive execution splits a hot key only in a join of plain tables.
    shared = stage(
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .filter("lo < hi")
        .select("anchor"),
        "shared",
    )
    ranges = stage(
        anchors.join(shared, "anchor")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("first", "last")).alias("ranges")),
        "ranges",
    )
    # Only the texts that have such a window are moved.
    wanted = only_maybe(texts, "version", Bloom(ranges, "version"))
    rows = stage(
        wanted.join(ranges, KEY)
        .select(*KEY, "text", "ranges")
        .transform(map_batches, _windows(window), "hash long, doc_id long, version long, place int"),
        "windows",
    )
    least = stage(
        rows.groupBy("hash")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .filter("lo < hi")
        .select("hash", "lo"),
        "least",
    )
    repeated = (
        rows.join(least, "hash")
        .filter(F.col("doc_id") > F.col("lo"))
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_set("place")).alias("p"))
    )
    # A window ends an interval when the next one starts behind its last word.
    merged = repeated.select(
        *KEY,
        F.expr(f"filter(p, (x, i) -> i = 0 or x - p[i - 1] > {window})").alias("a"),
        F.expr(f"filter(p, (x, i) -> i = size(p) - 1 or p[i + 1] - x > {window})").alias("z"),
    ).select(
        *KEY, F.expr(f"transform(a, (x, i) -> struct(x as first, z[i] + {window} as end))").alias("found")
    )
    # A copy of an earlier word sequence goes whole.
    copy = (F.col("n_words") >= window) & (F.col("doc_id") > F.col("first"))
    whole = F.expr("array(struct(0 as first, cast(n_words as int) as end))")
    return (
        profile.select(*KEY, "n_words", "sequence")
        .join(firsts, "sequence", "left")
        .join(merged, KEY, "left")
        .select(*KEY, "n_words", F.when(copy, whole).otherwise(F.col("found")).alias("intervals"))
    )


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.pieces(batches):
        counts, removed, texts = [], [], []
        for text, parts in zip(W.utf8(batch.column(1)), batch.column(2).to_pylist()):
            found = (text or b"").split()
            keep, at = [], 0
            for part in parts or ():
                keep += found[at : part["first"]]
                at = part["end"]
            keep += found[at:]
            counts.append(len(found))
            removed.append(len(found) - len(keep))
            texts.append(b" ".join(keep))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "text"],
        )


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, version, text) of texts without an interval."""
    for batch in batches:
        none = pa.nulls(batch.num_rows)
        yield from _apply([pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), none], ["doc_id", "text", "intervals"])])


_LEFT = "doc_id long, n_words long, n_removed long, text string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and the text that is left, its words joined by one space."""
    found = removal_intervals(docs, window, gram).filter("intervals is not null")
    found = stage(found.select(*KEY, "intervals").dropDuplicates(KEY), "intervals")
    hit, texts = Bloom(found, "version"), _texts(docs)
    # Texts that surely lose nothing stay where they are.
    moved = only_maybe(texts, "version", hit).join(found, KEY, "left")
    still = only_maybe(texts, "version", hit, wanted=False, then=_untouched, schema=_LEFT)
    return moved.select("doc_id", "text", "intervals").transform(map_batches, _apply, _LEFT).unionByName(still)
