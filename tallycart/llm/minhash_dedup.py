"""Near-duplicate documents by b-bit MinHash, confirmed on the full sets.

A document's set holds its distinct five-word shingles (ASCII letters lower-cased; a
shorter text is one shingle). Two documents are linked if 100 * |A & B| >= 75 * |A | B|.

* Copies first: documents with equal sets form a class, and only the class's smallest id
  goes on, with the hash of its text there. A group of copies of any size costs one row.
* Signature: ``BANDS * ROWS`` minima. Each band's minima hash to one key; documents that
  share a key are candidates. A link at the threshold is missed with a chance of
  (1 - 0.75**4)**40, about 2 in 10 million, closer ones with less.
* Sketch: of each minimum only the low ``BITS`` bits are kept, packed into longs. The
  similarity of candidates is estimated from the count of equal groups of bits,
  corrected for groups that agree by chance; two are alike unless their estimate is
  ``MARGIN`` below the threshold (4.6 standard deviations, about 2 in a million).
* Families: within a bucket, what alike pairs connect is one family, and so are buckets
  that share a member. A bucket gives one row for each member, whatever its pairs.
* Proof: the texts of a family are brought together and their full sets compared, all
  with all; again one row tells of each member to whom it is linked.

Pairs are never rows, so a large group costs rows in proportion to its members. Its comparisons
still grow with its square: buckets of more than ``BUCKET`` members and families of more than
``FAMILY`` are dealt into parts, and every two parts meet in a task of their own (a tile), so no
task holds a large group. A member's text goes to as many tiles as its family has other
parts: ``SPREAD - 1`` at most up to ``SPREAD * LARGEST`` members and ``SPREAD * SHINGLES``
shingles, more beyond that. No pair of a bucket goes unseen.

Nodes of buckets and families are 64-bit hashes of the classes' digests: among n classes two
share one with a chance of n**2 / 2**65.

Defined results. A row without ``doc_id`` can't be named and is left out. Null or empty
text, or text without words, has an empty set and is linked with nothing. Rows that
repeat a ``doc_id`` are one document: each has the links of its own text, and all are in
one component, those with an empty set too. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W
from tallycart.llm.bloom import Bloom, only_maybe, without
from tallycart.llm.components import components
from tallycart.session import stage

SHINGLE = 5
PERCENT = 75
BANDS = 40
ROWS = 4
BITS = 2
MARGIN = 0.19
BUCKET = 2048  # members of a bucket in one part
FAMILY = 128  # texts of a family in one part, while it has at most SPREAD parts
SPREAD = 16
LARGEST = 1024  # texts of a family in one part, however many parts
SHINGLES = 500_000  # shingles of a family in one part, on average
KEY = ["doc_id", "version"]
PER_LONG = 64 // BITS

_RNG = np.random.default_rng(20240229)
_FACTORS = (_RNG.integers(0, 1 << 32, BANDS * ROWS, np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFTS = _RNG.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    hashes = W.HASHES.of((text or b"").lower().split())
    if not len(hashes):
        return hashes
    return np.unique(W.rolling(hashes, min(SHINGLE, len(hashes))))


def signature(members: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a non-empty set."""
    small = (members >> np.uint64(32)).astype(np.uint32)
    least = None
    for part in range(0, len(small), 4096):
        values = small[None, part : part + 4096] * _FACTORS[:, None] + _SHIFTS[:, None]
        values ^= values >> np.uint32(15)
        found = values.min(axis=1)
        least = found if least is None else np.minimum(least, found)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One long for each band, different bands never sharing a key by design."""
    rows = least.astype(np.uint64).reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        keys = W.mix(keys + rows[:, i])
    return W.signed(keys)


def sketch(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, PER_LONG)
    places = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
    return W.signed(np.bitwise_or.reduce(low << places, axis=1))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = np.empty(0, np.int64)
    for batch in W.pieces(batches):
        sizes, digests, keys, sketches = [], [], [], []
        for text in W.utf8(batch.column(2)):
            members = shingles(text)
            least = signature(members) if len(members) else None
            sizes.append(len(members))
            digests.append(xxhash.xxh3_128_digest(members.tobytes()))
            keys.append(empty if least is None else band_keys(least))
            sketches.append(empty if least is None else sketch(least))
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                W.lists_of(keys, pa.int64()),
                W.lists_of(sketches, pa.int64()),
            ],
            ["doc_id", "version", "n_shingles", "digest", "bands", "sketch"],
        )


_PROFILE = "doc_id long, version long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the similarity estimated from two sketches, corrected for chance agreement, is not
    too low for a link. Sketches are rows of unsigned longs."""
    differ = a ^ b
    folded = differ
    for shift in range(1, BITS):
        folded = folded | differ >> np.uint64(shift)
    groups = np.uint64(int("1" * PER_LONG, 1 << BITS))
    n, chance = BANDS * ROWS, 1 / (1 << BITS)
    equal = 1 - np.bitwise_count(folded & groups).sum(axis=-1, dtype=np.int64) / n
    return (equal - chance) / (1 - chance) >= PERCENT / 100 - MARGIN


def clusters(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each of ``n`` items the first one it is connected with. ``near`` tells which of some
    items are near one; it is asked once for each item, about those not reached yet."""
    root, left = np.arange(n), np.arange(n)
    while len(left):
        first, left = left[0], left[1:]
        reached = [first]
        while reached and len(left):
            hit = near(reached.pop(), left)
            found, left = left[hit], left[~hit]
            root[found] = first
            reached.extend(found.tolist())
    return root


def _whole(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows again, no group cut in two, with the groups' first rows and the number of rows.
    The first ``keys`` columns are longs and name the group."""

    def starts(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, bool)
        for column in batch.columns[:keys]:
            new[1:] |= np.diff(column.to_numpy()) != 0
        new[:1] = True
        return np.flatnonzero(new)

    def joined(held: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, np.ndarray]:
        batch = pa.concat_batches(held)
        return batch, np.append(starts(batch), batch.num_rows)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(starts(batch)[-1])
        if held and not last and any(h[-1] != c[0] for h, c in zip(held[-1].columns[:keys], batch.columns)):
            yield joined(held)
            held = []
        elif last:
            yield joined([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield joined(held)


def _edges(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    """The distinct pairs of two columns of nodes."""
    pairs = np.unique(np.column_stack([np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b)]), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, i], pa.int64()) for i in (0, 1)], ["a", "b"])


def _connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, i, j, node, sketch) sorted by bucket tile, to edges that connect what is alike."""
    for batch, bounds in _whole(batches, 3):
        node = batch.column(3).to_numpy()
        sketches = batch.column(4).flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        first = np.repeat(bounds[:-1], np.diff(bounds))
        with_first = alike(sketches, sketches[first])
        others = with_first & (first != np.arange(len(node)))
        a, b = [node[others]], [node[first[others]]]
        # Where not all are alike with a tile's first member, the others are compared too.
        for start in np.unique(first[~with_first]):
            stop = bounds[np.searchsorted(bounds, start) + 1]
            if stop - start > 2:
                own = sketches[start:stop]
                root = clusters(stop - start, lambda x, some: alike(own[x], own[some]))
                a.append(node[start:stop])
                b.append(node[start + root])
        yield _edges(a, b)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (family, i, j, node, head, text) sorted by tile, to edges (a, b) of heads that
    connect what is linked."""
    for batch, bounds in _whole(batches, 3):
        node, head = (batch.column(i).to_numpy() for i in (3, 4))
        a, b = [], []
        for start, stop in zip(bounds, bounds[1:]):
            # Rows that repeat an id and its text are one.
            rows = start + np.unique(node[start:stop], return_index=True)[1]
            if len(rows) > 1:
                sets = [shingles(t) for t in W.utf8(batch.column(5).take(pa.array(rows)))]
                a.append(head[rows])
                b.append(head[rows[linked(sets)]])
        yield _edges(a, b)


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """For each of some non-empty sets the first one it is connected with by links."""
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), np.uint8)

    def near(x: int, some: np.ndarray) -> np.ndarray:
        own = flat[starts[x] : ends[x]]
        mark[own] = 1
        if 4 * len(some) < len(sets):
            both = np.array([np.count_nonzero(mark[flat[starts[y] : ends[y]]]) for y in some])
        else:
            both = np.add.reduceat(mark[flat], starts, dtype=np.int64)[some]
        mark[own] = 0
        return 100 * both >= PERCENT * (sizes[x] + sizes[some] - both)

    return clusters(len(sets), near)


def _tiles(rows: DataFrame) -> DataFrame:
    """``rows`` with i and j: dealt into ``parts`` parts by ``node``, once for each other part (or
    0, 0 if there is one part), so that any two rows of a group meet."""
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    tile = "transform(filter(sequence(0L, parts - 1), o -> parts = 1 or o <> part), o -> struct(least(o, part) as i, greatest(o, part) as j))"
    return dealt.withColumn("tile", F.explode(F.expr(tile))).select(*rows.columns, "tile.*").drop("parts")


def _families(classes: DataFrame) -> DataFrame:
    """(node, family) of the classes that share a bucket with one alike. ``classes``: node, bands,
    sketch."""
    members = classes.select("node", F.explode("bands").alias("key"))
    # A key is of one band, so it has at most one row in BANDS.
    shared = members.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1")
    parts = F.ceil(F.col("n") / BUCKET).cast("long").alias("parts")
    live = stage(shared.select("key", "node", parts), "buckets")
    edges = (
        _tiles(live).join(classes.select("node", "sketch"), "node")
        .select("key", "i", "j", "node", "sketch")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "node")
        .transform(map_batches, _connect, "a long, b long")
    )
    return stage(components(edges).withColumnRenamed("component", "family"), "families")


def links(classes: DataFrame, families: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges (a, b) of ids that connect all that is linked within a family. ``classes``: node, doc_id,
    version, n_shingles; ``families``: node, family; ``texts``: doc_id, version, text."""
    near = classes.select("node", *KEY, "n_shingles").join(families, "node")
    near = stage(near, "near")
    number, size = F.count("*"), F.sum("n_shingles")
    parts = F.greatest(
        F.least(F.ceil(number / FAMILY), F.lit(SPREAD)), F.ceil(number / LARGEST), F.ceil(size / SHINGLES)
    )
    large = stage(near.groupBy("family").agg(parts.cast("long").alias("parts")).filter("parts > 1"), "large")
    placed = near.join(large, "family", "left").fillna(1, ["parts"]).drop("n_shingles")
    # Only the texts of families are moved.
    some = only_maybe(texts, "version", Bloom(near, "version"))
    return (
        some.join(stage(_tiles(placed), "tiles"), KEY)
        .select("family", "i", "j", "node", "doc_id", "text")
        .repartition("family", "i", "j")
        .sortWithinPartitions("family", "i", "j", "node")
        .transform(map_batches, _prove, "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), one row each input row."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text")
    ).filter("doc_id is not null")
    profile = stage(texts.transform(map_batches, _profile, _PROFILE), "profile")
    # One row stands for a class; an id can stand for several. Equal sets have equal bands.
    equal = [F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")]
    classes = stage(
        profile.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min(F.struct(*KEY)).alias("least"), *equal)
        .select("digest", F.xxhash64("digest").alias("node"), "least.*", "n_shingles", "bands", "sketch"),
        "classes",
    )
    heads = classes.select("digest", F.col("doc_id").alias("head"))
    rows = stage(
        profile.select("doc_id", "n_shingles", "digest").join(heads, "digest", "left").drop("digest"), "rows"
    )
    edges = links(classes, _families(classes), texts).union(_same_id(rows))
    merged = stage(components(edges), "components").withColumnRenamed("node", "head")
    return (
        rows.withColumn("head", F.coalesce("head", "doc_id"))
        .join(merged, "head", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "head").alias("component_id"))
    )


def _same_id(rows: DataFrame) -> DataFrame:
    """Edges (a, b) of the ids whose rows are in several classes and those that stand for them. ``rows``: doc_id, and
    head, the id that stands for the row's class (null without one)."""
    several = (
        rows.groupBy("doc_id")
        .agg(
            F.min("head").alias("lo"),
            F.max("head").alias("hi"),
            (F.count("*") > F.count("head")).alias("without"),
        )
        .filter("lo <> hi or without and lo <> doc_id")
        .select("doc_id")
    )
    edges = rows.join(stage(several, "several"), "doc_id", "left_semi").filter("head <> doc_id")
    return edges.select(F.col("doc_id").alias("a"), F.col("head").alias("b"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component the document with the smallest id, with all its columns. Rows that
    repeat an id stay or go together; rows without an id stay."""
    others = near_duplicates(docs).filter("doc_id <> component_id")
    gone = stage(others.select(F.xxhash64("doc_id").alias("key"), F.col("doc_id").alias("id")), "others")
    return without(docs, F.xxhash64(F.col("doc_id").cast("long")), gone.select("key"))
