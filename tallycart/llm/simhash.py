"""SimHash near-dedup: 64-bit fingerprints linked within a Hamming budget.

Fingerprint: A-Z lower-cased, words are runs of bytes other than the six ASCII
white-space characters, shingles are all runs of ``SHINGLE`` words (repeats count), joined
by one space; fewer words make one shingle of the whole sequence, no words none. Each
shingle's XXH64 (seed 42) votes for its set bits; a fingerprint bit is
1 when over half of the shingles set it. No shingles: fingerprint zero.

Links: a binary trie self-join. The distinct fingerprints are the leaves of a binary trie;
two leaves within ``BUDGET`` differing bits are found by walking pairs of trie nodes down
together, adding up the bits in which their branches differ and dropping a pair as soon as
the sum exceeds the budget. Walked from the root, pairs within budget grow to some
hundred per node in the middle of the trie. So the walk runs over ``PARTS`` = 4 blocks of
16 bits reordered: a pair within 2 bits agrees on at least two whole blocks, and for each of
the 6 choices of two blocks put first, the first 32 levels of that trie are walked with
budget 0 (a node paired with itself, no join) and the last 32 in steps of ``STEP`` bits
with the full budget, every step one join of the pairs with the children of both ends.
A node has at most 2**STEP children and a pair's partner set is bounded by the number of
bit patterns within the budget, so no key is hot; the walk is exact.

Components: fingerprints are the nodes; pairs found by the walk are edges, and so are
fingerprints of one doc_id (a doc_id with several texts is one document). A component is
named by the smallest doc_id among its fingerprints' rows.

Defined cases: null text counts as empty (fingerprint zero); rows with a null doc_id get
their fingerprint and the smallest doc_id their component reaches, null if none.
Repeated rows give equal fingerprints. An empty table gives no rows. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.llm import words as W
from tallycart.llm.batches import map_batches
from tallycart.llm.components import components
from tallycart.session import stage

# Fixed values of the contract.
SHINGLE = 3
SEED = 42
BUDGET = 2
BITS = 64

PARTS = 4
STEP = 8
_WIDTH = BITS // PARTS
_ORDERS = [(i, j, *[k for k in range(PARTS) if k not in (i, j)]) for i, j in combinations(range(PARTS), 2)]


def _fingerprint(text: bytes | None) -> int:
    """The fingerprint of one text, as a signed 64-bit value."""
    words = (text or b"").lower().split()  # bytes: A-Z only, six white-space bytes
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, seed=SEED) for x in shingles), np.uint64, len(shingles))
    votes = np.zeros(BITS, np.int64)
    for b in range(BITS):
        votes[b] = int(np.count_nonzero((hashes >> np.uint64(b)) & np.uint64(1)))
    bits = (2 * votes > len(shingles)).astype(np.uint64)
    value = int(np.bitwise_or.reduce(bits << np.arange(BITS, dtype=np.uint64)))
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.pieces(batches):
        texts = W.utf8(batch.column("text"))
        fps = [_fingerprint(t) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``; fp is a signed long holding the 64 bits.

    Each text is read once inside its task: split, shingled, hashed and voted on in
    one pass, so a very long text costs in proportion to its length.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, _prints, "doc_id long, fp long")


def _block(x: Column, k: int) -> Column:
    return F.shiftrightunsigned(x, _WIDTH * (PARTS - 1 - k)).bitwiseAND((1 << _WIDTH) - 1)


def _reordered(x: Column, order: tuple[int, ...]) -> Column:
    out = F.lit(0).cast("long")
    for place, k in enumerate(order):
        out = out.bitwiseOR(F.shiftleft(_block(x, k), _WIDTH * (PARTS - 1 - place)))
    return out


def _restored(x: Column, order: tuple[int, ...]) -> Column:
    out = F.lit(0).cast("long")
    for place, k in enumerate(order):
        out = out.bitwiseOR(F.shiftleft(_block(x, place), _WIDTH * (PARTS - 1 - k)))
    return out


def close_pairs(fps: DataFrame) -> DataFrame:
    """(a, b), a < b: distinct fingerprints of ``fps`` (column fp) within ``BUDGET`` bits."""
    leaves = fps.select("fp").distinct()
    orders = F.array(*[F.lit(o) for o in range(len(_ORDERS))])
    perm = F.col("o")
    leaves = leaves.select("fp", F.explode(orders).alias("o"))
    pf = F.lit(None).cast("long")
    for o, order in enumerate(_ORDERS):
        pf = F.when(perm == o, _reordered(F.col("fp"), order)).otherwise(pf)
    leaves = stage(leaves.select("o", pf.alias("pf")), "simhash_leaves")
    depth = BITS // 2
    pairs = leaves.select("o", F.shiftrightunsigned("pf", BITS - depth).alias("a")).distinct()
    pairs = pairs.select("o", "a", F.col("a").alias("b"), F.lit(0).alias("d"))
    while depth < BITS:
        below = depth + STEP
        kids = leaves.select(
            "o",
            F.shiftrightunsigned("pf", BITS - depth).alias("up"),
            F.shiftrightunsigned("pf", BITS - below).alias("kid"),
        ).distinct()
        left, right = kids.alias("l"), kids.alias("r")
        step = (
            pairs.alias("p")
            .join(left, (F.col("p.o") == F.col("l.o")) & (F.col("p.a") == F.col("l.up")))
            .join(right, (F.col("p.o") == F.col("r.o")) & (F.col("p.b") == F.col("r.up")))
        )
        # Only the bits of this step: those above were counted on the way down.
        d = F.col("p.d") + F.bit_count(F.col("l.kid").bitwiseXOR(F.col("r.kid")).bitwiseAND((1 << STEP) - 1))
        keep = (d <= BUDGET) & ((F.col("p.a") != F.col("p.b")) | (F.col("l.kid") <= F.col("r.kid")))
        pairs = stage(
            step.filter(keep).select(F.col("p.o").alias("o"), F.col("l.kid").alias("a"), F.col("r.kid").alias("b"), d.alias("d")),
            "simhash_pairs",
        )
        depth = below
    pairs = pairs.filter(F.col("a") != F.col("b"))
    x = y = F.lit(None).cast("long")
    for o, order in enumerate(_ORDERS):
        x = F.when(perm == o, _restored(F.col("a"), order)).otherwise(x)
        y = F.when(perm == o, _restored(F.col("b"), order)).otherwise(y)
    found = pairs.select(x.alias("x"), y.alias("y"))
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    fingerprint: 16 lower-case hex digits; component_id: the smallest doc_id reachable.
    """
    prints = stage(fingerprints(docs), "simhash_prints")
    close = close_pairs(prints)
    firsts = prints.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("fp").alias("first"))
    same_id = prints.join(firsts, "doc_id").select(F.col("first").alias("a"), F.col("fp").alias("b"))
    parts = stage(components(close.unionByName(same_id)), "simhash_parts")
    named = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = named.join(parts, named["fp"] == parts["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("c"), "least"
    )
    names = labels.groupBy("c").agg(F.min("least").alias("component_id"))
    label_of = labels.join(names, "c").select("fp", "component_id")
    hex16 = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return prints.join(label_of, "fp").select("doc_id", hex16.alias("fingerprint"), "component_id", "fp")
