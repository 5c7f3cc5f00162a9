"""Importance resampling towards a target distribution, by hashed word buckets.

Weights: A-Z lower-cased, words are runs of code points other than ASCII control,
punctuation and symbols (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``), features are runs of
``ORDER`` consecutive words joined by one space, repeats counted. A feature falls in the
bucket crc32(UTF-8) % ``BUCKETS``. Counts per bucket over the raw corpus (s, total S) and
the target texts (t, total T) give each bucket the gain
floor(1000 * ln((t + 1)(S + B) / ((s + 1)(T + B)))). The gains are one array of ``BUCKETS``
doubles, a fixed size whatever the data, broadcast as a table; a document's weight is the
sum of the array at its features' buckets.

Draw: a Gumbel key per document, floor(-1000 ln(-ln((h + 0.5) / 2**32))) with h the first
32 bits of sha256(``<SEED>:<doc_id>``), is added to the weight (the Gumbel-max trick, so
the highest scores are a draw without replacement in proportion to exp(weight / 1000)).
Of the N documents of at least ``LEAST_WORDS`` words, the ``SHARE`` percent with the
highest scores are drawn, ties to the smaller doc_id.

The k-th composite key (-score, doc_id, n_features, text digest) is found by a
distributed quickselect: random pivot keys from the candidates, then one pass counts
the rows below, equal to and above every pivot, which narrows the candidates to one gap
between pivots or to one pivot. Only when few candidates are left are their keys brought
to the driver (at most ``FEW``). Winners alone are then sorted by range and ranked by
prefix sums over the ranges.

Defined cases: a null text has no words; weight 0 without features. A null doc_id has
no h: its score is null and it is neither counted in N nor drawn. Rows equal in doc_id and
text are equal in all results but rank; they take consecutive ranks. An empty table, or
no document of ``LEAST_WORDS`` words, draws nothing. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.session import stage

# Fixed values of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
SHARE = 10

PIVOTS = 64
FEW = 20_000
KEY = ["neg_score", "doc_id", "n_features", "digest"]


def features(text: Column) -> Column:
    """The features of a text, as an array of strings."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), 0)
    if ORDER == 1:
        return words
    last = F.size(words) - ORDER
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, ORDER), " "))


def _bucket(feature: Column) -> Column:
    return F.crc32(feature.cast("binary")) % BUCKETS


def bucket_counts(texts: DataFrame) -> list[int]:
    """Features per bucket over all ``texts`` (column text): a list of ``BUCKETS`` counts."""
    each = texts.select(F.explode(features(F.col("text"))).alias("f"))
    counts = each.groupBy(_bucket(F.col("f")).alias("k")).count().collect()  # at most BUCKETS rows
    out = [0] * BUCKETS
    for row in counts:
        out[row["k"]] = row["count"]
    return out


def gains(raw: list[int], target: list[int]) -> list[float]:
    big_s, big_t = float(sum(raw)), float(sum(target))
    return [
        float(math.floor(1000 * math.log(((t + 1.0) * (big_s + BUCKETS)) / ((s + 1.0) * (big_t + BUCKETS)))))
        for s, t in zip(raw, target)
    ]


def scored(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_features, weight, score, digest) for every row of ``docs``.

    Features are exploded and joined to the broadcast gain table, then added up per row;
    rows equal in doc_id and text are one group, given back as often as they came.
    """
    table = gains(bucket_counts(docs), bucket_counts(target))
    # BUCKETS rows whatever the data: a broadcast of fixed size.
    lookup = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(table)), "_b long, _g double"))
    feats = features(F.col("text"))
    # The list is made in its own projection: an expression beside the explode would be
    # evaluated again for every exploded row.
    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.hash("text").alias("_h"), feats.alias("_fs"))
    each = rows.select("doc_id", "digest", "_h", F.size("_fs").alias("_k"), F.explode_outer("_fs").alias("_f"))
    each = each.select("doc_id", "digest", "_h", "_k", _bucket(F.col("_f")).alias("_b")).join(lookup, "_b", "left")
    per = each.groupBy("doc_id", "digest", "_h").agg(
        F.coalesce(F.sum("_g"), F.lit(0.0)).alias("_w"), F.count("*").alias("_c"), F.max("_k").alias("_k")
    )
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10)
    u = (h.cast("double") + 0.5) / 4294967296.0
    gumbel = F.floor(-1000.0 * F.log(-F.log(u)))
    # Equal rows added up their features alike: one row's weight is the sum over the copies.
    per = per.withColumn("_n", (F.col("_c") / F.greatest(F.lit(1), "_k")).cast("int"))
    per = per.withColumn("_w", F.col("_w") / F.col("_n"))
    return per.select(
        "doc_id",
        F.col("_k").cast("long").alias("n_features"),
        F.col("_w").cast("long").alias("weight"),
        (F.col("_w") + gumbel).cast("long").alias("score"),
        "digest",
        F.explode(F.sequence(F.lit(1), "_n")).alias("_copy"),
    ).drop("_copy")


def _key(row) -> tuple:
    return tuple(row[k] for k in KEY)


def _less(key: tuple) -> Column:
    """Rows whose composite key is below ``key`` (lexicographic)."""
    out = F.lit(False)
    for i in reversed(range(len(KEY))):
        here = F.col(KEY[i]) < F.lit(key[i])
        if i < len(KEY) - 1:
            here = here | ((F.col(KEY[i]) == F.lit(key[i])) & out)
        out = here
    return out


def _equal(key: tuple) -> Column:
    out = F.lit(True)
    for name, value in zip(KEY, key):
        out = out & (F.col(name) == F.lit(value))
    return out


def kth_key(cand: DataFrame, k: int, seed: int = 7) -> tuple:
    """The k-th smallest composite key of ``cand`` (1-based, 1 <= k <= rows), exactly."""
    low = high = None  # candidates lie strictly above low and strictly below high
    size = cand.count()
    rnd = seed
    while True:
        live = cand
        if low is not None:
            live = live.filter(~(_less(low) | _equal(low)))
        if high is not None:
            live = live.filter(_less(high))
        if size <= FEW:
            keys = sorted(_key(r) for r in live.select(*KEY).collect())
            return keys[k - 1]
        rnd += 1
        picked = live.select(*KEY).sample(False, min(1.0, 2.0 * PIVOTS / size), rnd).limit(4 * PIVOTS).collect()
        pivots = sorted({_key(r) for r in picked})
        if not pivots:
            continue
        # gap i: below pivot i and above pivot i-1; (i, True): equal to pivot i. The pivots are one
        # literal array: a comparison written out for each makes code of a size that the
        # driver needs hundreds of MB to compile.
        kinds = ", ".join(f"{name}: {cand.schema[name].dataType.simpleString()}" for name in KEY)
        edges = F.from_json(F.lit(json.dumps([dict(zip(KEY, p)) for p in pivots])), f"array<struct<{kinds}>>")
        here = F.struct(*KEY)
        gap = F.size(F.filter(edges, lambda p: p < here))
        same = F.array_contains(edges, here)
        counts = {
            (r["g"], r["e"]): r["n"] for r in live.groupBy(gap.alias("g"), same.alias("e")).agg(F.count("*").alias("n")).collect()
        }
        seen = 0
        for i in range(len(pivots) + 1):
            below = counts.get((i, False), 0)
            if seen + below >= k:
                k -= seen
                size = below
                low = pivots[i - 1] if i > 0 else low
                high = pivots[i] if i < len(pivots) else high
                break
            seen += below
            equal = counts.get((i, True), 0)
            if seen + equal >= k:
                return pivots[i]
            seen += equal


def rank_rows(winners: DataFrame) -> DataFrame:
    """Winners with rank 1, 2, ... by composite key: ranges of the key, then prefix sums."""
    spark = winners.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = stage(winners.repartitionByRange(parts, *KEY).withColumn("_part", F.spark_partition_id()), "resample_winners")
    sizes = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # one row a range
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    starts = spark.createDataFrame(list(before.items()), "_part int, _start long")
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*KEY))
    # One row a range: a size bounded by the number of ranges.
    placed = ranged.join(F.broadcast(starts), "_part")
    return placed.withColumn("rank", F.col("_start") + inner).drop("_part", "_start")


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs``; rank null if undrawn."""
    rows = stage(scored(docs, target).withColumn("neg_score", -F.col("score")), "resample_scores")
    cand = rows.filter((F.col("n_features") >= LEAST_WORDS) & F.col("score").isNotNull())
    n = cand.count()
    k = n * SHARE // 100
    names = ["doc_id", "n_features", "weight", "score"]
    if k == 0:
        return rows.select(*names, F.lit(None).cast("long").alias("rank"))
    edge = kth_key(cand, k)
    winners = cand.filter(_less(edge) | _equal(edge))
    ranked = rank_rows(winners).select(*names, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    # The rest keep their rows, with a null rank.
    eligible = F.coalesce((F.col("n_features") >= LEAST_WORDS) & F.col("score").isNotNull(), F.lit(False))
    rest = rows.filter(~eligible | ~(_less(edge) | _equal(edge))).select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
