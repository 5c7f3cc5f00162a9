"""User-merchant and mixed graphs, neighbour averages and factorised pairs.

Nodes keep their own ids: a table of (kind, id) with one column per vector
component. A round is a join and two grouped averages over all relations at once.
Sums combine before the shuffle, so a node with very many edges is no hot spot;
a frequent source node is split by adaptive skew handling in the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.operators.encoding import ranks
from tallycart.session import stage

DIM = 16
# Pairs in one block of the factorisation: what a task of it holds.
BLOCK_PAIRS = 1_000_000
LEAST_BLOCKS = 10
# Node kinds and their ids in the log.
NODE_IDS = {
    "user": "user_id",
    "merchant": "merchant_id",
    "category": "cat_id",
    "brand": "brand_id",
    "item": "item_id",
}


def nodes(log: DataFrame, kinds: list[str]) -> DataFrame:
    """Distinct (kind, id)."""
    each = [
        log.select(F.lit(kind).alias("kind"), F.col(NODE_IDS[kind]).alias("id")).distinct()
        for kind in kinds
    ]
    return reduce(DataFrame.unionByName, each)


def _edge(src: str, relation: str, dst: str) -> list[Column]:
    return [
        F.lit(src).alias("src_kind"),
        F.lit(relation).alias("relation"),
        F.lit(dst).alias("dst_kind"),
        F.col(NODE_IDS[src]).alias("src"),
        F.col(NODE_IDS[dst]).alias("dst"),
    ]


def pair_edges(log: DataFrame) -> DataFrame:
    """User to merchant; the weight counts the actions."""
    counts = log.groupBy("user_id", "merchant_id").agg(F.count("*").alias("weight"))
    return counts.select(*_edge("user", "buys", "merchant"), "weight")


def attribute_edges(log: DataFrame) -> DataFrame:
    """Merchant to each category, brand and item it sells, once each."""
    relations = [("has", "category"), ("has", "brand"), ("contains", "item")]
    each = [
        log.select("merchant_id", NODE_IDS[dst])
        .distinct()
        .select(*_edge("merchant", name, dst), F.lit(1).cast("long").alias("weight"))
        for name, dst in relations
    ]
    return reduce(DataFrame.unionByName, each)


def self_loops(log: DataFrame) -> DataFrame:
    users = log.select("user_id").distinct()
    return users.select(*_edge("user", "self", "user"), F.lit(1).cast("long").alias("weight"))


def reversed_edges(edges: DataFrame) -> DataFrame:
    """The same relations walked backwards, so that users also hear from merchants."""
    return edges.select(
        F.col("dst_kind").alias("src_kind"),
        F.concat(F.lit("from "), F.col("relation")).alias("relation"),
        F.col("src_kind").alias("dst_kind"),
        F.col("dst").alias("src"),
        F.col("src").alias("dst"),
        "weight",
    )


def edge_nodes(edges: DataFrame) -> DataFrame:
    """The nodes that edges touch; smaller to read than the log they come from."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src_kind").alias("kind"), F.col("src").alias("id")),
                F.struct(F.col("dst_kind").alias("kind"), F.col("dst").alias("id")),
            )
        )
    )
    return ends.distinct()


def _components(dim: int) -> list[str]:
    return [f"v{i}" for i in range(dim)]


def start_vectors(points: DataFrame, dim: int = DIM) -> DataFrame:
    """A repeatable start vector per node: eight hex digits of an MD5 per component.

    A digest of kind, id and block number serves four components, so each node has a
    vector of its own and its components are independent.
    """
    blocks = [F.md5(F.concat_ws(":", "kind", "id", F.lit(b))).alias(f"_b{b}") for b in range(-(-dim // 4))]
    digits = [F.substring(f"_b{i // 4}", 8 * (i % 4) + 1, 8) for i in range(dim)]
    return points.select("kind", "id", *blocks).select(
        "kind",
        "id",
        *[
            (F.conv(d, 16, 10).cast("double") / float(1 << 32)).alias(name)
            for d, name in zip(digits, _components(dim))
        ],
    )


def neighbour_mean(vectors: DataFrame, edges: DataFrame, dim: int = DIM) -> DataFrame:
    """Weighted mean over the neighbours of a relation, then over relations.

    Only nodes with incoming edges appear. Every edge finds its source's vector, so
    the left join loses and adds nothing; it keeps the long edge table on the
    streamed side, where a frequent source can be split.
    """
    names = _components(dim)
    source = vectors.withColumnsRenamed({"kind": "src_kind", "id": "src"})
    weight = F.sum("weight").cast("double")
    per_relation = (
        edges.join(source, ["src_kind", "src"], "left")
        .groupBy("dst_kind", "dst", "src_kind", "relation")
        .agg(*[(F.sum(F.col(c) * F.col("weight")) / weight).alias(c) for c in names])
    )
    return per_relation.groupBy("dst_kind", "dst").agg(*[F.avg(c).alias(c) for c in names])


def graph_vectors(edges: DataFrame, dim: int = DIM, rounds: int = 2) -> DataFrame:
    """Each round a node moves half way to its neighbours' mean; others stay.

    Results are cut to 9 digits: sums of doubles depend on their order beyond that.
    """
    names = _components(dim)
    edges = stage(edges, "edges")
    vectors = start_vectors(edge_nodes(edges), dim)
    for round_number in range(rounds):
        heard = neighbour_mean(vectors, edges, dim).withColumnsRenamed(
            {"dst_kind": "kind", "dst": "id", **{c: f"_{c}" for c in names}}
        )
        moved = vectors.join(heard, ["kind", "id"], "left").select(
            "kind",
            "id",
            *[
                F.coalesce((F.col(c) + F.col(f"_{c}")) / 2, F.col(c)).alias(c)
                for c in names
            ],
        )
        # The next round reads the vectors twice and restarts from a stored table.
        vectors = moved if round_number == rounds - 1 else stage(moved, "vectors")
    return vectors.select("kind", "id", *[F.round(F.col(c), 9).alias(c) for c in names])


def bipartite_vectors(
    log: DataFrame, dim: int = DIM, rounds: int = 2, both_directions: bool = True
) -> DataFrame:
    edges = pair_edges(log)
    if both_directions:
        edges = edges.unionByName(reversed_edges(edges))
    return graph_vectors(edges, dim, rounds)


def mixed_vectors(
    log: DataFrame, dim: int = DIM, rounds: int = 2, both_directions: bool = True
) -> DataFrame:
    edges = pair_edges(log).unionByName(attribute_edges(log))
    if both_directions:
        edges = edges.unionByName(reversed_edges(edges))
    edges = edges.unionByName(self_loops(log))
    return graph_vectors(edges, dim, rounds)


def vector_columns(vectors: DataFrame, kind: str, prefix: str, dim: int = DIM) -> DataFrame:
    """One kind's vectors keyed by its log id, components named ``<prefix>_<i>``."""
    return vectors.filter(F.col("kind") == kind).select(
        F.col("id").alias(NODE_IDS[kind]),
        *[F.col(c).alias(f"{prefix}_{i}") for i, c in enumerate(_components(dim))],
    )


def factorise_pairs(log: DataFrame, rank: int = DIM, iterations: int = 10, seed: int = 42):
    """Learned user and merchant vectors from the weighted pairs.

    ALS works on 32-bit ids, so users and merchants are numbered first and get their
    own ids back; each kind may have 2**31 members.
    """
    edges = stage(pair_edges(log).select("src", "dst", "weight"), "pair_edges")
    numbers = {}
    for kind, end in (("user", "src"), ("merchant", "dst")):
        values = edges.select(F.lit(kind).alias("feature"), F.col(end).alias("label")).distinct()
        table = ranks(values).select(F.col("label").alias(end), F.col("number").cast("int").alias(f"{end}_no"))
        numbers[end] = stage(table, "numbers")
    als = ALS(
        userCol="src_no",
        itemCol="dst_no",
        ratingCol="weight",
        rank=rank,
        maxIter=iterations,
        seed=seed,
        implicitPrefs=True,
    )
    pairs = edges.join(numbers["src"], "src").join(numbers["dst"], "dst").select(
        "src_no", "dst_no", F.col("weight").cast("float").alias("weight")
    )
    # The default of 10 blocks would grow with the pairs, and a task holds a block.
    blocks = max(LEAST_BLOCKS, -(-edges.count() // BLOCK_PAIRS))
    model = als.setNumBlocks(blocks).fit(pairs)

    def spread(factors: DataFrame, end: str, key: str, prefix: str) -> DataFrame:
        return factors.join(numbers[end], F.col("id") == F.col(f"{end}_no")).select(
            F.col(end).alias(key),
            *[
                F.col("features")[i].cast("double").alias(f"{prefix}_{i}") for i in range(rank)
            ],
        )

    users = spread(model.userFactors, "src", "user_id", "u_als")
    return users, spread(model.itemFactors, "dst", "merchant_id", "m_als")
