"""Secret scan on built-in functions, with multipart credentials linked by an interval join.

Three kinds of secret are found by themselves: assignments of a long value to a telling
name, access identifiers, and long hexadecimal runs. Three weaker kinds are reported
only where the parts of a credential come together: identifiers in an assignment, runs of
mixed letters and digits, and endpoints. A part has a role (identifier, secret, endpoint);
a weak identifier needs a secret, a weak secret an identifier, an endpoint both, each
starting at most ``SCOPE`` code points before or behind it in the same text.

* Places of matches come from two built-in functions that scan alike: the text is
  split at the matches, and running sums of the lengths of gaps and matches are places.
  Only matches become rows.
* The interval join is an equality join: places fall into buckets as wide as the scope, so
  a partner is in the same bucket or a neighbour, and of each role and bucket
  only the first and last place are needed. However many parts a text has, no pairs
  are listed.

Defined results. Null text is empty. A row without ``doc_id`` can't be named and is left out.
Rows that repeat a ``doc_id`` are separate, kept apart by a hash of the text. Places count
code points. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycart.session import stage

SCOPE = 200
KEY = ["doc_id", "version"]
# Kinds in the order in which spans with one start are listed, each with its
# pattern, the group whose length counts, the least length, and its role. The first
# three stand by themselves.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
NAMED = r"""((?i:client|account|user|app)[_-]?(?i:id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.-]+)"""
KINDS = [
    ("assign", ASSIGN, 2, 12, "secret"),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18, "identifier"),
    ("hex", r"([0-9a-f]{16,})", 1, 16, "secret"),
    ("named_id", NAMED, 2, 4, "identifier"),
    ("mixed", r"([A-Za-z0-9+/_-]{24,})", 1, 24, "secret"),
    ("endpoint", r"""(https?://[^\x20\x09-\x0D"'<>]+)""", 1, 12, "endpoint"),
]
BASE = 3
NEEDS = {"named_id": ["secret"], "mixed": ["identifier"], "endpoint": ["identifier", "secret"]}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(number: int) -> Column:
    """The matches of one kind as structs (kind, i, gap before it, width, long enough)."""
    name, pattern, group, least, _ = KINDS[number]
    p = _quoted(pattern)
    enough = f"char_length(v) >= {least}"
    if name == "mixed":  # one sort of letter or no digit is a word, not a key
        enough += " and v rlike '[A-Z]' and v rlike '[a-z]' and v rlike '[0-9]'"
    return F.expr(
        f"""if(text rlike {p},
          transform(
            arrays_zip(split(text, {p}, -1), regexp_extract_all(text, {p}, 0),
              transform(regexp_extract_all(text, {p}, {group}), v -> {enough})),
            (m, i) -> struct({number} as kind, i as i, char_length(m.`0`) as gap,
              char_length(m.`1`) as width, m.`2` as enough)),
          cast(array() as array<struct<kind:int,i:int,gap:int,width:int,enough:boolean>>))"""
    )


def find_parts(docs: DataFrame) -> DataFrame:
    """Every match that is long enough: doc_id, version (xxhash64 of the text), kind (its
    number), start, end."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.coalesce("text", F.lit("")).alias("text")
    ).filter("doc_id is not null")
    found = F.concat(*[_matches(n) for n in range(len(KINDS))])
    # The last gap has no match behind it.
    rows = texts.select(*KEY, F.explode(found).alias("m")).select(*KEY, "m.*").filter("width is not null")
    before = Window.partitionBy(*KEY, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.repartition(*KEY, "kind")
        .dropDuplicates([*KEY, "kind", "i"])
        .withColumn("end", F.sum(F.col("gap") + F.col("width")).over(before))
        .filter("enough")
        .select(*KEY, "kind", (F.col("end") - F.col("width")).alias("start"), "end")
    )


def _role(kind: str) -> Column:
    return F.element_at(F.array(*[F.lit(k[4]) for k in KINDS]), F.col(kind) + 1)


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that have all the partners they need within the scope."""
    placed = parts.withColumn("bucket", F.floor(F.col("start") / scope))
    spots = (
        placed.groupBy(*KEY, _role("kind").alias("role"), "bucket")
        .agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    )
    needs = F.create_map(
        *[c for k, v in NEEDS.items() for c in (F.lit([x[0] for x in KINDS].index(k)), F.array(*map(F.lit, v)))]
    )
    asked = (
        placed.filter(F.col("kind") >= BASE)
        .select(*KEY, "kind", "start", "end", F.col("bucket").alias("own"), needs[F.col("kind")].alias("needs"))
        .select("*", F.explode("needs").alias("role"))
        .select("*", F.explode(F.expr("array(own - 1, own, own + 1)")).alias("bucket"))
    )
    near = (
        (F.col("bucket") == F.col("own"))
        | ((F.col("bucket") < F.col("own")) & (F.col("hi") >= F.col("start") - scope))
        | ((F.col("bucket") > F.col("own")) & (F.col("lo") <= F.col("start") + scope))
    )
    return (
        asked.join(spots, [*KEY, "role", "bucket"])
        .filter(near)
        .groupBy(*KEY, "kind", "start", "end")
        .agg(F.count_distinct("role").alias("n"), F.max(F.size("needs")).alias("asked"))
        .filter("n = asked")
        .select(*KEY, "kind", "start", "end")
    )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, the number of each base kind, and the base and all spans as text, of every row."""
    # Stored: the texts are scanned once, and the join reads the few parts.
    parts = stage(find_parts(docs), "parts")
    told = parts.filter(F.col("kind") < BASE).unionByName(link_parts(parts, scope))
    names = F.array(*[F.lit(k[0]) for k in KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
        )

    per_text = (
        told.groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
        .select(
            *KEY,
            *[F.expr(f"cast(size(filter(s, x -> x.kind = {n})) as long) as n_{KINDS[n][0]}") for n in range(BASE)],
            listed(F.filter("s", lambda x: x["kind"] < BASE)).alias("base_spans"),
            listed(F.col("s")).alias("spans"),
        )
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"))
    counts = [F.coalesce(f"n_{KINDS[n][0]}", F.lit(0)).cast("long").alias(f"n_{KINDS[n][0]}") for n in range(BASE)]
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")]
    return rows.filter("doc_id is not null").join(per_text, KEY, "left").select("doc_id", *counts, *texts)
