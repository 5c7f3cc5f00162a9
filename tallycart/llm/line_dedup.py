"""Line dedup on built-in functions: of a line that many documents have, one document keeps it.

A line's key is the line without ASCII white space at its ends, ASCII letters
lower-cased. A key of at least ``MIN_CHARS`` code points in at least ``MIN_DOCS`` documents
loses its lines in all of them but the one with the largest ``doc_id``, which keeps all.

* Lines become rows (96 bits of hash, document, position), written once. They are
  range-partitioned by hash and document and sorted by hash, document and position, so
  that the first line of each key in each document is found in one streaming pass. A key
  in a third of all lines spans many ranges; per range and key one count goes on.
* The result is a keep bitmap for each document, compressed to its runs: the first line
  and the number of lines of every stretch that stays. Texts are not moved to find it.

Defined results. Null or empty text is one empty line. A row without ``doc_id`` takes no part
and keeps its lines. Rows that repeat a ``doc_id`` count as one document, and each gets its
own bitmap by its text. Other columns pass through ``dedup_lines`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.session import stage

MIN_CHARS = 40
MIN_DOCS = 5
KEY = ["doc_id", "version"]


def lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: str) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.btrim(F.col(line), F.lit(" \t\n\x0b\f\r")), upper, upper.lower())


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, version (xxhash64 of the text), n_dropped, keep_runs: the bitmaps of the
    documents that lose a line. All others keep every line."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    split = texts.filter("doc_id is not null").select(*KEY, lines("text").alias("l"))
    rows = (
        split.select(*KEY, F.size("l").alias("n_lines"), F.posexplode("l").alias("place", "line"))
        .filter(F.char_length("line") >= min_chars)
        .withColumn("k", line_key("line"))
        .filter(F.char_length("k") >= min_chars)
    )
    found = stage(
        rows.select(*KEY, "n_lines", "place", F.xxhash64("k").alias("h"), F.hash("k").alias("g")), "lines"
    )
    firsts = (
        found.select("h", "g", "doc_id", "place")
        .repartitionByRange("h", "g", "doc_id")
        .sortWithinPartitions("h", "g", "doc_id", "place")
        .groupBy("h", "g", "doc_id")
        .agg(F.min("place").alias("first"))
    )
    # Stored, as adaptive execution splits a hot key only in a join of plain tables.
    common = stage(
        firsts.groupBy("h", "g")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
        .filter(F.col("n") >= min_docs)
        .select("h", "g", "last"),
        "common",
    )
    dropped = (
        found.join(common, ["h", "g"])
        .filter(F.col("doc_id") < F.col("last"))
        .groupBy(*KEY)
        .agg(F.max("n_lines").alias("n"), F.array_sort(F.collect_set("place")).alias("p"))
    )
    # Between two dropped lines, and before and behind them, a run of lines stays.
    begin = "if(i = 0, 0, p[i - 1] + 1)"
    stays = f"transform(sequence(0, size(p)), i -> struct({begin} as first, if(i = size(p), n, p[i]) - {begin} as length))"
    return dropped.select(
        *KEY,
        F.size("p").cast("long").alias("n_dropped"),
        F.expr(f"filter({stays}, r -> r.length > 0)").alias("keep_runs"),
    )


def kept_text(text: str, runs: str) -> Column:
    """The lines of the runs, joined again; the text as it is where there is no bitmap."""
    parts = F.transform(F.col(runs), lambda r: F.slice(F.col("_lines"), r["first"] + 1, r["length"]))
    return F.when(F.col(runs).isNull(), F.col(text)).otherwise(F.array_join(F.flatten(parts), "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lines dropped, all other columns as they are."""
    joined = _with_bitmaps(docs, min_chars, min_docs)
    return joined.select(*[kept_text("_text", "_runs").alias(c) if c == "text" else F.col(f"_own.`{c}`") for c in docs.columns])


def _with_bitmaps(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """The rows of ``docs`` as the struct ``_own``, their text and lines, and their bitmap."""
    maps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("n_dropped").alias("_dropped"), F.col("keep_runs").alias("_runs")
    )
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_own"))
    same = (F.col("_own.doc_id").cast("long") == F.col("_id")) & (F.xxhash64("_own.text") == F.col("_version"))
    return own.join(maps, same, "left").select(
        "_own", F.col("_own.text").alias("_text"), lines("_own.text").alias("_lines"), "_dropped", "_runs"
    )


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left (null text: empty), of rows with an id."""
    joined = _with_bitmaps(docs.select("doc_id", "text").filter("doc_id is not null"), min_chars, min_docs)
    return joined.select(
        F.col("_own.doc_id").cast("long").alias("doc_id"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(kept_text("_text", "_runs"), F.lit("")).alias("text"),
    )
