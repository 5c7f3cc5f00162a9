"""Spelling variants: words one edit apart, each pointed at a much more frequent form.

Method: a dictionary of trie-node pairs. Every prefix of a vocabulary word is a node of
the forward trie, every suffix a node of the reversed trie. A node is numbered by its
depth and a 122-bit polynomial digest of its path (two Mersenne-61 residues), so the
numbers come without a join and two nodes share a number with a chance below
V**2 / 2**122 for V nodes. A word w of L code points gives

* a *skip* key (node of w[:i], node of w[i+1:]) for every i, flagged ``start`` where i
  begins a run of equal code points;
* a *split* key (node of w[:i], node of w[i:]) for every i in 0..L.

Equal skip keys of two words: they differ by one replaced code point at i. A start
skip key of a equal to a split key of b: b is a with one code point deleted (one
inserted, seen from b). Each near pair meets in exactly one key, and a key holds at most
one word per letter of the alphabet plus one split word, so groups are small by
construction: no key can be hot, and each word's near count and best near word come
from its keys' groups without a single pair being emitted.

Words: maximal runs of ``[A-Za-zÀ-ÿ]``, A-Z lower-cased. h is the unsigned
crc32 of the UTF-8 text ``<doc_id>:<run>``; when 31 divides h the code point at h % length
is deleted. Results of at least ``SHORTEST`` code points that occur at least ``FEWEST``
times over all documents are the words; n counts them.

Defined cases: a null text has no runs; a null doc_id gives a null h, so its runs keep
all code points. Repeated rows count every time. Ties of frequency go to the smaller
word in code-point order. An empty table gives no rows. Only ``doc_id`` and ``text``
are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm import words as W
from tallycart.llm.batches import map_batches
from tallycart.session import stage

# Fixed values of the contract.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 7
FEWEST = 2
DROP_EVERY = 31
FORM_RATIO = 10

_M = (1 << 61) - 1
_BASES = (1_000_003, 998_244_353)
KEY = ["pi", "p1", "p2", "sj", "s1", "s2"]
_ROWS = pa.schema(
    [(k, pa.int64()) for k in KEY]
    + [("word", pa.string()), ("n", pa.int64()), ("split", pa.bool_()), ("start", pa.bool_())]
)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts and how often each occurs."""
    run = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), 0))
    runs = docs.select(F.col("doc_id").alias("_id"), run.alias("_run"))
    low = F.translate("_run", UPPER, LOWER)
    runs = runs.select("_id", low.alias("_run")).filter(F.char_length("_run") >= SHORTEST)
    h = F.crc32(F.concat(F.col("_id").cast("string"), F.lit(":"), "_run").cast("binary"))
    runs = runs.select("_run", (h % DROP_EVERY == 0).alias("_drop"), (h % F.char_length("_run")).cast("int").alias("_at"))
    cut = F.expr("concat(substring(_run, 1, _at), substring(_run, _at + 2))")
    words = runs.select(F.when(F.col("_drop"), cut).otherwise(F.col("_run")).alias("word"))
    counts = words.filter(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= FEWEST)


def _digests(text: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """Digests of every prefix text[:i] and suffix text[i:], i = 0..len, in both residues."""
    out = []
    for base in _BASES:
        pre = [0]
        for ch in text:
            pre.append((pre[-1] * base + ord(ch) + 1) % _M)
        suf = [0] * (len(text) + 1)
        for i in range(len(text) - 1, -1, -1):
            suf[i] = (suf[i + 1] * base + ord(text[i]) + 1) % _M
        out += [pre, suf]
    return out[0], out[2], out[1], out[3]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.pieces(batches):
        cols: dict[str, list] = {name: [] for name in _ROWS.names}
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            p1, p2, s1, s2 = _digests(word)
            size = len(word)
            for i in range(2 * size + 1):
                split = i > size - 1
                at = i - size if split else i
                tail = at if split else at + 1
                for name, value in zip(KEY, (at, p1[at], p2[at], size - tail, s1[tail], s2[tail])):
                    cols[name].append(value)
                cols["word"].append(word)
                cols["n"].append(n)
                cols["split"].append(split)
                cols["start"].append(not split and (at == 0 or word[at] != word[at - 1]))
        yield pa.RecordBatch.from_pydict(cols, schema=_ROWS)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best): near-word count and the near word of largest n, as a
    struct (neg_n, word) whose least value is the best, or null without near words."""
    schema = ", ".join(f"{k} long" for k in KEY) + ", word string, n long, split boolean, start boolean"
    rows = map_batches(words.select("word", "n"), _keys, schema)
    member = F.struct((-F.col("n")).alias("neg_n"), "word", "split", "start")
    groups = rows.groupBy(*KEY).agg(F.collect_list(member).alias("m")).filter(F.size("m") > 1)
    # Per member x of a group: replaced neighbours are the other skip rows; a start skip row
    # also has the split word; a split row has the start skip rows.
    mine = F.expr(
        """transform(m, x -> named_struct(
            'word', x.word,
            'near', case when x.split then size(filter(m, y -> not y.split and y.start))
                         else size(filter(m, y -> not y.split)) - 1
                              + if(x.start, size(filter(m, y -> y.split)), 0) end,
            'best', array_min(transform(filter(m, y -> case when x.split then not y.split and y.start
                         else (not y.split and y.word <> x.word) or (x.start and y.split) end),
                         y -> named_struct('neg_n', y.neg_n, 'word', y.word)))))"""
    )
    each = groups.select(F.explode(mine).alias("e")).select("e.*")
    found = each.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best"
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for every word of ``links`` (word, up) by pointer jumping.

    Forms raise n tenfold at each step, so chains are short and acyclic; each round
    doubles the jump and is written to the shared folder.
    """
    now = stage(links.select("word", F.col("up").alias("root")), "roots")
    while True:
        a, b = now.alias("a"), now.alias("b")
        step = a.join(b, F.col("a.root") == F.col("b.word"), "left").select(
            F.col("a.word"), F.coalesce("b.root", "a.root").alias("root"), F.col("b.word").isNotNull().alias("moved")
        )
        step = stage(step, "roots")
        if step.filter("moved").head() is None:
            return step.select("word", "root")
        now = step.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``.

    form: the near word of largest n (ties: smallest word) if its n is at least
    ``FORM_RATIO`` times the word's, else null; root: the end of the chain of forms,
    the word itself without a form.
    """
    words = stage(word_counts(docs), "spelling_words")
    judged = near_words(words)
    strong = F.col("best").isNotNull() & (-F.col("best.neg_n") >= FORM_RATIO * F.col("n"))
    judged = stage(
        judged.select(
            "word",
            "n",
            "n_near",
            F.when(strong, F.col("best.word")).alias("form"),
            F.when(strong, -F.col("best.neg_n")).cast("long").alias("form_n"),
        ),
        "spelling_forms",
    )
    ends = roots(judged.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("up")))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
