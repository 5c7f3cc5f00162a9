"""Near-dedup, substring dedup and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallycart.llm import line_dedup, minhash_dedup, substring_dedup
from tallycart.llm.components import components
from tests.llm.conftest import sentence


def split(text):
    return (text or "").encode().split()


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute_components(docs):
    sets = [(i, shingle_set(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a < b and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def test_near_duplicates(make_docs, some_docs):
    got = minhash_dedup.near_duplicates(make_docs(some_docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(some_docs)
    assert len(got) == len(some_docs)


def test_near_duplicates_of_large_groups(make_docs):
    """A group of near copies whose pairs aren't all linked, and copies of one of them."""
    rnd = random.Random(5)
    base = sentence(rnd, 150).split()
    docs = []
    for i in range(120):
        own = list(base)
        for _ in range(4):
            own[rnd.randrange(len(own))] = f"y{rnd.randrange(10**6)}"
        docs.append((i, " ".join(own)))
    docs += [(i, docs[7][1]) for i in range(200, 300)] + [(i, sentence(rnd, 80)) for i in range(300, 340)]
    got = minhash_dedup.near_duplicates(make_docs(docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs)


def test_near_duplicates_in_tiles(make_docs, monkeypatch):
    """A large group, most of it not linked: dealt into parts, compared without a row for each pair."""
    rnd = random.Random(6)
    base = sentence(rnd, 150).split()
    docs = []
    for i in range(150):
        own = list(base)
        for _ in range(rnd.randrange(3, 14)):
            own[rnd.randrange(len(own))] = f"z{rnd.randrange(10**6)}"
        docs.append((i, " ".join(own)))
    docs += [(200 + i, docs[i][1]) for i in range(20)] + [(3, None), (300, docs[3][1].upper()), (300, docs[4][1])]
    for name, most in (("BUCKET", 16), ("FAMILY", 8), ("SPREAD", 4), ("LARGEST", 32)):
        monkeypatch.setattr(minhash_dedup, name, most)
    made = []
    monkeypatch.setattr(minhash_dedup, "links", lambda *args, run=minhash_dedup.links: made.append(run(*args)) or made[0])
    got = minhash_dedup.near_duplicates(make_docs(docs)).collect()
    assert by_id(got) == brute_by_id(docs)
    assert len({r.component_id for r in got}) > 20
    assert made[0].count() <= 150 * (150 // 32)  # at most a row for each text and tile


@pytest.mark.parametrize("cuts", [[4], [1, 1, 2, 3], [2, 5, 9], []])
def test_groups_over_batches(cuts):
    """Groups stay whole wherever the batches end."""
    keys = [1, 1, 1, 2, 3, 3, 3, 3, 3, 4]
    table = pa.table({"k": pa.array(keys, pa.int64()), "v": pa.array(range(10), pa.int64())})
    ends = [0, *cuts, 10]
    batches = [b for x, y in zip(ends, ends[1:]) for b in table.slice(x, y - x).combine_chunks().to_batches()]
    groups = [
        batch.column(1).to_pylist()[x:y]
        for batch, bounds in minhash_dedup._whole(iter(batches), 1)
        for x, y in zip(bounds, bounds[1:])
    ]
    assert groups == [[0, 1, 2], [3], [4, 5, 6, 7, 8], [9]]


def test_near_duplicates_odd_tables(make_docs, odd_docs):
    rows = minhash_dedup.near_duplicates(make_docs([*odd_docs, (None, "no id")])).collect()
    assert len(rows) == len(odd_docs)
    assert {r.component_id for r in rows if r.doc_id == 90} == {3}
    assert minhash_dedup.near_duplicates(make_docs([])).count() == 0
    assert minhash_dedup.near_duplicates(make_docs([(1, None), (2, "")])).count() == 2


def by_id(rows):
    """The rows' shingle counts with the component of their id."""
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def brute_by_id(docs):
    named = brute_components(docs)
    return Counter((i, len(shingle_set(t)), named[i][1]) for i, t in docs)


@pytest.mark.parametrize("hot", [0, 40])
def test_near_duplicates_with_repeated_ids(make_docs, odd_docs, hot):
    """Every text has its own links, whichever of an id's texts hashes lower."""
    rnd = random.Random(8)
    docs = [d for d in odd_docs if d[0] != 80] + [(91, None), (70, "one"), (6, ""), (6, odd_docs[0][1])]
    for i in range(1000, 1040, 4):  # (1, A), (1, B), a near copy of each, a copy of B
        texts = [sentence(rnd, 90), sentence(rnd, 90)]
        docs += [(i, t) for t in texts] + [(i + 1 + k, f"{t} more") for k, t in enumerate(texts)] + [(i + 3, texts[1])]
    for i in range(hot):  # one id with many texts, each with a near copy
        text = sentence(rnd, 60)
        docs += [(2000, text), (2001 + i, f"{text} more"), (2001 + i, sentence(rnd, 20))]
    rnd.shuffle(docs)
    got = minhash_dedup.near_duplicates(make_docs(docs)).collect()
    assert by_id(got) == brute_by_id(docs)
    left = {r.doc_id for r in minhash_dedup.one_of_each(make_docs(docs)).collect()}
    assert left == {i for i, (_, c) in brute_components(docs).items() if i == c}


def test_one_of_each(make_docs, some_docs):
    docs = make_docs([*some_docs, (None, "no id")])
    left = minhash_dedup.one_of_each(docs)
    want = {i for i, (_, c) in brute_components(some_docs).items() if i == c}
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == want | {None}
    assert minhash_dedup.one_of_each(make_docs([])).count() == 0


def test_components_of_a_chain_a_hub_and_nothing(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(3, 3), (None, 4), (61, 60), (60, 8)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 62)}}
    assert dict(got) == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(docs, window):
    first = {}
    for i, t in docs:
        w = split(t)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in docs:
        w = split(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return Counter(out)


@pytest.mark.parametrize("window,gram", [(50, 20), (6, 2)])
def test_remove_repeats(make_docs, odd_docs, window, gram):
    got = substring_dedup.remove_repeats(make_docs([*odd_docs, (None, "no id")]), window, gram).collect()
    assert Counter(tuple(r) for r in got) == brute_removed(odd_docs, window)


def test_remove_repeats_of_nothing(make_docs):
    assert substring_dedup.remove_repeats(make_docs([])).count() == 0
    rows = substring_dedup.remove_repeats(make_docs([(1, None), (2, "a b")])).collect()
    assert {tuple(r) for r in rows} == {(1, 0, 0, ""), (2, 2, 0, "a b")}


SPACE = " \t\n\x0b\f\r"


def line_key(line):
    return line.strip(SPACE).encode().lower().decode()


def brute_lines(docs, chars, least):
    where = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= chars:
                where[line_key(line)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(where[line_key(x)]) >= least and i < max(where[line_key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("chars,least", [(40, 5), (1, 2)])
def test_line_counts(make_docs, odd_docs, chars, least):
    got = line_dedup.line_counts(make_docs([*odd_docs, (None, "no id")]), chars, least).collect()
    assert Counter(tuple(r) for r in got) == brute_lines(odd_docs, chars, least)


def test_dedup_lines_keeps_columns(make_docs, odd_docs):
    docs = make_docs([*odd_docs, (None, odd_docs[30][1]), (None, None)])
    left = line_dedup.dedup_lines(docs)
    assert left.schema == docs.schema or left.dtypes == docs.dtypes
    assert left.count() == docs.count()
    assert Counter(r.text for r in left.filter("doc_id is null").collect()) == Counter([odd_docs[30][1], None])
    assert line_dedup.dedup_lines(make_docs([])).count() == 0


def test_keep_bitmaps_are_runs_of_kept_lines(make_docs):
    line = "x" * 50
    docs = make_docs([(i, f"a\n{line}\nb\n{line}\n{line}") for i in range(6)])
    rows = line_dedup.keep_bitmaps(docs).collect()
    assert {r.doc_id for r in rows} == set(range(5))
    assert all([tuple(x) for x in r.keep_runs] == [(0, 1), (2, 1)] and r.n_dropped == 3 for r in rows)


def test_line_dedup_runs_no_python(make_docs):
    plan = line_dedup.line_counts(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_kept_digest_of_all_lines_dropped(make_docs):
    rows = line_dedup.line_counts(make_docs([(i, "y" * 45) for i in range(5)]))
    digests = {r.doc_id: r.d for r in rows.select("doc_id", F.sha2("text", 256).alias("d")).collect()}
    assert digests[0] == hashlib.sha256(b"").hexdigest() != digests[4]
