"""Quality rules, secret scan and decontamination against brute force."""

from __future__ import annotations

import itertools
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallycart.llm import quality_crf, secret_scan, tiling
from tallycart.llm import words as W

SF_DIR = "/root/testdata/sf0.01"


def brute_page(text):
    text = text or ""
    words = text.encode().split()
    lines = text.split("\n")
    dup = sum(bool(x.encode().split()) and x in lines[:i] for i, x in enumerate(lines))
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_base_counts(make_docs, odd_docs):
    docs = [*odd_docs, (100, "a | b\n\na | b\n x#%\na | b"), (101, "a b c a b c\nd"), (None, "no id")]
    got = quality_crf.assess(make_docs(docs), quality_crf.LineField()).collect()
    told = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got]
    assert Counter(told) == Counter((i, *brute_page(t)) for i, t in docs)
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.content_share >= 0.5)


def test_decoding_finds_the_best_labels():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        n, change = rnd.integers(0, 8), -abs(rnd.normal())
        lines = rnd.normal(size=(n, 3))
        field = quality_crf.LineField(tuple(rnd.normal(size=3)), change)
        score = lines @ np.array(field.weights)

        def total(labels, score=score, change=change):
            return sum(s for s, x in zip(score, labels) if x) + change * sum(a != b for a, b in zip(labels, labels[1:]))

        best = max((total(x) for x in itertools.product([False, True], repeat=int(n))), default=0)
        assert total(field.decode(lines).tolist()) == pytest.approx(best)


def test_expected_labels_are_those_of_all_labellings():
    rnd = np.random.default_rng(4)
    score, change = rnd.normal(size=(3, 4)), -0.7
    live = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)
    share, changes = quality_crf._expected(score, change, live)
    for row in range(3):
        n = live[row].sum()
        all_ = list(itertools.product([0, 1], repeat=int(n)))
        moves = [sum(a != b for a, b in zip(x, x[1:])) for x in all_]
        weight = np.exp([np.dot(x, score[row, :n]) + change * m for x, m in zip(all_, moves)])
        weight /= weight.sum()
        assert share[row, :n] == pytest.approx(weight @ np.array(all_))
        assert changes[row] == pytest.approx(weight @ np.array(moves))


def test_field_without_labels(make_docs, spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_crf.fit(quality_crf.sample_lines(make_docs([(1, "a b")]), empty)) == quality_crf.LineField()
    assert quality_crf.assess(make_docs([]), quality_crf.LineField()).count() == 0
    docs = make_docs([(1, "word. " * 20), (None, None)])
    assert quality_crf.keep_content(docs, quality_crf.LineField()).columns == docs.columns


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    """Documents that the field wasn't fitted on: clean ones stay, junk goes."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    field = quality_crf.fit(quality_crf.sample_lines(docs, labels.filter("doc_id % 2 = 0")))
    rest = quality_crf.assess(docs, field).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed")
    seen = Counter((r.quality, r.kept) for r in rest.collect())
    assert seen[1, True] / (seen[1, True] + seen[1, False]) > 0.98
    assert seen[0, False] / max(1, seen[0, True] + seen[0, False]) > 0.8


def brute_secrets(text):
    text = text or ""
    found = []
    for number, (name, pattern, group, least, role) in enumerate(secret_scan.KINDS):
        flat = re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in m[1]) + ")", pattern)
        for m in re.finditer(flat, text):
            mixed = all(re.search(c, m[group]) for c in ("[A-Z]", "[a-z]", "[0-9]"))
            if len(m[group]) >= least and (name != "mixed" or mixed):
                found.append((m.start(), number, m.end(), role))
    told = []
    for start, number, end, _ in found:
        needs = secret_scan.NEEDS.get(secret_scan.KINDS[number][0], [])
        if all(any(r == need and abs(s - start) <= secret_scan.SCOPE for s, _, _, r in found) for need in needs):
            told.append((start, number, end))

    def listed(spans):
        return ",".join(f"{secret_scan.KINDS[k][0]}:{s}:{e}" for s, k, e in sorted(spans))

    base = [t for t in told if t[1] < secret_scan.BASE]
    return *(sum(t[1] == n for t in base) for n in range(3)), listed(base), listed(told)


def test_secrets(make_docs, odd_docs):
    rnd = random.Random(9)
    parts = [
        "password = ", "Api_Key:'", "abcdefghijklmnop", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "token=", "é ü ",
        "client_id: abcd1234", "https://a.example/x?y", "Zz9/" * 8, " ", "\n", "x " * 60, "secret=token:", "'", "AKIAAKIA",
    ]
    docs = [(200 + i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(25)))) for i in range(300)]
    docs += [*odd_docs, (190, "0123456789abcdef " * 3000), (190, "token=aaaaaaaaaaaaaaaa")]
    got = secret_scan.scan(make_docs([*docs, (None, "password=aaaaaaaaaaaaaaa")])).collect()
    told = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_spans, r.spans) for r in got]
    assert Counter(told) == Counter((i, *brute_secrets(t)) for i, t in docs)
    assert any(n in r[5] for r in told for n in ("mixed", "named_id", "endpoint"))
    assert secret_scan.scan(make_docs([])).count() == 0


def test_secret_scan_runs_no_python(make_docs):
    plan = secret_scan.scan(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_tiles(a, b, least):
    least = min(least, len(a))
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while least:
        best = None
        for i in range(len(a)):
            for t in range(len(b)):
                n = 0
                while i + n < len(a) and t + n < len(b) and free_a[i + n] and free_b[t + n] and a[i + n] == b[t + n]:
                    n += 1
                if n >= least and (best is None or (-n, i, t) < best):
                    best = (-n, i, t)
        if best is None:
            return out
        n, i, t = -best[0], *best[1:]
        out.append((i, t, n))
        free_a[i : i + n] = free_b[t : t + n] = [False] * n
    return out


@pytest.mark.parametrize("first", [3, 8, 20])
def test_tiles(monkeypatch, first):
    monkeypatch.setattr(tiling, "FIRST_SEARCH", first)
    rnd = random.Random(first)
    for _ in range(300):
        k = rnd.choice([2, 3, 6])
        a = [rnd.randint(0, k) for _ in range(rnd.randint(0, 25))]
        b = [rnd.randint(0, k) for _ in range(rnd.randint(0, 35))]
        x, y = (W.mix(np.array(v, np.uint64) + np.uint64(1)) for v in (a, b))
        assert sorted(tiling.tiles(x, y, 3)) == sorted(brute_tiles(a, b, 3))


def brute_contaminated(docs, items):
    found = {}
    for i, text in docs:
        words = tiling.normal_words((text or "").encode())
        hits = []
        for name, item in items:
            own = tiling.normal_words((item or "").encode())
            if name is not None and own:
                covered = sum(n for *_, n in brute_tiles(own, words, 5))
                if 100 * covered >= 50 * len(own):
                    hits.append((-covered / len(own), name, covered, len(own)))
        if hits:
            found[i] = (len({h[1] for h in hits}), *min(hits)[1:])
    return found


def test_contamination(make_docs, spark):
    rnd = random.Random(6)
    items = [(i, " ".join(f"b{rnd.randrange(300)}" for _ in range(rnd.randrange(12, 30))) + ".") for i in range(12)]
    items += [(20, "only three words"), (21, ""), (22, None), (None, "b1 b2 b3 b4 b5 b6"), (3, items[5][1]), (30, items[7][1])]
    docs = []
    for i in range(60):
        words = [f"d{rnd.randrange(200)}" for _ in range(rnd.randrange(0, 60))]
        item = rnd.choice(items[:12])[1].split()
        if i % 3 == 0:  # reordered, in capitals, with punctuation
            cut = len(item) // 2
            words[10:10] = [w.upper() + "," for w in item[cut:]] + ["gap"] + item[:cut]
        elif i % 3 == 1:
            words[5:5] = item[: rnd.randrange(len(item) + 1)]
        docs.append((i, " ".join(words)))
    docs += [(70, None), (71, ""), (72, "ONLY three, words!"), (73, f"x {items[5][1]} " * 40), (74, "only three"), (None, items[2][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = tiling.contaminated(make_docs(docs), bench).collect()
    assert {r.doc_id: (r.n_items, r.item_id, r.covered, r.size) for r in got} == brute_contaminated(docs, items)
    left = tiling.decontaminate(make_docs(docs), bench)
    assert left.columns == make_docs([]).columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - set(brute_contaminated(docs, items))
    assert tiling.contaminated(make_docs([]), bench).count() == 0
    assert tiling.contaminated(make_docs(docs), bench.limit(0)).count() == 0
    assert tiling.decontaminate(make_docs(docs), bench.limit(0)).count() == len(docs)
