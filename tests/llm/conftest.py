from __future__ import annotations

import random

import pytest

# Extra columns whose names the operators use inside themselves.
EXTRA = "version long, kept boolean, key string, hash long, _text string, _key long, intervals string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with clashing extra columns, over several partitions."""

    def build(pairs, parts=3):
        rows = [(i, t, None, "s", len(t or ""), 7, True, "k", None, "x", 1, None) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(parts)

    return build


def sentence(rnd: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs():
    """Copies, near copies, shared passages and lines, odd white space, nulls, a very long text."""
    rnd = random.Random(11)
    base = sentence(rnd, 120)
    passage = sentence(rnd, 60)
    line = "This very line is in many documents, word for word."
    docs = [(i, base) for i in (5, 3, 9)]
    near = base.split()
    for i in range(20, 40):  # near copies of growing distance
        own = list(near)
        for _ in range(i - 19):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(1000)}"
        docs.append((i, " ".join(own)))
    docs += [(i, f"{sentence(rnd, 30)}\n{line}\n{sentence(rnd, 20)}") for i in range(50, 60)]
    docs += [(i, f"{sentence(rnd, 15)} {passage}\t{sentence(rnd, 5)}") for i in range(60, 66)]
    docs += [(70, None), (71, ""), (72, " \n\t "), (73, "one"), (74, "one"), (75, "ONE two"), (76, "one two")]
    docs += [(77, "\n\n"), (78, "é　ü  x\x1cy"), (79, f"  {line.upper()}  \n\r\n{line}")]
    docs += [(80, sentence(rnd, 6000, 3000)), (81, "same same same " * 40), (82, f"{base}\n{base}")]
    docs += [(90, base), (90, base), (91, passage), (91, sentence(rnd, 70))]
    return docs


@pytest.fixture(scope="session")
def some_docs(odd_docs):
    """The same without repeated ids."""
    seen = set()
    return [d for d in odd_docs if not (d[0] in seen or seen.add(d[0]))]
