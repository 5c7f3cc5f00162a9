"""The pipeline's stages on a small table, against brute force."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from tallycart.llm import quality_crf, tiling
from tallycart.llm.queries import CHECKS, QUERIES
from tests.llm.test_dedup import brute_components, brute_lines
from tests.llm.test_outputs import ids_of, tokenizer  # noqa: F401
from tests.llm.test_text_rules import brute_contaminated

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_pipeline(spark, tokenizer):  # noqa: F811
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    field = quality_crf.fit(quality_crf.sample_lines(table, labels))
    docs = [(r.doc_id, r.text) for r in table.collect()]
    docs = [d for d in docs if quality_crf.verdict(quality_crf.read_page((d[1] or "").encode()), field)[3]]
    docs = [(i, text) for i, _, _, text in brute_lines(docs, 40, 5)]
    linked = brute_components(docs)
    docs = [d for d in docs if linked[d[0]][1] == d[0]]
    # Brute tiling is slow: only texts that share a run of five words with an item can be hit.
    runs = {tuple(w[i : i + 5]) for _, t in items for w in [tiling.normal_words(t.encode())] for i in range(len(w) - 4)}
    near = [
        (i, t) for i, t in docs for w in [tiling.normal_words(t.encode())] if any(tuple(w[k : k + 5]) in runs for k in range(len(w) - 4))
    ]
    gone = brute_contaminated(near, items)
    want = {i: len(ids_of(tokenizer, t)) for i, t in docs if i not in gone}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.doc_tokens for r in got} == want
    assert sum(r.length for r in got) == sum(want.values())


def test_registration():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(CHECKS) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(set(CHECKS)))
def test_equals_sql(spark, name):
    import check_queries

    con = check_queries.connect(SF_DIR)
    assert check_queries.compare(spark, con, SF_DIR, name) == ""
