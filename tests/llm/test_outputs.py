"""Token files, packing, web archives and chat formatting: exact round trips."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycart.llm import chat_format, encoder, packing, token_files, warc

VOCABULARY = encoder.vocabulary()


@pytest.fixture(scope="module")
def tokenizer():
    return encoder.Tokenizer.from_file(VOCABULARY)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder_equals_the_library(tokenizer, odd_docs):
    rnd = random.Random(1)
    parts = ["a", "b ", "\n", " ", "'s", "é", "　", "1", ".", "\t", "\x1c", "\r", "<|endoftext|>", "日本", "Word"]
    texts = [t for _, t in odd_docs] + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(3000)]
    own = encoder.Encoder(VOCABULARY, limit=50)  # small, so that it forgets
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        for text, ids in zip(some, own.encode(some)):
            assert ids.tolist() == ids_of(tokenizer, text)[:-1]


def test_encoder_keeps_the_units_it_meets_often(monkeypatch):
    own, seen = encoder.Encoder(VOCABULARY, limit=20), []
    whole = own._whole
    monkeypatch.setattr(own, "_whole", lambda text: seen.append(text) or whole(text))
    for i in range(60):
        own.encode([f"a often {i}x"])
    assert sum(text.count(" often") for text in seen) == 1
    assert len(own.units) + len(own.units.older) <= 24


def test_encoder_looks_a_unit_up_once_for_many_texts():
    asked = []

    class Counting(encoder._Units):
        def __getitem__(self, unit):
            asked.append(unit)
            return super().__getitem__(unit)

    own = encoder.Encoder(VOCABULARY)
    own.units = Counting(100)
    found = own.encode(["a the cat the", "the the\nthe", None, "", "x the  the", "<|endoftext|> the"])
    assert asked.count("the") == 1
    assert [len(f) for f in found] == [4, 4, 0, 0, len(own._whole("x the  the")), 2]
    assert own.encode([]) == []



def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, make_docs, some_docs, tokenizer, tmp_path):
    docs = [*some_docs, (None, "no id")]
    parts = token_files.write_token_files(make_docs(docs), str(tmp_path / "t"), VOCABULARY)
    got = token_files.read_documents(parts).orderBy("doc_id").collect()
    start, want = 0, []
    for i, text in sorted(some_docs):
        ids = ids_of(tokenizer, text)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    for row in parts.collect():
        part = token_files.TokenPart(row.path)
        assert part.offsets[0] == row.base and len(part.tokens) == row.n_tokens and part.tokens.dtype == np.uint16
    empty = token_files.write_token_files(make_docs([]), str(tmp_path / "e"), VOCABULARY)
    assert token_files.read_documents(empty).count() == 0


def test_first_fit_decreasing():
    rnd = random.Random(2)
    for _ in range(200):
        sizes = [rnd.randint(1, 20) for _ in range(rnd.randint(0, 60))]
        bins, want = [], [None] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            b = next((b for b, used in enumerate(bins) if used + sizes[i] <= 20), len(bins))
            bins += [0] * (b == len(bins))
            want[i] = (b, bins[b])
            bins[b] += sizes[i]
        assert packing.pack(sizes, 20) == want


def test_packing(monkeypatch, make_docs, odd_docs, tokenizer):
    monkeypatch.setattr(packing, "GROUP", 16)  # several groups
    rows = packing.pack_documents(make_docs([*odd_docs, (None, "no id")]), VOCABULARY).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        docs[r.doc_id].append((r.start, r.doc_tokens, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i in {i for i, _ in odd_docs}:
        texts = [ids_of(tokenizer, t) for j, t in odd_docs if j == i]
        assert sum(len(x[2]) for x in docs[i]) == sum(map(len, texts))
        if len(texts) == 1:
            assert sum((x[2] for x in sorted(docs[i])), []) == texts[0]
            assert {x[1] for x in docs[i]} == {len(texts[0])}
    used = []
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        used.append(end)
        assert end <= 1024
    # Only a group's last bins may be less than half full.
    assert sum(u <= 512 for u in used) <= -(-len(odd_docs) // 16) * 2
    assert packing.pack_documents(make_docs([]), VOCABULARY).count() == 0
    assert [packing.padded_length(n) for n in (1, 3, 512, 1000, 1024)] == [1, 1024, 512, 1024, 1024]


PAGES = "page_id long, url string, html string, captured_at timestamp, sum string, offset long"


def test_archives_and_index(spark, tmp_path):
    rnd = random.Random(8)
    rows = []
    for i in range(150):
        url = rnd.choice(["http://www.a.example/x", "https://b.example:8443/y?z=1", f"http://c.example/{i}", None, "http://[bad", "no url\n at all"])
        html = rnd.choice(["<p>same</p>", "", None, f"<p>é{i}</p>\r\n\r\n" * rnd.randrange(1, 9)])
        rows.append((i, url, html, None if i % 7 == 0 else 1_700_000_000 + rnd.randrange(5)))
    rows += [rows[0], (None, "http://x.example", "x", 0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, t long").select(
        "page_id", "url", "html", F.timestamp_seconds("t").alias("captured_at"), F.lit("s").alias("sum"), F.lit(1).alias("offset")
    )
    folder = str(tmp_path / "w")
    runs = warc.write_archives(frame.repartition(3), folder, most=7, sparse=2)
    assert runs.count() > 20
    captures = warc.merge_index(runs, folder, fan_in=4, per_range=9, sparse=2).orderBy("number", "place").collect()
    keys = [(r.url_key, r.captured_at, r.page_id) for r in captures]
    assert keys == sorted(keys) and len(keys) == 151 and len({r.number for r in captures}) > 9
    archives = runs.select(F.regexp_replace("path", r"\.\d{4}\.cdx$", ".warc.gz").alias("archive")).distinct()
    records = warc.read_archives(archives).collect()
    assert {(r.archive, r.offset) for r in records} == {(r.archive, r.offset) for r in captures}
    first = {}
    for i, _, html, _ in rows[:150]:
        first.setdefault(html or "", i)
    for r in records:
        payload = (rows[r.page_id][2] or "").encode()
        head = first[payload.decode()]
        want = ("revisit", head) if head < r.page_id else ("response", None)
        assert (r.record_type, r.refers_to) == want
        assert (r.payload_bytes, r.payload_digest) == (len(payload), warc.digest32(payload))
    large = warc.write_archives(frame, str(tmp_path / "v"), min_bytes=1)
    archives = large.select(F.regexp_replace("path", r"\.\d{4}\.cdx$", ".warc.gz").alias("archive")).distinct()
    assert not [r for r in warc.read_archives(archives).collect() if r.payload_bytes == 0 and r.record_type == "revisit"]
    none = warc.write_archives(frame.limit(0), str(tmp_path / "e"))
    assert warc.merge_index(none, str(tmp_path / "e")).count() == 0


def test_loser_tree():
    rnd = random.Random(3)
    for k in range(20):
        streams = [sorted((rnd.randint(0, 30), "", i) for _ in range(rnd.randint(0, 9))) for i in range(k)]
        assert list(warc.LoserTree([iter(s) for s in streams])) == sorted(x for s in streams for x in s)


def test_members_of_any_chunk_size():
    data = b"".join(warc.record(i, f"http://a/{i}", "t", b"<h>\r\n\r\n" * i, 1 if i % 2 else None) for i in range(40))
    for size in (1, 7, 1000, len(data)):
        found = list(warc.members(data[i : i + size] for i in range(0, len(data), size)))
        assert len(found) == 40 and sum(x[1] for x in found) == len(data)
    assert warc.parse(found[8][2])[1] == b"<h>\r\n\r\n" * 8
    with pytest.raises(ValueError):
        list(warc.members([data[:-3]]))


def test_template_round_trip():
    rnd = random.Random(4)
    parts = ["\\", "###", " ", "### ", "</turn>", " </turn>\n", "a", ":", ": ", "\n", "é", "#"]
    for _ in range(3000):
        turns = [tuple("".join(rnd.choice(parts) for _ in range(rnd.randrange(8))) for _ in "rt") for _ in range(rnd.randrange(1, 4))]
        pieces = [chat_format.format_turn(*t) for t in turns]
        assert list(chat_format.parse_turns("".join(p[0] for p in pieces))) == turns
        assert [chat_format.unescape(p[s:e]) for p, s, e in pieces] == [t for _, t in turns]


def test_layouts(spark):
    records = [
        (1, {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "more": {"x": [1]}}),
        (2, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}),
        (3, {"instruction": "i", "output": "o"}),
        (4, {"instruction": "i", "input": "n", "output": "o"}),
        (5, {"prompt": "p", "completion": "c", "id": 5}),
        (6, {"question": "q", "answer": "a"}),
        (7, {"conv_id": 7, "turn": 4, "role": "user", "text": "t"}),
        (8, {"something": "else"}),
    ]
    rows = [(i, json.dumps(r)) for i, r in records] + [(9, "not json"), (10, None), (None, json.dumps(records[2][1]))]
    frame = spark.createDataFrame(rows, "conv_id long, record string")
    got = defaultdict(list)
    for r in chat_format.canonical_turns(frame).orderBy("turn").collect():
        got[r.conv_id].append((r.turn, r.role, r.text))
    assert got[1] == [(0, "user", "q"), (1, "assistant", "a")] and got[2] == [(0, "user", "q"), (1, "assistant", "")]
    assert got[4] == [(0, "system", "i"), (1, "user", "n"), (2, "assistant", "o")] and got[7] == [(4, "user", "t")]
    assert got[3] == got[None] and len(got) == 8
    assert {r.conv_id for r in chat_format.unknown_records(frame).collect()} == {8, 9, 10}
    assert chat_format.canonical_turns(frame.limit(0)).count() == 0


EXAMPLES = {
    "turn_row": {"conv_id": 7, "turn": 4, "role": "user", "text": "t"},
    "messages": {"messages": [{"role": "user", "content": "m"}]},
    "from_value": {"conversations": [{"from": "human", "value": "v"}]},
    "dialogue": {"dialog": [{"speaker": "bot", "text": "d"}]},
    "instruction": {"instruction": "i", "output": "o"},
    "instruction_input": {"instruction": "i", "input": "n", "output": "o"},
    "prompt_completion": {"prompt": "p", "completion": "c"},
    "prompt_response": {"prompt": "p", "response": "r"},
    "question_answer": {"question": "q", "answer": "a"},
}


def test_layouts_with_fields_of_others(spark):
    assert set(EXAMPLES) == set(chat_format.LAYOUTS)
    turns = {name: chat_format.turns_of(json.dumps(r)) for name, r in EXAMPLES.items()}
    sizes = {name: len(layout.paths) for name, layout in chat_format.LAYOUTS.items()}
    fields = {**EXAMPLES["turn_row"], **EXAMPLES["instruction_input"], **EXAMPLES["prompt_completion"], "response": "r", **{k: v for n in ("messages", "from_value", "dialogue", "question_answer") for k, v in EXAMPLES[n].items()}}
    records, want = [], []
    for name, record in EXAMPLES.items():
        for extra in [{k: v} for k, v in fields.items()] + list(EXAMPLES.values()):
            both = {**extra, **record}
            known = [n for n in EXAMPLES if EXAMPLES[n].keys() <= both.keys()]
            assert name in known
            best = max(known, key=lambda n: (sizes[n], -list(EXAMPLES).index(n)))
            records.append((len(records), json.dumps(both)))
            want += [(len(records) - 1, *t) for t in turns[best]]
    n = len(records)
    odd = [{"messages": [{"role": "u", "content": "c"}, "x"]}, {"messages[]": {"role": "u", "content": "c"}}, {**EXAMPLES["turn_row"], "turn": "4"}, {"prompt": "p", "text": "t"}, {"": EXAMPLES["question_answer"]}]
    rows = records + [(n + i, json.dumps(r)) for i, r in enumerate(odd)] + [(n + 9, json.dumps({**odd[0], **EXAMPLES["question_answer"]}))]
    read, unknown = chat_format.read_records(spark.createDataFrame(rows, "conv_id long, record string"))
    want += [(n + 9, *t) for t in turns["question_answer"]]
    assert sorted(tuple(r) for r in read.collect()) == sorted(want)
    assert sorted(r.conv_id for r in unknown.collect()) == [n, n + 1, n + 2, n + 3, n + 4]


def test_chats_read_back(spark):
    rnd = random.Random(5)
    hard = "\\### Assistant: </turn> ok"
    rows = [(c, t, rnd.choice(["user", "assistant", "to:ol", None]), rnd.choice([hard, None, "", "é" * 50])) for c in [None, *range(20)] for t in range(rnd.randrange(1, 6))]
    rows += [(3, 1, "assistant", "again")] * 2 + [(4, None, "user", "no number")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_chats(turns.repartition(3), most=60)  # many parts
    assert formatted.filter("part > 1").count()
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    for r in chat_format.read_chats(formatted).collect():
        parts = sorted(own.pop(r.conv_id))
        said = "".join(f"{p[3]}\n{p[5]}\n" for p in parts)
        loss = "".join(p[5] for p in parts if p[3] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(parts), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        marked = [(re.sub(r"(\\|###|</turn>|:)", r"\\\1", p[3]), re.sub(r"(\\|###|</turn>)", r"\\\1", p[5])) for p in parts]
        assert r.formatted_chars == sum(len(f"### {a}: {b} </turn>\n") for a, b in marked)
    assert not own
    assert chat_format.read_chats(chat_format.format_chats(turns.limit(0))).count() == 0
