"""The registered queries of this folder: each applies an operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.llm import (
    chat_format,
    line_dedup,
    minhash_dedup,
    packing,
    quality_crf,
    resample,
    secret_scan,
    simhash,
    spelling,
    substring_dedup,
    tiling,
    token_files,
    warc,
)
from tallycart.llm.encoder import vocabulary
from tallycart.session import scratch_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"


@query(
    "op3_substring_dedup",
    rf"""with docs as (select doc_id, {WORDS} as words from documents),
    places as (select doc_id, unnest(range(0, len(words) - 49)) as p, words from docs where len(words) >= 50),
    windows as (select doc_id, p, array_to_string(words[p + 1 : p + 50], ' ') as w from places),
    least as (select w, min(doc_id) as lo from windows group by w),
    hits as (select doc_id, list(p) as ps from windows join least using (w) where doc_id > lo group by doc_id),
    covered as (select distinct doc_id, unnest(range(p, p + 50)) as i from (select doc_id, unnest(ps) as p from hits)),
    gone as (select doc_id, count(*) as n, list(i) as spots from covered group by doc_id)
    select d.doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
      sha256(array_to_string(case when spots is null then words else
        list_transform(list_filter(range(len(words)), lambda i: not list_contains(spots, i)), lambda i: words[i + 1]) end, ' ')) as kept_sha256
    from docs d left join gone g using (doc_id)""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op1_minhash_dedup",
    rf"""with recursive docs as (select doc_id,
      list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ \t\n\x0B\f\r]+'), lambda w: w <> '') as words from documents),
    sets as (select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
      else list_distinct(list_transform(range(0, len(words) - 4), lambda i: array_to_string(words[i + 1 : i + 5], ' '))) end as s from docs),
    parts as (select doc_id, len(s) as n, unnest(s) as w from sets),
    shared as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as common
      from parts a join parts b on a.w = b.w and a.doc_id <> b.doc_id group by 1, 2),
    edges as (select x, y from shared where 100 * common >= 75 * (nx + ny - common)),
    reach(x, y) as (select doc_id, doc_id from sets union select r.x, e.y from reach r join edges e on r.y = e.x)
    select s.doc_id, len(s.s)::bigint as n_shingles, min(r.y) as component_id, min(r.y) = s.doc_id as kept
    from sets s join reach r on s.doc_id = r.x group by s.doc_id, s.s""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query("op8_quality_crf")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_crf.assess(docs, quality_crf.fit(quality_crf.sample_lines(docs, labels)))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    parts = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary())
    return token_files.read_documents(parts)


@query("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = tiling.contaminated(docs, table(spark, sf_dir, "benchmark")).alias("f")
    keys = docs.select("doc_id", F.xxhash64("text").alias("version")).alias("d")
    same = F.col("d.version").eqNullSafe(F.col("f.version")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
    return keys.join(found, same, "left").select(
        "d.doc_id",
        F.coalesce("f.n_items", F.lit(0)).alias("n_items"),
        "f.item_id",
        (F.col("f.covered") / F.col("f.size")).alias("coverage"),
        F.col("f.item_id").isNotNull().alias("contaminated"),
        F.col("f.item_id").isNull().alias("kept"),
    )


@query(
    "op4_line_dedup",
    """with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
    rows as (select doc_id, i, ls[i + 1] as line,
        translate(trim(ls[i + 1], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
      from (select doc_id, ls, unnest(range(len(ls))) as i from docs)),
    common as (select k, max(doc_id) as last from rows where length(k) >= 40
      group by k having count(distinct doc_id) >= 5),
    judged as (select doc_id, i, line, c.k is not null and doc_id < last as gone from rows left join common c using (k))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
    from judged group by doc_id""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.line_counts(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _secret_sql() -> str:
    def matches(n: int) -> str:
        name, pattern, group, least, role = secret_scan.KINDS[n]
        p = "'" + pattern.replace("'", "''") + "'"
        more = "".join(f" and regexp_matches(v, '{c}')" for c in ("[A-Z]", "[a-z]", "[0-9]")) if name == "mixed" else ""
        return f"""select doc_id, {n} as kind, '{role}' as role, a + g as start, a + g + w as "end" from (
          select doc_id, length(h[i]) as w, vs[i] as v, list_sum(list_transform(gs[1:i], lambda x: length(x))) as g,
            coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) as a
          from (select doc_id, h, gs, vs, unnest(range(1, len(h) + 1)) as i from (
            select doc_id, regexp_extract_all(t, {p}, 0) as h, regexp_split_to_array(t, {p}) as gs,
              regexp_extract_all(t, {p}, {group}) as vs from docs))) where length(v) >= {least}{more}"""

    every = " union all ".join(matches(n) for n in range(len(secret_scan.KINDS)))
    base, scope = secret_scan.BASE, secret_scan.SCOPE
    near = "exists (select 1 from parts p where p.doc_id = w.doc_id and p.role = '{}' and abs(p.start - w.start) <= " + f"{scope})"
    tests = {
        n: " and ".join(near.format(r) for r in secret_scan.NEEDS[k[0]])
        for n, k in enumerate(secret_scan.KINDS)
        if n >= base
    }
    weak = " or ".join(f"(kind = {n} and {test})" for n, test in tests.items())
    names = " ".join(f"when {n} then '{k[0]}'" for n, k in enumerate(secret_scan.KINDS))
    span = f"(case kind {names} end) || ':' || start || ':' || \"end\""
    counts = ", ".join(
        f"count(*) filter (kind = {n}) as n_{secret_scan.KINDS[n][0]}" for n in range(base)
    )
    return f"""with docs as (select doc_id, coalesce(text, '') as t from documents),
    parts as ({every}), told as (select * from parts w where kind < {base} or {weak})
    select d.doc_id, {counts},
      sha256(coalesce(string_agg({span}, ',' order by start, kind) filter (kind < {base}), '')) as base_sha256,
      coalesce(string_agg({span}, ',' order by start, kind), '') as spans
    from docs d left join told using (doc_id) group by d.doc_id"""


@query("op2_secret_scan", _secret_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


@query(
    "op6_warc_index",
    """with p as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
    f as (select h, min(page_id) as first from p group by h),
    x as (select p.*, first, list_transform(range(8), lambda k: ('0x' || substr(p.h, 5 * k + 1, 5))::bigint) as c from p join f using (h))
    select page_id, octet_length(encode(payload))::bigint as payload_bytes,
      array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((c[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31)::int + 1, 1)), '') as payload_digest,
      case when page_id > first then 'revisit' else 'response' end as record_type,
      case when page_id > first then first end as refers_to from x""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    # The table has no time of capture: one page a second stands in for it.
    pages = table(spark, sf_dir, "pages").withColumn(
        "captured_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod("page_id", F.lit(1_000_000_000)))
    )
    runs = warc.write_archives(pages, folder)
    captures = warc.merge_index(runs, folder)
    archives = runs.select(F.regexp_replace("path", r"\.\d{4}\.cdx$", ".warc.gz").alias("archive")).distinct()
    records = warc.read_archives(archives)
    # The records that the merged index names. The entries compress so well that adaptive
    # execution would take them for a small table and broadcast them.
    named = captures.select("archive", "offset").hint("merge")
    return records.join(named, ["archive", "offset"]).drop("archive", "offset")


CONTROL = r"(\\|###|</turn>)"


@query(
    "op7_chat_format",
    rf"""with c as (select conv_id, turn, role, coalesce(text, '') as text from conversations
      union all select -7, i, case i when 0 then 'user' else 'assistant' end, '\### Assistant: </turn> ok' from range(2) t(i)),
    r as (select *, length(regexp_replace(text, '{CONTROL}', '_\0', 'g')) as n,
      length(regexp_replace(role, '(\\|###|</turn>|:)', '_\0', 'g')) as m from c)
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
      coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
      sum(4 + m + 2 + n + 9)::bigint as formatted_chars
    from r group by conv_id""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    turn = F.struct("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    records = rows.unionByName(extra).select(
        "conv_id", F.to_json(turn, {"ignoreNullFields": "false"}).alias("record")
    )
    turns = chat_format.canonical_turns(records)
    return chat_format.read_chats(stage(chat_format.format_chats(turns), "chats"))


def _crc32_sql(hex_text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of the bytes spelled by the hex string ``hex_text``."""
    return f"""xor(list_reduce([4294967295::bigint] || list_transform(range(0, length({hex_text}), 2),
        lambda i: ('0x' || substr({hex_text}, i + 1, 2))::bigint),
      lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda e, z: xor(e >> 1, 3988292384 * (e & 1)))),
      4294967295::bigint)"""


_UP, _LO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op11_spelling_variants",
    f"""with recursive runs as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z{chr(0xC0)}-{chr(0xFF)}]+')) as r
      from documents),
    low as (select doc_id, translate(r, '{_UP}', '{_LO}') as w from runs where length(r) >= 7),
    hs as (select w, {_crc32_sql("x")} as h from (select w, hex(encode(doc_id::varchar || ':' || w)) as x from low)),
    cut as (select case when h % 31 = 0 then substr(w, 1, (h % length(w))::int) || substr(w, (h % length(w))::int + 2)
      else w end as w from hs),
    words as (select w as word, count(*) as n from cut where length(w) >= 7 group by w having count(*) >= 2),
    dels as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as d from words, range(length(word)) t(i)),
    near as (select a.word as x, b.word as y, b.n as yn from dels a join dels b on a.i = b.i and a.d = b.d and a.word <> b.word
      union select a.word, b.word, b.n from dels a join words b on a.d = b.word
      union select b.word, a.word, a.n from dels a join words b on a.d = b.word),
    best as (select x, count(*) as n_near, max(yn) as top_n, first(y order by yn desc, y) as top from near group by x),
    res as (select w.word, w.n, coalesce(b.n_near, 0) as n_near,
        case when b.top_n >= 10 * w.n then b.top end as form, case when b.top_n >= 10 * w.n then b.top_n end as form_n
      from words w left join best b on w.word = b.x),
    chain(word, root, depth) as (select word, word, 0 from res
      union all select c.word, r.form, c.depth + 1 from chain c join res r on c.root = r.word where r.form is not null),
    ends as (select word, arg_max(root, depth) as root from chain group by word)
    select r.word, r.form, e.root, r.n::bigint as n, r.n_near::bigint as n_near, r.form_n::bigint as form_n
    from res r join ends e using (word)""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_simhash_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '" + _UP + "', '" + _LO + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op13_importance_resample",
    f"""with d as (select row_number() over () as rid, doc_id, {_TERMS} as ws from documents),
    bw as (select unnest({_TERMS}) as w from benchmark),
    dw as (select rid, unnest(ws) as w from d),
    vocab as (select distinct w from (select w from dw union all select w from bw)),
    crc as (select w, {_crc32_sql("x")} % 10000 as k from (select w, hex(encode(w)) as x from vocab)),
    s as (select k, count(*) as s from dw join crc using (w) group by k),
    t as (select k, count(*) as t from bw join crc using (w) group by k),
    tot as (select (select count(*) from dw)::double as big_s, (select count(*) from bw)::double as big_t),
    g as (select r.range as k, floor(1000 * ln(((coalesce(t.t, 0) + 1)::double * (big_s + 10000))
        / ((coalesce(s.s, 0) + 1)::double * (big_t + 10000)))) as gain
      from range(10000) r left join s on s.k = r.range left join t on t.k = r.range, tot),
    wt as (select rid, sum(gain) as weight from dw join crc using (w) join g using (k) group by rid),
    sc as (select d.rid, d.doc_id, len(d.ws)::bigint as n_features, coalesce(wt.weight, 0) as weight,
        coalesce(wt.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id::varchar), 1, 8))::bigint + 0.5)
          / 4294967296))) as score
      from d left join wt using (rid)),
    el as (select rid, row_number() over (order by score desc, doc_id) as rn from sc where n_features >= 20 and score is not null),
    kk as (select count(*) * 10 // 100 as k from el)
    select doc_id, n_features, weight::bigint as weight, score::bigint as score,
      (case when rn <= k then rn end)::bigint as rank
    from sc left join el using (rid), kk""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
