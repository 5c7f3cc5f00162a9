"""Sources, sinks, cleaning, filters, joins and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import sql as q
from catalog.registry import Data, query
from tallycart.functions import columns, decode, ratios
from tallycart.operators import encoding, grains, sequences, sessions
from tallycart.plans import matrix as mx
from tallycart.session import scratch_path
from tallycart.sources import cleaning
from tallycart.sources.loader import DataLoader, save_predictions
from tallycart.sources.schemas import FILES, LOG_FILE, TEST_FILE

PAIR = ["user_id", "merchant_id"]


def raw_log(d: Data) -> DataFrame:
    """The log in the layout of the input file: codes, MMDD text, null brands."""
    code = F.when(F.lit(False), 0)
    for number, name in decode.ACTION_NAMES.items():
        code = code.when(F.col("action_type") == name, number)
    return d.log.select(
        "user_id",
        "item_id",
        "cat_id",
        F.col("merchant_id").alias("seller_id"),
        F.when(F.col("brand_id") != 0, F.col("brand_id")).alias("brand_id"),
        F.date_format("dt", "MMdd").alias("time_stamp"),
        code.alias("action_type"),
        "seq1",
        "seq2",
    )


def labelled(d: Data) -> DataFrame:
    return d.pairs.filter("origin = 'train'").select(*PAIR, "label")


def to_score(d: Data) -> DataFrame:
    prob = F.lit(None).cast("double").alias("prob")
    return d.pairs.filter("origin = 'test'").select(*PAIR, prob)


def write_files(d: Data, *names: str) -> DataLoader:
    """The test tables as input files below a fresh folder."""
    path = scratch_path(d.spark, "files")
    joined = mx.add_profile(d.pairs, d.users).drop("origin")
    content = {
        "log": lambda: raw_log(d).select(*LOG_FILE.names),
        "users": lambda: d.users,
        "train": lambda: labelled(d),
        "test": lambda: to_score(d),
        "train_prejoined": lambda: joined.filter("label is not null"),
        "test_prejoined": lambda: joined.filter("label is null"),
    }
    for name in names:
        content[name]().write.option("header", True).csv(f"{path}/{FILES[name]}")
    return DataLoader(d.spark, path)


CLEAN = """clean as (select user_id, merchant_id, item_id, cat_id, brand_id,
  make_date(2016, month(dt), day(dt)) as dt, action_type from log)"""


def cleaned(d: Data) -> DataFrame:
    return cleaning.clean_log(raw_log(d))


@query("s_interaction_log", f"{CLEAN} :: select * from clean")
def s_interaction_log(d: Data):
    return write_files(d, "log").log().drop("seq1", "seq2")


@query("s_ingested_log", f"{CLEAN} :: select * from clean where action_type = 'purchase'")
def s_ingested_log(d: Data):
    log = write_files(d, "log").ingest_log(scratch_path(d.spark, "log"))
    return log.filter(grains.is_action("purchase")).drop("seq1", "seq2")


@query("s_user_profile", "select * from users")
def s_user_profile(d: Data):
    return write_files(d, "users").users()


@query("s_labelled_pairs", "select user_id, merchant_id, label, origin from pairs where origin = 'train'", ["label"])
def s_labelled_pairs(d: Data):
    return write_files(d, "train").labelled_pairs()


@query("s_pairs_to_score", "select user_id, merchant_id, origin from pairs where origin = 'test'")
def s_pairs_to_score(d: Data):
    return write_files(d, "test").pairs_to_score()


@query(
    "s_prejoined",
    """select p.user_id::varchar as user_id, merchant_id::varchar as merchant_id,
      label::varchar as label, age_range::varchar as age_range, gender::varchar as gender
    from pairs p left join users u using (user_id)""",
)
def s_prejoined(d: Data):
    files = write_files(d, "train_prejoined", "test_prejoined")
    return files.prejoined("train").unionByName(files.prejoined("test"))


@query(
    "s_predictions",
    "select user_id, merchant_id, (merchant_id % 97) / 97.0::double as prob from pairs where origin = 'test'",
    ["prob"],
)
def s_predictions(d: Data):
    pairs = d.pairs.filter("origin = 'test'")
    scores = pairs.select(*PAIR, ((F.col("merchant_id") % 97) / F.lit(97.0)).alias("prob"))
    path = scratch_path(d.spark, "predictions")
    save_predictions(scores, pairs, path)
    return d.spark.read.schema(TEST_FILE).option("header", True).csv(path)


@query("p_origin_tag", "select user_id, merchant_id, label, 'train' as origin from pairs where origin = 'train'", ["label"])
def p_origin_tag(d: Data):
    return cleaning.clean_labelled_pairs(labelled(d))


@query("p_drop_prob", "select user_id, merchant_id, 'test' as origin from pairs where origin = 'test'")
def p_drop_prob(d: Data):
    return cleaning.clean_pairs_to_score(to_score(d))


@query("p_rename_seller", f"{CLEAN} :: select merchant_id, count(*) as n from clean group by all")
def p_rename_seller(d: Data):
    return cleaned(d).groupBy("merchant_id").agg(F.count("*").alias("n"))


@query("p_decode_action", f"{CLEAN} :: select action_type, count(*) as n from clean group by all")
def p_decode_action(d: Data):
    return cleaned(d).groupBy("action_type").agg(F.count("*").alias("n"))


@query("p_fill_brand", f"{CLEAN} :: select brand_id, count(*) as n from clean group by all")
def p_fill_brand(d: Data):
    return cleaned(d).groupBy("brand_id").agg(F.count("*").alias("n"))


@query(
    "p_cast_log",
    """select user_id::integer as user_id, merchant_id::varchar as merchant_id,
      brand_id::double as brand_id, dt, count(*) as n from log group by all""",
    ["brand_id"],
)
def p_cast_log(d: Data):
    kinds = {"user_id": "int", "merchant_id": "string", "brand_id": "double"}
    typed = cleaning.retype(d.log, kinds)
    return typed.groupBy("user_id", "merchant_id", "brand_id", "dt").agg(F.count("*").alias("n"))


@query("p_parse_date", f"{CLEAN} :: select dt, count(*) as n from clean group by all")
def p_parse_date(d: Data):
    return cleaned(d).groupBy("dt").agg(F.count("*").alias("n"))


@query(
    "p_parse_date_lenient",
    """select mmdd, try_strptime('2016' || mmdd, '%Y%m%d')::date as dt, count(*) as n
    from (select strftime(dt, '%m') || case when brand_id % 2 = 0 then '30' else '31' end as mmdd from log)
    group by all""",
)
def p_parse_date_lenient(d: Data):
    day = F.when(F.col("brand_id") % 2 == 0, "30").otherwise("31")
    text = d.log.select(F.concat(F.date_format("dt", "MM"), day).alias("mmdd"))
    parsed = text.withColumn("dt", decode.parse_day(F.col("mmdd"), lenient=True))
    return parsed.groupBy("mmdd", "dt").agg(F.count("*").alias("n"))


DECODED = """case age_range when 1 then 'first group' when 2 then 'second group'
  when 3 then 'third group' when 4 then 'fourth group' when 5 then 'fifth group'
  when 6 then 'sixth group' when 7 then 'seventh group' when 8 then 'eighth group'
  else 'unknown' end"""


@query("p_decode_gender", "select user_id, case gender when 0 then 'female' when 1 then 'male' else 'unknown' end as gender from users")
def p_decode_gender(d: Data):
    return d.users.select("user_id", decode.gender_name(F.col("gender")).alias("gender"))


@query("p_decode_age", f"select user_id, {DECODED} as age_range from users")
def p_decode_age(d: Data):
    return d.users.select("user_id", decode.age_name(F.col("age_range")).alias("age_range"))


@query("p_cast_matrix", "select * from matrix", ["label"])
def p_cast_matrix(d: Data):
    return d.matrix


@query("p_calendar_date", "select user_id, ts::date as day, count(*) as n from events group by all")
def p_calendar_date(d: Data):
    days = d.table("events").select("user_id", F.to_date("ts").alias("day"))
    return days.groupBy("user_id", "day").agg(F.count("*").alias("n"))


_RATES = ["u_purchase_click_rate", "u_cart_click_rate", "u_fav_click_rate", "u_purchase_cart_rate"]


@query("p_select_columns", f"raw as ({q.USER_RAW}) :: select user_id, {q.cols(_RATES)} from raw", _RATES)
def p_select_columns(d: Data):
    grain = grains.user_grain(d.log)
    return grain.select("user_id", *columns.columns_with(grain, "u_", "_rate"))


LOG_ROW = "user_id, merchant_id, item_id, cat_id, brand_id, dt, action_type, seq1, seq2"


@query("f_purchase", f"select {LOG_ROW} from log where action_type = 'purchase'")
def f_purchase(d: Data):
    return d.log.filter(grains.is_action("purchase"))


@query("f_cart_or_purchase", f"select {LOG_ROW} from log where action_type in ('add-to-cart', 'purchase')")
def f_cart_or_purchase(d: Data):
    return d.log.filter(F.col("action_type").isin("add-to-cart", "purchase"))


@query("f_promo_day", f"select {LOG_ROW} from log where month(dt) = 11 and day(dt) = 11")
def f_promo_day(d: Data):
    return d.log.filter(decode.is_promo_day(F.col("dt")))


FOLLOWED = """followed as (select user_id, merchant_id, count(*) as n from (
    select *, lead(action_type) over (partition by user_id, merchant_id
      order by dt, seq1, seq2, item_id) as next_action
    from log where action_type in ('add-to-cart', 'purchase'))
  where action_type = 'add-to-cart' and next_action = 'purchase' group by user_id, merchant_id)"""


@query("f_cart_then_purchase", f"{FOLLOWED} :: select * from followed")
def f_cart_then_purchase(d: Data):
    runs = sequences.action_runs(d.log)
    across = (F.col("last_action") == "add-to-cart") & (F.col("next_action") == "purchase")
    total = F.sum(F.col("pairs_inside") + F.coalesce(across, F.lit(False)).cast("long"))
    return runs.groupBy(*PAIR).agg(total.alias("n")).filter("n > 0")


@query("f_by_origin", "select * from matrix where origin = 'train'", ["label"])
def f_by_origin(d: Data):
    return d.matrix.filter(F.col("origin") == "train")


@query("j_profile", "select p.*, age_range, gender from pairs p left join users u using (user_id)", ["label"])
def j_profile(d: Data):
    return mx.add_profile(d.pairs, d.users)


@query(
    "j_user_grain",
    f"raw as ({q.USER_RAW}) :: select p.*, u_iid, u_mid, u_purchase, u_active_days from pairs p left join raw using (user_id)",
    ["label"],
)
def j_user_grain(d: Data):
    wanted = ["u_iid", "u_mid", "u_purchase", "u_active_days"]
    return d.pairs.join(grains.user_grain(d.log, wanted), "user_id", "left")


@query(
    "j_merchant_grain",
    f"raw as ({q.MERCHANT_RAW}) :: select p.*, m_uid, m_bid, m_purchase, m_days_between from pairs p left join raw using (merchant_id)",
    ["label"],
)
def j_merchant_grain(d: Data):
    wanted = ["m_uid", "m_bid", "m_purchase", "m_days_between"]
    return d.pairs.join(grains.merchant_grain(d.log, wanted), "merchant_id", "left")


@query(
    "j_pair_grain",
    f"raw as ({q.PAIR_RAW}) :: select p.*, um_iid, um_click, um_days_between from pairs p left join raw using (user_id, merchant_id)",
    ["label"],
)
def j_pair_grain(d: Data):
    wanted = ["um_iid", "um_click", "um_days_between"]
    return d.pairs.join(grains.pair_grain(d.log, wanted), PAIR, "left")


@query(
    "j_favourite_key",
    f"""top as ({q.top_per_pair('brand_id', 'top_brand_id', 'freq_brand')}),
    raw as ({q.attribute_raw('brand_id', 'b', False)}) ::
    select t.*, b_unique_items, b_purchase_count from top t left join raw on top_brand_id = brand_id""",
)
def j_favourite_key(d: Data):
    wanted = ["b_unique_items", "b_purchase_count"]
    brands = grains.brand_grain(d.log, wanted).withColumnRenamed("brand_id", "top_brand_id")
    return grains.top_brand_per_pair(d.log).join(brands, "top_brand_id", "left")


@query(
    "j_promo_with_totals",
    f"raw as ({q.promo_raw('user_id', 'u', True)}) :: select * from raw",
    grains.promo_columns("u", False)[4:],
)
def j_promo_with_totals(d: Data):
    wanted = grains.promo_columns("u", True)
    return grains.user_grain(d.log, wanted).filter(F.col(wanted[0]).isNotNull())


@query(
    "j_same_grain",
    f"""rfm as ({q.RECENCY}), gaps as ({q.GAP_STATS}) ::
    select rfm.*, g.* exclude (user_id, merchant_id) from rfm left join gaps g using (user_id, merchant_id)""",
    ["R", "F", "M", "repurchase_gap_mean", "repurchase_gap_std", "repurchase_gap_min", "repurchase_gap_max"],
)
def j_same_grain(d: Data):
    return sequences.rfm_and_gaps(d.log)


@query("set_union_pairs", "select user_id, merchant_id, label, origin from pairs", ["label"])
def set_union_pairs(d: Data):
    return mx.union_pairs(
        cleaning.clean_labelled_pairs(labelled(d)), cleaning.clean_pairs_to_score(to_score(d))
    )


@query(
    "set_union_categories",
    """select distinct 'age_range' as feature, age_range as label from matrix
    union select distinct 'gender', gender from matrix""",
)
def set_union_categories(d: Data):
    return encoding.label_union(d.matrix, ["age_range", "gender"])


@query(
    "p_parse_date_unpadded",
    r"""forms as (select distinct month(dt) as m, day(dt) as d from log),
    texts as (select unnest([lpad(m::varchar, 2, '0') || lpad(d::varchar, 2, '0'), m::varchar || d::varchar,
      m::varchar || lpad(d::varchar, 2, '0'), lpad(m::varchar, 2, '0') || d::varchar]) as text from forms),
    parts as (select distinct text, regexp_extract(text, '^(1[0-2]|0[1-9]|[1-9])(3[01]|[12][0-9]|0[1-9]|[1-9])$', ['m', 'd']) as p from texts) ::
    select text, make_date(2016, p.m::bigint, p.d::bigint) as strict, make_date(2016, p.m::bigint, p.d::bigint) as lenient from parts""",
)
def p_parse_date_unpadded(d: Data):
    forms = d.log.select(F.month("dt").cast("string").alias("m"), F.dayofmonth("dt").cast("string").alias("d")).distinct()
    month, day = F.lpad("m", 2, "0"), F.lpad("d", 2, "0")
    texts = F.array(F.concat(month, day), F.concat("m", "d"), F.concat("m", day), F.concat(month, "d"))
    rows = forms.select(F.explode(texts).alias("text")).distinct()
    return rows.select(
        "text", decode.parse_day(F.col("text")).alias("strict"), decode.parse_day(F.col("text"), lenient=True).alias("lenient")
    )


@query("x_date_parts", "select month(dt)::integer as month, day(dt)::integer as day, count(*) as n from log group by all")
def x_date_parts(d: Data):
    parts = d.log.select(F.month("dt").alias("month"), F.dayofmonth("dt").alias("day"))
    return parts.groupBy("month", "day").agg(F.count("*").alias("n"))


@query("x_diff_days", "select l_orderkey, l_linenumber, date_diff('day', o_orderdate::date, l_shipdate::date)::integer as days from lineitem join orders on l_orderkey = o_orderkey")
def x_diff_days(d: Data):
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = d.table("orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days"),
    )


@query("x_diff_seconds", "select user_id, date_diff('second', min(ts), max(ts)) as seconds from (select user_id, date_trunc('second', ts) as ts from events) group by user_id")
def x_diff_seconds(d: Data):
    whole = d.table("events").select(
        "user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s")
    )
    return whole.groupBy("user_id").agg((F.max("s") - F.min("s")).alias("seconds"))


_EVENT_GAPS = """gaps as (select user_id, event_id, ts,
      (epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts, event_id))) / 1e6 as gap_seconds
    from events where user_id is not null and ts is not null),
  numbered as (select *, sum(case when gap_seconds > 43200 then 1 else 0 end)
      over (partition by user_id order by ts, event_id rows unbounded preceding)::bigint as session_no from gaps)"""


@query(
    "w_event_sessions",
    f"{_EVENT_GAPS} :: select user_id, event_id, gap_seconds, session_no from numbered",
    ["gap_seconds"],
)
def w_event_sessions(d: Data):
    """Every event with the seconds since its user's previous one and its session number (12-hour gap)."""
    rows = sessions.timed_sessions(d.table("events"))
    return rows.select("user_id", "event_id", "gap_seconds", "session_no")


_SESSION_FEATURES = ["session_action_mean", "session_action_max", "session_duration_mean", "session_duration_max"]


@query(
    "b_event_sessions",
    f"""{_EVENT_GAPS},
  per_session as (select user_id, session_no, count(*) as n, epoch_us(max(ts)) - epoch_us(min(ts)) as us
    from numbered group by user_id, session_no) ::
    select user_id, count(*) as n_sessions, avg(n) as session_action_mean, max(n)::double as session_action_max,
      round(avg(us)) / 1e6 as session_duration_mean, max(us) / 1e6 as session_duration_max
    from per_session group by user_id""",
    _SESSION_FEATURES,
)
def b_event_sessions(d: Data):
    """Session features of every user on time stamps: sessions, their events and length in seconds."""
    return sessions.user_session_features(d.table("events"))


@query(
    "x_fill_missing",
    "select user_id, coalesce(age_range, -1) as age_range, coalesce(gender, 185) as gender from users",
)
def x_fill_missing(d: Data):
    return d.users.fillna({"age_range": -1, "gender": 185})


@query(
    "x_text_to_number",
    "select o_orderpriority, try_cast(substr(o_orderpriority, 1, 1) as integer) as level, try_cast(o_orderpriority as integer) as whole, count(*) as n from orders group by all",
)
def x_text_to_number(d: Data):
    text = d.table("orders").select("o_orderpriority")
    numbers = text.withColumns(
        {
            "level": F.substring("o_orderpriority", 1, 1).try_cast("int"),
            "whole": F.col("o_orderpriority").try_cast("int"),
        }
    )
    return numbers.groupBy("o_orderpriority", "level", "whole").agg(F.count("*").alias("n"))


@query("x_key_composition", "select user_id, coalesce(age_range, -1) * 10 + coalesce(gender, -1) as code from users")
def x_key_composition(d: Data):
    filled = d.users.fillna(-1, ["age_range", "gender"])
    return filled.select("user_id", (F.col("age_range") * 10 + F.col("gender")).alias("code"))


@query("ratio_or_zero", f"raw as ({q.USER_RAW}) :: select user_id, u_purchase_click_rate as r from raw", ["r"])
def ratio_or_zero(d: Data):
    g = grains.user_grain(d.log, ["u_purchase", "u_click"])
    return g.select("user_id", ratios.ratio_or_zero(F.col("u_purchase"), F.col("u_click")).alias("r"))


@query("ratio_zero_as_one", f"raw as ({q.PAIR_RAW}) :: select user_id, merchant_id, um_avg_orders_per_day as r from raw", ["r"])
def ratio_zero_as_one(d: Data):
    g = grains.pair_grain(d.log, ["um_purchase", "um_days_between"])
    r = ratios.ratio_zero_as_one(F.col("um_purchase"), F.col("um_days_between"))
    return g.select(*PAIR, r.alias("r"))


@query(
    "ratio_if_positive",
    f"raw as ({q.attribute_raw('cat_id', 'c', True)}) :: select cat_id, c_avg_purchases_per_day as r from raw",
    ["r"],
)
def ratio_if_positive(d: Data):
    g = grains.category_grain(d.log, ["c_purchase_count", "c_days_between"])
    r = ratios.ratio_if_positive(F.col("c_purchase_count"), F.col("c_days_between"))
    return g.select("cat_id", r.alias("r"))
