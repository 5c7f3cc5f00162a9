"""SQL of the grain tables and feature families, written straight from their meaning."""

from __future__ import annotations

from tallycart.operators.grains import PROMO_NAMES, promo_columns

PROMO = "(month(dt) = 11 and day(dt) = 11)"
SHORT = {
    "click": "click",
    "cart": "add-to-cart",
    "purchase": "purchase",
    "fav": "add-to-favorite",
}


def counts(prefix: str, names: dict[str, str] = SHORT, suffix: str = "", extra: str = "true") -> str:
    return ", ".join(
        f"count(*) filter (where action_type = '{a}' and {extra}) as {prefix}_{n}{suffix}"
        for n, a in names.items()
    )


def zero_rate(num: str, den: str) -> str:
    return f"case when {den} is null or {num} is null or {den} = 0 then 0.0 else {num}::double / {den} end"


def one_rate(num: str, den: str) -> str:
    return f"{num}::double / case when {den} = 0 then 1 else {den} end"


def positive_rate(num: str, den: str) -> str:
    return f"case when {den} > 0 then {num}::double / {den} else 0.0 end"


# name -> select over the log, keyed by the grain's key
USER_RAW = f"""select g.*, gap.u_avg_days_between_purchases,
  {zero_rate('u_purchase', 'u_click')} as u_purchase_click_rate,
  {zero_rate('u_cart', 'u_click')} as u_cart_click_rate,
  {zero_rate('u_fav', 'u_click')} as u_fav_click_rate,
  {zero_rate('u_purchase', 'u_cart')} as u_purchase_cart_rate
from (select user_id, count(distinct item_id) as u_iid, count(distinct cat_id) as u_cid,
        count(distinct merchant_id) as u_mid, count(distinct brand_id) as u_bid,
        {counts('u')}, count(distinct dt) as u_active_days,
        count(distinct case when action_type = 'purchase' then dt end) as u_purchase_days,
        count(*) as u_total
      from log group by user_id) g
left join (select user_id, coalesce(avg(d), 185.0) as u_avg_days_between_purchases
           from (select user_id, date_diff('day', lag(dt) over (partition by user_id
                        order by dt, seq1, seq2, item_id, merchant_id), dt) as d
                 from log where action_type = 'purchase')
           group by user_id) gap on g.user_id = gap.user_id"""

MERCHANT_RAW = f"""select *, {one_rate('m_purchase', 'm_days_between')} as m_avg_orders_per_day,
  {zero_rate('m_purchase', 'm_click')} as m_purchase_per_click,
  {zero_rate('m_cart', 'm_click')} as m_cart_per_click,
  {zero_rate('m_fav', 'm_click')} as m_fav_per_click
from (select merchant_id, count(distinct item_id) as m_iid, count(distinct cat_id) as m_cid,
        count(distinct user_id) as m_uid, count(distinct brand_id) as m_bid, {counts('m')},
        date_diff('day', min(dt), max(dt)) as m_days_between
      from log group by merchant_id)"""

PAIR_RAW = f"""select * exclude (um_cart), {one_rate('um_purchase', 'um_days_between')} as um_avg_orders_per_day,
  {zero_rate('um_purchase', 'um_click')} as um_purchase_per_click,
  {zero_rate('um_fav', 'um_click')} as um_fav_per_click
from (select user_id, merchant_id, count(distinct item_id) as um_iid,
        count(distinct cat_id) as um_cid, count(distinct brand_id) as um_bid, {counts('um')},
        date_diff('day', min(dt), max(dt)) as um_days_between, count(*) as um_count
      from log group by user_id, merchant_id)"""


def attribute_raw(key: str, prefix: str, with_users: bool) -> str:
    users = f"count(distinct user_id) as {prefix}_unique_users, " if with_users else ""
    rates = ", ".join(
        f"{positive_rate(f'{prefix}_{s}', f'{prefix}_click')} as {prefix}_{s}_click_rate"
        for s in ("purchase", "cart", "fav")
    )
    per_day = positive_rate(f"{prefix}_purchase_count", f"{prefix}_days_between")
    return f"""select *, {per_day} as {prefix}_avg_purchases_per_day, {rates}
from (select {key}, {users}count(distinct merchant_id) as {prefix}_unique_merchants,
        count(distinct item_id) as {prefix}_unique_items,
        count(*) filter (where action_type = 'purchase') as {prefix}_purchase_count,
        date_diff('day', min(dt), max(dt)) as {prefix}_days_between, {counts(prefix)}
      from log group by {key})"""


def promo_raw(key: str, prefix: str, totals: bool) -> str:
    """Only keys active on the promotion day."""
    shares = ", ".join(
        f"{one_rate(f'{prefix}_{n}_1111', f'{prefix}_{n}_total')} as {prefix}_{n}_1111_ratio"
        for n in PROMO_NAMES
    )
    columns = ", ".join(promo_columns(prefix, totals))
    return f"""select {key}, {columns} from (select *, {shares} from (
  select {key}, {counts(prefix, PROMO_NAMES, '_1111', PROMO)},
         {counts(prefix, PROMO_NAMES, '_total')}, count(*) filter (where {PROMO}) as promo_rows
  from log group by {key}) where promo_rows > 0)"""


def mixed_raw(key: str, prefix: str) -> str:
    return f"""select *, {one_rate(f'{prefix}_purchase', f'{prefix}_click')} as {prefix}_purchase_click_rate
from (select merchant_id, {key}, count(distinct user_id) as {prefix}_unique_users,
        count(distinct item_id) as {prefix}_unique_items, {counts(prefix)}, count(*) as n
      from log group by merchant_id, {key})"""


def top_per_pair(key: str, top: str, freq: str) -> str:
    return f"""select user_id, merchant_id, {key} as {top}, n as {freq}
from (select user_id, merchant_id, {key}, count(*) as n from log group by all)
qualify row_number() over (partition by user_id, merchant_id order by n desc, {key}) = 1"""


GAP_STATS = """select user_id, merchant_id, avg(d) as repurchase_gap_mean,
  stddev_samp(d) as repurchase_gap_std, min(d)::double as repurchase_gap_min,
  max(d)::double as repurchase_gap_max
from (select user_id, merchant_id, date_diff('day', lag(dt) over (partition by user_id, merchant_id
        order by dt, seq1, seq2, item_id), dt) as d
      from log where action_type = 'purchase')
group by user_id, merchant_id"""

RECENCY = """select user_id, merchant_id,
  date_diff('day', max(dt), (select max(dt) from log where action_type = 'purchase'))::double as "R",
  count(*)::double as "F", count(*)::double as "M"
from log where action_type = 'purchase' group by user_id, merchant_id"""

INTERVAL = """select user_id, merchant_id, avg(date_diff('day', dt, next_dt)) as um_avg_cart_purchase_interval
from (select *, lead(dt) over w as next_dt, lead(action_type) over w as next_action
      from log where action_type in ('add-to-cart', 'purchase')
      window w as (partition by user_id, merchant_id order by dt, seq1, seq2, item_id))
where action_type = 'add-to-cart' and next_action = 'purchase'
group by user_id, merchant_id"""

SESSION_ROWS = """select *, sum(case when gap > 7 then 1 else 0 end) over (partition by user_id
    order by dt, seq1, seq2, item_id, merchant_id rows unbounded preceding) as session_id
from (select *, date_diff('day', lag(dt) over (partition by user_id
        order by dt, seq1, seq2, item_id, merchant_id), dt) as gap from log)"""

SESSIONS = f"""select user_id, cast(session_id as bigint) as session_id,
  count(*) as session_action_count, min(dt) as session_start, max(dt) as session_end,
  (date_diff('day', min(dt), max(dt)) * 86400)::double as session_duration
from ({SESSION_ROWS}) group by user_id, session_id"""

USER_SESSIONS = f"""select user_id, avg(session_action_count) as session_action_mean,
  max(session_action_count)::double as session_action_max,
  avg(session_duration) as session_duration_mean, max(session_duration) as session_duration_max
from ({SESSIONS}) group by user_id"""


def cap_bin(
    source: str, keys: list[str], capped: list[str], binned: list[str], bins: int = 8,
    cap: float | None = 0.95, kept: list[str] | None = None,
) -> list[tuple[str, str]]:
    """CTEs ``<source>_done`` with capped columns and bins, in two honest passes."""
    out, src = [], source
    rest = ", ".join(f"s.{c}" for c in [*keys, *(kept or [])])
    if cap is not None:
        limits = ", ".join(f"quantile_cont({c}::double, {cap}) as {c}" for c in capped)
        out.append((f"{source}_cap", f"select {limits} from {source}"))
        cut = ", ".join(
            f"case when s.{c}::double > k.{c} then k.{c} else s.{c}::double end as {c}" for c in capped
        )
        out.append((f"{source}_cut", f"select {rest}, {cut} from {source} s, {source}_cap k"))
        src = f"{source}_cut"
    if not binned:
        return [*out, (f"{source}_done", f"select * from {src}")]
    shares = ", ".join(str(i / bins) for i in range(bins + 1))
    edges = ", ".join(f"list_distinct(quantile_cont({c}::double, [{shares}])) as {c}" for c in binned)
    out.append((f"{source}_edge", f"select {edges} from {src}"))
    numbers = ", ".join(
        f"case when s.{c} is null or len(e.{c}) < 2 then null else cast(greatest("
        f"len(list_filter(e.{c}, lambda v: v < s.{c}::double)) - 1, 0) as integer) end as {c}_bin"
        for c in binned
    )
    out.append((f"{source}_done", f"select s.*, {numbers} from {src} s, {source}_edge e"))
    return out


def ctes(parts: list[tuple[str, str]]) -> str:
    return ",\n".join(f"{name} as materialized ({body})" for name, body in parts)


def cols(names: list[str], alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return ", ".join(f'{dot}"{c}"' for c in names)


def filled(names: list[str], alias: str, value: str = "0") -> str:
    return ", ".join(f'coalesce({alias}."{c}", {value}) as "{c}"' for c in names)
