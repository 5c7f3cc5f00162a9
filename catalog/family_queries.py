"""One query per feature family, and the matrices that hold several of them."""

from __future__ import annotations

from catalog import sql as q
from catalog.registry import Data, query
from tallycart.operators import pruning
from tallycart.plans import families as fam
from tallycart.plans import runs

KEYS = ["user_id", "merchant_id"]
MATRIX = ["user_id", "merchant_id", "origin", "label", "age_range", "gender"]


class Check:
    """CTEs of one family ending in ``<name>_out`` (pair keys and its columns)."""

    def __init__(self, name: str, family: fam.Family, parts: list[tuple[str, str]]):
        self.name, self.parts = name, parts
        taken = [c for cs in family.takes.values() for c in cs if c not in family.helpers]
        bins = [f"{c}_bin" for c in family.binned]
        self.columns = [*taken, *family.derived, *bins]
        whole = [c for c in self.columns if c.endswith("_bin") or c.startswith("top_")]
        self.doubles = [c for c in self.columns if c not in whole]

    @property
    def out(self) -> str:
        return f"{self.name}_out"

    def body(self) -> str:
        return f"select m.*, {q.cols(self.columns, 'f')} from matrix m join {self.out} f using (user_id, merchant_id)"


def _over_pairs(
    name: str, family: fam.Family, sources: list[tuple[str, str]], joins: str, select: str
) -> Check:
    """Cap and bin after the join to the pairs."""
    kept = [
        c
        for cs in family.takes.values()
        for c in cs
        if c not in family.capped and c not in family.helpers
    ]
    raw = (name, f"select m.user_id, m.merchant_id, {select} from matrix m {joins}")
    parts = [*sources, raw]
    parts += q.cap_bin(name, KEYS, family.capped, family.binned, kept=kept)
    parts.append((f"{name}_out", f"select * from {name}_done"))
    return Check(name, family, parts)


def _entity(
    name: str, family: fam.Family, key: str, raw: str, joins: str, top: list[str]
) -> Check:
    """Cap and bin within the grain's table, then join and fill with 0."""
    parts = [(name, raw)]
    parts += q.cap_bin(name, [key], family.capped, family.binned)
    names = [*family.capped, *[f"{c}_bin" for c in family.binned]]
    extra = f"{q.cols(top, 't')}, " if top else ""
    parts.append(
        (
            f"{name}_out",
            f"select m.user_id, m.merchant_id, {extra}{q.filled(names, 'd')} from matrix m {joins}",
        )
    )
    return Check(name, family, parts)


def _user() -> Check:
    f = fam.USER
    rest = [c for c in f.capped if c not in f.fills]
    select = f"{q.cols(rest, 'g')}, {q.filled(list(f.fills), 'g')}"
    return _over_pairs("fu", f, [("fu_raw", q.USER_RAW)], "left join fu_raw g using (user_id)", select)


def _merchant() -> Check:
    f = fam.MERCHANT
    rest = [c for c in f.capped if c not in f.fills]
    select = f"{q.cols(rest, 'g')}, {q.filled(list(f.fills), 'g')}"
    return _over_pairs(
        "fm", f, [("fm_raw", q.MERCHANT_RAW)], "left join fm_raw g using (merchant_id)", select
    )


def _user_merchant() -> Check:
    f = fam.USER_MERCHANT
    rates = list(f.fills)
    rest = [c for c in f.takes["pair"] if c not in (*rates, "um_count")]
    select = (
        f"{q.cols(rest, 'g')}, {q.filled(rates, 'g')}, "
        "g.um_count::double / t.total as um_interaction_freq"
    )
    total = ("fum_total", "select user_id, count(*) as total from log group by user_id")
    joins = "left join fum_raw g using (user_id, merchant_id) left join fum_total t using (user_id)"
    return _over_pairs("fum", f, [("fum_raw", q.PAIR_RAW), total], joins, select)


def _attribute(name: str, f: fam.Family, key: str, prefix: str, top: str, freq: str) -> Check:
    sources = [
        (f"{name}_raw", q.attribute_raw(key, prefix, prefix == "c")),
        (f"{name}_top", q.top_per_pair(key, top, freq)),
    ]
    joins = (
        f"left join {name}_top t using (user_id, merchant_id) "
        f"left join {name}_raw g on t.{top} = g.{key}"
    )
    columns = [c for c in f.capped if c != freq]
    return _over_pairs(name, f, sources, joins, f"t.{top}, t.{freq}, {q.cols(columns, 'g')}")


def _attribute_promo(name: str, f: fam.Family, key: str, prefix: str, top: str, freq: str) -> Check:
    joins = (
        f"left join ({q.top_per_pair(key, top, freq)}) t using (user_id, merchant_id) "
        f"left join {name}_done d on t.{top} = d.{key}"
    )
    return _entity(name, f, key, q.promo_raw(key, prefix, True), joins, [top, freq])


def _mixed(name: str, f: fam.Family, key: str, prefix: str) -> Check:
    parts = [(name, q.mixed_raw(key, prefix))]
    parts += q.cap_bin(name, ["merchant_id", key], f.capped, f.binned, kept=["n"])
    names = [*f.capped, *[f"{c}_bin" for c in f.binned]]
    parts.append(
        (
            f"{name}_best",
            f"select * from {name}_done qualify row_number() over "
            f"(partition by merchant_id order by n desc, {key}) = 1",
        )
    )
    parts.append(
        (
            f"{name}_out",
            f"select m.user_id, m.merchant_id, {q.filled(names, 'd')} "
            f"from matrix m left join {name}_best d using (merchant_id)",
        )
    )
    return Check(name, f, parts)


def _rfm() -> Check:
    f = fam.RFM_REPURCHASE
    names = f.takes["purchases"]
    gap, rfm = [c for c in names if c.startswith("rep")], ["R", "F", "M"]
    body = (
        f"select m.user_id, m.merchant_id, {q.filled(rfm, 'r')}, {q.filled(gap, 'g')} from matrix m "
        f"left join ({q.RECENCY}) r using (user_id, merchant_id) "
        f"left join ({q.GAP_STATS}) g using (user_id, merchant_id)"
    )
    return Check("frfm", f, [("frfm_out", body)])


def _session() -> Check:
    f = fam.SESSION
    body = (
        f"select m.user_id, m.merchant_id, {q.filled(f.takes['user_sessions'], 's', '-1')} "
        f"from matrix m left join ({q.USER_SESSIONS}) s using (user_id)"
    )
    return Check("fses", f, [("fses_out", body)])


def _interval() -> Check:
    f = fam.CART_PURCHASE_INTERVAL
    return _over_pairs(
        "fci", f, [("fci_raw", q.INTERVAL)], "left join fci_raw g using (user_id, merchant_id)",
        q.filled(f.capped, "g", "-1"),
    )


CHECKS = {
    "user": _user(),
    "user_1111": _entity(
        "fup", fam.USER_PROMO, "user_id", q.promo_raw("user_id", "u", False),
        "left join fup_done d using (user_id)", [],
    ),
    "merchant": _merchant(),
    "merchant_1111": _entity(
        "fmp", fam.MERCHANT_PROMO, "merchant_id", q.promo_raw("merchant_id", "m", True),
        "left join fmp_done d using (merchant_id)", [],
    ),
    "category": _attribute("fc", fam.CATEGORY, "cat_id", "c", "top_cat_id", "freq_cat"),
    "category_1111": _attribute_promo(
        "fcp", fam.CATEGORY_PROMO, "cat_id", "c", "top_cat_id", "freq_cat"
    ),
    "brand": _attribute("fb", fam.BRAND, "brand_id", "b", "top_brand_id", "freq_brand"),
    "brand_1111": _attribute_promo(
        "fbp", fam.BRAND_PROMO, "brand_id", "b", "top_brand_id", "freq_brand"
    ),
    "user_merchant": _user_merchant(),
    "cart_purchase_interval": _interval(),
    "merchant_category": _mixed("fmc", fam.MERCHANT_CATEGORY, "cat_id", "mc"),
    "merchant_brand": _mixed("fmb", fam.MERCHANT_BRAND, "brand_id", "mb"),
    "rfm_repurchase": _rfm(),
    "session": _session(),
}

ADD = {
    "user": fam.add_user_features,
    "user_1111": fam.add_user_1111_features,
    "merchant": fam.add_merchant_features,
    "merchant_1111": fam.add_merchant_1111_features,
    "category": fam.add_category_features,
    "category_1111": fam.add_category_1111_features,
    "brand": fam.add_brand_features,
    "brand_1111": fam.add_brand_1111_features,
    "user_merchant": fam.add_user_merchant_features,
    "cart_purchase_interval": fam.add_user_merchant_cart_purchase_interval,
    "merchant_category": fam.add_merchant_category_features,
    "merchant_brand": fam.add_merchant_brand_features,
    "rfm_repurchase": fam.add_rfm_and_repurchase_features,
    "session": fam.add_session_features,
}


def _register(name: str) -> None:
    check = CHECKS[name]
    sql = f"{q.ctes(check.parts)} :: {check.body()}"
    doubles = [*check.doubles]

    @query(f"family_{name}", sql, doubles)
    def run(d: Data, add=ADD[name]):
        return add(d.matrix, d.log)


for _name in ADD:
    _register(_name)


def combined(names: list[str], dropped: tuple[str, ...] = ()) -> tuple[str, str, list[str]]:
    """(ctes, select, doubles) of several families side by side.

    Favourite ids and counts come once, from the family that caps the counts.
    """
    seen: set[str] = set(dropped)
    parts, select, joins, doubles = [], [], [], []
    for i, name in enumerate(names):
        check = CHECKS[name]
        parts += check.parts
        fresh = [c for c in check.columns if c not in seen]
        seen |= set(fresh)
        doubles += [c for c in check.doubles if c in fresh]
        select.append(q.cols(fresh, f"f{i}"))
        joins.append(f"join {check.out} f{i} using (user_id, merchant_id)")
    body = f"select m.*, {', '.join(select)} from matrix m {' '.join(joins)}"
    return q.ctes(parts), body, doubles


SHORT = ["user", "merchant", "user_merchant"]
FULL = ["rfm_repurchase", *[n for n in ADD if n not in ("rfm_repurchase", "session")]]

_parts, _body, _doubles = combined(SHORT)


@query("matrix_short", f"{_parts} :: {_body}", _doubles)
def matrix_short(d: Data):
    return runs.short_matrix(runs.Inputs(d.log, d.pairs, d.users))


def full(d: Data):
    return runs.feature_matrix(runs.Inputs(d.log, d.pairs, d.users))


FULL_PARTS, FULL_BODY, FULL_DOUBLES = combined(FULL, dropped=("M",))
FULL_COLUMNS = [
    c
    for c in dict.fromkeys(c for n in FULL for c in CHECKS[n].columns)
    if c != "M"
]


@query("matrix_full", f"{FULL_PARTS} :: {FULL_BODY}", FULL_DOUBLES)
def matrix_full(d: Data):
    return full(d)


def _per_column(columns: list[str], select: str) -> str:
    """A union of one aggregate row per column of the full matrix."""
    return " union all ".join(
        f"select '{c}' as feature, {select.format(c=c)} from wide" for c in columns
    )


WIDE = f"{FULL_PARTS}, wide as materialized ({FULL_BODY})"


@query(
    "report_ranges",
    f"""{WIDE} :: {_per_column(FULL_COLUMNS, 'cast(min("{c}") as double) as low, cast(max("{c}") as double) as high, count("{c}") as filled')}""",
    ["low", "high"],
)
def report_ranges(d: Data):
    return pruning.column_ranges(full(d))


def _dropped(d: Data, names: list[str]):
    return d.spark.createDataFrame([(n,) for n in names], "feature string")


@query(
    "prune_constant",
    f"""{WIDE} :: select feature from ({_per_column(FULL_COLUMNS, 'min("{c}") = max("{c}") as flat')}) where flat""",
)
def prune_constant(d: Data):
    return _dropped(d, pruning.constant_columns(full(d)))


@query(
    "prune_empty",
    f"""{WIDE} :: select feature from ({_per_column(FULL_COLUMNS, 'count("{c}") as n')}) where n = 0""",
)
def prune_empty(d: Data):
    return _dropped(d, pruning.empty_columns(full(d).drop(*MATRIX)))


_TWINS = [c for c in FULL_COLUMNS if f"{c}_bin" in FULL_COLUMNS]


@query(
    "prune_binned",
    f"""{WIDE} :: select feature from ({_per_column(_TWINS, 'count(distinct "{c}_bin") as n')}) where n > 1""",
)
def prune_binned(d: Data):
    return _dropped(d, pruning.binned_originals(full(d)))


@query("matrix_head", f"{FULL_PARTS} :: {FULL_BODY} order by m.user_id, m.merchant_id limit 5", FULL_DOUBLES)
def matrix_head(d: Data):
    return full(d).orderBy("user_id", "merchant_id").limit(5)
