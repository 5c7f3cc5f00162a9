"""Exact quantiles, percentile caps and equal-frequency bins over many columns.

Fit once, then transform with literals, as an ML estimator does. A bounded sketch gives
each column cuts a little below and above every wanted quantile. One pass counts the
values at and between the cuts, which says in which slot each wanted rank is; a rank at
a cut is that value, and only the values of the wanted slots between cuts, a small part,
are counted, shuffled and sorted. A slot between cuts with too many values for one task
is cut again; a frequent value becomes a cut, so every cutting leaves a small share of
the slot between two cuts. No task and no driver call sees a whole column, and the
result is exact at any size: the sketch only chooses where to cut.

The passes run over Arrow batches: a row's many columns are counted in place, and only
sums or the wanted values become rows of Spark.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.session import compile_in_parts

CAP = 0.95
# Accuracy of the sketch that chooses where to cut, and the number of values that one
# task may sort: a slot with more is cut again.
SKETCH = 1_000
SLOT_VALUES = 1_000_000


@dataclass(frozen=True)
class Rank:
    """A quantile as the two neighbouring order statistics and the step between."""

    low: float
    high: float
    step: float

    def value(self, upper: float | None = None) -> float:
        """Linear interpolation, of the values capped at ``upper`` if given."""
        low, high = self.low, self.high
        if upper is not None:
            low, high = min(low, upper), min(high, upper)
        if low == high:
            return low
        if self.step >= 0.5:
            return high - (high - low) * (1 - self.step)
        return low + (high - low) * self.step


@dataclass(frozen=True)
class Fitted:
    """What the transform needs of one column."""

    cap: float | None
    edges: tuple[float, ...]

    def capped(self, column: str) -> str:
        """SQL text of the capped value."""
        x = f"cast(`{column}` as double)"
        if self.cap is None:
            return f"nanvl({x}, cast(null as double))"
        return f"case when isnan({x}) then null when {x} > {_number(self.cap)} then {_number(self.cap)} else {x} end"

    def bin(self, column: str) -> str:
        """SQL text of the bin: edges below the value, the first interval closed.

        Edges equal to the cap bound only the last interval, so the uncapped
        value lands in the same bin as the capped one.
        """
        if len(self.edges) < 2:
            return "cast(null as int)"
        x, inner = f"`{column}`", self.edges[1:-1]
        steps = " ".join(f"when {x} <= {_number(e)} then {i}" for i, e in enumerate(inner))
        return f"case when {x} is null or isnan({x}) then null {steps} else {len(inner)} end"


def _number(value: float) -> str:
    if math.isinf(value):
        return f"double('{'-' if value < 0 else ''}Infinity')"
    return f"{value!r}D"


def _slots(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Slot 2k lies between the cuts k - 1 and k, slot 2k + 1 holds the values equal to cut k."""
    return np.searchsorted(cuts, values, "left") + np.searchsorted(cuts, values, "right")


def _known(column: pa.Array) -> np.ndarray:
    """The values of a column; NaN is missing too: it has no rank among the values."""
    values = column.to_numpy(zero_copy_only=False).astype("float64")
    return values[~np.isnan(values)] + 0.0


def _over_columns(
    tables: list[tuple[DataFrame, list[str]]],
    run: Callable[[int], Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]],
    schema: str,
) -> DataFrame:
    """``run`` over the columns of several tables; columns are numbered through."""
    parts, number = [], 0
    for df, columns in tables:
        if columns:
            doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(str(i)) for i, c in enumerate(columns, number)])
            parts.append(doubles.mapInArrow(run(number), schema))
        number += len(columns)
    return reduce(DataFrame.unionByName, parts)


def _counted(tables: list[tuple[DataFrame, list[str]]], cuts: dict[int, list[float]]) -> DataFrame:
    """(name, slot, n): each task adds up its own counts."""
    edges = {name: np.array(values, float) for name, values in cuts.items()}
    none = np.array([], float)

    def run(number: int):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                for i, column in enumerate(batch.columns, number):
                    at = edges.get(i, none)
                    found = np.bincount(_slots(_known(column), at), minlength=2 * len(at) + 1)
                    totals[i] = totals[i] + found if i in totals else found
            for i, found in totals.items():
                slots = np.flatnonzero(found)
                names = np.full(len(slots), i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array(slots, pa.int32()), pa.array(found[slots], pa.int64())],
                    ["name", "slot", "n"],
                )

        return count

    rows = _over_columns(tables, run, "name int, slot int, n long")
    return rows.groupBy("name", "slot").agg(F.sum("n").alias("n"))


def _within(
    tables: list[tuple[DataFrame, list[str]]], cuts: dict[int, list[float]], wanted: list[_Target], merged: bool
) -> DataFrame:
    """(name, slot, x, n): the values in the wanted slots, equal ones of a batch in one row if ``merged``."""
    edges = {name: np.array(values, float) for name, values in cuts.items()}
    none = np.array([], float)
    slots: dict[int, list[int]] = {}
    for t in wanted:
        slots.setdefault(t.name, []).append(t.slot)

    def run(number: int):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, column in enumerate(batch.columns, number):
                    if i not in slots:
                        continue
                    x = _known(column)
                    at = edges.get(i, none)
                    x = x[np.isin(_slots(x, at), slots[i])]
                    x, n = np.unique(x, return_counts=True) if merged else (x, np.ones(len(x), "int64"))
                    if len(x):
                        arrays = [np.full(len(x), i), _slots(x, at), x, n]
                        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a, k) for a, k in zip(arrays, kinds)], ["name", "slot", "x", "n"]
                        )

        return pick

    return _over_columns(tables, run, "name int, slot int, x double, n long")


def _first_cuts(tables: list[tuple[DataFrame, list[str]]], probs: list[float]) -> dict[int, list[float]]:
    """Values a little below and above each quantile, from one bounded sketch per column."""
    near = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-2 / SKETCH, 2 / SKETCH)})
    cuts, number = {}, 0
    for df, columns in tables:
        if columns:
            known = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
            row = df.agg(*[F.percentile_approx(x, near, SKETCH).alias(str(i)) for i, x in enumerate(known)]).first()
            cuts |= {number + i: sorted(set(row[i])) for i in range(len(columns)) if row[i]}
        number += len(columns)
    return cuts


@dataclass(frozen=True)
class _Target:
    """A slot that holds wanted ranks, the values below it and within it."""

    name: int
    slot: int
    below: int
    size: int
    ranks: tuple[int, ...]


def _targets(
    tables: list[tuple[DataFrame, list[str]]], cuts: dict[int, list[float]], probs: list[float]
) -> tuple[dict[int, int], list[_Target]]:
    """The number of values of each column, and the slots with a wanted rank."""
    rows = _counted(tables, cuts).collect()
    sizes: dict[int, dict[int, int]] = {}
    for r in rows:
        sizes.setdefault(r["name"], {})[r["slot"]] = r["n"]
    totals = {name: sum(slots.values()) for name, slots in sizes.items()}
    targets = []
    for name, slots in sizes.items():
        wanted = {f(pos) for pos in _positions(totals[name], probs).values() for f in (math.floor, math.ceil)}
        below = 0
        for slot in sorted(slots):
            inside = tuple(sorted(r for r in wanted if below <= r < below + slots[slot]))
            if inside:
                targets.append(_Target(name, slot, below, slots[slot], inside))
            below += slots[slot]
    return totals, targets


def _positions(total: int, probs: list[float]) -> dict[float, float]:
    return {p: (total - 1) * p for p in probs}


def _narrowed(
    tables: list[tuple[DataFrame, list[str]]], cuts: dict[int, list[float]], large: list[_Target]
) -> dict[int, list[float]]:
    """More cuts within the slots that hold too many values for one task to sort."""
    shares = [i / 64 for i in range(65)]
    rows = (
        _within(tables, cuts, large, merged=False)
        .groupBy("name", "slot")
        .agg(F.percentile_approx("x", shares, SKETCH).alias("cuts"))
        .collect()
    )
    out = {name: set(values) for name, values in cuts.items()}
    for r in rows:
        out.setdefault(r["name"], set()).update(r["cuts"])
    return {name: sorted(values) for name, values in out.items()}


def _sorted_out(
    tables: list[tuple[DataFrame, list[str]]], cuts: dict[int, list[float]], targets: list[_Target]
) -> list[tuple[int, int, float]]:
    """(name, rank, value) of the wanted ranks in slots between cuts."""
    if not targets:
        return []
    spark = next(df for df, columns in tables if columns).sparkSession
    # At most one short row for each column and quantile.
    small = spark.createDataFrame(
        [(t.name, t.slot, t.below, list(t.ranks)) for t in targets],
        "name int, slot int, below long, ranks array<long>",
    )
    in_slot = Window.partitionBy("name", "slot").orderBy("x")
    upto = F.col("below") + F.sum("n").over(in_slot.rowsBetween(Window.unboundedPreceding, 0))
    found = (
        _within(tables, cuts, targets, merged=True)
        .groupBy("name", "slot", "x")
        .agg(F.sum("n").alias("n"))
        .join(F.broadcast(small), ["name", "slot"])
        .withColumn("upto", upto)
        .withColumn("hit", F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n"))))
        .filter(F.size("hit") > 0)
        .select("name", "x", "hit")
        .collect()
    )
    return [(r["name"], rank, r["x"]) for r in found for rank in r["hit"]]


def order_statistics(
    tables: list[tuple[DataFrame, list[str]]], probs: list[float]
) -> dict[str, dict[float, Rank]]:
    """The neighbours of every quantile of every column; columns without values are left out."""
    names = [c for _, columns in tables for c in columns]
    cuts = _first_cuts(tables, probs)
    totals, targets = _targets(tables, cuts, probs)
    if not totals:
        return {}
    while large := [t for t in targets if not t.slot % 2 and t.size > SLOT_VALUES]:
        cuts = _narrowed(tables, cuts, large)
        _, targets = _targets(tables, cuts, probs)
    at: dict[int, dict[int, float]] = {name: {} for name in totals}
    for t in targets:
        if t.slot % 2:
            at[t.name] |= dict.fromkeys(t.ranks, cuts[t.name][t.slot // 2] + 0.0)
    between = [t for t in targets if not t.slot % 2]
    for name, rank, x in _sorted_out(tables, cuts, between):
        at[name][rank] = x
    return {
        names[name]: {
            p: Rank(at[name][math.floor(pos)], at[name][math.ceil(pos)], pos - math.floor(pos))
            for p, pos in _positions(total, probs).items()
        }
        for name, total in totals.items()
    }


def fit(
    tables: list[tuple[DataFrame, list[str]]],
    bins: int = 8,
    cap: float | None = CAP,
) -> dict[str, Fitted]:
    """Cap and bin edges of every column; a column without values gets neither.

    The edges are those of the capped values: capping keeps the order, so the
    order statistics of the capped column are the capped order statistics.
    """
    columns = [c for _, names in tables for c in names]
    if not columns:
        return {}
    probs = sorted({i / bins for i in range(bins + 1)} | ({cap} if cap is not None else set()))
    ranks = order_statistics(tables, probs)
    out = {}
    for name in columns:
        if name not in ranks:
            out[name] = Fitted(None, ())
            continue
        upper = ranks[name][cap].value() if cap is not None else None
        edges = {ranks[name][i / bins].value(upper) for i in range(bins + 1)}
        out[name] = Fitted(upper, tuple(sorted(edges)))
    return out


def apply_fit(
    df: DataFrame,
    fitted: dict[str, Fitted],
    capped: list[str],
    binned: list[str],
    suffix: str = "_bin",
) -> DataFrame:
    """Replace the capped columns and add a bin number for each binned one."""
    compile_in_parts(df.sparkSession)
    kept = [f"{fitted[c].capped(c)} as `{c}`" if c in capped else f"`{c}`" for c in df.columns]
    added = [f"{fitted[c].bin(c)} as `{c}{suffix}`" for c in binned]
    return df.selectExpr(*kept, *added)


def cap_values(df: DataFrame, columns: list[str], percentile: float = 99) -> DataFrame:
    """Values above the percentile become it; missing values stay."""
    fitted = fit([(df, columns)], bins=1, cap=percentile / 100)
    return apply_fit(df, fitted, columns, [])


def bin_values(df: DataFrame, columns: list[str], bins: int = 5) -> DataFrame:
    """Equal-frequency bin numbers in ``<column>_bin``."""
    fitted = fit([(df, columns)], bins=bins, cap=None)
    return apply_fit(df, fitted, [], columns)


def percentiles(df: DataFrame, columns: list[str], prob: float = CAP) -> DataFrame:
    """One row per column with its exact percentile."""
    ranks = order_statistics([(df, columns)], [prob])
    rows = [(c, ranks[c][prob].value() if c in ranks else None) for c in columns]
    return df.sparkSession.createDataFrame(rows, "feature string, value double")
