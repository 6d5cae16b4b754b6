"""One grouped report from one scan: sums, extremes, exact quantiles, distinct counts, modes.

A plain ``groupBy(keys).agg(percentile, count_distinct)`` makes the task that owns a hot key merge
one value table per map task. Here the first shuffle is on ``(keys, value)``: equal values are
counted map-side and a hot key spreads over all tasks; the second step sees each distinct value of
a key once, with its frequency. Sums and extremes ride along in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlens.operators.ordered import pinned

By = Sequence[str] | Mapping[str, Column]
Quantiles = Sequence[tuple[Column, Mapping[str, float]]]


def flag(test: Column) -> Column:
    """1 where the test holds, else 0: summing it counts the rows."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0))


def keys_of(by: By) -> dict[str, Column]:
    return dict(by) if isinstance(by, Mapping) else {name: F.col(name) for name in by}


def summarise(
    df: DataFrame,
    by: By,
    *,
    sums: Mapping[str, Column] | None = None,
    mins: Mapping[str, Column] | None = None,
    maxs: Mapping[str, Column] | None = None,
    quantiles: Quantiles = (),
    unbounded: Quantiles = (),
    nearest: Quantiles = (),
    distinct: Mapping[str, Column] | None = None,
    modes: Mapping[str, Column] | None = None,
    moments: bool = False,
    exact: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """Grouped measures; ``exact=False`` uses bounded sketches for quantiles and distinct counts.

    Quantiles interpolate linearly and are rounded to 6 digits; ``nearest`` ones are the value at place
    ``floor(n * p)`` of the sorted values. Exact quantiles suit measures with a bounded domain, such as
    whole milliseconds; those of ``unbounded`` measures (sizes, prices) are found by slices in the same
    pass, so that no task gets all values of a group (:func:`_placed`). A mode is the most frequent
    value, ties to the smallest. ``moments`` adds ``_sum``, ``_count``, ``_min`` and ``_max`` with the number of each
    measure of ``quantiles`` and ``unbounded``, from its counted values instead of columns that travel with every row.
    """
    keys = keys_of(by)
    sums, mins, maxs = dict(sums or {}), dict(mins or {}), dict(maxs or {})
    distinct, modes = dict(distinct or {}), dict(modes or {})
    bounded, quantiles = len(quantiles), [*quantiles, *unbounded, *nearest]
    if not exact:
        return _sketched(df, keys, sums, mins, maxs, quantiles, distinct, modes, accuracy)
    inputs = {**sums, **mins, **maxs}
    named = [c.alias(k) for k, c in keys.items()] + [c.alias(f"_v_{n}") for n, c in inputs.items()]
    if not (quantiles or distinct or modes):
        flat = df.select(*named)
        return flat.groupBy(*keys).agg(*_direct(sums, mins, maxs)) if keys else flat.agg(*_direct(sums, mins, maxs))

    slots, texts = _slots(quantiles, distinct, modes)
    if len(slots) == 1:
        flat = df.select(*named, slots[0].alias("_slot"))
    else:
        # entry 0 carries the sums; of the others one without a value adds nothing
        slots[1:] = [F.when(slot["num"].isNotNull() | slot["txt"].isNotNull(), slot) for slot in slots[1:]]
        flat = df.select(*named, F.explode(F.array(*slots)).alias("_slot")).filter("_slot is not null")
    head = F.col("_slot")["slot"] == 0
    fine = flat.groupBy(*keys, "_slot").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.when(head, F.col(f"_v_{n}"))).alias(f"_v_{n}") for n in sums],
        *[F.min(F.when(head, F.col(f"_v_{n}"))).alias(f"_v_{n}") for n in mins],
        *[F.max(F.when(head, F.col(f"_v_{n}"))).alias(f"_v_{n}") for n in maxs],
    )
    wide = _direct(sums, mins, maxs)
    lists: list[tuple[str, Sequence[str]]] = []
    picked: dict[str, Column] = {}
    if len(quantiles) > bounded:
        fine = _placed(fine, list(keys), bounded, len(quantiles))
    for i, (measure, wanted) in enumerate(quantiles[bounded:], bounded):
        whole = i >= len(quantiles) - len(nearest)
        for name, p in wanted.items():
            aggregates, found = _pick(i, name, float(p), nearest=whole)
            picked[name] = found.cast(df.select(measure.alias("m")).schema["m"].dataType) if whole else found
            wide += aggregates
    for i, (_, wanted) in enumerate(quantiles[:bounded]):
        value = F.when(F.col("_slot")["slot"] == i, F.col("_slot")["num"])
        points = F.array(*[F.lit(float(p)) for p in wanted.values()])
        wide.append(F.percentile(value, points, F.col("_n")).alias(f"_q{i}"))
        lists.append((f"_q{i}", list(wanted)))
    described: list[str] = []
    for i, (measure, _) in enumerate(quantiles if moments else []):
        mine = F.when(F.col("_slot")["slot"] == i, F.col("_slot")["num"]).cast(df.select(measure.alias("m")).schema["m"].dataType)
        found = {
            f"_sum{i}": F.sum(mine * F.col("_n")),
            f"_count{i}": F.coalesce(F.sum(F.when(mine.isNotNull(), F.col("_n"))), F.lit(0)),
            f"_min{i}": F.min(mine),
            f"_max{i}": F.max(mine),
        }
        wide += [value.alias(name) for name, value in found.items()]
        described += list(found)
    for name, kind, i in texts:
        mine = F.when(F.col("_slot")["slot"] == i, F.col("_slot")["txt"])
        if kind == "distinct":
            wide.append(F.count(mine).alias(name))
        else:
            wide.append(F.min_by(mine, F.when(mine.isNotNull(), F.struct(-F.col("_n"), mine))).alias(name))
    out = fine.groupBy(*keys).agg(*wide) if keys else fine.agg(*wide)
    plain = [F.col(k) for k in keys] + [F.col(n) for n in (*inputs, *distinct, *modes, *described)]
    points = [
        F.round(F.get(F.col(c), F.lit(j)), 6).alias(name) for c, names in lists for j, name in enumerate(names)
    ]
    return out.select(*plain, *points, *[value.alias(name) for name, value in picked.items()])


def wide_quantiles(df: DataFrame, by: By, quantiles: Mapping[str, tuple[Column, Mapping[str, float]]]) -> DataFrame:
    """Exact quantiles of measures with unbounded domains, such as speeds, one row per group."""
    return summarise(df, by, unbounded=list(quantiles.values()))


def _placed(fine: DataFrame, keys: Sequence[str], start: int, stop: int) -> DataFrame:
    """Counted values with their place in the group: ``_cum`` values up to here, of ``_all``; slots ``start`` to ``stop``.

    Values are cut into logarithmic slices (a fixed, order-keeping function of the value), ranked
    inside their slice and lifted by the counts of lower slices, one row per slice. The slice totals are
    the last rows of the ranking, so they come from the same shuffle. The values of other slots need no place;
    they are spread by hash.
    """
    slot, value = F.col("_slot")["slot"], F.col("_slot")["num"]
    wide = (slot >= start) & (slot < stop) & value.isNotNull()
    part = F.when(wide, _slice(value)).otherwise(F.pmod(F.xxhash64("_slot"), F.lit(1024)))
    cut = fine.withColumn("_in", F.struct(slot.alias("slot"), part.alias("part")))
    inner = Window.partitionBy(*keys, "_in").orderBy(value)
    running = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut.withColumns({"_upto": F.sum("_n").over(running), "_more": F.lead(F.lit(1)).over(inner), "_wide": F.max(wide).over(running)})
    rows = pinned(rows)
    slices = rows.filter("_more is null and _wide")  # both come from the window: neither is asked below its shuffle
    slices = slices.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_in").alias("_of_in"), F.col("_upto").alias("_size"))
    group = Window.partitionBy(*[f"_of_{k}" for k in keys], F.col("_of_in")["slot"])
    lower = group.orderBy(F.col("_of_in")["part"]).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumns({"_base": F.coalesce(F.sum("_size").over(lower), F.lit(0)), "_all": F.sum("_size").over(group)})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.col("_in") == F.col("_of_in"))
    joined = rows.join(slices, same, "left")
    return joined.select(*fine.columns, (F.col("_base") + F.col("_upto")).alias("_cum"), "_all")


def _pick(slot: int, name: str, p: float, *, nearest: bool) -> tuple[list[Column], Column]:
    """Aggregates over placed values, and the quantile from them."""
    mine = F.col("_slot")["slot"] == slot

    def value_at(rank: Column) -> Column:
        here = mine & (rank >= F.col("_cum") - F.col("_n")) & (rank < F.col("_cum"))
        return F.max(F.when(here, F.col("_slot")["num"]))

    if nearest:
        rank = F.least(F.floor(F.col("_all") * F.lit(p)), F.col("_all") - 1)
        return [value_at(rank).alias(f"_lo_{name}")], F.col(f"_lo_{name}")
    at = (F.col("_all") - 1) * F.lit(p)
    lo, hi, part = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_f_{name}")
    aggregates = [
        value_at(F.floor(at)).alias(f"_lo_{name}"),
        value_at(F.ceil(at)).alias(f"_hi_{name}"),
        F.max(F.when(mine, at - F.floor(at))).alias(f"_f_{name}"),
    ]
    return aggregates, F.round(lo + (hi - lo) * part, 6)


def _slice(value: Column) -> Column:
    """Order-keeping slice number: 1000 slices per factor e on either side of zero."""
    size = F.floor(F.ln(F.abs(value)) * 1000) + 1_000_000
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0))


def _direct(sums: Iterable[str], mins: Iterable[str], maxs: Iterable[str]) -> list[Column]:
    return (
        [F.sum(f"_v_{n}").alias(n) for n in sums]
        + [F.min(f"_v_{n}").alias(n) for n in mins]
        + [F.max(f"_v_{n}").alias(n) for n in maxs]
    )


def _slots(quantiles, distinct, modes):
    """Per row: one entry per measured value; entry 0 also carries the sums and extremes."""
    no_num, no_txt = F.lit(None).cast("double"), F.lit(None).cast("string")

    def entry(i: int, num: Column, txt: Column) -> Column:
        return F.struct(F.lit(i).alias("slot"), num.alias("num"), txt.alias("txt"))

    slots = [entry(i, value.cast("double"), no_txt) for i, (value, _) in enumerate(quantiles)]
    texts = []
    for kind, wanted in (("distinct", distinct), ("mode", modes)):
        for name, value in wanted.items():
            texts.append((name, kind, len(slots)))
            slots.append(entry(len(slots), no_num, value.cast("string")))
    return slots, texts


def _sketched(df, keys, sums, mins, maxs, quantiles, distinct, modes, accuracy):
    if modes:
        raise ValueError("modes need exact=True")
    aggs = (
        [F.sum(c).alias(n) for n, c in sums.items()]
        + [F.min(c).alias(n) for n, c in mins.items()]
        + [F.max(c).alias(n) for n, c in maxs.items()]
        + [F.approx_count_distinct(c).alias(n) for n, c in distinct.items()]
        + [
            F.percentile_approx(c.cast("double"), float(p), accuracy).alias(n)
            for c, wanted in quantiles
            for n, p in wanted.items()
        ]
    )
    return df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*aggs)


def describe(
    df: DataFrame,
    by: By,
    metrics: Sequence[str],
    points: Mapping[str, float] | None = None,
    *,
    sums: Mapping[str, Column] | None = None,
    unbounded: Sequence[str] = (),
) -> DataFrame:
    """Count, mean, min, max and percentiles of each metric, and further ``sums``, one row per group.

    ``unbounded`` names the metrics with too many different values for one task.
    """
    points = points or {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    bounded, wide = [m for m in metrics if m not in unbounded], [m for m in metrics if m in unbounded]
    out = summarise(
        df,
        by,
        sums={"requests": F.lit(1), **(sums or {})},
        quantiles=[(F.col(m), {f"{p}_{m}": q for p, q in points.items()}) for m in bounded],
        unbounded=[(F.col(m), {f"{p}_{m}": q for p, q in points.items()}) for m in wide],
        moments=True,
    )
    place = {m: i for i, m in enumerate([*bounded, *wide])}
    out = out.withColumns(
        {f"{end}_{m}": F.col(f"_{end}{place[m]}") for end in ("min", "max") for m in metrics}
        | {f"avg_{m}": mean(F.col(f"_sum{place[m]}"), F.col(f"_count{place[m]}")) for m in metrics}
    )
    return out.drop(*[f"_{kind}{i}" for kind in ("sum", "count", "min", "max") for i in place.values()])


def mean(total: Column, count: Column) -> Column:
    """Guarded mean, NULL for no rows."""
    return F.when(count > 0, total / count)


def rate(part: Column, whole: Column) -> Column:
    """Percentage, 0 when the whole is 0."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def apdex(satisfied: Column, tolerated: Column, whole: Column) -> Column:
    return F.when(whole > 0, (satisfied + tolerated * F.lit(0.5)) / whole).otherwise(F.lit(0.0))


def deviation(sum_: Column, sum_sq: Column, n: Column, *, sample: bool = False) -> Column:
    """Standard deviation from mergeable sums; sample deviation of one value is 0."""
    total = sum_.cast("double")  # the square of a whole number leaves 64 bits above a sum of 3 * 10^9
    centred = F.greatest(F.lit(0.0), sum_sq - total * total / n)
    divisor = n - 1 if sample else n
    return F.when(divisor > 0, F.sqrt(centred / divisor)).otherwise(F.lit(0.0))
