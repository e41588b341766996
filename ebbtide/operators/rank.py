"""Exact global ranks, running totals and quantiles without a single-task window or a stored copy.

Cut points of the full ordering (ending in a unique id) are fixed once, from a sample of rows taken by a hash of
their keys. The part of a row is then a plain expression, so any scan gives the same answer. The position of a row is its place inside its part, from a window over
that part, plus the number of rows in the parts before it; only one small row per part (and group) is
needed for that. A block of tied scores, however large, is cut by id.

The input must give the same rows whenever it is read; store it first if it holds random values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a part, about, and sampled keys for each of them.
ROWS_PER_PART, KEYS_PER_PART = 2_000_000, 20
#: More than there are cuts.
CUTS = 2**24


@dataclass(frozen=True)
class Key:
    """An ascending ordering expression, missing values first, and a number that never falls along it."""

    column: Column
    code: Column


def _code(c: Column, missing: float) -> Column:
    """A finite number, and no negative zero."""
    bounded = F.greatest(F.least(c.cast("double"), F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))
    return F.when(c.isNull(), missing).otherwise(bounded) + F.lit(0.0)


def rising(c: Column) -> Key:
    """An ordering by number, missing ones first."""
    return Key(c, _code(c, -sys.float_info.max))


def falling(c: Column) -> Key:
    """An ordering by falling number, missing ones last."""
    return Key(F.struct(c.isNull().alias("missing"), (-c).alias("negated")), _code(-c, sys.float_info.max))


def hexadecimal(c: Column) -> Key:
    """An ordering by lower-case hexadecimal text of one length."""
    return Key(c, _code(F.conv(F.substring(c, 1, 12), 16, 10), -sys.float_info.max))


def _columns(order: Sequence[Column | Key]) -> list[Column]:
    return [k.column if isinstance(k, Key) else k for k in order]


def _part(df: DataFrame, order: Sequence[Column | Key]) -> DataFrame:
    """The rows with the part they fall in; parts rise along the order.

    The cuts are every so-manieth of the keys whose hash is low enough, so equal keys are one and any layout
    of the rows has the same cuts. Numbers are looked up in them by Spark's bucketizer; only where several cuts
    have one number (ties) is the whole key searched among them.
    """
    n = df.count()
    parts = max(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / ROWS_PER_PART))
    code = order[0].code if isinstance(order[0], Key) else F.lit(0.0)
    key = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(_columns(order))])
    keys = df.select(code.alias("code"), key.alias("key"))
    share = parts * KEYS_PER_PART / max(n, 1)
    if share < 1:
        keys = keys.where(F.xxhash64("key") < F.lit(int(share * 2**64) - 2**63))
    step = F.greatest(F.lit(1), F.ceil(F.size("keys") / F.lit(parts)))
    sample = keys.agg(F.array_sort(F.collect_set(F.struct("code", "key"))).alias("keys")).select(
        F.filter("keys", lambda _, i: (i + 1) % step == 0).alias("cuts")
    )
    tied = F.filter("cuts", lambda x, i: (F.get("cuts.code", i - 1) == x["code"]) | (F.get("cuts.code", i + 1) == x["code"]))
    sample = sample.select("cuts.code", F.transform(tied, lambda x: x["key"]).alias("ties"))
    codes, ties, many = sample.select("code", F.to_json("ties"), F.size("ties")).first()
    splits = sorted(set(codes))
    out = df.withColumn("_part", F.lit(0))
    if splits and isinstance(order[0], Key):
        spread = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="_code", outputCol="_bucket", handleInvalid="keep")
        out = spread.transform(df.withColumn("_code", code)).withColumn("_part", F.col("_bucket").cast("long")).drop("_code", "_bucket")
    if not many:
        return out
    cuts = F.from_json(F.lit(ties), sample.schema["ties"].dataType)

    def advance(place: Column, step: Column) -> Column:
        return F.when((place + step <= many) & (F.get(cuts, place + step - 1) <= key), place + step).otherwise(place)

    steps = F.array(*[F.lit(2**i) for i in reversed(range(many.bit_length()))])
    shared = [c for c in set(codes) if codes.count(c) > 1]
    within = F.when(code.isin(shared), F.aggregate(steps, F.lit(0), advance))
    # of a bucket, rows with the shared number come first
    return out.withColumn("_part", F.col("_part") * CUTS + F.coalesce(within, F.lit(CUTS - 1)))


def _laid_out(df: DataFrame, order: Sequence[Column | Key], by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows with their part (and group, as text that is never missing), and the names of these columns."""
    laid = _part(df, order)
    if not by:
        return laid, ["_part"]
    return laid.withColumn("_group", F.to_json(F.struct(*by))), ["_group", "_part"]


def _offsets(laid: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per part: sums over the parts before it (``_o_<name>``) and over the group (``_t_<name>``)."""
    group = Window.partitionBy(*keys[:-1])
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = laid.groupBy(*keys).agg(*[c.alias(f"_s_{name}") for name, c in sums.items()])
    return cells.select(
        *keys,
        *[F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0)).alias(f"_o_{name}") for name in sums],
        *[F.sum(f"_s_{name}").over(group).alias(f"_t_{name}") for name in sums],
    )


def ranked(
    df: DataFrame,
    order: Sequence[Column | Key],
    by: Sequence[str] = (),
    rank: str = "rank",
    total: str = "total",
) -> DataFrame:
    """Add the 1-based position of each row under ``order`` (per group ``by``) and the group size.

    ``order`` holds ascending expressions, missing values first, and must end in a column that is unique within the
    group; the result is then the same for every partitioning of the input. Where the first is a :class:`Key`, as
    :func:`falling` gives, parts are found by its number, else by a slower search among whole keys.
    """
    laid, keys = _laid_out(df, order, list(by))
    placed = laid.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order))))
    return placed.join(_offsets(laid, keys, {"n": F.count("*")}), keys).select(
        *df.columns, (F.col("_place") + F.col("_o_n")).alias(rank), F.col("_t_n").alias(total)
    )


def _with_totals(rows: DataFrame, laid: DataFrame, keys: Sequence[str], order: Sequence[Column | Key], values: Sequence[str]) -> DataFrame:
    so_far = Window.partitionBy(*keys).orderBy(*_columns(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.select("*", *[F.sum(v).over(so_far).alias(f"_c_{v}") for v in values])
    out = summed.join(_offsets(laid, keys, {v: F.sum(v) for v in values}), list(keys))
    return out.select(
        *[c for c in rows.columns if c not in keys],
        *[(F.col(f"_c_{v}") + F.col(f"_o_{v}")).alias(f"cum_{v}") for v in values],
        *[F.col(f"_t_{v}").alias(f"total_{v}") for v in values],
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column | Key],
    values: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive) and ``total_<v>`` for each value column, per group ``by``.

    ``order`` (as in :func:`ranked`) must be unique within the group; see :func:`totals_by_value` for ties.
    """
    laid, keys = _laid_out(df, order, list(by))
    return _with_totals(laid, laid, keys, order, values)


def totals_by_value(
    df: DataFrame,
    value: Column,
    name: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """One row per group and distinct value: the sums of its rows, running totals up to it and group totals.

    Columns are ``by``, ``name`` and per sum ``<s>``, ``cum_<s>`` and ``total_<s>``. A missing value is one
    of its own, last if descending. Rows are read for the cuts, and again for the sums of parts; only distinct values
    are shuffled.
    """
    rows = df.select(*by, value.alias(name), *[c.alias(s) for s, c in sums.items()])
    order = [falling(F.col(name)) if descending else rising(F.col(name))]
    laid, keys = _laid_out(rows, order, list(by))
    counts = laid.groupBy(*by, *keys, name).agg(*[F.sum(s).alias(s) for s in sums])
    return _with_totals(counts, laid, keys, order, list(sums))


def group_number(rank: Column, total: Column, groups: int) -> Column:
    """Equal-size group of a 1-based rank: the floor rule, not ``ntile``."""
    before = (rank - 1).cast("bigint") * F.lit(groups).cast("bigint")
    whole_groups = ((before - before % total) / total).cast("bigint")
    return F.least(whole_groups + 1, F.lit(groups)).cast("int")


#: Points of a sketch, its accuracy, and rows of a bracket that one task may order.
SKETCH_POINTS, SKETCH_ACCURACY, BRACKET_ROWS = 200, 4000, 500_000


@dataclass(frozen=True)
class _Bracket:
    """The value at a 0-based place of a column lies within ``[low, high]``; about ``rows`` lie between these."""

    column: str
    place: int
    low: float = -math.inf
    high: float = math.inf
    rows: float = math.inf


def _narrowed(values: DataFrame, brackets: Sequence[_Bracket]) -> list[_Bracket]:
    """One scan: every bracket cut down to the stretch between two points of a sketch of what lies in it."""
    bounds = list(dict.fromkeys((b.column, b.low, b.high) for b in brackets))
    shares = [i / SKETCH_POINTS for i in range(SKETCH_POINTS + 1)]
    columns = []
    for i, (c, low, high) in enumerate(bounds):
        v = F.col(f"`{c}`")
        inside = F.when((v > low) & (v < high), v)
        columns += [
            F.count_if(v <= low).alias(f"low{i}"), F.count(inside).alias(f"n{i}"),
            F.percentile_approx(inside, shares, F.lit(SKETCH_ACCURACY)).alias(f"points{i}"),
        ]
    row = values.agg(*columns).first()
    out = []
    for b in brackets:
        i = bounds.index((b.column, b.low, b.high))
        n, points, place = row[f"n{i}"], row[f"points{i}"], b.place - row[f"low{i}"]
        if place < 0 or place >= n:
            at = b.low if place < 0 else b.high
            out.append(replace(b, low=at, high=at, rows=0))
            continue
        # a point may be off by 1 / accuracy of the rows, on either side
        off = n / SKETCH_ACCURACY + 1
        a, z = math.floor((place - off) / n * SKETCH_POINTS) - 1, math.ceil((place + 1 + off) / n * SKETCH_POINTS) + 1
        low, high = points[a] if a >= 0 else b.low, points[z] if z <= SKETCH_POINTS else b.high
        out.append(replace(b, low=low, high=high, rows=(z - a) / SKETCH_POINTS * n + 2 * off))
    return out


def _at_places(values: DataFrame, brackets: Sequence[_Bracket]) -> DataFrame:
    """``column``, ``place``, ``value``: the rows below a bracket are counted, and the values within it are ordered."""
    own = [F.col(f"`{b.column}`") for b in brackets]
    below = values.agg(*[F.count_if(v < b.low).alias(f"n{i}") for i, (v, b) in enumerate(zip(own, brackets))]).first()
    rows = [(b.column, b.place, b.low, b.high, n) for b, n in zip(brackets, below)]
    places = values.sparkSession.createDataFrame(rows, "column string, place long, low double, high double, below long")
    within = {c: reduce(or_, [v.between(b.low, b.high) for v, b in zip(own, brackets) if b.column == c]) for c in values.columns if any(b.column == c for b in brackets)}
    near = values.where(reduce(or_, within.values())).select(*[F.when(w, F.col(f"`{c}`")).alias(c) for c, w in within.items()])
    long = near.unpivot([], list(within), "column", "value").where("value is not null")
    # As many rows as there are places asked for.
    met = long.groupBy("column", "value").agg(F.count("*").alias("n")).join(F.broadcast(places), "column").where(F.col("value").between(F.col("low"), F.col("high")))
    up_to = Window.partitionBy("column", "place").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = met.withColumn("to", F.sum("n").over(up_to) + F.col("below"))
    return held.where((F.col("to") > F.col("place")) & (F.col("to") - F.col("n") <= F.col("place"))).select("column", "place", "value")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
) -> DataFrame:
    """Linearly interpolated quantiles of each column over its non-missing values.

    Returns rows ``(column, probability, value)``. A mergeable sketch with a known error brackets each order
    statistic, and scans narrow the bracket until few rows lie in it. Only distinct values within the
    brackets are shuffled and ordered, so the result is exact and no task holds a column.
    """
    numbers = {c: F.col(c).cast("double") for c in columns}
    values = df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in numbers.items()])
    sizes = values.agg(*[F.count(f"`{c}`").alias(c) for c in columns]).first()
    wanted = [(c, float(p), (sizes[c] - 1) * float(p)) for c in columns for p in probabilities if sizes[c]]
    places = {(c, at) for c, _, h in wanted for at in (math.floor(h), math.ceil(h))}
    if not wanted:
        return df.sparkSession.createDataFrame([], "column string, probability double, value double")
    brackets = _narrowed(values, [_Bracket(c, at) for c, at in sorted(places)])
    while any(b.rows > BRACKET_ROWS for b in brackets):
        brackets = [b for b in brackets if b.rows <= BRACKET_ROWS] + _narrowed(values, [b for b in brackets if b.rows > BRACKET_ROWS])
    rows = [(c, p, float(h - math.floor(h)), at) for c, p, h in wanted for at in {math.floor(h), math.ceil(h)}]
    asked = df.sparkSession.createDataFrame(rows, "column string, probability double, part double, place long")
    joined = _at_places(values, brackets).join(F.broadcast(asked), ["column", "place"])
    low, high = F.min_by("value", "place"), F.max_by("value", "place")
    return joined.groupBy("column", "probability", "part").agg(low.alias("_low"), high.alias("_high")).select(
        "column",
        "probability",
        F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("part")).alias("value"),
    )
