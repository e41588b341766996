"""Average precision of boosted trees when one feature at a time is taken from another row.

A swap moves a row to another leaf only where a split parts the two codes, so each tree is gone through once for all
features, and only the moved rows go on. Tasks pass on the scores that a swap took away and those it made, counted and packed by
parts of the score; a part is merged with the counts of the plain scores for every feature and repeat at a time.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.trees import BoostedTrees, Tree, _chance
from ebbtide.session import durable

#: Counts that a part holds at most, about, counts that a task packs at a time, and sampled scores for each part.
COUNTS_PER_PART, COUNTS_PER_PACK, SCORES_PER_PART = 2_000_000, 1_000_000, 50
PACKED = "part int, n int, counts binary"
COUNT = np.dtype([("key", "<i4"), ("pos", "<i8"), ("neg", "<i8"), ("score", "<f8")])
#: Gains are added as whole numbers of 2**-HIGH and, what is left of them, of 2**-(HIGH + LOW), so their sum has no order.
HIGH, LOW = 20, 36

# Tasks get the functions of this module by value, as those of the trees.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _steps(tree: Tree) -> list[tuple]:
    """The splits from the root on, and whether one above each looks at the same feature."""
    above = {0: frozenset()}
    out = []
    for i, (f, left, made) in enumerate(zip(tree.feature, tree.lefts, tree.children)):
        if f >= 0:
            out.append((i, f, np.array(left), made, f in above[i]))
            above[made[0]] = above[made[1]] = above[i] | {f}
    return out


def swapper(trees: Sequence[Tree]) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A function of the codes (a row per feature) of rows and of other rows.

    It gives each row's sum over the trees, and per feature the sum if that feature's code is the other row's. Values are added
    tree by tree in either, so equal paths give equal sums.
    """
    plans = [(_steps(t), np.array(t.values)) for t in trees]

    def sums(own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = own.shape[1]
        plain, total = np.zeros(n), np.zeros(own.shape)
        flat = total.reshape(-1)
        value = np.empty(n)
        for steps, values in plans:
            # rows at each node, and swaps there (a row, and its place among all swaps) that left the row's path
            held, moved = {0: np.arange(n)}, {}
            gone: dict[int, np.ndarray] = {}
            for i, f, left, made, again in steps:
                rows = held.pop(i)
                goes, turned = left.take(own[f].take(rows)), left.take(other[f].take(rows))
                sides = rows.compress(goes), rows.compress(~goes)
                away = [rows.compress(turned > goes), rows.compress(goes > turned)]
                if again:
                    away = [x[~gone[f][x]] for x in away]
                for x in away:
                    gone.setdefault(f, np.zeros(n, dtype=bool))[x] = True
                parts = [[(x, x + f * n)] if len(x) else [] for x in away]
                for row, place in moved.pop(i, ()):
                    code = own[f].take(row)
                    if again:
                        mine = place // n == f
                        code[mine] = other[f][row[mine]]
                    side = left.take(code)
                    for part, which in zip(parts, (side, ~side)):
                        part.append((row.compress(which), place.compress(which)))
                for child, side, part in zip(made, sides, parts):
                    held[child] = side
                    if part:
                        moved[child] = part if len(part) == 1 else [tuple(map(np.concatenate, zip(*part)))]
            for i, rows in held.items():
                value[rows] = values[i]
            ended = [(place, values[i]) for i, found in moved.items() for _, place in found]
            before = [flat.take(place) + v for place, v in ended]
            plain += value
            total += value
            for (place, _), x in zip(ended, before):
                flat[place] = x
        return plain, total

    return sums


def _merged(counts: np.ndarray) -> np.ndarray:
    """One count per key and score, in that order; those that come to nothing are left out."""
    if not len(counts):
        return counts
    counts = counts[np.lexsort((counts["score"], counts["key"]))]
    first = np.append(True, (counts["key"][1:] != counts["key"][:-1]) | (counts["score"][1:] != counts["score"][:-1]))
    starts = np.flatnonzero(first)
    out = counts[starts]
    for c in ("pos", "neg"):
        out[c] = np.add.reduceat(counts[c], starts)
    return out[(out["pos"] != 0) | (out["neg"] != 0)]


def _counted(key, score: np.ndarray, positive: np.ndarray, negative: np.ndarray, sign: int) -> np.ndarray:
    out = np.empty(len(score), dtype=COUNT)
    out["key"], out["score"], out["pos"], out["neg"] = key, score, sign * positive, sign * negative
    return out


def _pack(held: list[np.ndarray], cuts: np.ndarray) -> pa.RecordBatch:
    counts = _merged(np.concatenate(held))
    part = np.searchsorted(cuts, counts["score"], side="right")
    order = np.argsort(part, kind="stable")
    part, counts = part[order], counts[order]
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.array([], dtype=np.int64)
    blobs = np.split(counts, starts[1:]) if len(part) else []
    raw = [pa.compress(b"".join(np.ascontiguousarray(b[c]).tobytes() for c in COUNT.names), codec="lz4", asbytes=True) for b in blobs]
    columns = [pa.array(part[starts], pa.int32()), pa.array([len(b) for b in blobs], pa.int32()), pa.array(raw, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["part", "n", "counts"])


def _unpacked(n: int, raw: bytes) -> np.ndarray:
    data = pa.decompress(raw, n * COUNT.itemsize, codec="lz4", asbytes=True)
    out, at = np.empty(n, dtype=COUNT), 0
    for c in COUNT.names:
        out[c] = np.frombuffer(data, COUNT[c], n, at)
        at += n * COUNT[c].itemsize
    return out


def _codes(batch: pa.RecordBatch, column: str, features: int) -> np.ndarray:
    raw = b"".join(batch[column].to_pylist())
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint16).reshape(-1, features).T)


def _labels(batch: pa.RecordBatch, label: str) -> tuple[np.ndarray, np.ndarray]:
    found = batch[label].to_numpy(zero_copy_only=False)
    return (found == 1).astype(np.int64), (found == 0).astype(np.int64)


def _packer(counts_of: Callable[[pa.RecordBatch], list[np.ndarray]], cuts: np.ndarray):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            found = counts_of(batch)
            held += found
            n += sum(map(len, found))
            if n >= COUNTS_PER_PACK:
                yield _pack(held, cuts)
                held, n = [], 0
        if n:
            yield _pack(held, cuts)

    return pack


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per part and key of the packed counts."""
    for batch in batches:
        for x in batch.to_pylist():
            counts = _unpacked(x["n"], x["counts"])
            keys, place = np.unique(counts["key"], return_inverse=True)
            sums = [np.bincount(place, counts[c], len(keys)).astype(np.int64) for c in ("pos", "neg")]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), x["part"], dtype=np.int32)), pa.array(keys), *map(pa.array, sums)], names=["part", "key", "pos", "neg"])


def _gains(scores, pos, neg, before: tuple[int, int]) -> tuple[int, int]:
    """The sum of positives times precision over falling distinct scores, behind the counts ``before``, as whole numbers."""
    starts = np.flatnonzero(np.append(True, scores[1:] != scores[:-1]))
    own = np.add.reduceat(pos, starts)
    up, down = before[0] + np.cumsum(own), before[1] + np.cumsum(np.add.reduceat(neg, starts))
    some = own > 0
    gain = own[some] * (up[some] / (up[some] + down[some]))
    high = np.floor(gain * 2.0**HIGH)
    low = int(np.rint((gain * 2.0**HIGH - high) * 2.0**LOW).astype(np.int64).sum())
    return int(high.sum()) + (low >> LOW), low & (2**LOW - 1)


def _merger(plain_key: int):
    def merge(packed: pa.Table, offsets: pa.Table) -> pa.Table:
        """The gains of each key within a part; the counts of a key are the plain ones with the key's added."""
        rows = packed.to_pylist()
        counts = _merged(np.concatenate([_unpacked(x["n"], x["counts"]) for x in rows]) if rows else np.empty(0, dtype=COUNT))[::-1]
        ends = np.searchsorted(-counts["key"], [-plain_key, 1 - plain_key])
        plain = counts[ends[0] : ends[1]]
        out = []
        for x in offsets.to_pylist():
            own = plain
            if x["key"] != plain_key:
                a, z = np.searchsorted(-counts["key"], [-x["key"], 1 - x["key"]])
                if z > a:
                    own = np.concatenate([plain, counts[a:z]])
                    own = own[np.argsort(-own["score"], kind="stable")]
            if len(own):
                before = x["before_pos"], x["before_neg"]
                out.append((x["key"], *_gains(own["score"], own["pos"].astype(np.int64), own["neg"].astype(np.int64), before)))
        columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else ((), (), ()), (pa.int32(), pa.int64(), pa.int64()))]
        return pa.Table.from_arrays(columns, names=["key", "high", "low"])

    return merge


def coded(model: BoostedTrees, df: DataFrame, column: str) -> DataFrame:
    """``df``, which has the features under their names, with the codes of each row as bytes."""
    bins, names = model.bins, model.bins.features

    def codes(*columns: pa.Array) -> pa.Array:
        found = np.ascontiguousarray(bins.codes(pa.RecordBatch.from_arrays(list(columns), names=names)))
        return pa.array([row.tobytes() for row in found], pa.binary())

    return df.withColumn(column, F.arrow_udf(codes, "binary")(*names))


def _cuts(model: BoostedTrees, rows: DataFrame, id_col: str, codes: str, parts: int, n: int) -> np.ndarray:
    """About ``parts`` stretches of the plain scores, from a sample of rows taken by a hash; these only deal out the counts."""
    wanted = parts * SCORES_PER_PART
    keys = rows.select(id_col, codes)
    if wanted < n:
        keys = keys.where(F.xxhash64(id_col, codes) < F.lit(int(wanted / n * 2**64) - 2**63))
    found = keys.select(codes).toArrow().to_batches() if parts > 1 else []
    scores = [_chance(model.base + sum((t(own.T) for t in model.trees), np.zeros(own.shape[1]))) for own in (_codes(b, codes, len(model.bins.features)) for b in found if b.num_rows)]
    scores = np.sort(np.concatenate(scores)) if scores else np.empty(0)
    return np.unique(scores[:: max(1, len(scores) // parts)][1:]) if len(scores) else scores


def swapped_precision(
    model: BoostedTrees, rows: DataFrame, pairs: DataFrame, wanted: Sequence[str], repeats: int, label: str, id_col: str, codes: str, donor: str
) -> tuple[float | None, list[tuple[str, int, float | None]]]:
    """Average precision of ``rows``, and (feature, repeat, average precision) if a feature is taken from the donor.

    ``rows`` has each row's ``codes``; ``pairs`` has for every ``repeat`` each row's codes and those of its ``donor``.
    """
    names, base, trees = model.bins.features, model.base, model.trees
    places = [f for f, name in enumerate(names) if name in wanted]
    plain_key, n = len(places) * repeats, rows.count()
    if not n or not places:
        return None, []
    cuts = _cuts(model, rows, id_col, codes, math.ceil(2 * n * plain_key / COUNTS_PER_PART), n)

    def packing(counts_of: Callable[[Callable], Callable[[pa.RecordBatch], list[np.ndarray]]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _packer(counts_of(swapper(trees)), cuts)(batches)

        return run

    def plain_counts(sums):
        def of(batch: pa.RecordBatch) -> list[np.ndarray]:
            own = _codes(batch, codes, len(names))
            return [_counted(plain_key, _chance(base + sums(own, own)[0]), *_labels(batch, label), 1)]

        return of

    def swap_counts(sums):
        def of(batch: pa.RecordBatch) -> list[np.ndarray]:
            plain, total = sums(_codes(batch, codes, len(names)), _codes(batch, donor, len(names)))
            old = _chance(base + plain)
            pos, neg = _labels(batch, label)
            repeat = batch["repeat"].to_numpy() - 1
            out = []
            for k, f in enumerate(places):
                at = np.flatnonzero(total[f] != plain)
                new = _chance(base + total[f][at])
                at, new = at[new != old[at]], new[new != old[at]]
                key = k * repeats + repeat[at]
                out += [_counted(key, old[at], pos[at], neg[at], -1), _counted(key, new, pos[at], neg[at], 1)]
            return out

        return of

    packed = durable(
        rows.select(label, codes).mapInArrow(packing(plain_counts), PACKED)
        .unionAll(pairs.select("repeat", label, codes, donor).mapInArrow(packing(swap_counts), PACKED))
    )
    sums = durable(packed.mapInArrow(_sums, "part int, key int, pos long, neg long").groupBy("part", "key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    plain = sums.where(F.col("key") == plain_key).select("part", F.col("pos").alias("_pos"), F.col("neg").alias("_neg"))
    keys = rows.sparkSession.range(plain_key + 1).select(F.col("id").cast("int").alias("key"))
    cells = sums.select("part").distinct().crossJoin(keys).join(sums, ["part", "key"], "left").join(plain, "part", "left")
    higher = Window.partitionBy("key").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)

    def so_far(c: str):
        own = F.coalesce(c, F.lit(0)) + F.when(F.col("key") == plain_key, 0).otherwise(F.coalesce(f"_{c}", F.lit(0)))
        return F.coalesce(F.sum(own).over(higher), F.lit(0)).alias(f"before_{c}")

    offsets = cells.select("part", "key", so_far("pos"), so_far("neg"))
    gains = packed.groupBy("part").cogroup(offsets.groupBy("part")).applyInArrow(_merger(plain_key), "key int, high long, low long")
    positives = plain.agg(F.sum("_pos")).first()[0]
    found = gains.groupBy("key").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    precision = {r["key"]: (r["high"] + r["low"] / 2**LOW) / 2**HIGH / positives if positives else None for r in found}
    return precision[plain_key], [(names[f], r + 1, precision[k * repeats + r]) for k, f in enumerate(places) for r in range(repeats)]
