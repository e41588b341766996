"""Gradient-boosted trees grown best first on histograms that Spark adds up.

Rows are kept as bin codes in one stored table, many rows a block, and dealt to all cores. A pass sums gradients per node, feature and bin inside the tasks and
then by a DataFrame aggregation; the driver sees these bounded histograms only and picks splits from them. Sums are
whole numbers, so trees don't depend on the partitioning. Missing values are a code of their own that a split sends to the better
side; categories are parted into two sets by the order of their gradients.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import scratch_path

#: Gradients are counted in units of 1 / UNIT.
UNIT = 2**24
#: Trees whose values are added to the rows at a time, and rows that are worth a task of their own.
TREES_PER_STEP, ROWS_PER_PART = 10, 20_000
#: Bytes of a block's codes, and blocks that a partition holds at most.
BLOCK_BYTES, BLOCKS_PER_PART = 2**21, 32
#: A level's gradients are weighed with so much more, so that rare ones don't lead the order.
LEVEL_SMOOTHING = 10.0
HISTOGRAM = "node int, feature int, code int, g long, h long, n long"
#: One row per block: codes by feature, two bytes each; weights and margins as doubles, labels and marks as bytes.
BLOCKS = "label binary, weight binary, is_validation binary, codes binary, margin binary"

# Tasks get the functions of this module by value, so executors needn't have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Bins:
    """Rising cut points per numeric feature and levels per category; the last code of each stands for missing."""

    cuts: Mapping[str, list[float]]
    levels: Mapping[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.cuts, *self.levels]

    def sizes(self) -> list[int]:
        """Codes of each feature without the missing one."""
        return [len(c) + 1 for c in self.cuts.values()] + [len(v) for v in self.levels.values()]

    def codes(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.empty((batch.num_rows, len(self.features)), dtype=np.uint16)
        for i, (name, cuts) in enumerate(self.cuts.items()):
            values = batch[name].to_numpy(zero_copy_only=False).astype(np.float64)
            own = np.searchsorted(np.array(cuts, dtype=np.float64), values)
            out[:, i] = np.where(np.isnan(values), len(cuts) + 1, own)
        for i, (name, levels) in enumerate(self.levels.items(), len(self.cuts)):
            found = pc.index_in(batch[name].cast(pa.string()), value_set=pa.array(levels, pa.string()))
            out[:, i] = pc.fill_null(found, len(levels)).to_numpy(zero_copy_only=False)
        return out


@dataclass
class Tree:
    """Nodes in the order of their making; a split sends the codes marked in ``lefts`` left, and children come later."""

    feature: list[int] = field(default_factory=lambda: [-1])
    lefts: list[list[bool] | None] = field(default_factory=lambda: [None])
    children: list[tuple[int, int]] = field(default_factory=lambda: [(-1, -1)])
    values: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, left: Sequence[bool], values: tuple[float, float]) -> tuple[int, int]:
        made = len(self.feature), len(self.feature) + 1
        self.feature[node], self.lefts[node], self.children[node] = feature, list(left), made
        for v in values:
            self.feature.append(-1)
            self.lefts.append(None)
            self.children.append((-1, -1))
            self.values.append(v)
        return made

    def walk(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function that gives the leaf of each row; a split looks at the rows of its node only."""
        steps = [(i, f, np.array(left), made) for i, (f, left, made) in enumerate(zip(self.feature, self.lefts, self.children)) if f >= 0]

        def nodes(codes: np.ndarray) -> np.ndarray:
            out, held = np.zeros(len(codes), dtype=np.int64), {0: np.arange(len(codes))}
            for i, f, left, made in steps:
                rows = held.pop(i)
                goes = left[codes[:, f][rows]]
                held[made[0]], held[made[1]] = rows[goes], rows[~goes]
            for i, rows in held.items():
                out[rows] = i
            return out

        return nodes

    def scorer(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function that gives the value of each row."""
        walk, values = self.walk(), np.array(self.values)
        return lambda codes: values[walk(codes)]

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        return self.walk()(codes)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        return self.scorer()(codes)


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoder(bins: Bins, base: float) -> Rows:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, held, n = _block_rows(len(bins.features)), [], 0

        def block() -> pa.RecordBatch:
            codes, label, weight, held_out = (np.concatenate(x) for x in zip(*held))
            columns = [label, weight, held_out, np.ascontiguousarray(codes.T), np.full(len(codes), base)]
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=["label", "weight", "is_validation", "codes", "margin"])

        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                if n and n + part.num_rows > most:
                    yield block()
                    held, n = [], 0
                held.append((
                    bins.codes(part), part["label"].to_numpy().astype(np.uint8), part["weight"].to_numpy().astype(np.float64),
                    part["is_validation"].to_numpy(zero_copy_only=False).astype(np.uint8),
                ))
                n += part.num_rows
        if n:
            yield block()

    return encode


def _block_rows(features: int) -> int:
    return max(1, BLOCK_BYTES // (2 * max(1, features)))


def _parts(n: int, features: int, cores: int) -> int:
    """Tasks that share ``n`` rows: all cores as soon as there is work for them, more where a task's blocks would get too many."""
    wanted = min(-(-n // ROWS_PER_PART), cores)
    return max(1, wanted, -(-n // (_block_rows(features) * BLOCKS_PER_PART)))


def _blocks(batches: Iterator[pa.RecordBatch], trees: Sequence[Tree]) -> Iterator[tuple[dict[str, bytes], np.ndarray, np.ndarray]]:
    """Each block with its codes (a row per row, stored by feature) and its margins with the trees' values."""
    scorers = [tree.scorer() for tree in trees]
    for batch in batches:
        for block in batch.to_pylist():
            margin = np.frombuffer(block["margin"], dtype=np.float64).copy()
            codes = np.frombuffer(block["codes"], dtype=np.uint16).reshape(-1, len(margin)).T
            for score in scorers:
                margin += score(codes)
            yield block, codes, margin


def _adder(trees: Sequence[Tree]) -> Rows:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, margin in _blocks(batches, trees):
            yield pa.RecordBatch.from_pydict({c: pa.array([margin.tobytes() if c == "margin" else x], pa.binary()) for c, x in block.items()})

    return add


def _counter(trees: Sequence[Tree], tree: Tree, wanted: Sequence[int], width: int) -> Rows:
    """Sums per wanted node, feature and code over a task's rows; node -1 holds the loss of the validation rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(len(tree.feature), -1)
        place[list(wanted)] = np.arange(len(wanted))
        walk, cells = tree.walk(), len(wanted) * width
        sums, loss = None, np.zeros(3, dtype=np.int64)
        for block, codes, margin in _blocks(batches, trees):
            weight = np.frombuffer(block["weight"], dtype=np.float64)
            label = np.frombuffer(block["label"], dtype=np.uint8).astype(np.float64)
            held_out = np.frombuffer(block["is_validation"], dtype=np.uint8).astype(bool)
            if 0 in wanted and held_out.any():
                own = weight * (np.logaddexp(0, margin) - label * margin)
                loss += [np.rint(own[held_out] * UNIT).astype(np.int64).sum(), np.rint(weight[held_out] * UNIT).astype(np.int64).sum(), held_out.sum()]
            node = place[walk(codes)]
            rows = np.flatnonzero((node >= 0) & ~held_out)
            chance = _chance(margin[rows])
            g = np.rint(weight[rows] * (chance - label[rows]) * UNIT)
            h = np.rint(weight[rows] * chance * (1 - chance) * UNIT)
            if sums is None:
                sums = np.zeros((3, codes.shape[1], cells), dtype=np.int64)
            first = node[rows] * width
            for f in range(codes.shape[1]):
                cell = first + codes[:, f][rows]
                for total, own in zip(sums, (g, h, None)):
                    total[f] += np.bincount(cell, own, cells).astype(np.int64)
        if sums is not None:
            feature, cell = np.nonzero(sums[2])
            columns = [np.array(wanted)[cell // width], feature, cell % width]
            arrays = [pa.array(c.astype(np.int32)) for c in columns] + [pa.array(x[feature, cell]) for x in sums]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "feature", "code", "g", "h", "n"])
        if loss[2]:
            row = [pa.array([x], pa.int32()) for x in (-1, 0, 0)] + [pa.array([int(x)], pa.int64()) for x in loss]
            yield pa.RecordBatch.from_arrays(row, names=["node", "feature", "code", "g", "h", "n"])

    return count


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    left: np.ndarray
    sums: tuple[np.ndarray, np.ndarray]  # g, h, n of either side


class Grower:
    """Grows one tree from histograms; nodes are split speculatively and the best ones are kept in the end."""

    def __init__(self, sizes: Sequence[int], numeric: int, l2: float, min_leaf: int, leaves: int, step: float):
        self.sizes, self.numeric, self.l2, self.min_leaf, self.leaves, self.step = sizes, numeric, l2, min_leaf, leaves, step
        self.tree = Tree()
        self.held: dict[int, np.ndarray] = {}  # histograms
        self.best: dict[int, Split | None] = {}
        self.total: dict[int, np.ndarray] = {}
        self.parent: dict[int, int] = {}

    def value(self, sums: np.ndarray) -> float:
        return float(-sums[0] / (sums[1] + self.l2 * UNIT) * self.step) if sums[2] else 0.0

    def _score(self, g, h):
        return g * g / (h + self.l2 * UNIT) / UNIT

    def _best(self, node: int) -> Split | None:
        total = self.total[node].astype(np.float64)
        best = None
        for f, size in enumerate(self.sizes):
            own = self.held[node][f, : size + 1]
            cells, missing = own[:size], own[size]
            if f < self.numeric:
                order = np.arange(size)
            else:
                known = np.flatnonzero(cells[:, 2])
                order = known[np.argsort(cells[known, 0] / (cells[known, 1] + LEVEL_SMOOTHING * UNIT), kind="stable")]
            if len(order) < 1:
                continue
            up_to = np.cumsum(cells[order], axis=0)
            ways = [(up_to, False)]
            if missing[2]:
                ways.append((up_to + missing, True))
            for left, with_missing in ways:
                # with missing values on the right, the last cut parts them from all others
                left = left[: len(order) if missing[2] and not with_missing else len(order) - 1].astype(np.float64)
                right = total - left
                good = (left[:, 2] >= self.min_leaf) & (right[:, 2] >= self.min_leaf)
                if not good.any():
                    continue
                gain = self._score(left[:, 0], left[:, 1]) + self._score(right[:, 0], right[:, 1]) - self._score(total[0], total[1])
                gain = np.where(good, gain, -np.inf)
                at = int(gain.argmax())
                if gain[at] > 1e-7 and (best is None or gain[at] > best.gain):
                    mask = np.zeros(size + 1, dtype=bool)
                    mask[order[: at + 1]] = True
                    # missing values that a node hasn't seen follow the larger side
                    mask[size] = with_missing if missing[2] else left[at, 2] > right[at, 2]
                    sums = np.rint(left[at]).astype(np.int64)
                    best = Split(float(gain[at]), f, mask, (sums, self.total[node] - sums))
        return best

    def put(self, node: int, histogram: np.ndarray) -> None:
        self.held[node] = histogram
        if node not in self.total:
            self.total[node] = histogram[0].sum(axis=0)
        self.best[node] = self._best(node)

    def grown(self) -> tuple[list[int], list[int]]:
        """Best first over what is known: the nodes to split, and the nodes that still lack a histogram."""
        heap, kept, open_ = [], [], []

        def meet(node: int) -> None:
            if self.total[node][2] < 2 * self.min_leaf:
                return
            if node not in self.best:
                open_.append(node)
            elif self.best[node]:
                heapq.heappush(heap, (-self.best[node].gain, node))

        meet(0)
        while heap and len(kept) + 1 < self.leaves:
            _, node = heapq.heappop(heap)
            kept.append(node)
            if self.tree.feature[node] < 0:
                split = self.best[node]
                made = self.tree.split(node, split.feature, split.left.tolist(), tuple(self.value(s) for s in split.sums))
                for child, sums in zip(made, split.sums):
                    self.total[child], self.parent[child] = sums, node
            for child in self.tree.children[node]:
                meet(child)
        return kept, open_

    def wanted(self, open_: Sequence[int]) -> list[int]:
        """Of two children the smaller is counted; the other's histogram is what is left of the parent's."""
        out = set()
        for node in open_:
            pair = self.tree.children[self.parent[node]]
            out.add(min(pair, key=lambda c: (self.total[c][2], c)))
        return sorted(out)

    def fill(self, counted: Mapping[int, np.ndarray], open_: Sequence[int]) -> None:
        for node in open_:
            pair = self.tree.children[self.parent[node]]
            small = min(pair, key=lambda c: (self.total[c][2], c))
            self.put(node, counted[small] if node == small else self.held[self.parent[node]] - counted[small])

    def pruned(self, kept: Sequence[int]) -> Tree:
        out, chosen = Tree(values=[self.value(self.total[0])]), set(kept)
        todo = [(0, 0)]
        for old, new in todo:
            if old in chosen:
                made = self.tree.children[old]
                todo += zip(made, out.split(new, self.tree.feature[old], self.tree.lefts[old], tuple(self.tree.values[c] for c in made)))
        return out


def numeric_cuts(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Distinct cut points at even shares of each column's values, one per value where these are few."""
    shares = [i / bins for i in range(1, bins)]
    known = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns]
    row = df.agg(*[F.percentile_approx(v, shares, F.lit(20 * bins)).alias(c) for v, c in zip(known, columns)]).first() if columns else {}
    return {c: sorted(set(row[c] or [])) for c in columns}


def frequent_levels(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list[str]]:
    """The levels of each column, but for those beyond the ``most`` commonest, which count as missing."""
    out = {}
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("level")).agg(F.count("*").alias("n"))
        out[c] = sorted(r["level"] for r in counts.orderBy(F.desc("n"), "level").limit(most).collect())
    return out


@dataclass
class BoostedTrees:
    bins: Bins
    base: float
    trees: list[Tree]
    losses: list[float]

    def probability(self, df: DataFrame, column: str) -> DataFrame:
        """``df``, which has the features under their names, with the chance of label 1."""
        bins, base, trees, names = self.bins, self.base, self.trees, self.bins.features

        def chance(*columns: pa.Array) -> pa.Array:
            codes = np.asfortranarray(bins.codes(pa.RecordBatch.from_arrays(list(columns), names=names)))
            return pa.array(_chance(base + sum((tree(codes) for tree in trees), np.zeros(len(codes)))))

        return df.withColumn(column, F.arrow_udf(chance, "double")(*names))

    def rows(self, spark: SparkSession) -> DataFrame:
        """The model as a table: one row per node, and one for the bins."""
        nodes = [
            (t, i, int(f), None if left is None else "".join("01"[x] for x in left), int(made[0]), int(made[1]), float(v), None)
            for t, tree in enumerate(self.trees)
            for i, (f, left, made, v) in enumerate(zip(tree.feature, tree.lefts, tree.children, tree.values))
        ]
        about = json.dumps({"cuts": self.bins.cuts, "levels": self.bins.levels, "losses": self.losses})
        nodes.append((-1, -1, -1, None, -1, -1, float(self.base), about))
        return spark.createDataFrame(nodes, "tree int, node int, feature int, lefts string, left int, right int, value double, about string")

    @staticmethod
    def of_rows(rows: DataFrame) -> BoostedTrees:
        trees: dict[int, Tree] = {}
        base, about = 0.0, {}
        for r in sorted(rows.collect(), key=lambda r: (r.tree, r.node)):
            if r.tree < 0:
                base, about = r.value, json.loads(r.about)
                continue
            tree = trees.setdefault(r.tree, Tree([], [], [], []))
            tree.feature.append(r.feature)
            tree.lefts.append(None if r.lefts is None else [x == "1" for x in r.lefts])
            tree.children.append((r.left, r.right))
            tree.values.append(r.value)
        return BoostedTrees(Bins(about["cuts"], about["levels"]), base, [trees[t] for t in sorted(trees)], about["losses"])


def fit_trees(
    df: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str],
    step: float = 0.08,
    max_iter: int = 150,
    leaves: int = 31,
    min_leaf: int = 50,
    l2: float = 1.0,
    bins: int = 255,
    patience: int = 15,
) -> BoostedTrees:
    """Trees over the columns ``label`` (0 or 1), ``weight`` and ``is_validation`` and the features of ``df``.

    Growth stops after ``max_iter`` trees, or when the validation loss has not got better for ``patience`` trees. Numbers
    that are missing or not a number, and levels that are missing, unknown or not among the ``bins`` commonest, take the missing branch.
    """
    spark = df.sparkSession
    train = df.where(~F.col("is_validation"))
    space = Bins(numeric_cuts(train, numeric, bins), frequent_levels(train, categories, bins))
    about = df.agg(
        F.count("*").alias("n"), F.sum(F.when(~F.col("is_validation"), F.col("weight") * F.col("label"))).alias("ones"),
        F.sum(F.when(~F.col("is_validation"), F.col("weight"))).alias("all"),
    ).first()
    share = min(max((about["ones"] or 0.0) / (about["all"] or 1.0), 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    parts = _parts(about["n"], len(space.features), spark.sparkContext.defaultParallelism)

    def stored(rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, "boosting")
        rows.write.parquet(path)
        out = spark.read.schema(rows.schema).parquet(path)
        # one task for a small table, and then no shuffle
        return out.coalesce(1) if parts == 1 else out

    kept = df.select(F.col("label").cast("int").alias("label"), F.col("weight").cast("double").alias("weight"), "is_validation", *numeric, *categories)
    rows = stored(kept.repartition(parts).mapInArrow(_encoder(space, base), BLOCKS))
    width = max(space.sizes(), default=0) + 1
    trees: list[Tree] = []
    recent: list[Tree] = []
    losses: list[float] = []

    def counted(tree: Tree, wanted: Sequence[int]) -> dict[int, np.ndarray]:
        own = rows.mapInArrow(_counter(recent, tree, wanted, width), HISTOGRAM)
        # a feature's sums meet in one task: they are few, and their number is known
        dealt = own if parts == 1 else own.repartition(min(parts, len(space.features)), "feature")
        found = dealt.groupBy("node", "feature", "code").agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow()
        node, feature, code, *sums = (found[c].to_numpy() for c in ("node", "feature", "code", "g", "h", "n"))
        out = {i: np.zeros((len(space.sizes()), width, 3), dtype=np.int64) for i in (-1, *wanted)}
        for i, own in out.items():
            at = node == i
            own[feature[at], code[at]] = np.stack([s[at] for s in sums], axis=1)
        return out

    while len(trees) < max_iter and space.features:
        grower = Grower(space.sizes(), len(numeric), l2, min_leaf, leaves, step)
        first = counted(grower.tree, [0])
        loss, weight, n = first[-1][0, 0]
        if n:
            losses.append(float(loss / weight))
            if len(losses) > patience and min(losses[-patience:]) >= min(losses[:-patience]) - 1e-7:
                break
        grower.put(0, first[0])
        kept_nodes, open_ = grower.grown()
        while open_:
            grower.fill(counted(grower.tree, grower.wanted(open_)), open_)
            kept_nodes, open_ = grower.grown()
        if not kept_nodes:
            break
        trees.append(grower.pruned(kept_nodes))
        recent.append(trees[-1])
        if len(recent) == TREES_PER_STEP:
            rows, recent = stored(rows.mapInArrow(_adder(recent), BLOCKS)), []
    return BoostedTrees(space, base, trees, losses)
