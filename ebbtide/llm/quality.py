"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on the driver from the statistics of a bounded sample of labelled rows, and
flattened into arrays that a few numpy steps traverse for a whole batch of documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import identified, keep_only

#: Of labelled rows, at most about this many are learnt from, chosen by a hash of the id.
SAMPLE_ROWS = 20_000
BINS = 64
#: Bytes counted together, each group one statistic.
GROUPS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ",.", "!?", "|", "#$%&*", ";:", "'\"()-", "@/_", "<>{}[]=+\\^~`", " \t\r", "\n")
STATISTICS = (
    "bytes", "words", "word_length", "longest_word", "distinct_words", "same_as_before", "lines", "line_length", "distinct_lines",
    "longest_line", "entropy", "commonest_byte", "high_bytes", "upper_words", "compressed", *(f"group_{i}" for i in range(len(GROUPS))),
)


def statistics(text: str) -> list[float]:
    """The statistics of one whole text; zeros where there is nothing to measure."""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = counts[counts > 0] / n
    words, lines = text.split(), text.split("\n")
    nw, nl = max(len(words), 1), len(lines)
    return [
        np.log1p(n), np.log1p(len(words)), sum(map(len, words)) / nw, max(map(len, words), default=0),
        len(set(words)) / nw, sum(a == b for a, b in zip(words, words[1:])) / nw, np.log1p(nl), np.log1p(n / nl),
        len(set(lines)) / nl, max(map(len, lines)) / n, float(-(share * np.log2(share)).sum()), float(share.max()),
        float(counts[128:].sum()) / n, sum(map(str.isupper, words)) / nw, len(zlib.compress(raw, 1)) / n,
        *(float(counts[list(g.encode())].sum()) / n for g in GROUPS),
    ]


@dataclass
class Trees:
    """Complete trees of one depth in flat arrays: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows, inner = np.full(len(x), self.base), np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, ridge: float = 1.0,
              least: float = 2.0) -> Trees:
    """Boost logistic loss; every level of a tree is split from one histogram of gradients per node and feature."""
    inner, leaves = 2**depth - 1, 2**depth
    rate_of = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), float(np.log(rate_of / (1 - rate_of))))
    if len(y) == 0 or y.min() == y.max():
        return out
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
    offset = np.arange(d) * BINS
    margin = np.full(n, out.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = (((node - first) * d * BINS)[:, None] + offset + binned).ravel()
            hist = [np.bincount(cell, np.repeat(w, d), width * d * BINS).reshape(width, d, BINS) for w in (grad, hess)]
            g, h = (np.cumsum(a, axis=2) for a in hist)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i in range(width):
                j, b = divmod(int(best[i]), BINS)
                if gain[i, j, b] > 1e-9 and b < len(edges[j]):
                    out.feature[t, first + i], out.threshold[t, first + i] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), out.feature[t, node]] > out.threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        out.value[t] = rate * g / (h + ridge)
        margin += out.value[t, leaf]
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label_col: str = "quality",
                id_col: str = "doc_id") -> Trees:
    """Trees fitted on a sample of about `sample_rows` labelled rows that aren't held out (docs: doc_id, text).

    Null labels are no labels; of several labels of one id the largest counts. Without labels
    the score is 0.5 everywhere, with one class only the share of that class. The sample's ids are
    broadcast, being bounded by its size.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    marks = marks.where(~held_out() & F.col("y").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
    total = marks.count()
    if total > sample_rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(1_000_000 * sample_rows / total))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("quality")
        for batch in batches:
            x = pa.array([statistics(t.as_py()) for t in batch["text"]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], x], ["doc_id", "y", "x"])

    rows = docs.join(F.broadcast(marks), "doc_id").select("doc_id", "y", "text").mapInArrow(measure, "doc_id long, y int, x array<double>").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, len(STATISTICS)))
    order = np.lexsort((*x.T, rows["doc_id"].to_numpy()))
    return fit_trees(x[order], rows["y"].to_numpy()[order].astype(float))


def scorer(trees: Trees):
    """A column function that gives the score of a text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        keep_only("quality")
        # one text at a time: workers without pandas and without a copy of a batch's texts stay small
        x = np.array([statistics(t.as_py()) for t in texts], dtype=float).reshape(len(texts), len(STATISTICS))
        return pa.array(trees.score(x), pa.float64())

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (score >= 0.5).

    Only the text is an input of a score. Missing and empty texts are scored like any other,
    from zero statistics. Repeated rows get equal scores. Rows without an id are scored and count
    as not held out. An empty table gives an empty result.
    """
    source = identified(docs, id_col, text_col)
    score = scorer(fit_quality(source, labels, sample_rows))
    scored = source.select("doc_id", score("text").alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose predicted quality is 1, with all their columns."""
    score = scorer(fit_quality(identified(docs, id_col, text_col), labels, sample_rows))
    return docs.where(score(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) >= 0.5)
