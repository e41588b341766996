"""Ranked lexical search: exact inner products of sparse vectors with a ball tree.

A document is a sparse vector of saturated term frequencies, an item a sparse vector of term weights, all integers. Blocks of
documents become ball trees: a node knows the rounded mean of its documents and a radius around it. The inner
product of an item with any document of a node is at most its product with the centre plus norm times
radius, norm and radius rounded up, so the bound is safe. Subtrees are visited in order of falling bound until none can reach the k-th
best score; documents of a leaf are scored exactly.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import pieces_for, row_numbers, stored

#: Documents and item terms of one block pair, documents of a leaf.
DOC_BLOCK, ITEM_TERMS, LEAF = 8192, 500_000, 48
#: Bytes of text whose postings are sent together.
RUN_BYTES = 2_000_000
#: Bytes of terms as they are or in lower case, all others as blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Stands for no id; after all others among equal scores.
NO_ID = 2**63 - 1
POSTINGS = "row long, doc_id long, n long, term binary, tf long"
FOUND = "item_id long, doc_id long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII; only A-Z lower-cased."""
    return (text or b"").translate(FOLD).split()


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per term of a document, and one with the empty term that stands for the document itself."""
    for batch, rows in row_numbers(batches):
        ids, texts = batch["doc_id"], batch["text"].to_pylist()
        start = 0
        while start < len(texts):
            size, end = 0, start
            terms, counts, ns, sizes = [], [], [], []
            while end < len(texts) and size < RUN_BYTES:
                words = terms_of(texts[end])
                if words:
                    own = Counter(words)
                    terms.append(b"")
                    terms += own
                    counts.append(1)
                    counts += own.values()
                    ns.append(len(words))
                sizes.append(len(own) + 1 if words else 0)
                size += len(texts[end] or b"")
                end += 1
            place = np.repeat(np.arange(start, end), sizes)
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(rows[place], pa.int64()), "doc_id": ids.take(pa.array(place)),
                "n": pa.array(np.repeat(np.array(ns, dtype=np.int64), [s for s in sizes if s]), pa.int64()),
                "term": pa.array(terms, pa.binary()), "tf": pa.array(counts, pa.int64()),
            })
            start = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t))) for t in batch["text"].to_pylist()]
        place = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        yield pa.RecordBatch.from_pydict({"item_id": batch["item_id"].take(pa.array(place)), "term": pa.array([t for own in terms for t in own], pa.binary())})


def _stretches(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after another."""
    sizes = last - first
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _up(square: int) -> int:
    """The root, rounded up."""
    return math.isqrt(int(square)) + 1


class BallTree:
    """Balls over sparse integer vectors: `ptr`, `cols`, `vals` give each vector's entries, `ids` what it is called."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, dims: int, leaf: int = LEAF):
        self.dims, n = dims, len(ids)
        squares = np.add.reduceat(vals * vals, ptr[:-1]) if n else vals[:0]
        order = np.arange(n)
        self.nodes: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []  # first, last, radius, places and values of the centre
        self.children: dict[int, tuple[int, int]] = {}
        todo = [(0, n)] if n else []
        for me, (first, last) in enumerate(todo):  # grows as nodes are split
            rows = order[first:last]
            at = _stretches(ptr[rows], ptr[rows + 1])
            own, x, sizes = cols[at], vals[at], ptr[rows + 1] - ptr[rows]
            edges = np.cumsum(sizes) - sizes

            def distances(point: np.ndarray) -> np.ndarray:
                return squares[rows] - 2 * np.add.reduceat(point[own] * x, edges) + int((point * point).sum())

            centre = np.rint(np.bincount(own, weights=x, minlength=dims) / len(rows)).astype(np.int64)
            far = distances(centre)
            held = np.flatnonzero(centre)
            self.nodes.append((first, last, _up(far.max()), held, centre[held]))
            if len(rows) > leaf:
                # parted by which of two distant vectors is nearer, or in halves where one part would be very small
                one = distances(self._dense(cols, vals, ptr, rows[far.argmax()]))
                two = distances(self._dense(cols, vals, ptr, rows[one.argmax()]))
                order[first:last] = rows[np.argsort(one - two, kind="stable")]
                nearer = int((one < two).sum())
                half = first + (nearer if len(rows) < 16 * min(nearer, len(rows) - nearer) else len(rows) // 2)
                self.children[me] = len(todo), len(todo) + 1
                todo += [(first, half), (half, last)]
        at = _stretches(ptr[order], ptr[order + 1])
        self.ids, self.cols, self.vals = ids[order], cols[at], vals[at]
        self.ptr = np.concatenate([[0], np.cumsum(ptr[order + 1] - ptr[order])])
        self.read = 0  # documents scored exactly, over all searches

    def _dense(self, cols, vals, ptr, row) -> np.ndarray:
        out = np.zeros(self.dims, dtype=np.int64)
        out[cols[ptr[row] : ptr[row + 1]]] = vals[ptr[row] : ptr[row + 1]]
        return out

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best with a score above 0, ties to smaller ids."""
        norm = _up((query * query).sum())
        bound = lambda radius, held, centre: int((query[held] * centre).sum()) + norm * radius
        ids, scores = self.ids[:0], self.vals[:0]
        heap = [(-bound(*self.nodes[0][2:]), 0)] if len(self.ids) else []
        while heap:
            top, i = heapq.heappop(heap)
            if -top <= 0 or (len(ids) == k and -top < scores[-1]):
                break
            if i in self.children:
                for child in self.children[i]:
                    heapq.heappush(heap, (-bound(*self.nodes[child][2:]), child))
                continue
            first, last = self.nodes[i][:2]
            at, end = self.ptr[first], self.ptr[last]
            own = np.add.reduceat(query[self.cols[at:end]] * self.vals[at:end], self.ptr[first:last] - at)
            self.read += last - first
            good = np.flatnonzero(own >= (scores[-1] if len(ids) == k else 1))
            if len(good):
                ids, scores = np.concatenate([ids, self.ids[first + good]]), np.concatenate([scores, own[good]])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
        return ids, scores


def _searcher(k: int):
    def search(key: tuple, docs: pa.Table, items: pa.Table) -> pa.Table:
        out_item, out_id, out_score = [], [], []
        if docs.num_rows and items.num_rows:
            terms, cols = np.unique(docs["tid"].to_numpy(), return_inverse=True)
            order = np.lexsort((cols, docs["row"].to_numpy()))
            rows = docs["row"].to_numpy()[order]
            starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            ids = docs["doc_id"].to_numpy()[order][starts]
            tree = BallTree(ids, np.append(starts, len(rows)), cols[order], docs["v"].to_numpy()[order].astype(np.int64), len(terms))
            by_item = np.argsort(items["item_id"].to_numpy(), kind="stable")
            item, tid, w = (items[c].to_numpy()[by_item] for c in ("item_id", "tid", "w"))
            cuts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
            query = np.zeros(len(terms), dtype=np.int64)
            for a, b in zip(cuts, np.append(cuts[1:], len(item))):
                place = np.searchsorted(terms, tid[a:b])
                known = (place < len(terms)) & (terms[np.minimum(place, len(terms) - 1)] == tid[a:b])
                query[place[known]] = w[a:b][known]
                found, scores = tree.search(query, k)
                query[place[known]] = 0
                out_item += [item[a]] * len(found)
                out_id += found.tolist()
                out_score += scores.tolist()
        return pa.table({"item_id": pa.array(out_item, pa.int64()), "doc_id": pa.array(out_id, pa.int64()), "score": pa.array(out_score, pa.int64())})

    return search


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's k best documents: item_id, rank, doc_id, score. Scores are above 0; ties go to the smaller doc_id.

    Every row of `docs` is a document of its own, also if it repeats an id or a text; a missing text and one without a term
    are no documents. Documents without an id come after others of the same score. Item rows that share an id
    are one item; those without id, text or terms find nothing. Empty tables give an empty result, and extra columns are not looked at.

    Postings are cut down to terms that an item has, by a join that Spark broadcasts only if the stored
    vocabulary is small. Documents are dealt into blocks, one ball tree each, and items into blocks that meet all
    trees; a task holds one block of each and returns k rows per item.
    """
    own = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("binary").alias("text"))
    wanted = stored(own.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "wanted")
    marker = docs.sparkSession.createDataFrame([(bytearray(),)], "term binary")
    vocabulary = stored(wanted.select("term").distinct().union(marker).withColumn("tid", F.monotonically_increasing_id()), "vocabulary")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    held = stored(texts.mapInArrow(_postings, POSTINGS).join(vocabulary, "term"), "postings")
    itself = F.octet_length("term") == 0
    total = held.where(itself).agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    n, length = total["n"], total["l"] or 1
    held = held.where(~itself)
    weights = held.groupBy("tid").agg(F.count(F.lit(1)).alias("df")).select(
        "tid", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long").alias("w")
    )
    asked = stored(wanted.join(vocabulary, "term").join(weights, "tid").where("w > 0").select("item_id", "tid", "w"), "asked")
    m = F.expr(f"(100 - 50 + ((50 * n * {n}L) div {length}L))")
    vectors = held.withColumn("m", m).select(
        "row", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "tid", F.expr("(1000000000L * tf) div (1000 * tf + 20 * m)").alias("v")
    )
    blocks, item_blocks = pieces_for(n, DOC_BLOCK), pieces_for(asked.count(), ITEM_TERMS)
    block = lambda c, of: F.pmod(F.xxhash64(c), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    left = vectors.withColumn("db", block("row", blocks)).withColumn("ib", every(item_blocks))
    right = asked.withColumn("ib", block("item_id", item_blocks)).withColumn("db", every(blocks))
    found = left.groupBy("db", "ib").cogroup(right.groupBy("db", "ib")).applyInArrow(_searcher(k), FOUND)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
    )
