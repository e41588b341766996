"""Alignment of two tokenizers over the same bytes.

Both token lists of a text are lists of byte ends. The shorter list drives an exponential and then binary search
(galloping) into the longer one. Ends found in both cut the tokens into groups; the difference of the ranks of a
token's two ends is the range of tokens that overlap it. Links (overlapping pairs) are counted over the corpus: a chunk of
documents sends every distinct id pair once, and gets its corpus-wide count back.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import identified, row_numbers, stored
from ebbtide.llm.sp_model import BPE, BYTE, NORMAL, SPACE, USER_DEFINED, read_model

#: Bytes of text whose links are counted together, and that are aligned in one go.
CHUNK_BYTES, RUN_BYTES = 8_000_000, 1_000_000
#: A blank between other characters. Pre-tokens of byte-level vocabularies never reach across one.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_UNSURE = re.compile(r"\s\s|^\s|\s$")
#: Words whose tokens a task remembers.
KNOWN_WORDS = 200_000
#: New words that are encoded as one text.
JOINED_WORDS = 200
#: Needles that one lane of the search takes one after another.
LANE = 64
#: Document rows have `links`, places of id pairs within their chunk; the other rows are these pairs.
ALIGNED = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, place int, a int, b int, n long"


def byte_alphabet() -> dict[str, int]:
    """The printable character of each byte in byte-level vocabularies: itself if visible, else the next beyond 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A tokenizers file with byte-level entries; special strings in texts are plain text."""

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.encode_special_tokens = True
        letters = byte_alphabet()
        vocab = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()

        # that blanks stay with the word behind them is what the built-in pattern says
        self.by_word = self.tokenizer.normalizer is None and json.loads(data)["pre_tokenizer"] in (
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": t, "use_regex": True} for t in (True, False))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which adds the leading space itself."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        model = read_model(data)
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in model.pieces]
        # no piece reaches across a blank, and texts are taken as they are
        self.by_word = (
            model.kind == BPE and model.add_dummy_prefix and model.escape_spaces and not model.charsmap and not model.remove_extra_spaces
            and not any(SPACE in p.lstrip(SPACE) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)




class Coder:
    """Encodes texts by both sides, word by word where that is the same, each distinct word once while it is remembered.

    Ids are kept as bytes, four each, so that texts are put together without a loop over tokens.
    """

    def __init__(self, one: ByteLevel, two: Pieces):
        self.sides = one, two
        self.by_word = one.by_word and two.by_word
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.wrong: set[str] = set()  # words that either side does not spell
        for side in self.sides:
            side.lengths = np.array([len(x) for x in side.bytes])

    def _coded(self, texts: list[str]) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
        """The ids of either side, and whether they spell the text with a blank in front."""
        wholes = [(" " + t).encode() for t in texts]
        out, right = [], np.ones(len(texts), dtype=bool)
        for side in self.sides:
            lists = side.encode(texts)
            out.append([np.array(x, dtype="<i4").tobytes() for x in lists])
            right &= np.array([b"".join([side.bytes[i] for i in x]) == w for x, w in zip(lists, wholes)], dtype=bool)
        return list(zip(*out)), right

    def _coded_words(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """As above, many words a text: a word's tokens are those that end within its bytes. Notes the wrong ones."""
        out: dict[str, tuple[bytes, bytes]] = {}
        alone = [w for w in words if not w or w[0].isspace() or w[-1].isspace()]
        words = list(set(words).difference(alone))
        rows = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        texts = [" ".join(row) for row in rows]
        for row, text, *lists in zip(rows, texts, *(side.encode(texts) for side in self.sides)):
            ends = np.cumsum([len(w.encode()) + 1 for w in row])
            parts = []
            for side, own in zip(self.sides, lists):
                ids = np.array(own, dtype="<i4")
                at = np.cumsum(side.lengths[ids])
                cuts = np.searchsorted(at, ends, side="right")
                if b"".join([side.bytes[i] for i in own]) != (" " + text).encode() or not np.array_equal(at[cuts - 1], ends):
                    break
                data, cuts = ids.tobytes(), (4 * cuts).tolist()
                parts.append([data[s:e] for s, e in zip([0, *cuts], cuts)])
            if len(parts) == len(self.sides):
                out.update(zip(row, zip(*parts)))
            else:
                alone += row
        coded, right = self._coded(alone)
        out.update(zip(alone, coded))
        self.wrong.update(w for w, good in zip(alone, right) if not good)
        return out

    def __call__(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of either side, None for a text without tokens."""
        if not self.by_word:
            return [ids if t and good else None for t, ids, good in zip(texts, *self._coded(texts))]
        parted = [(BETWEEN.split(t) if _UNSURE.search(t) else t.split(" ")) if t else [] for t in texts]
        found = self._coded_words(list(set(chain.from_iterable(parted)).difference(self.known)))
        if len(self.known) < KNOWN_WORDS:
            self.known.update(found)
        known = self.known.get
        out: list[tuple[bytes, bytes] | None] = []
        for t, words in zip(texts, parted):
            ids = tuple(b"".join(x) for x in zip(*[known(w) or found[w] for w in words]))
            out.append(ids if t and (self.wrong.isdisjoint(words) or self._spells(t, ids)) else None)
        self.wrong = {w for w in self.wrong if w in self.known}
        return out

    def _spells(self, text: str, ids: tuple[bytes, bytes]) -> bool:
        whole = (" " + text).encode()
        return all(b"".join(map(side.bytes.__getitem__, np.frombuffer(x, dtype="<i4").tolist())) == whole for side, x in zip(self.sides, ids))


@functools.lru_cache(2)
def _coder(first: bytes, second: bytes) -> Coder:
    """Kept by the worker, with the words it knows."""
    return Coder(ByteLevel(first), Pieces(second))


def gallop(needles: np.ndarray, hay: np.ndarray, lane: int = LANE) -> np.ndarray:
    """For each of the rising needles the number of smaller entries of the rising hay.

    Needles are dealt to lanes of consecutive ones, which advance together: each needle doubles its stride from where the one
    before it stopped until it is passed, then halves the last stride.
    """
    n = len(needles)
    if not n or not len(hay):
        return np.zeros(n, dtype=np.int64)
    padded = np.append(needles, np.full(-n % lane, needles[-1])).reshape(-1, lane)
    out = np.empty_like(padded, dtype=np.int64)
    at = np.searchsorted(hay, padded[:, 0]).astype(np.int64)
    fenced = np.append(hay, np.iinfo(hay.dtype).max)
    end = len(hay)
    for j in range(lane):
        needle = padded[:, j]
        todo = np.flatnonzero(fenced[at] < needle)
        if len(todo):
            wanted, low, stride = needle[todo], at[todo], np.ones(len(todo), dtype=np.int64)
            high = np.minimum(low + 1, end)  # invariant: hay[low] < needle; low and high close in on its rank
            while len(far := np.flatnonzero(fenced[high] < wanted)):
                low[far] = high[far]
                stride[far] *= 2
                high[far] = np.minimum(high[far] + stride[far], end)
            while len(wide := np.flatnonzero(high - low > 1)):
                middle = (low[wide] + high[wide]) // 2
                below = fenced[middle] < wanted[wide]
                low[wide[below]] = middle[below]
                high[wide[~below]] = middle[~below]
            at[todo] = high
        out[:, j] = at
    return out.ravel()[:n]


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Aligned:
    """Groups and links of documents whose token lists spell the same bytes; ids are those of all documents in a row."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, a_drives: bool):
        short, long = (a_ends, b_ends) if a_drives else (b_ends, a_ends)
        rank = gallop(short, long)
        common = long[rank] == short
        # what overlaps a token starts behind what its own start has passed, and ends where its end falls
        first = np.concatenate([[0], (rank + common)[:-1]])
        sizes = rank - first + 1
        own, other = np.repeat(np.arange(len(short)), sizes), _ranges(first, sizes)
        self.link_a, self.link_b = (a[own], b[other]) if a_drives else (a[other], b[own])
        cut = np.flatnonzero(common)
        a_cut, b_cut = (cut, rank[cut]) if a_drives else (rank[cut], cut)
        self.a_last, self.b_last = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        self.a_last[a_cut] = self.b_last[b_cut] = True
        self.a, self.b, self.a_cut, self.b_cut = a, b, a_cut, b_cut
        edges = lambda sizes: np.concatenate([[0], np.cumsum(sizes)])
        self.a_edges, self.b_edges = edges(a_sizes), edges(b_sizes)
        self.n_groups = np.diff(np.searchsorted(a_cut, self.a_edges))
        driver = self.a_edges if a_drives else self.b_edges
        self.link_edges = edges(sizes)[driver]

    def written(self, words: list[str], n: int) -> list[str]:
        """Every document's groups as `a1,a2|b1;a3|b2,b3`; `words` are all ids with a comma, with a bar and with a semicolon."""
        a_group, b_group = (np.cumsum(x) - x for x in (self.a_last, self.b_last))
        place_a = np.arange(len(self.a)) + np.concatenate([[0], self.b_cut + 1])[a_group]
        place_b = np.arange(len(self.b)) + (self.a_cut + 1)[b_group]
        codes = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        codes[place_a] = self.a + n * self.a_last
        codes[place_b] = self.b + 2 * n * self.b_last
        spelt = [words[c] for c in codes.tolist()]
        edges = (self.a_edges + self.b_edges).tolist()
        return ["".join(spelt[s:e])[:-1] for s, e in zip(edges, edges[1:])]


def _align(coder: Coder, texts: list[str], words: list[str], n: int) -> tuple[list[tuple], list[np.ndarray]]:
    """(n_a, n_b, n_groups, n_links, groups) of every text, and its links as first id * n + second id."""
    one, two = coder.sides
    coded = coder(texts)
    facts: list[tuple] = [(0, 0, 0, 0, None)] * len(texts)
    links = [np.zeros(0, dtype=np.int64)] * len(texts)
    drives: tuple[list[int], list[int]] = [], []
    for i, ids in enumerate(coded):
        if ids:
            drives[len(ids[0]) > len(ids[1])].append(i)
    for kind, docs in enumerate(drives):
        if not docs:
            continue
        flat = [(np.frombuffer(b"".join([coded[i][side] for i in docs]), dtype="<i4").astype(np.int64), np.array([len(coded[i][side]) // 4 for i in docs])) for side in (0, 1)]
        (a, a_sizes), (b, b_sizes) = flat
        found = Aligned(a, b, a_sizes, b_sizes, np.cumsum(one.lengths[a]), np.cumsum(two.lengths[b]), kind == 0)
        spelt = found.written(words, n)
        keys = found.link_a * n + found.link_b
        for j, i in enumerate(docs):
            links[i] = keys[found.link_edges[j] : found.link_edges[j + 1]]
            facts[i] = int(a_sizes[j]), int(b_sizes[j]), int(found.n_groups[j]), len(links[i]), spelt[j]
    return facts, links


def _chunk_rows(chunk: int, ids: list, facts: list[tuple], links: list[np.ndarray], n: int, with_groups: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in ALIGNED.split(", "))])
    if with_groups:
        schema = schema.append(pa.field("groups", pa.string()))
    pairs, place, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
    place = place.astype("<u2" if len(pairs) <= 2**16 else "<u4")
    edges = np.cumsum([0, *map(len, links)])
    digest = lambda t: "" if t is None else hashlib.sha256(t.encode()).hexdigest()
    docs = {
        "doc_id": ids, **{c: [f[i] for f in facts] for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
        "groups_sha256": [digest(f[4]) for f in facts], "links": [place[s:e].tobytes() for s, e in zip(edges, edges[1:])], "groups": [f[4] for f in facts],
    }
    own = {"place": np.arange(len(pairs)), "a": pairs // n, "b": pairs % n, "n": counts}
    for columns, size in ((docs, len(ids)), (own, len(pairs))):
        columns["chunk"] = [chunk] * size
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def _aligner(first: bytes, second: bytes, with_groups: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = _coder(first, second)
        n = max(len(side.bytes) for side in coder.sides)
        words = [f"{i}{end}" for end in ",|;" for i in range(n)]
        chunk, ids, facts, links, size = None, [], [], [], 0
        for batch, rows in row_numbers(batches):
            own_ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            start = 0
            while start < len(texts):
                if chunk is None:
                    chunk = int(rows[start])
                end, run = start, 0
                while end < len(texts) and run < RUN_BYTES:
                    run += 4 + len(texts[end])
                    end += 1
                more, found = _align(coder, texts[start:end], words, n)
                ids, facts, links, size = ids + own_ids[start:end], facts + more, links + found, size + run
                start = end
                if size >= CHUNK_BYTES:
                    yield from _chunk_rows(chunk, ids, facts, links, n, with_groups)
                    chunk, ids, facts, links, size = None, [], [], [], 0
        if ids:
            yield from _chunk_rows(chunk, ids, facts, links, n, with_groups)

    return align


def _score(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    total, best = np.zeros((2, pairs.num_rows), dtype=np.int64)
    total[pairs["place"].to_numpy()] = pairs["total"].to_numpy()
    best[pairs["place"].to_numpy()] = pairs["best"].to_numpy()
    sums = []
    for blob, n in zip(docs["links"].to_pylist(), docs["n_links"].to_pylist()):
        place = np.frombuffer(blob, dtype=f"<u{len(blob) // n}") if n else np.zeros(0, dtype=int)
        sums.append((int(best[place].sum()), int(total[place].sum())))
    out = docs.drop_columns(["links", "chunk"])
    for i, c in enumerate(("n_best", "count_sum")):
        out = out.append_column(c, pa.array([s[i] for s in sums], pa.int64()))
    return out


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, total, best: over all documents how many links hold the id pair, and whether no pair of `b` has more."""
    totals = stored(aligned.where("links is null").groupBy("a", "b").agg(F.sum("n").alias("total")), "totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))


def align_tokenizers(docs: DataFrame, byte_level: bytes, pieces: bytes, with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and groups if asked for.

    `byte_level` is a tokenizers file with a byte-level vocabulary (A), `pieces` a sentencepiece model that adds a space
    in front (B). Texts that are missing or empty, or which the tokens of either do not spell byte for byte, have no tokens, zero counts, an
    empty digest and missing groups. n_best counts links whose pair is the most frequent of its B id in the corpus,
    ties included; count_sum adds up the corpus-wide counts. Rows that repeat count as often as they come; rows without an id are
    aligned like others. Extra columns are not looked at. An empty table gives an empty result.

    Links are stored once, two or four bytes each; a chunk of about 8 MB of text, or one longer text, is the most that a task holds.
    """
    columns = ALIGNED + ", groups string" * with_groups
    aligned = stored(identified(docs, id_col, text_col).mapInArrow(_aligner(byte_level, pieces, with_groups), columns), "aligned")
    counted = aligned.where("links is null").select("chunk", "place", "a", "b").join(pair_counts(aligned), ["a", "b"]).select(F.col("chunk").alias("of"), "place", "total", "best")
    own = aligned.where("links is not null").drop("place", "a", "b", "n")
    result = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string" + ", groups string" * with_groups + ", n_best long, count_sum long"
    found = own.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(_score, result)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups)
