"""Removal of repeated byte strings with suffix arrays.

Equal strings of `length` bytes hold the same smallest GRAM-byte gram (by hash) at the same place,
so texts are cut into pieces, each with all strings that share such a gram, and pieces with one
gram meet in one task, wherever they come from. There the pieces of each gram are sorted by their suffixes;
neighbours in the suffix array that agree in `length` bytes are occurrences of one string, of which only the
first in the corpus stays.

* Whole texts that repeat are found by their digest; all but the first go, and only that one is searched.
* Grams that occur once in the corpus can't repeat anything and never leave their chunk.
* Equal pieces of a chunk travel once, as their first occurrence; all later ones repeat it.
* The strings of a gram that a great many pieces hold (one passage in a third of all texts, with
  different surroundings) travel one by one, keyed by the hash of all their bytes, and so spread over all
  tasks; of equal ones the first stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import rolling
from ebbtide.llm.common import keep_only, pieces_for
from ebbtide.llm.suffix_array import suffix_arrays

#: More pieces of one gram than this travel string by string.
FREQUENT = 150
#: Bytes whose suffixes are sorted side by side.
SORT_BYTES = 1_500_000
#: Pieces are dealt by their gram into so many buckets at least; more for more text.
LEAST_BUCKETS = 100
NO_ID = -(2**63)

PIECES = "bucket int, key long, check long, doc long, hash long, start int, strings int, text binary"
SPANS = "chunk int, doc long, hash long, start int, strings int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, spans array<struct<start:int,end:int>>, text_hash long"
SHORT_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class _Run:
    """Some texts end to end, with the pieces they fall into."""

    def __init__(self, raw: list[bytes], length: int, gram: int):
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        self.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.begins = np.cumsum(sizes) - sizes
        n, span = len(self.data), length - gram + 1
        self.start = self.strings = self.key = self.doc = np.zeros(0, dtype=np.int64)
        if n < length:
            return
        self.running = rolling.running_hash(self.data)
        places = np.arange(n - gram + 1)
        hashes = rolling.stretch_hash(self.running, places, places + gram)
        bits = np.uint64(max(1, int(n).bit_length()))
        low = (hashes >> bits << bits) | places.astype(np.uint64)
        have, least = 1, low
        while 2 * have <= span:
            least = np.minimum(least[: len(least) - have], least[have:])
            have *= 2
        if have < span:
            least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
        chosen = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)  # for each start of a string its gram
        doc = np.repeat(np.arange(len(raw)), np.maximum(sizes - length + 1, 0))
        at = np.arange(len(doc)) + np.repeat(self.begins[sizes >= length] - (np.cumsum(np.maximum(sizes - length + 1, 0)) - np.maximum(sizes - length + 1, 0))[sizes >= length], (sizes - length + 1)[sizes >= length])
        gram_at = chosen[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (gram_at[1:] != gram_at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        self.start, self.doc = at[first], doc[first]
        self.strings = np.diff(np.append(first, len(at)))
        self.key = rolling.mix(hashes[gram_at[first]])  # chosen for their small hashes, so those alone would crowd the first buckets


def _documents(table: pa.Table, copies: set[tuple[int, int]]):
    """Texts to search of a chunk: ids, text hashes and bytes, in rising order, without later copies and repeated rows."""
    seen = {}
    for d, h, t in zip(table["doc"].to_pylist(), table["hash"].to_pylist(), table["text"].to_pylist()):
        if (d, h) not in copies:
            seen[d, h] = t.encode("utf-8", "replace")
    return sorted(seen.items())


def _copies(table: pa.Table) -> set[tuple[int, int]]:
    picked = table.filter(pc.less(table["start"], 0))
    return set(zip(picked["doc"].to_pylist(), picked["hash"].to_pylist()))


def _runs_of(table: pa.Table, copies: set[tuple[int, int]], length: int, gram: int):
    docs = _documents(table, copies)
    for part in rolling.runs([len(t) for _, t in docs]):
        own = docs[part]
        yield [k for k, _ in own], _Run([t for _, t in own], length, gram)


def _gram_sender(length: int, gram: int, buckets: int):
    def send(key: tuple, docs: pa.Table, copies: pa.Table) -> pa.Table:
        keep_only("suffix_dedup")
        keys = [r.key for _, r in _runs_of(docs, _copies(copies), length, gram)]
        hashes, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_counts=True)
        return rolling.pack(key[0].as_py(), hashes, counts, buckets)

    return send


def _piece_sender(length: int, gram: int, buckets: int):
    def send(key: tuple, docs: pa.Table, other: pa.Table) -> pa.Table:
        levels = rolling.unpack(other.filter(pc.is_valid(other["counts"])))
        runs = list(_runs_of(docs, _copies(other), length, gram))
        hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *(r.key for _, r in runs)]))
        frequent = int(rolling.level(np.array([FREQUENT]))[0])
        columns: dict[str, list] = {c: [] for c in ("key", "check", "doc", "hash", "start", "strings", "text")}
        first: dict = {}

        def put(key, check, doc, start, strings, text):
            for c, v in zip(columns, (key, check, *doc, start, strings, text)):
                columns[c].append(v)

        for ids, run in runs:
            level = levels[np.searchsorted(hashes, run.key)]
            for i in np.flatnonzero((level > 1) & (level <= frequent)):
                start, strings = int(run.start[i]), int(run.strings[i])
                text = run.data[start : start + strings + length - 1].tobytes()
                doc, at = ids[run.doc[i]], start - int(run.begins[run.doc[i]])
                if text in first:  # repeats what this chunk has already sent
                    put(None, None, doc, at, strings, None)
                else:
                    first[text] = True
                    put(int(run.key[i].astype(np.int64)), 0, doc, at, strings, text)
            for i in np.flatnonzero(level > frequent):
                start, strings = int(run.start[i]), int(run.strings[i])
                text = run.data[start : start + strings + length - 1].tobytes()
                doc, at = ids[run.doc[i]], start - int(run.begins[run.doc[i]])
                if text in first:
                    put(None, None, doc, at, strings, None)
                    continue
                first[text] = True
                places = np.arange(start, start + strings)
                one = rolling.stretch_hash(run.running, places, places + length).astype(np.int64).tolist()
                half = rolling.mix(rolling.stretch_hash(run.running, places + length // 2, places + length))
                two = (rolling.stretch_hash(run.running, places, places + length // 2) ^ half).astype(np.int64).tolist()
                sent = 0  # strings in a row that this chunk has already sent
                for j, string in enumerate(zip(one, two)):
                    if string in first:
                        sent += 1
                        continue
                    if sent:
                        put(None, None, doc, at + j - sent, sent, None)
                        sent = 0
                    first[string] = True
                    put(*string, doc, at + j, 1, None)
                if sent:
                    put(None, None, doc, at + strings - sent, sent, None)
        types = {"key": pa.int64(), "check": pa.int64(), "doc": pa.int64(), "hash": pa.int64(), "start": pa.int32(), "strings": pa.int32(), "text": pa.binary()}
        spread = [k if k is not None else d ^ s for k, d, s in zip(columns["key"], columns["doc"], columns["start"])]
        bucket = (rolling.mix(np.array(spread, dtype=np.int64).astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        return pa.table({"bucket": pa.array(bucket, pa.int32()), **{c: pa.array(columns[c], t) for c, t in types.items()}})

    return send


def _later(docs: np.ndarray, hashes: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Of the members of each group, all but the first by document and place."""
    order = np.lexsort((starts, hashes, docs, group))
    later = np.zeros(len(group), dtype=bool)
    later[order[1:]] = group[order[1:]] == group[order[:-1]]
    return later


def _repeated_strings(texts: list[list[bytes]], length: int) -> list[np.ndarray]:
    """For groups of different pieces: arrays of (piece, place, set of equal strings), only sets of two or more."""
    found = []
    sizes = [sum(map(len, g)) + len(g) for g in texts]
    order = sorted(range(len(texts)), key=lambda i: sizes[i])  # texts of like length side by side
    at = 0
    while at < len(order):
        own, total = [], 0
        while at < len(order) and (not own or total + sizes[order[at]] <= SORT_BYTES):
            own.append(order[at])
            total += sizes[order[at]]
            at += 1
        joined = b"".join(t + b"\x00" for i in own for t in texts[i])
        lengths = np.array([len(t) + 1 for i in own for t in texts[i]])
        ends = np.cumsum(lengths)
        symbols = np.frombuffer(joined, dtype=np.uint8).astype(np.int64) + 2
        symbols[ends - 1] = 1
        counts = np.array([len(texts[i]) for i in own])
        symbols[ends[np.cumsum(counts) - 1] - 1] = 0
        begins = np.cumsum([sizes[i] for i in own]) - np.array([sizes[i] for i in own])
        array = suffix_arrays(symbols, begins)
        piece = np.repeat(np.arange(len(lengths)), lengths)
        array = array[ends[piece[array]] - 1 - array >= length]  # suffixes that begin a whole string
        group = np.repeat(np.arange(len(own)), counts)
        data = np.frombuffer(joined, dtype=np.uint8)
        near = np.flatnonzero(group[piece[array[1:]]] == group[piece[array[:-1]]])
        for part in range(0, length, 25):  # drop pairs of neighbours as soon as they differ
            for j in range(part, min(part + 25, length)):
                if not len(near):
                    break
                near = near[data[array[near] + j] == data[array[near + 1] + j]]
        same = np.zeros(len(array), dtype=bool)
        same[near + 1] = True
        sets = np.cumsum(~same) if len(array) else np.zeros(0, np.int64)
        in_set = same.copy()
        in_set[near] = True
        array, sets = array[in_set], sets[in_set]
        offset = np.cumsum(counts) - counts
        found.append((np.array(own), group[piece[array]], piece[array] - offset[group[piece[array]]], array - (ends - lengths)[piece[array]], sets))
    return found


def _repeat_finder(length: int, chunks: int):
    def find(table: pa.Table) -> pa.Table:
        key, check = (table[c].fill_null(0).to_numpy() for c in ("key", "check"))
        doc, hashes, start, strings = (table[c].to_numpy() for c in ("doc", "hash", "start", "strings"))
        texts = table["text"].combine_chunks()
        known = table["key"].is_null().to_numpy()
        out = [np.stack([doc, hashes, start, strings])[:, known]]
        single = ~known & texts.is_null().to_numpy(zero_copy_only=False)
        if single.any():
            rows = np.flatnonzero(single)
            _, group = np.unique(np.stack([key[rows], check[rows]]), axis=1, return_inverse=True)
            rows = rows[_later(doc[rows], hashes[rows], start[rows], group.ravel())]
            out.append(np.stack([doc[rows], hashes[rows], start[rows], strings[rows]]))
        rows = np.flatnonzero(~known & ~single)
        rows = rows[np.lexsort((start[rows], hashes[rows], doc[rows], key[rows]))]
        first: list[list[int]] = []  # of each gram with several different pieces the first row of each
        begin = np.flatnonzero(np.append(True, key[rows[1:]] != key[rows[:-1]])) if len(rows) else []
        for a, b in zip(begin, np.append(begin[1:], len(rows)) if len(rows) else []):
            if b - a > 1:
                own: dict[bytes, int] = {}
                for r in rows[a:b].tolist():
                    text = texts[r].as_py()
                    if text in own:
                        out.append(np.array([[doc[r]], [hashes[r]], [start[r]], [strings[r]]]))
                    else:
                        own[text] = r
                if len(own) > 1:
                    first.append(list(own.values()))
        for own, group, piece, place, sets in _repeated_strings([[texts[r].as_py() for r in g] for g in first], length):
            row = np.array([first[own[g]][p] for g, p in zip(group.tolist(), piece.tolist())], dtype=np.int64)
            at = start[row] + place
            later = _later(doc[row], hashes[row], at, sets)
            row, at = row[later], at[later]
            order = np.lexsort((at, row))
            row, at = row[order], at[order]
            new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))) if len(row) else np.zeros(0, np.int64)
            out.append(np.stack([doc[row[new]], hashes[row[new]], at[new], np.diff(np.append(new, len(row)))]))
        d, h, s, n = np.concatenate(out, axis=1)
        return pa.table({"doc": d, "hash": h, "start": pa.array(s, pa.int32()), "strings": pa.array(n, pa.int32())})

    return find


def _cutter(length: int, with_text: bool):
    def cut(key: tuple, docs: pa.Table, spans: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for d, h, s, n in zip(*(spans[c].to_pylist() for c in ("doc", "hash", "start", "strings"))):
            found.setdefault((d, h), []).append((s, n))
        rows = []
        for real, d, h, t in zip(*(docs[c].to_pylist() for c in ("doc_id", "doc", "hash", "text"))):
            raw = t.encode("utf-8", "replace")
            merged: list[list[int]] = []
            for s, n in sorted(found.get((d, h), ())):
                s, e = (0, len(raw)) if s < 0 else (s, s + n + length - 1)
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            ends = [0, *(x for span in merged for x in span), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))
            row = {"doc_id": real, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(merged), "kept_sha256": hashlib.sha256(kept).hexdigest()}
            rows.append(row | ({"kept": kept.decode("utf-8", "ignore"), "spans": [{"start": a, "end": b} for a, b in merged], "text_hash": h} if with_text else {}))
        fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
        if with_text:
            fields += [("kept", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("text_hash", pa.int64())]
        return pa.Table.from_pylist(rows, schema=pa.schema(fields))

    return cut


def remove_repeats(docs: DataFrame, length: int = 100, gram: int | None = None, with_text: bool = True, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept text, the removed spans and text_hash.

    Every byte covered by a string of `length` bytes that also starts earlier goes: in a document with a smaller id, or
    in the same one further left. Strings are judged on the input, not on what is left, may overlap, and never cross
    documents. Missing and empty texts have no bytes. Texts under one id are ordered by a
    hash; repeated rows (same id and text) count as one document and get the same result. Rows without an id
    come before all ids. An empty table gives an empty result. Extra columns are ignored.
    text_hash, xxhash64 of the text (a missing one as empty), tells apart texts under one id.
    Characters that a cut splits are missing from `kept`; the counts and the digest are those of bytes.
    """
    gram = gram or length - length // 2 + 2
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"))
    chunked, chunks, total = rolling.chunked(source, "doc")
    buckets = pieces_for(total / max(1, (length - gram) // 2), rolling.BUCKET_HASHES)
    digests = source.where(F.octet_length("text") >= length).select("doc", "hash", F.md5("text").alias("digest"))
    firsts = digests.groupBy("hash", "digest").agg(F.min("doc").alias("first"))
    copies = digests.join(firsts, ["hash", "digest"]).where(F.col("doc") > F.col("first")).select(
        F.pmod(F.xxhash64("doc"), F.lit(chunks)).cast("int").alias("chunk"), "doc", "hash", F.lit(-1).alias("start"), F.lit(0).alias("strings")
    )
    copies = copies.select(*(F.col(c).alias(c) for c in copies.columns))
    by_chunk = chunked.groupBy("chunk")
    packed = by_chunk.cogroup(copies.groupBy("chunk")).applyInArrow(_gram_sender(length, gram, buckets), rolling.PACKED)
    levels = rolling.frequencies(packed)
    none = lambda kind: F.lit(None).cast(kind)
    known = levels.select("chunk", none("long").alias("doc"), none("long").alias("hash"), none("int").alias("start"), none("int").alias("strings"), "bucket", "counts").unionByName(
        copies.withColumn("bucket", none("int")).withColumn("counts", none("binary"))
    )
    pieces = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(_piece_sender(length, gram, LEAST_BUCKETS + 4 * buckets), PIECES)
    repeats = pieces.groupBy("bucket").applyInArrow(_repeat_finder(length, chunks), "doc long, hash long, start int, strings int")
    spans = repeats.withColumn("chunk", F.pmod(F.xxhash64("doc"), F.lit(chunks)).cast("int")).unionByName(copies)
    return by_chunk.cogroup(spans.groupBy("chunk")).applyInArrow(_cutter(length, with_text), RESULT if with_text else SHORT_RESULT)
