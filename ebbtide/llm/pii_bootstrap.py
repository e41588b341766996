"""Personal data by bootstrapped contextual extraction.

Identifiers that fixed rules find are the seeds. The words around them are lexical patterns; patterns and the things that
stand in their slots (instances) make a graph, whose scores Spark computes in rounds: a pattern is as sure as the share of
its slots that hold sure instances, an instance as sure as its best pattern. Patterns that are sure enough turn
looser identifiers in their slots, which the rules don't find, into personal data of their kind.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import identified, row_numbers, stored
from ebbtide.llm.rolling import mix

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Scores are whole thousandths, so sums don't depend on their order.
FULL = 1000
#: Bits of the filter that keeps contexts of no pattern out of the count; it is all that is sent to every task.
FILTER_BITS = 2**20
#: Keys of a join are dealt to so many places each.
SALT = 16
#: Words whose hash a task remembers.
KNOWN_WORDS = 500_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match starts within a number: it would have started at its first digit.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGNS = re.compile("[0-9@]")
_WORD = re.compile(r"\S+")
_CHAIN = re.compile(r"\+?[0-9](?:[ ()./-]{0,3}[0-9])+")
_HEX_IP = re.compile(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}")
_EDGES = ".,;:!?\"'()[]{}<>|*#&%$"

SPAN = "struct<kind:int,start:int,end:int>"
MARK = "struct<kind:int,start:int,end:int,seed:boolean,item:long,wide:boolean,p0:long,p1:long,p2:long>"
FOUND = f"row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<{SPAN}>, marks array<{MARK}>"


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the fixed rules, by kind and place: leftmost non-overlapping matches per kind, failing ones dropped."""
    out = [(EMAIL, s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((IP, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((CARD, *m.span()))
    out += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _loose(text: str, words: list[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Stretches that look like an identifier of some kinds, apart from each other and from those taken."""
    own: list[tuple[int, int, list[int]]] = []
    for s, e in words:
        word = text[s:e]
        if "@" in word or ":" in word:
            s += len(word) - len(word.lstrip(_EDGES))
            core = word.strip(_EDGES)
            if 0 < core.find("@") < len(core) - 1:
                own.append((s, s + len(core), [EMAIL]))
            elif _HEX_IP.fullmatch(core) and core.count(":") >= 2 and any(c != ":" for c in core):
                own.append((s, s + len(core), [IP]))
    before = [(s, e) for s, e, _ in own]
    for m in _CHAIN.finditer(text):
        chain, n = m.group(), len(_digits(m.group()))
        kinds = [IP] * bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3,}", chain))
        kinds += [CARD] * (12 <= n <= 19 and not set(chain) & set("()/+")) + [PHONE] * (7 <= n <= 15)
        if kinds and all(m.end() <= s or e <= m.start() for s, e in before):
            own.append((*m.span(), kinds))
    return (x for x in own if all(x[1] <= s or e <= x[0] for s, e in taken))


class WordHashes:
    """64-bit hashes of lower-cased words, the commoner ones remembered."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        get, out = self.known.get, []
        for w in words:
            h = get(w)
            if h is None:
                h = xxhash.xxh64_intdigest(w.lower().encode())
                if len(self.known) < KNOWN_WORDS:
                    self.known[w] = h
            out.append(h)
        return np.array(out, dtype=np.uint64)


def contexts(before2: np.ndarray, before: np.ndarray, after: np.ndarray) -> list[np.ndarray]:
    """Patterns of a slot: the two words before it; the word before and the one after; the word before alone. 0 stands for no word."""
    one, two, three = (np.uint64(2 * i + 0x9E3779B97F4A7C15) for i in range(3))
    none = np.uint64(0)
    first = np.where((before2 != none) & (before != none), mix(before2 * one + mix(before + one)), none)
    second = np.where((after != none) & (before != none), mix(before * two + mix(after + two)), none)
    third = np.where(before != none, mix(before + three), none)
    return [x.astype(np.int64) for x in (first, second, third)]


def _marks(text: str, base: list[tuple[int, int, int]], hashes: WordHashes) -> list[dict]:
    """Seeds and loose identifiers of a text with the patterns they stand in; the single word before is one only if it is a label."""
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [s for s, _ in words]
    found = [(s, e, [k], True) for k, s, e in base] + [(s, e, kinds, False) for s, e, kinds in _loose(text, words, [(s, e) for _, s, e in base])]
    out = []
    word = lambda i: text[slice(*words[i])] if 0 <= i < len(words) else ""
    for s, e, kinds, seed in found:
        first, last = bisect_right(starts, s) - 1, bisect_right(starts, e - 1) - 1
        near = [word(first - 2), word(first - 1), word(last + 1)]
        h = [hashes([w]) if w else np.zeros(1, dtype=np.uint64) for w in near]
        p = [int(x[0]) for x in contexts(*h)]
        if near[1][-1:] not in (":", "=", "#"):
            p[2] = 0
        for i, kind in enumerate(kinds):
            name = text[s:e].lower() if kind in (EMAIL, IP) else _digits(text[s:e])
            item = np.uint64(xxhash.xxh64_intdigest(f"{kind} {name}".encode())).astype(np.int64)
            # several words in one slot aren't met when words are counted, so they are counted here, once
            out.append({"kind": kind, "start": s, "end": e, "seed": seed, "item": int(item), "wide": first < last and i == 0, "p0": p[0], "p1": p[1], "p2": p[2]})
    return out


_SPAN_TYPE = pa.struct([(c, pa.int32()) for c in ("kind", "start", "end")])
_MARK_TYPE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("item", pa.int64()), ("wide", pa.bool_()), ("p0", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch, rows in row_numbers(batches):
        bases, marks = [], []
        for text in batch["text"].to_pylist():
            signs = _SIGNS.search(text)
            bases.append(base_spans(text) if signs else [])
            marks.append(_marks(text, bases[-1], hashes) if signs else [])
        counts = {f"n_{k}": pa.array([sum(x[0] == i for x in b) for b in bases], pa.int64()) for i, k in enumerate(KINDS)}
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(rows, pa.int64()), "doc_id": batch["doc_id"], **counts,
            "base_sha256": pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in bases]),
            "base": pa.array([[dict(zip(("kind", "start", "end"), x)) for x in b] for b in bases], pa.list_(_SPAN_TYPE)),
            "marks": pa.array(marks, pa.list_(_MARK_TYPE)),
        })


def slots(words: np.ndarray) -> list[np.ndarray]:
    """The patterns that each word of a text stands in, by the words' hashes."""
    padded = np.concatenate([np.zeros(2, dtype=np.uint64), words, np.zeros(1, dtype=np.uint64)])
    return contexts(padded[:-3], padded[1:-2], padded[3:])


def _counter(wanted: bytes):
    """Counts the slots of patterns, whatever word fills them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted, dtype=np.uint8), bitorder="little").astype(bool)
        hashes = WordHashes()
        for batch in batches:
            found = [np.zeros(0, dtype=np.int64)]
            for text in batch["text"].to_pylist():
                for p in slots(hashes(text.split())):
                    found.append(p[bits[p & (FILTER_BITS - 1)] & (p != 0)])
            patterns, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(patterns, pa.int64()), "n": pa.array(n, pa.int64())})

    return count


def _filter(patterns: DataFrame) -> bytes:
    """One bit per residue of a pattern: of the same size however many there are."""
    taken = patterns.select(F.col("pattern").bitwiseAND(FILTER_BITS - 1).alias("bit")).distinct().toArrow()["bit"].to_numpy()
    bits = np.zeros(FILTER_BITS, dtype=np.uint8)
    bits[taken] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _salted(left: DataFrame, right: DataFrame, on: list[str], by: str) -> DataFrame:
    """An inner join whose keys are spread over SALT places by another column of the left side."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALT)).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")


def pattern_scores(texts: DataFrame, marks: DataFrame, support: int, rounds: int) -> DataFrame:
    """pattern, kind, sure: how sure a pattern is of its kind, in thousandths, after so many rounds over the graph.

    An instance of a seed is wholly sure. A pattern's score is the sum over its occurrences of the scores of the
    instances there, divided by the number of its slots in all texts plus one; it counts only with `support` different
    instances of a score. Any other instance has the score of its best pattern.
    """
    found = marks.select("kind", "item", "seed", "wide", F.posexplode(F.array("p0", "p1", "p2")).alias("form", "pattern")).where("pattern <> 0")
    edges = found.groupBy("pattern", "item", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("wide") & (F.col("form") == 1)).cast("long")).alias("wide"), F.max("seed").alias("seed")
    )
    edges = stored(edges, "edges")
    live = stored(edges.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("items")).where(F.col("items") >= support).select("pattern").distinct(), "live")
    edges = stored(_salted(edges, live, ["pattern"], "item"), "live_edges")
    words = texts.mapInArrow(_counter(_filter(live)), "pattern long, n long")
    slots = words.unionByName(edges.groupBy("pattern").agg(F.sum("wide").alias("n"))).groupBy("pattern").agg((F.sum("n") + 1).alias("slots"))
    slots = stored(slots.join(live, "pattern"), "slots")
    scores = edges.where("seed").select("item", "kind", F.lit(FULL).cast("long").alias("score")).distinct()
    for i in range(rounds):
        held = _salted(edges, scores.where("score > 0"), ["item", "kind"], "pattern")
        sums = held.groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("sum"), F.count(F.lit(1)).alias("items"))
        sure = sums.where(F.col("items") >= support).join(slots, "pattern").select("pattern", "kind", F.least(F.expr("sum div slots"), F.lit(FULL)).cast("long").alias("sure"))
        sure = stored(sure, f"patterns{i}")
        best = _salted(edges, sure, ["pattern", "kind"], "item").groupBy("item", "kind").agg(F.max(F.when(F.col("seed"), FULL).otherwise(F.col("sure"))).alias("score"))
        seeds = edges.where("seed").select("item", "kind", F.lit(FULL).cast("long").alias("score"))
        scores = stored(best.unionByName(seeds).groupBy("item", "kind").agg(F.max("score").cast("long").alias("score")), f"items{i}")
    return sure


def find_personal_data(docs: DataFrame, confidence: float = 0.5, support: int = 3, rounds: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, base, added.

    `base` holds the spans (kind, start, end) that the fixed rules find, ends exclusive, in code points, and the counts and the
    digest are theirs. `added` holds those that patterns of at least the given confidence found besides: looser
    identifiers (an address without a domain's dots, numbers without a plus sign or a right check digit, other forms of internet
    addresses) that overlap no base span; of several kinds the surest counts, ties by the order of kinds. Patterns need `support`
    different instances. Missing and empty texts have no spans. Repeated rows are documents of their own, and rows without an id are
    treated like others. Extra columns are not looked at. An empty table gives an empty result.

    A text is read whole by one task. The graph holds hashes of words and identifiers, grows with the input and
    is joined by salted keys; a filter of fixed size goes to all tasks.
    """
    texts = identified(docs, id_col, text_col)
    found = stored(texts.mapInArrow(_extract, FOUND), "found")
    marks = found.select("row", F.explode("marks").alias("m")).select("row", "m.*")
    sure = pattern_scores(texts.select("text"), marks, support, rounds).where(F.col("sure") >= int(FULL * confidence))
    loose = marks.where("not seed").select("row", "kind", "start", "end", F.explode(F.array("p0", "p1", "p2")).alias("pattern"))
    hits = _salted(loose, sure, ["pattern", "kind"], "row").groupBy("row", "start", "end").agg(F.max(F.struct("sure", (-F.col("kind")).alias("kind"))).alias("best"))
    hits = hits.select("row", F.struct((-F.col("best.kind")).cast("int").alias("kind"), "start", "end").alias("span"))
    added = hits.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("added"))
    none = F.array().cast(f"array<{SPAN}>")
    return found.join(added, "row", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", F.coalesce("added", none).alias("added")
    )


def spelt_spans(spans: Column) -> Column:
    """kind:start:end of every span by kind and place, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
