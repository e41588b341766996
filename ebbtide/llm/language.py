"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds the vectors of its letters, each
rotated by its place, into one; a text bundles (adds) the vectors of its trigrams; a language
bundles its texts. A text belongs to the language whose prototype has the highest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import identified
from ebbtide.llm.quality import held_out

DIMENSIONS = 1024
SEED = 20_24
#: Texts are bundled in batches of about so many characters; a longer text is a batch of its own.
BATCH_CHARS = 400_000
#: Fixed-point scale of the bundles, so that sums don't depend on their order.
FIXED = 2**20
#: Trigram vectors kept by a worker.
KEPT_GRAMS = 30_000
BLANK = 32

_letters: dict[int, np.ndarray] = {}
_rows: dict[int, int] = {}
_vectors = np.zeros((KEPT_GRAMS, DIMENSIONS), dtype=np.int8)
_alpha: list[np.ndarray] = []


def letter_vector(code: int) -> np.ndarray:
    if code not in _letters:
        _letters[code] = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1
    return _letters[code]


def gram_vector(gram: int) -> np.ndarray:
    """Binding of three letters: rotated by their place, multiplied."""
    a, b, c = gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF
    return np.roll(letter_vector(a), 2) * np.roll(letter_vector(b), 1) * letter_vector(c)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """The vectors of distinct trigrams, from the worker's store where it has them."""
    global _rows
    if len(grams) > KEPT_GRAMS:
        return np.stack([gram_vector(int(g)) for g in grams]).astype(np.float32)
    new = [g for g in grams.tolist() if g not in _rows]
    if len(_rows) + len(new) > KEPT_GRAMS:
        _rows, new = {}, grams.tolist()
    for g in new:
        _vectors[len(_rows)] = gram_vector(g)
        _rows[g] = len(_rows)
    return _vectors[[_rows[g] for g in grams.tolist()]].astype(np.float32)


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _alpha:
        _alpha.append(np.array([chr(i).isalpha() for i in range(0x10000)]))
    out = _alpha[0][np.minimum(codes, 0xFFFF)]
    for i in np.flatnonzero(codes > 0xFFFF):
        out[i] = chr(int(codes[i])).isalpha()
    return out


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of lower-cased letters and single blanks, and their counts per text."""
    codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "replace"), dtype="<u4") for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    flat = np.concatenate(codes).astype(np.int64)
    flat[~_is_letter(flat)] = BLANK
    keep = np.ones(len(flat), dtype=bool)
    keep[1:] = (flat[1:] != BLANK) | (flat[:-1] != BLANK) | (doc[1:] != doc[:-1])
    flat, doc = flat[keep], doc[keep]
    seen = np.unique(flat[:1]) if len(flat) < 3 else None
    if seen is not None:
        return np.zeros(0, np.int64), np.zeros((len(texts), 0), np.float32)
    same = doc[:-2] == doc[2:]
    first, doc = flat[:-2][same], doc[:-2][same]
    second, third = flat[1:-1][same], flat[2:][same]
    present = np.zeros(int(flat.max()) + 1, dtype=bool)
    present[flat] = True
    alphabet = np.flatnonzero(present)
    if len(alphabet) <= 200:  # trigrams fit a dense table
        place = np.zeros(len(present), dtype=np.int64)
        place[alphabet] = np.arange(len(alphabet))
        n = len(alphabet)
        dense = (place[first] * n + place[second]) * n + place[third]
        used = np.zeros(n**3, dtype=bool)
        used[dense] = True
        ids = np.flatnonzero(used)
        column = np.zeros(n**3, dtype=np.int64)
        column[ids] = np.arange(len(ids))
        column = column[dense]
        grams = alphabet[ids // (n * n)] << 42 | alphabet[ids // n % n] << 21 | alphabet[ids % n]
    else:
        grams, column = np.unique(first << 42 | second << 21 | third, return_inverse=True)
    counts = np.bincount(doc * len(grams) + column, minlength=len(texts) * len(grams))
    return grams, counts.reshape(len(texts), len(grams)).astype(np.float32)


def _groups(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > BATCH_CHARS or i - start >= 256):
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if len(texts) > start:
        yield slice(start, len(texts))


def _bundle_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task: the bundle of each language, every text with the same weight."""
    bundles: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch["text"].to_pylist(), np.array(batch["lang"].to_pylist(), dtype=object)
        for part in _groups(texts):
            grams, counts = trigram_counts(texts[part])
            total = counts.sum(axis=1, keepdims=True)
            weights = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
            names = sorted(set(langs[part]))
            shares = np.stack([weights[langs[part] == n].sum(axis=0) for n in names])
            for name, v in zip(names, shares @ gram_vectors(grams) if len(grams) else np.zeros((len(names), DIMENSIONS))):
                bundles[name] = bundles.get(name, 0) + np.rint(v.astype(np.float64) * FIXED).astype(np.int64)
    for name, v in bundles.items():
        yield pa.RecordBatch.from_pydict({"lang": [name] * DIMENSIONS, "i": np.arange(DIMENSIONS, dtype=np.int32), "v": v})


def learn_prototypes(texts: DataFrame) -> dict[str, np.ndarray]:
    """One vector per language from all rows of text and lang; sums are merged per task first."""
    parts = texts.mapInArrow(_bundle_languages, "lang string, i int, v long")
    rows = parts.groupBy("lang", "i").agg(F.sum("v").alias("v")).orderBy("lang", "i").toArrow().to_pydict()
    out: dict[str, np.ndarray] = {}
    for lang, i, v in zip(rows["lang"], rows["i"], rows["v"]):
        out.setdefault(lang, np.zeros(DIMENSIONS))[i] = v
    return {k: v for k, v in out.items() if np.abs(v).sum() > 0}


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (half of 1 + cosine).

    Learns from rows that have a language and aren't held out. Texts that are missing, empty or without letters
    are `und` with score 0, as is everything if nothing could be learnt. Ties go to the language first in
    alphabetical order. Repeated rows get equal results. Rows without an id count as not held
    out. An empty table gives an empty result.
    """
    source = identified(docs.select(id_col, text_col), id_col, text_col)
    learnt = docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col)).select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    prototypes = learn_prototypes(learnt)
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]) if names else np.zeros((1, DIMENSIONS))
    matrix = (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lang, score = batch["text"].to_pylist(), [], []
            for part in _groups(texts):
                grams, counts = trigram_counts(texts[part])
                vectors = counts @ gram_vectors(grams) if len(grams) else np.zeros((len(counts), DIMENSIONS), np.float32)
                length = np.linalg.norm(vectors, axis=1, keepdims=True)
                cosine = vectors @ matrix.T / np.maximum(length, 1e-12)
                best = cosine.argmax(axis=1)
                for row, b in enumerate(best):
                    known = bool(names) and length[row, 0] > 0
                    lang.append(names[b] if known else "und")
                    score.append(min(1.0, max(0.0, (1 + float(cosine[row, b])) / 2)) if known else 0.0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    found = source.mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
