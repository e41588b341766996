"""SentencePiece encoding and decoding with the tokenizers library as backend."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ebbtide.llm.common import identified
from ebbtide.llm.sp_model import BPE, BYTE, NORMAL, SPACE, UNIGRAM, USER_DEFINED, PieceModel, read_model

#: Texts are encoded in batches of about so many characters.
BATCH_CHARS = 2_000_000
#: Words whose pieces a worker remembers, and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 800_000, 64
#: Ids as they are digested.
IDS = np.dtype("<i4")

_built: dict[str, object] = {}


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece, best score first.

    Among equal scores longer pieces come first and then the pair with the longer left part:
    runs of blanks, whose pieces share one score, then grow from the left as the model's
    leftmost-first rule has it.
    """
    usable = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    pairs = [(-s, -len(p), -i, p[:i], p[i:]) for p, s in usable.items() for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable]
    return [(a, b) for *_, a, b in sorted(pairs)]


def build_tokenizer(data: bytes):
    """A tokenizers.Tokenizer with the model's normaliser, blank marker, scores or merges, and byte fallback."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    model = read_model(data)
    if model.charsmap or model.remove_extra_spaces or not model.escape_spaces:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.remove_extra_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    else:
        steps = []
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", SPACE))
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unknown_id, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, merges_of(model), unk_token=model.pieces[model.unknown_id][0], fuse_unk=not model.byte_fallback, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model kind {model.kind} is neither unigram nor BPE")
    out = Tokenizer(core)
    out.normalizer = normalizers.Sequence(steps)
    strip = [decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(SPACE, " "), *strip])
    return out


def _once(kind: str, data: bytes, make):
    key = kind + hashlib.md5(data).hexdigest()
    if key not in _built:
        _built[key] = make(data)
    return _built[key]


def batches_of(texts: list[str], chars: int = BATCH_CHARS) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > chars:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if len(texts) > start:
        yield slice(start, len(texts))


def words_apart(model: PieceModel) -> bool:
    """Whether no usable piece holds a blank behind another character, so that a text is coded word by word."""
    return not any(SPACE in p.lstrip(SPACE) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


def single_spaced(text: str) -> bool:
    """Whether the text is words with one blank between each two."""
    return text != "" and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " "


class WordCoder:
    """Codes texts with the backend, each distinct word once where a text is coded word by word.

    Those are texts of single blanks, for a BPE model that puts a blank before a text and changes
    no character; all others are coded whole. Ids are kept as little-endian 32-bit integers. `learnt` is called with words that
    were coded as one text, and the ids of that text.
    """

    def __init__(self, data: bytes, learnt: Callable[[list[str], list[int]], None] | None = None):
        model = read_model(data)
        self.tokenizer = _once("tokenizers", data, build_tokenizer)
        plain = model.escape_spaces and model.add_dummy_prefix and not model.charsmap and not model.remove_extra_spaces
        self.by_word = plain and model.kind == BPE and model.byte_fallback and words_apart(model)
        self.starts = np.array([p.startswith(SPACE) for p, _, _ in model.pieces])
        self.kept: dict[str, bytes] = {}
        self.learnt = learnt or (lambda words, ids: None)

    def _coded(self, texts: list[str]) -> Iterator[list[int]]:
        return (e.ids if t else [] for e, t in zip(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), texts))

    def _learn(self, words: list[str]) -> None:
        """Many words are coded as one text, which is cut before each piece with a blank."""
        rows = [words[i : i + 1000] for i in range(0, len(words), 1000)]
        for row, ids in zip(rows, self._coded([" ".join(row) for row in rows])):
            raw = np.array(ids, dtype=IDS)
            at = np.flatnonzero(self.starts[raw])
            if len(at) == len(row) and at[0] == 0:
                cuts = (at * raw.itemsize).tolist()
                self.kept.update(zip(row, map(raw.tobytes().__getitem__, map(slice, cuts, [*cuts[1:], None]))))
                self.learnt(row, ids)
            else:
                for word, own in zip(row, self._coded(row)):
                    self.kept[word] = np.array(own, dtype=IDS).tobytes()
                    self.learnt([word], own)

    def words(self, texts: list[str]) -> list[list[str] | None]:
        """The words of each text that is coded word by word, and None for the others."""
        return [t.split(" ") if self.by_word and single_spaced(t) else None for t in texts]

    def coded(self, texts: list[str], words: list[list[str] | None]) -> list[bytes]:
        """The ids of every text, given what words() says of them."""
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        new = list(set(chain.from_iterable(w for w in words if w)) - self.kept.keys())
        self._learn(new)
        known = self.kept
        whole = self._coded([t for t, w in zip(texts, words) if w is None])
        out = [np.array(next(whole), dtype=IDS).tobytes() if w is None else b"".join(map(known.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > KEPT_LENGTH:
                del known[w]
        return out

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [_listed(x) for x in self.coded(texts, self.words(texts))]


def _listed(raw: bytes) -> list[int]:
    return np.frombuffer(raw, dtype=IDS).tolist()


def encode_texts(data: bytes, texts: list[str]) -> list[list[int]]:
    """Piece ids of every text, without begin, end or other added tokens; an empty text has none."""
    coder = _once("words", data, WordCoder)
    return [ids for part in batches_of(texts) for ids in coder.ids(texts[part])]


def decode_ids(data: bytes, ids: list[list[int]]) -> list[str]:
    return _once("tokenizers", data, build_tokenizer).decode_batch(ids, skip_special_tokens=False)


def _native(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


class WholeCoder:
    """Encodes each text as a whole, decodes its ids again, and encodes it as a whole with the sentencepiece library.

    Nothing is taken from other texts. Where a model only marks blanks, Python's replacement does so faster than the
    backend's normaliser.
    """

    def __init__(self, data: bytes):
        from tokenizers import normalizers

        model = read_model(data)
        self.native, self.tokenizer = _native(data), build_tokenizer(data)
        self.marked = not model.charsmap and not model.remove_extra_spaces and model.escape_spaces
        self.before = SPACE if model.add_dummy_prefix else ""
        if self.marked:
            self.tokenizer.normalizer = normalizers.Sequence([])

    def code(self, texts: list[str]) -> tuple[list[bytes], list[str], list[bool]]:
        """Of every text the ids, what they decode to, and whether the sentencepiece library gives the same."""
        sent = [self.before + t.replace(" ", SPACE) for t in texts] if self.marked else texts
        ids = [e.ids if t else [] for e, t in zip(self.tokenizer.encode_batch_fast(sent, add_special_tokens=False), texts)]
        coded = [np.array(x, dtype=IDS).tobytes() for x in ids]
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        parity = [self.native.encode_as_numpy(t).astype(IDS, copy=False).tobytes() == x for t, x in zip(texts, coded)]
        return coded, back, parity


class CheckedCoder:
    """Codes texts, decodes them again and compares the ids with those of the sentencepiece library, word by word.

    This is no part of encode_documents, which treats whole texts (see WholeCoder). Where a text is coded word by word, both libraries code each word alike wherever it stands, and what a word's pieces decode to
    begins with the word's blank, so that no run of bytes goes on beyond it. Each distinct word is therefore decoded and compared
    when it is learnt. Texts with a word that does not decode to itself are decoded whole; all other texts, such as those with
    runs of blanks, are decoded and compared whole.
    """

    def __init__(self, data: bytes):
        self.native = _native(data)
        self.coder = WordCoder(data, self._learnt)
        #: Words that the libraries code differently, and words that may not decode to themselves.
        self.other: set[str] = set()
        self.changed: set[str] = set()

    def _decoded(self, ids: list[list[int]]) -> list[str]:
        return self.coder.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def _learnt(self, words: list[str], ids: list[int]) -> None:
        """Many words are compared and decoded as one text, and one by one if that text differs."""
        text = " ".join(words)
        same = self.native.encode(text) == ids
        if same and self.coder.starts[ids[0]] and self._decoded([ids]) == [text]:
            return
        for word in words:
            own = ids if len(words) == 1 else _listed(self.coder.kept[word])
            if not same and self.native.encode(word) != own:
                self.other.add(word)
            if not self.coder.starts[own[0]] or self._decoded([own]) != [word]:
                self.changed.add(word)

    def code(self, texts: list[str]) -> tuple[list[bytes], list[str], list[bool]]:
        """Of every text the ids, what they decode to, and whether the sentencepiece library gives the same."""
        if len(self.coder.kept) > KEPT_WORDS:
            self.other.clear()
            self.changed.clear()
        words = self.coder.words(texts)
        coded = self.coder.coded(texts, words)
        back = [t if w is not None and self.changed.isdisjoint(w) else None for t, w in zip(texts, words)]
        whole = iter(self._decoded([_listed(x) for x, b in zip(coded, back) if b is None]))
        back = [next(whole) if b is None else b for b in back]
        parity = [self.other.isdisjoint(w) if w is not None else self.native.encode(t) == _listed(x) for t, x, w in zip(texts, coded, words)]
        return coded, back, parity


def _coder(data: bytes, threads: int, with_ids: bool):
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        coder = _once("whole", data, WholeCoder)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for part in batches_of(texts):
                own = texts[part]
                coded, back, parity = coder.code(own)
                sizes = [len(x) // IDS.itemsize for x in coded]
                columns = {
                    "doc_id": batch["doc_id"].slice(part.start, len(own)),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in coded]),
                    "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                    "round_trip": pa.array([a == b for a, b in zip(own, back)]),
                    "parity": pa.array(parity),
                }
                if with_ids:
                    ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
                    columns["ids"] = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(coded), dtype=IDS), pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return code


def encode_documents(docs: DataFrame, model: bytes, threads: int = 1, with_ids: bool = True, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip, parity, and ids.

    `ids_sha256` digests the ids as little-endian 32-bit integers. `round_trip` says that
    decoding gives the text back, `parity` that the sentencepiece library gives the same ids. Every text
    is encoded, decoded and compared whole. A batch is encoded and decoded by `threads` threads. Missing and empty texts have no pieces. Repeated
    rows and rows without an id are coded like others. An empty table gives an empty result.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean"
    return identified(docs, id_col, text_col).mapInArrow(_coder(model, threads, with_ids), schema + ", ids array<int>" * with_ids)
