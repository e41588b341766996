"""Token counts from a BPE tokenizer compiled to a deterministic finite-state transducer.

The transducer reads the normalised text character by character. A transition carries the change
in the number of tokens that the text read so far has. A state keeps what decides the future: the
longest suffix that some piece begins with and, at each of its places, the last token and
the count there. A piece ends the encoding of a prefix exactly if it doesn't merge with the
token before it, so every prefix has one last token; the states follow from that and are
built when first met.

A text falls into words at the blank markers, where the machine restarts, and long words into
chunks. Words and chunks run side by side, one character a step. The map of a word is
constant (it starts in the start state), so words compose by a prefix sum of their counts; the
maps of the chunks of a long word compose by passing exit states on until nothing changes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import identified, kept
from ebbtide.llm.sp_model import BPE, CONTROL, NORMAL, SPACE, UNKNOWN, USER_DEFINED, read_model

#: Bytes of text that run together; a longer text is a run of its own.
RUN_BYTES = 500_000
CHUNK = 48
#: States a worker keeps; beyond that it forgets the younger half, which is the rarer one.
MOST_STATES = 200_000

#: Pairs of tokens of which a worker remembers whether they merge.
MOST_PAIRS = 500_000


class Transducer:
    """The transducer of one model, with its states and columns (characters) built on demand."""

    def __init__(self, data: bytes):
        model = read_model(data)
        if model.kind != BPE or model.charsmap or model.remove_extra_spaces or not (model.escape_spaces and model.byte_fallback):
            raise ValueError("only BPE models with identity normalisation, escaped blanks and byte fallback are compiled")
        if any(kind == USER_DEFINED for *_, kind in model.pieces):
            raise ValueError("user-defined pieces aren't compiled")
        self.prefix = SPACE if model.add_dummy_prefix else ""
        self.score = {p: s for p, s, kind in model.pieces if kind == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece holds a blank behind other characters")
        # texts to themselves, so that states and pairs share them
        self.beginnings = {b: b for b in ("", *(p[:i] for p in self.score for i in range(1, len(p) + 1)))}
        self.known = set("".join(self.score))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.column = np.full(0x110000, -1, dtype=np.int32)
        self.letters: list[str] = []
        self.states: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.next = np.full((1024, 64), -1, dtype=np.int32)
        self.gain = np.zeros((1024, 64), dtype=np.int8)
        self.state(("", None, 0))

    def trim(self) -> None:
        """Forget all but the states met first, and the transitions to them."""
        keep = max(1, MOST_STATES // 2)
        for key in self.keys[keep:]:
            del self.states[key]
        del self.keys[keep:]
        self.next[keep:] = -1
        self.next[self.next >= keep] = -1

    def merged(self, text: str) -> list[str]:
        """The encoding by its definition: of all adjacent pairs that form a piece the best, then the leftmost, merges."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def apart(self, before: str | None, token: str) -> bool:
        """Whether the two stay as they are when encoded together."""
        if before is None:
            return True
        key = (before, token)
        if key not in self.pairs:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.merged(before + token) == [before, token]
        return self.pairs[key]

    def widen(self, rows: int, columns: int) -> None:
        """Room for more states and characters."""
        more = ((0, rows), (0, columns))
        self.next, self.gain = np.pad(self.next, more, constant_values=-1), np.pad(self.gain, more)

    def state(self, key: tuple) -> int:
        """The number of a state: its suffix, then the last token at each place, then the counts there."""
        if key not in self.states:
            self.states[key] = len(self.keys)
            self.keys.append(key)
            if len(self.keys) > len(self.next):
                self.widen(len(self.next) // 8, 0)
        return self.states[key]

    def step(self, state: int, char: str) -> tuple[int, int]:
        """The state after `char`, and the change in tokens."""
        if char not in self.known:  # byte tokens, with which nothing merges
            return 0, len(char.encode("utf-8", "replace"))
        suffix, *rest = self.keys[state]
        last, counts = rest[: len(rest) // 2], rest[len(rest) // 2 :]
        here = suffix + char
        for size in range(len(here), 0, -1):
            token, at = here[-size:], len(suffix) + 1 - size
            if token in self.score and self.apart(last[at], token):
                change = counts[at] + 1
                break
        else:
            token, change = char, len(char.encode())  # a character of pieces that is no piece itself
        tail = here
        while tail not in self.beginnings:
            tail = tail[1:]
        keep = -(len(tail) + 1)
        token = self.beginnings.get(token, token)
        key = (self.beginnings[tail], *[*last, token][keep:], *[c - change for c in (*counts, change)][keep:])
        return self.state(key), change

    def columns(self, codes: np.ndarray) -> np.ndarray:
        found = self.column[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                char = chr(code)
                if char not in self.known:  # one column per length in bytes
                    char = {1: "\x00", 2: "\x80", 3: "ࠀ", 4: "\U00010000"}[len(char.encode("utf-8", "replace"))]
                    if char in self.known:
                        char = chr(code)
                if char not in self.letters:
                    self.letters.append(char)
                    if len(self.letters) > self.next.shape[1]:
                        self.widen(0, 16)
                self.column[code] = self.letters.index(char)
            found = self.column[codes]
        return found

    def run(self, columns: np.ndarray, start: np.ndarray, size: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit state and tokens gained of many pieces of text, each from its entry state; one character of all a step."""
        order = np.argsort(-size, kind="stable")
        at, state, total = start[order], entry[order].astype(np.int64), np.zeros(len(start), dtype=np.int64)
        falling = -size[order]
        for i in range(int(size.max()) if len(size) else 0):
            n = int(np.searchsorted(falling, -i, side="left"))  # pieces longer than i
            s, c = state[:n], columns[at[:n] + i]
            to = self.next[s, c]
            if (to < 0).any():
                for cell in np.unique(s[to < 0] * len(self.letters) + c[to < 0]).tolist():
                    a, b = divmod(cell, len(self.letters))
                    goal, change = self.step(a, self.letters[b])
                    self.next[a, b], self.gain[a, b] = goal, change
                to = self.next[s, c]
            total[:n] += self.gain[s, c]
            state[:n] = to
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; an empty text has none."""
        if len(self.keys) > MOST_STATES:
            self.trim()
        full = [(self.prefix + t.replace(" ", SPACE)) if t else "" for t in texts]
        codes = np.frombuffer("".join(full).encode("utf-32-le", "replace"), dtype="<u4")
        ends = np.cumsum([len(t) for t in full])
        out = np.zeros(len(texts), dtype=np.int64)
        if not len(codes):
            return out
        blank = codes == ord(SPACE)
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        begins = ends - [len(t) for t in full]
        opens[begins[begins < len(codes)]] = True
        word = np.flatnonzero(opens)
        size = np.diff(np.append(word, len(codes)))
        pieces = -(-size // CHUNK)
        of = np.repeat(np.arange(len(word)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = word[of] + nth * CHUNK
        length = np.minimum(CHUNK, size[of] - nth * CHUNK)
        columns = self.columns(codes)
        entry, gained = np.zeros(len(of), dtype=np.int64), np.zeros(len(of), dtype=np.int64)
        leaves = np.zeros(len(of), dtype=np.int64)
        todo = np.arange(len(of))
        while len(todo):
            leaves[todo], gained[todo] = self.run(columns, start[todo], length[todo], entry[todo])
            inner = np.flatnonzero(nth > 0)
            todo = inner[entry[inner] != leaves[inner - 1]]
            entry[todo] = leaves[todo - 1]
        running = np.concatenate([[0], np.cumsum(gained)])
        first = np.searchsorted(start, begins, side="left")
        last = np.searchsorted(start, ends, side="left")
        return running[last] - running[first]


def machine(data: bytes) -> Transducer:
    return kept("token_counts", hashlib.md5(data).hexdigest(), lambda: Transducer(data))


def _counter(data: bytes):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = machine(data)
        for batch in batches:
            sizes, tokens = batch["n_bytes"].to_pylist(), []
            start = size = 0
            for i in range(len(sizes) + 1):
                if i == len(sizes) or (i > start and size + sizes[i] > RUN_BYTES):
                    if i > start:
                        tokens.append(own.count(batch["text"].slice(start, i - start).to_pylist()))
                    start, size = i, 0
                if i < len(sizes):
                    size += sizes[i]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], pa.array(np.concatenate(tokens or [np.zeros(0, np.int64)]))], ["doc_id", "n_bytes", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, model: bytes, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Counts are those of the sentencepiece library without begin, end or added tokens. Missing
    and empty texts have none. Repeated rows and rows without an id are counted like others. An empty table gives an empty
    result.
    """
    source = identified(docs, id_col, text_col).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = source.mapInArrow(_counter(model), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
