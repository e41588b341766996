"""Token alignment against a plain double loop, the galloping search, and edge frames."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbtide.llm import token_alignment
from ebbtide.llm.queries import model_bytes, vocabulary_bytes
from ebbtide.llm.token_alignment import ByteLevel, Pieces, align_tokenizers, gallop, pair_counts

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def sides():
    return ByteLevel(vocabulary_bytes("byte_bpe_50k.json")), Pieces(model_bytes())


def spelt(side, text):
    """(start, end, id) of every token, or None if the tokens don't spell the text with a space in front."""
    out, at = [], 0
    for i in side.encode([text])[0]:
        out.append((at, at + len(side.bytes[i]), i))
        at = out[-1][1]
    return out if text and b"".join(side.bytes[i] for *_, i in out) == (" " + text).encode() else None


def brute(sides, texts):
    rows, counts = [], Counter()
    for text in texts:
        a, b = (spelt(s, text or "") for s in sides)
        if a is None or b is None:
            rows.append(None)
            continue
        links = [(i, j) for s, e, i in a for x, y, j in b if s < y and x < e]
        counts.update(links)
        groups, start = [], 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= end) for side in (a, b)))
            start = end
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    none = (0, 0, 0, 0, 0, 0, "")
    return [none if r is None else (*r[:3], len(r[3]), sum(counts[x] == most[x[1]] for x in r[3]), sum(counts[x] for x in r[3]), hashlib.sha256(r[4].encode()).hexdigest()) for r in rows], counts, most


TEXTS = [
    "Hello world, this is a token alignment.", "Größe — naïve 漢字 🙂 1234567", None, "", " ", "  two  spaces\n\n\ttabs ", "a ▁ b", "<s> </s> <unk> <0x0A> <|endoftext|>", "\x00\x01", "é é",
    "Hello world, this is a token alignment.", "antidisestablishmentarianism " * 20, "x" * 500, "▁", "the the the of of and",
]


def aligned(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, chunk int, links string").repartition(3)
    return align_tokenizers(docs, vocabulary_bytes("byte_bpe_50k.json"), model_bytes(), **options)


@pytest.mark.parametrize("chunk", [50, 8_000_000])
def test_equals_a_double_loop(spark, sides, monkeypatch, chunk):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(token_alignment, "RUN_BYTES", min(chunk, 200))
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[1]), (0, TEXTS[0]), (0, TEXTS[0])]
    expected, _, _ = brute(sides, [t for _, t in rows])
    found = [tuple(r) for r in aligned(spark, rows).collect()]
    assert sorted(found, key=str) == sorted([(d, *x) for (d, _), x in zip(rows, expected)], key=str)


def test_groups_and_pair_counts(spark, sides, monkeypatch):
    rows = [(1, "Hello world"), (2, "")]
    found = {r.doc_id: r for r in aligned(spark, rows, with_groups=True).collect()}
    a, b = (s.encode(["Hello world"])[0] for s in sides)
    flat = found[1].groups.replace("|", ",").replace(";", ",").split(",")
    assert sorted(map(int, flat)) == sorted(a + b) and found[2].groups is None
    kept = []
    monkeypatch.setattr(token_alignment, "pair_counts", lambda x: kept.append(pair_counts(x)) or kept[0])
    aligned(spark, [(i, t) for i, t in enumerate(TEXTS)]).count()
    _, counts, most = brute(sides, TEXTS)
    assert {(r.a, r.b): (r.total, r.best) for r in kept[0].collect()} == {k: (n, int(n == most[k[1]])) for k, n in counts.items()}


def test_a_very_long_text(spark):
    text = "the quick brown fox. " * 100_000
    (r,) = aligned(spark, [(1, text)]).collect()
    assert r.n_links >= max(r.n_a, r.n_b) >= r.n_groups > 300_000 and r.count_sum > r.n_links


def test_empty_table(spark):
    assert aligned(spark, []).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=300), st.lists(st.integers(0, 400), max_size=300), st.sampled_from([1, 3, 64]))
def test_gallop_counts_smaller_entries(needles, hay, lane):
    needles, hay = (np.array(sorted(set(x)), dtype=np.int64) for x in (needles, hay))
    assert gallop(needles, hay, lane).tolist() == np.searchsorted(hay, needles).tolist()


def test_words_make_the_whole(sides):
    """Coding word by word gives what the libraries give for whole texts, whatever stands around blanks."""
    coder = token_alignment.Coder(*sides)
    assert coder.by_word
    rng = random.Random(4)
    pool = [" ", " ", "  ", "\n", "\t", "\u3000", "\xa0", "\x1c", "'s", "'", "a", "the", "12", "é", "漢", "🙂", ".", "▁", "ß-x", "\u180e", "\u200b", "<s>", "don't", "\x00"]
    texts = ["".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(4000)]
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        for t, got, *whole in zip(part, coder(part), *(s.encode(part) for s in sides)):
            right = all(b"".join(s.bytes[i] for i in ids) == (" " + t).encode() for s, ids in zip(sides, whole))
            assert (got and [np.frombuffer(x, dtype="<i4").tolist() for x in got]) == (whole if right else None), repr(t)


def test_words_beyond_those_remembered(sides, monkeypatch):
    monkeypatch.setattr(token_alignment, "KNOWN_WORDS", 3)
    full, small = token_alignment.Coder(*sides), token_alignment.Coder(*sides)
    texts = ["a b c", "d ▁ a", "e f ▁", "a d e", "▁ x", "b b b"]
    assert [small([t])[0] for t in texts] == full(texts) and len(small.known) == 3
