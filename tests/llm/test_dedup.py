"""Exact dedup, suffix dedup, line dedup and the similarity join against brute force, and their edge frames."""

import functools
import hashlib
import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.llm import rolling, suffix_dedup
from ebbtide.llm.components import components
from ebbtide.llm.exact_dedup import DigestIndex, exact_dedup, with_digest
from ebbtide.llm.jaccard_join import shingle_sets, similar_documents
from ebbtide.llm.line_templates import drop_recurring_lines, lines_of, masked_lines
from ebbtide.llm.suffix_array import suffix_arrays
from ebbtide.llm.suffix_dedup import remove_repeats

DOCS = "doc_id long, text string, n_lines string, hash string"
LOWER = {i: i + 32 for i in range(65, 91)}


def frame(spark, rows):
    """Documents with extra columns whose names clash with those in use inside."""
    return spark.createDataFrame([(d, t, "x", None) for d, t in rows], DOCS)


# exact dedup


def test_exact_dedup_keeps_the_largest_id(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "ab" * 30000), (7, "ab" * 30000), (None, "ab"), (None, "z")]
    found = {(r.doc_id, r.text_sha256[:6], r.keep_id, r.group_size, r.kept) for r in exact_dedup(frame(spark, rows)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()[:6]
    assert found == {
        (1, sha("ab"), 2, 3, False), (2, sha("ab"), 2, 3, True), (None, sha("ab"), 2, 3, False), (3, sha("É"), 3, 1, True),
        (4, sha("é"), 4, 1, True), (5, sha(""), 6, 2, False), (6, sha(""), 6, 2, True), (7, sha("ab" * 30000), 7, 2, True),
        (None, sha("z"), None, 1, True),
    }
    assert exact_dedup(frame(spark, [])).count() == 0


def test_index_outlives_a_batch(spark, tmp_path):
    path = str(tmp_path / "index")
    assert [tuple(r) for r in exact_dedup(frame(spark, [(1, "a"), (2, "b")]), path, 4).select("doc_id", "kept").orderBy("doc_id").collect()] == [(1, True), (2, True)]
    later = exact_dedup(frame(spark, [(3, "A"), (4, "c"), (5, "c")]), path, 4)
    assert [tuple(r) for r in later.select("doc_id", "keep_id", "kept").orderBy("doc_id").collect()] == [(3, 1, False), (4, 5, False), (5, 5, True)]
    index = DigestIndex(spark, path, 4)
    assert index.table().count() == 3
    plan = index.unseen(with_digest(frame(spark, [(9, "q")])).groupBy("digest").count())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Python" not in plan


# suffix arrays and suffix dedup


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=40), min_size=1, max_size=5))
def test_suffix_arrays(texts):
    texts = [[*t, 0] for t in texts]
    begins = np.cumsum([0] + [len(t) for t in texts])[:-1]
    expected = [i + b for t, b in zip(texts, begins) for i in sorted(range(len(t)), key=lambda i: t[i:])]
    assert suffix_arrays(np.concatenate([np.array(t) for t in texts]), begins).tolist() == expected


def brute_repeats(rows, length):
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0])):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[d] = (len(raw), len(raw) - len(kept), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "frequent", "chunk"), [(12, 150, 4_000_000), (12, 3, 400), (100, 2, 3000)])
def test_repeats_against_brute_force(spark, monkeypatch, length, frequent, chunk):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(rolling, "CHUNK_BYTES", chunk)
    rng = random.Random(length * frequent)
    base = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 500))) for _ in range(10)] + ["a" * 300, "ab" * 150]
    rows = [(None, base[0]), (0, None), (1, ""), (2, base[0]), (2, base[0])]
    for i in range(60):
        parts = [(s := rng.choice(base))[(a := rng.randint(0, 300)) : a + rng.randint(1, 300)] for _ in range(rng.randint(0, 5))]
        rows.append((10 + 3 * i, rng.choice(rows)[1] if rng.random() < 0.2 else "".join(parts)))
    rng.shuffle(rows)
    found = remove_repeats(frame(spark, rows), length).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute_repeats(rows, length)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)


def test_grams_fall_evenly_into_buckets():
    rng, buckets = random.Random(8), 20
    texts = ["".join(rng.choices("abcdefgh ", k=4000)) for _ in range(100)]
    docs = pa.table({"doc": pa.array(range(100), pa.int64()), "hash": pa.array([0] * 100, pa.int64()), "text": texts})
    copies = pa.table({c: pa.array([], pa.int64()) for c in ("doc", "hash", "start")})
    sent = suffix_dedup._gram_sender(100, 52, buckets)((pa.scalar(0),), docs, copies)
    held = {b: len(h) // 4 for b, h in zip(sent["bucket"].to_pylist(), sent["hashes"].to_pylist())}
    assert len(held) == buckets and sum(held.values()) > 10_000
    assert max(held.values()) < 1.3 * sum(held.values()) / buckets


def test_repeats_of_nothing(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    assert [r.n_bytes for r in remove_repeats(frame(spark, [(1, None), (2, "a")])).orderBy("doc_id").collect()] == [0, 1]


# line dedup


def test_recurring_templates_go(spark):
    rows = [(i, f"Page {i} of 9\nown text number x{'abcde'[i]}\n\nby Ann in room {i}") for i in range(5)]
    rows += [(10, "seen on monday at home again\nPage 77 of 9"), (11, None), (12, ""), (13, "seen on monday at work again")]
    rows += [(14, "seen on monday at sea again"), (15, "seen on monday at sea again"), (16, "seen on monday at play again")]
    found = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in drop_recurring_lines(frame(spark, rows)).collect()}
    assert found[0] == (rows[0][1], 4, 0)  # the first line of a template stays
    assert found[3] == ("own text number xd\n", 4, 2) or found[3] == ("", 4, 3)
    assert found[10] == ("seen on monday at home again", 2, 1)
    assert found[11] == (None, 0, 0) and found[12] == ("", 1, 0)
    assert [found[i][2] for i in (13, 14, 15, 16)] == [1, 1, 1, 1]  # one place varies, five are constant


def test_copies_count_once_and_blank_lines_stay(spark):
    rows = [(i, "the same line of a copied text\n\n \n") for i in range(9)] + [(20, "the same line of a copied text")]
    assert drop_recurring_lines(frame(spark, rows)).where("n_dropped > 0").count() == 0
    assert drop_recurring_lines(frame(spark, [])).count() == 0
    twice = [(None, "a b c d e\nx"), (1, "a b c d e\ny"), (1, "a b c d e\ny"), (2, "a b c d e\nz"), (3, "a b c d e\na b c d e")]
    found = sorted((r.doc_id or 0, r.n_dropped) for r in drop_recurring_lines(frame(spark, twice)).collect())
    assert found == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 2)]


# similarity join


def brute_components(rows, words, percent):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * max(1, len(sets[a] | sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("words", "percent", "chunk"), [(3, 90, 4_000_000), (5, 80, 2000), (2, 70, 3000)])
def test_similar_documents_against_brute_force(spark, monkeypatch, words, percent, chunk):
    monkeypatch.setattr(rolling, "CHUNK_BYTES", chunk)
    rng = random.Random(words)
    base = [[rng.choice("ab cd é fg".split()) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 60))] for _ in range(8)]
    rows = [(1000, None), (1001, ""), (1002, " \t "), (1003, "ONE two"), (1004, "one\x0btwo")]
    for i in range(200):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 500)}"
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(w)))
    rng.shuffle(rows)
    found = similar_documents(frame(spark, rows), words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, words, percent)


def test_similar_documents_edges(spark):
    assert similar_documents(frame(spark, [])).count() == 0
    rows = [(5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "q"), (None, "q"), (9, None)]
    found = sorted(((r.doc_id or 0), r.component_id or 0) for r in similar_documents(frame(spark, rows), 3, 90).collect())
    assert found == [(0, 0), (0, 0), (0, 5), (5, 5), (5, 5), (9, 9)]


def test_shingles_are_those_of_the_words():
    assert [len(s) for s in shingle_sets([b"", b"  ", b"a", b"a b", b"a b c", b"a b c a b c"], 3)] == [0, 0, 1, 1, 1, 3]
    a, b, c = shingle_sets([b"A  b\nC", b"a b c", b"a b d"], 3)
    assert a.tolist() == b.tolist() != c.tolist()


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 10 for i in range(10, 61)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).select(F.count(F.lit(1))).first()[0] == 0


def spark_hash(*values, seed):
    """Spark's xxhash64 of an int seed and values: ints as 4 bytes, texts as UTF-8, lists one by one."""
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    for v in values:
        for x in v if isinstance(v, list) else [v]:
            h = xxhash.xxh64_intdigest(x if isinstance(x, bytes) else x.encode(), h)
    return h - 2**64 if h >= 2**63 else h


def long_bytes(x):
    return struct.pack("<q", x)


def brute_templates(rows, min_docs=4, depth=3, similarity=0.75):
    """(id, kept lines) of every text by the rule as stated: masked lines, leaves, whole or split."""
    lines = []  # id, text, place, masked tokens
    for d, text in rows:
        for pos, line in enumerate(text.split("\n")):
            tokens = ["<*>" if re.search("[0-9]", t) else t for t in re.split("[ \t\r\f\x0b]+", line.strip(" \t\r\f\x0b"))]
            if tokens != [""]:
                lines.append((d, text, pos, tuple(tokens)))
    leaves = {}
    for x in lines:
        leaves.setdefault((len(x[3]), x[3][:depth]), []).append(x)
    template = {}
    shared = set()
    for leaf, own in leaves.items():
        kinds = sorted({x[3] for x in own})
        n = leaf[0]
        if len(kinds) < 2 or len(own) < min_docs:
            continue
        same = sum(len({k[j] for k in kinds}) == 1 for j in range(depth, n))
        if same > 0 and same + depth >= n * similarity:
            template |= {k: (leaf,) for k in kinds}
            continue
        room = min(n - math.ceil(n * similarity), n - depth - 1)
        if room <= 0:
            continue
        leaf_hash = long_bytes(spark_hash(struct.pack("<i", n), list(leaf[1]), seed=1))
        cell = lambda j, t, seed: spark_hash(leaf_hash, struct.pack("<i", j - depth), long_bytes(xxhash.xxh64_intdigest(t.encode(), 42) - (2**64 if xxhash.xxh64_intdigest(t.encode(), 42) >= 2**63 else 0)), seed=seed)
        hole = lambda j, seed: spark_hash(leaf_hash, struct.pack("<i", j - depth), "<*>", seed=seed)
        patterns, texts = {}, {}
        for k in kinds:
            common = {j: sum(o[j] == k[j] for o in kinds) for j in range(depth, n)}
            rarest = sorted(common, key=lambda j: (common[j], j))[:room]
            patterns[k] = set()
            for holes in [{j} for j in common] + [set(rarest)]:
                ids = tuple(functools.reduce(lambda a, j: a ^ (hole(j, i + 5) if j in holes else cell(j, k[j], i + 3)), common, 0) for i in (1, 2))
                patterns[k].add(ids)
                texts.setdefault(ids, set()).update(x[1] for x in own if x[3] == k)
        for k in kinds:
            good = [(len(texts[p]), *p) for p in patterns[k] if len(texts[p]) >= min_docs]
            if good:
                template[k] = max(good)[1:]
                shared.add(template[k])
    groups = {}
    for x in lines:
        groups.setdefault(template.get(x[3], x[3]), []).append(x)
    gone = set()
    for t, own in groups.items():
        if t in shared or len({x[1] for x in own}) >= min_docs:
            first = min((x[0], x[2]) for x in own)
            gone |= {(x[0], x[2]) for x in own if (x[0], x[2]) != first}
    return sorted((d, [line for pos, line in enumerate(text.split("\n")) if (d, pos) not in gone]) for d, text in rows)


@pytest.mark.parametrize("seed", range(4))
def test_line_templates_follow_the_rule(spark, seed):
    """Leaves of one template, mixed leaves that are split, lines of four tokens, fields with digits."""
    rng = random.Random(seed)
    names = ["Ann", "Bob", "Cid", "Dora", "Eve", "Finn"]
    shapes = [
        lambda: f"seen on monday at {rng.choice(names)} again", lambda: "seen on monday we all left", lambda: f"The capital is {rng.choice(['Paris', 'Rome', 'Oslo', 'Bern', 'Riga'])}",
        lambda: f"page {rng.randint(1, 99)} of {rng.randint(1, 99)}", lambda: " ".join(rng.choices("abc", k=rng.randint(1, 9))),
        lambda: f"a b c {rng.choice('xy')} {rng.choice('pq')} {rng.choice(names)} {rng.choice('mn')} t", lambda: "", lambda: f"  id {rng.randint(1, 5)}\t{rng.choice(names)} logged in today ",
    ]
    rows = [(i, "\n".join(rng.choice(shapes)() for _ in range(rng.randint(1, 5)))) for i in range(60)]
    found = sorted((r.doc_id, r.text.split("\n") if r.n_lines > r.n_dropped else []) for r in drop_recurring_lines(frame(spark, rows)).collect())
    assert found == brute_templates(rows)


def test_lines_are_masked_twice_and_columns_pass(spark):
    """Once for all lines and once for those of mixed leaves; names in use inside are ordinary columns of documents."""
    lines = masked_lines(frame(spark, [(1, "a b c 1")]), 3, "doc_id", "text")
    leaves = spark.createDataFrame([(1,)], "leaf long")
    for df in (lines, lines_of(lines, leaves, 3)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    clashing = spark.createDataFrame([(i, f"the same line here {i}\nown {'abcdefgh'[i]}", i, "g", i + 1, 5) for i in range(6)], "doc_id long, text string, _gone int, row string, _id int, _th long")
    found = sorted(drop_recurring_lines(clashing).collect())
    assert [(r._gone, r.row, r._id, r._th, r.n_dropped) for r in found] == [(i, "g", i + 1, 5, int(i > 0)) for i in range(6)]


def test_line_dedup_takes_a_very_long_text(spark):
    text = "\n".join(f"line {i} with some words in it" for i in range(60_000)) + "\n" + "x" * 300_000
    found = {r.doc_id: (r.n_lines, r.n_dropped) for r in drop_recurring_lines(frame(spark, [(i, text + f" z{'q' * i}") for i in range(4)])).collect()}
    assert found == {0: (60_001, 59_999)} | {i: (60_001, 60_000) for i in (1, 2, 3)}
    mixed = "\n".join(f"line {i} with some words in it\nown {chr(97 + i % 26) * (i // 26 + 1)}" for i in range(3_000))
    out = drop_recurring_lines(frame(spark, [(i, mixed + f"\nz{'q' * i} end") for i in range(4)] + [(9, mixed)]))
    assert {r.n_lines for r in out.collect()} == {6_001, 6_000}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
