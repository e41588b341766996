"""Personal data: the fixed rules and the pattern graph against plain versions, planted contexts, edge frames."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.llm.pii_bootstrap import FULL, KINDS, WordHashes, _marks, base_spans, find_personal_data, slots, spelt_spans, written

RULES = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, rule in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            double = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
            good = [True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True, 13 <= len(digits) <= 19 and sum(double) % 10 == 0, 9 <= len(digits) <= 15][kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@._%+-12 0()5:é\n", max_size=60))
def test_fixed_rules(text):
    assert base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", ["a@b.c_d@e.f", "4111 1111 1111 1111", "4111111111111112", "999.1.1.1 1.2.3.4.5", "+1 (017) 555-7713", "00000000001.1.1.1", "1" * 40, "x@y", "@a.b", "a@@b.c", "+49 30 1234567.", "1.2.3.4@5.6"])
def test_fixed_rules_on_odd_texts(text):
    assert base_spans(text) == plain_spans(text)


def brute_added(texts, confidence, support, rounds):
    """The graph with dictionaries."""
    hashes = WordHashes()
    marks = [_marks(t or "", base_spans(t or ""), hashes) for t in texts]
    edges, wide, seeds = Counter(), Counter(), set()
    for own in marks:
        for m in own:
            for form, p in enumerate((m["p0"], m["p1"], m["p2"])):
                if p:
                    edges[p, m["item"], m["kind"]] += 1
                    wide[p] += m["wide"] and form == 1
                    if m["seed"]:
                        seeds.add((p, m["item"], m["kind"]))
    size = Counter((p, k) for p, _, k in edges)
    live = {p for (p, _), n in size.items() if n >= support}
    total = Counter()
    for t in texts:
        for kind in slots(hashes((t or "").split())):
            total.update(x for x in kind.tolist() if x in live)
    score = {(i, k): FULL for p, i, k in seeds if p in live}
    fixed = set(score)
    for _ in range(rounds):
        sums, items = Counter(), Counter()
        for (p, i, k), n in edges.items():
            if p in live and score.get((i, k), 0) > 0:
                sums[p, k] += n * score[i, k]
                items[p, k] += 1
        sure = {(p, k): min(FULL, s // (total[p] + wide[p] + 1)) for (p, k), s in sums.items() if items[p, k] >= support}
        best = defaultdict(int)
        for p, i, k in edges:
            if (p, k) in sure:
                best[i, k] = max(best[i, k], sure[p, k])
        score = dict(best) | {x: FULL for x in fixed}
    out = []
    for own in marks:
        found = {}
        for m in own:
            for p in (m["p0"], m["p1"], m["p2"]):
                if not m["seed"] and sure.get((p, m["kind"]), 0) >= FULL * confidence:
                    at = m["start"], m["end"]
                    found[at] = max(found.get(at, (0, 0)), (sure[p, m["kind"]], -m["kind"]))
        out.append(sorted((-k, s, e) for (s, e), (_, k) in found.items()))
    return out


def looked_at(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, row int, marks string").repartition(3)
    return find_personal_data(docs, **options).collect()


def planted(seed):
    rng = random.Random(seed)
    words = [rng.choice("bdgklmnprst") + rng.choice("aeiou") + rng.choice("bdgklmnprst") for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = []
    for i in range(60):
        number = f"+49 30 {rng.randrange(10**6, 10**7)}" if i % 3 else f"030 {rng.randrange(10**6, 10**7)}"
        mail = f"{rng.choice(words)}{i}@{rng.choice(words)}" + ".example" * (i % 4 > 0)
        texts.append(f"{prose(20)} please call me at {number} today {prose(10)} e-mail: {mail} {prose(5)}")
        texts.append(f"{prose(15)} order number {rng.randrange(10**7, 10**8)} {prose(20)}")
    return texts, prose


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_equals_dictionaries(spark, seed):
    texts, prose = planted(seed)
    texts += [prose(40) for _ in range(40)] + [None, "", texts[0], texts[0]]
    rows = list(enumerate(texts)) + [(None, texts[2]), (3, texts[4])]
    expected = brute_added([t for _, t in rows], 0.5, 3, 3)
    found = looked_at(spark, rows)
    got = sorted(((r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.added]) for r in found), key=str)
    assert got == sorted(((d, base_spans(t or ""), x) for (d, t), x in zip(rows, expected)), key=str)


def test_patterns_find_unseen_identifiers_and_leave_others(spark):
    texts, prose = planted(3)
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.added] for r in looked_at(spark, list(enumerate(texts)))}
    for i, text in enumerate(texts):
        number, mail = re.search(r"call me at (030 [0-9]+) today", text), re.search(r"e-mail: (\S+@[a-z]+) ", text)
        assert found[i] == [m.group(1) for m in (mail, number) if m]


def test_digests_and_edge_frames(spark):
    text = "é a@b.co 1.2.3.4 +49 301 234567 or 4111 1111 1111 1111"
    rows = [(1, text), (2, None), (3, ""), (None, text), (4, "a@b.co " * 20000), (5, "a" * 200000 + "1" * 200000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in find_personal_data(docs).withColumn("spans", spelt_spans(F.concat("base", "added"))).collect()}
    spans = written(plain_spans(text))
    assert out[1].spans == out[None].spans == spans and out[1].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert [out[1][f"n_{k}"] for k in KINDS] == [1, 1, 1, 1] and out[4].n_email == 20000
    assert out[2].spans == out[3].spans == "" and out[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert find_personal_data(docs.limit(0)).collect() == []


def test_slots_of_words():
    hashes = WordHashes()
    one, two = (slots(hashes(t.split())) for t in ("Call me at x", "call ME at y z"))
    assert one[0][3] == two[0][3] and one[2][3] == two[2][3] and one[1][3] == 0 != two[1][3]
    assert np.count_nonzero(one[0]) == 2
