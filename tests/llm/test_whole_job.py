"""Jobs that were once done in part: each test failed before."""

import random
import re

import corpus_pipeline
from ebbtide.llm import jaccard_join
from ebbtide.llm.jaccard_join import similar_documents
from ebbtide.llm.line_templates import drop_recurring_lines
from tests.llm.test_dedup import LOWER, frame

# similarity join: the number of links


def brute_links(rows, words, percent):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    return {a: sum(a != b and 100 * len(sets[a] & sets[b]) >= percent * max(1, len(sets[a] | sets[b])) for b in sets) for a in sets}


def test_every_link_is_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", 7)
    rng = random.Random(4)
    base = [[f"w{rng.randint(0, 40)}" for _ in range(n)] for n in (5, 40, 80, 120)]
    rows = [(1000, None), (1001, ""), (1002, "ONE two"), (1003, "one\ttwo"), (1004, "all alone here it is")]
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 500)}"
        rows.append((i * 3, " ".join(w)))
    found = {r.doc_id: r.n_links for r in similar_documents(frame(spark, rows), 2, 80).collect()}
    assert found == brute_links(rows, 2, 80) and max(found.values()) > 20


def test_links_of_repeated_rows_and_rows_without_id(spark):
    rows = [(5, "a b c"), (5, "a b c"), (6, "A b c"), (None, "a b c"), (None, "q"), (None, "q"), (9, None)]
    found = sorted(((r.doc_id or 0), r.n_links) for r in similar_documents(frame(spark, rows), 3, 90).collect())
    assert found == [(0, 1), (0, 1), (0, 2), (5, 2), (5, 2), (6, 2), (9, 0)]
    assert "n_links" not in similar_documents(frame(spark, rows), 3, 90, count_links=False).columns


# line dedup


def test_lines_that_share_only_their_leading_tokens_stay(spark):
    rows = [(i, f"The capital is {x}") for i, x in enumerate(["Paris", "Rome", "Oslo", "Bern", "Riga"])]
    rows += [(10 + i, f"It was page {i}") for i in range(5)]
    found = {r.doc_id: r.n_dropped for r in drop_recurring_lines(frame(spark, rows)).collect()}
    assert found == {i: 0 for i in range(5)} | {10: 0} | {10 + i: 1 for i in range(1, 5)}


def test_other_lines_in_a_leaf_undo_no_template(spark):
    rows = [(i, f"seen on monday at {x} again") for i, x in enumerate("home work sea play school".split())] + [(9, "seen on monday we all left")]
    rows += [(20 + i, f"made by the {x} team of {x}ville in the far old {x}land") for i, x in enumerate("red blue green grey".split())]
    rows += [(30, "made by the way we went on and on with no end"), (31, "made by the sea where all our boats lay dry last year")]
    found = {r.doc_id: r.n_dropped for r in drop_recurring_lines(frame(spark, rows)).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 9: 0, 20: 0, 21: 1, 22: 1, 23: 1, 30: 0, 31: 0}


# pipeline: rows are known by id and text


def test_pipeline_keeps_one_row_of_each_text(spark):
    words = lambda seed, n=40: " ".join(f"{seed}{i}" for i in range(n))
    a, b, c, d, e = (words(x) for x in "abcde")
    rows = [(1, a), (1, a), (None, a + " end"), (2, b), (2, c), (None, d), (None, d + " end"), (3, e), (4, None), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    one = [t for i, t in kept if i is None]
    assert len(one) == 1 and one[0] in (d, d + " end")
    assert sorted(((i, t or "") for i, t in kept if i is not None)) == [(1, a), (2, b), (2, c), (3, e), (4, "")]


def test_repeats_are_cut_in_the_text_that_has_them(spark):
    same = " ".join(f"s{i}" for i in range(60))
    rows = [(None, "first " + same + " x"), (None, "second " + same + " y"), (5, "early " + same + " z"), (5, "another text"), (None, "no repeat")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = [(r.doc_id, r.text) for r in corpus_pipeline.repeats(spark, docs, "").collect()]
    assert len(found) == 5 and (5, "another text") in found and (None, "no repeat") in found
    assert sum(same in t for _, t in found) == 1 and (5, "earlyz") in [(i, t.replace(" ", "")) for i, t in found]
