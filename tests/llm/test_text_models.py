"""Quality, language, token counts, the piece codec, packing and top-k search: accuracy, parity, brute force, edge frames."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import token_counts, topk_search
from ebbtide.llm.language import identify_languages, letter_vector, trigram_counts
from ebbtide.llm.packing import best_fit_pack, pack_lengths
from ebbtide.llm.piece_codec import build_tokenizer, encode_documents, merges_of
from ebbtide.llm.quality import STATISTICS, fit_trees, keep_good, quality_scores, scorer, statistics
from ebbtide.llm.queries import model_bytes
from ebbtide.llm.sp_model import BPE, read_model
from ebbtide.llm.token_counts import Transducer, count_tokens
from ebbtide.llm.topk_search import exact_top_k

SF_DIR = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
ODD = [
    None, "", "a", "  a   b", "    ", " x", "x ", "\n\n a\tb", "日本語 テスト", "<s> </s> <unk> <0x0A>", "▁▁ a", "é é", "😀 😀😀", " " * 40 + "z",
    "a" * 300, "www.foo.com/" + "ab" * 500, "日本語中文" * 200, " \n  \n   def f(x):\n        return 1", "the " * 30000, "\x00\x01",
]


def frame(spark, rows, more="score string, chunk string"):
    return spark.createDataFrame([(d, t, None, "x") for d, t in rows], f"doc_id long, text string, {more}")


# quality


@needs_data
def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_scores(docs, labels)
    assert scored.count() == docs.count() and scored.where("score between 0 and 1").count() == docs.count()
    right = scored.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95
    assert keep_good(docs, labels).columns == docs.columns
    assert keep_good(docs, labels).count() == scored.where("predicted = 1").count()


def test_quality_without_labels_or_texts(spark):
    docs = frame(spark, [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "c " * 50000)])
    labels = "doc_id long, quality int"
    assert [r.score for r in quality_scores(docs, spark.createDataFrame([], labels)).collect()] == [0.5] * 5
    one_class = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], labels)
    assert all(r.predicted == 1 for r in quality_scores(docs, one_class).collect())
    assert quality_scores(frame(spark, []), one_class).count() == 0
    assert len(statistics("")) == len(statistics("a\n1")) == len(STATISTICS)


def test_trees_learn_a_curve():
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, (2000, 2))
    y = (x[:, 0] ** 2 + x[:, 1] ** 2 < 2).astype(float)
    trees = fit_trees(x, y)
    assert ((trees.score(x) >= 0.5) == (y == 1)).mean() > 0.95
    slow = []
    for row in x[:50]:  # the same trees, node by node
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        slow.append(1 / (1 + math.exp(-total)))
    assert np.allclose(trees.score(x[:50]), slow)


# language


@needs_data
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = identify_languages(docs)
    right = found.join(docs, "doc_id").where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97 and found.count() == docs.count()


def test_language_edges(spark):
    rows = [(i, "der die das und nicht ein ich " * 3, "de") for i in range(20)] + [(100 + i, "the and of to in that is was " * 3, "en") for i in range(20)]
    rows += [(200, None, "de"), (201, "", None), (202, "12 34 !?", "en"), (203, "die und das", None), (203, "die und das", None), (None, "of that the " * 20000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(docs).collect()}
    assert [found[i] for i in (200, 201, 202)] == [("und", 0.0)] * 3
    assert found[203][0] == "de" and found[None][0] == "en" and 0.5 < found[203][1] <= 1
    assert identify_languages(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_trigrams_do_not_depend_on_the_batch():
    texts = ["Ab, cd", "x", "", "ÀB 12 cd", "日本 語"]
    together, counts = trigram_counts(texts)
    for i, t in enumerate(texts):
        alone, own = trigram_counts([t])
        assert dict(zip(alone.tolist(), own[0].tolist())) == {g: c for g, c in zip(together.tolist(), counts[i].tolist()) if c}
    assert abs(int(letter_vector(97).astype(int) @ letter_vector(98).astype(int))) < 200


# tokens


def sentencepiece_model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model_bytes())


def samples(n):
    rng, pieces = random.Random(n), [p for p, _, kind in read_model(model_bytes()).pieces if kind == 1]
    return ["".join(rng.choice(pieces[:2000] if rng.random() < 0.7 else pieces) for _ in range(rng.randint(1, 60))).replace("▁", " ") for _ in range(n)]


def test_transducer_counts_like_the_library():
    texts = [t or "" for t in ODD] + samples(1500)
    assert Transducer(model_bytes()).count(texts).tolist() == [len(x) for x in sentencepiece_model().encode(texts)]
    assert Transducer(model_bytes()).count([]).tolist() == []


def test_counts_hold_when_states_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_STATES", 300)
    texts, own, most = samples(300), Transducer(model_bytes()), 0
    for i in range(0, 300, 10):
        assert own.count(texts[i : i + 10]).tolist() == [len(x) for x in sentencepiece_model().encode(texts[i : i + 10])]
        most = max(most, len(own.keys))
    assert most > 300 and len(own.keys) < most


def test_tables_grow_with_the_states_in_use():
    own = Transducer(model_bytes())
    for text in samples(400):
        own.count([text])
        if len(own.keys) > 1100:
            break
    assert 1100 < len(own.keys) <= len(own.next) < 1.25 * len(own.keys) and own.next.shape == own.gain.shape


def test_a_worker_forgets_what_another_operator_kept(spark):
    import pyarrow as pa

    from ebbtide.llm import common, jaccard_join

    first = token_counts.machine(model_bytes())
    assert token_counts.machine(model_bytes()) is first
    jaccard_join._sender(3, 1)((pa.scalar(0),), pa.table({"text": ["a b c d"]}))
    assert "token_counts" not in common._kept
    token_counts.machine(model_bytes())
    score = scorer(fit_trees(np.zeros((0, len(STATISTICS))), np.zeros(0)))
    assert score.func(pa.array(["a b"])).to_pylist() == [0.5] and "token_counts" not in common._kept


@needs_data
def test_token_counts_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    expected = dict(zip(texts, map(len, sentencepiece_model().encode(list(texts.values())))))
    found = count_tokens(docs, model_bytes()).collect()
    assert {r.doc_id: r.n_tokens for r in found} == expected
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 4096) for r in found)


def test_token_counts_edges(spark):
    rows = [*enumerate(ODD), (None, "a b"), (3, "  a   b")]
    found = count_tokens(frame(spark, rows), model_bytes()).collect()
    assert len(found) == len(rows) and {r.n_tokens for r in found if r.n_bytes == 0} == {0}
    assert count_tokens(frame(spark, []), model_bytes()).count() == 0


def test_codec_parity_and_round_trip(spark):
    texts = [*ODD, *samples(500)]
    found = {r.doc_id: r for r in encode_documents(frame(spark, list(enumerate(texts))), model_bytes(), threads=2).collect()}
    expected = sentencepiece_model().encode([t or "" for t in texts])
    assert [found[i].ids for i in range(len(texts))] == expected
    assert all(r.parity and r.n_tokens == len(r.ids) for r in found.values())
    assert all(found[i].round_trip for i, t in enumerate(texts) if "▁" not in (t or ""))
    assert not found[ODD.index("▁▁ a")].round_trip  # the marker itself decodes to a blank
    assert encode_documents(frame(spark, []), model_bytes()).count() == 0


def test_model_file_is_read_whole():
    import sentencepiece

    own, native = read_model(model_bytes()), sentencepiece.SentencePieceProcessor(model_proto=model_bytes())
    assert own.kind == BPE and own.byte_fallback and len(own.pieces) == native.get_piece_size()
    assert all(p == native.id_to_piece(i) and abs(s - native.get_score(i)) < 1e-6 for i, (p, s, _) in enumerate(own.pieces))
    assert merges_of(own)[0] == ("▁", "t") and build_tokenizer(model_bytes()).get_vocab_size() == len(own.pieces)


# packing


def test_packing_by_hand():
    lengths = [5, 3, 8, 2, 6]
    bins, starts, sizes = pack_lengths(lengths, [4, 8], attention=0.0)
    spans = sorted((b, s, s + n) for n, b, s in zip(lengths, bins, starts))
    assert all(a[0] != b[0] or a[2] == b[1] for a, b in zip(spans, spans[1:]))  # no gap, no overlap
    assert sorted(sum(n for n, b in zip(lengths, bins) if b == x) for x in set(bins)) == [8, 8, 8] and sizes == [8, 8, 8]
    assert pack_lengths([3], [4, 8])[2] == [4] and pack_lengths([], [4, 8]) == ([], [], [])


def test_every_token_has_one_place(spark):
    rng = random.Random(5)
    lengths = [(i, int(rng.lognormvariate(6, 1.3))) for i in range(3000)] + [(5000, 100_000), (5001, 0), (5002, None), (5003, -3), (None, 700)]
    df = spark.createDataFrame([(d, n, "x") for d, n in lengths], "doc_id long, n_tokens long, shard string")
    packed = best_fit_pack(df, shard_rows=800).toPandas()
    assert packed["length"].sum() == sum(n for _, n in lengths if n and n > 0)
    for _, rows in packed.groupby("bin_id"):
        rows = rows.sort_values("bin_start")
        assert (rows["bin_start"].to_numpy() == np.append(0, rows["length"].cumsum().to_numpy()[:-1])).all()
        assert rows["length"].sum() == rows["bin_used"].iloc[0] <= rows["bin_capacity"].iloc[0]
        assert rows["bin_capacity"].iloc[0] == next(s for s in (512, 1024, 2048, 4096, 8192) if s >= rows["bin_used"].iloc[0])
    bins = packed.drop_duplicates("bin_id")
    assert bins["bin_used"].sum() / bins["bin_capacity"].sum() > 0.97
    long = packed[packed["doc_id"] == 5000].sort_values("piece")
    assert long["length"].tolist() == [8192] * 12 + [100_000 - 12 * 8192] and long["start"].tolist() == [8192 * i for i in range(13)]
    assert best_fit_pack(df.limit(0)).count() == 0


# top-k search


def brute_top(rows, queries, k):
    good = {i: [math.floor(256 * x) for x in v] for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in queries:
        if q in good:
            best = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("block", [16384, 60])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk_search, "VECTOR_BLOCK", block)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", max(4, block // 10))
    rng = np.random.default_rng(block)
    rows = [(i, rng.normal(0, 0.3, 8).round(2).tolist()) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(500, 560)]  # ties
    rows += [(600, None), (601, [None] * 8), (650, [float("nan")] * 8), (700, [float("inf")] * 8), (750, []), (800, [900.0] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    queries = [i for i, _ in rows if i % 50 == 0]
    found = {tuple(r) for r in exact_top_k(df, df.where("vec_id % 50 = 0")).collect()}
    assert found == brute_top(rows, queries, 5)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [0.5, 0.5]), (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in exact_top_k(df, df).collect()} == {(0, 1, 50, 256 * 128 + 512 * 128), (50, 1, 0, 256 * 128 + 512 * 128)}
    assert exact_top_k(df.limit(0), df).count() == 0 and exact_top_k(df, df.limit(0)).count() == 0


def test_words_coded_once_give_the_ids_of_whole_texts(monkeypatch):
    from ebbtide.llm import piece_codec

    odd = ["", " ", "a", " a", "a ", "a  b", "▁", "a▁b", "x ▁ y", "the 日本 é \x00 end", "tab\tand\nline and \n more", "w" * 90 + " tail " + "w" * 90, "<s> </s> <unk> <0x41>", "a　b c"]
    texts = odd + [" ".join(odd), "one two one two three " * 50 + "end"] + [" ".join(f"w{i * j % 37}" for i in range(60)) for j in range(40)]
    whole = [e.ids if t else [] for e, t in zip(build_tokenizer(model_bytes()).encode_batch(texts, add_special_tokens=False), texts)]
    assert piece_codec.encode_texts(model_bytes(), texts) == whole
    monkeypatch.setattr(piece_codec, "KEPT_WORDS", 3)
    monkeypatch.setattr(piece_codec, "BATCH_CHARS", 40)
    monkeypatch.setattr(piece_codec, "_built", {})
    coder = piece_codec.WordCoder(model_bytes())
    assert coder.by_word and [x for t in texts for x in coder.ids([t])] == whole
    assert not any(len(w) > piece_codec.KEPT_LENGTH for w in coder.kept)


def test_a_word_is_sent_to_the_library_once(monkeypatch):
    from ebbtide.llm import piece_codec

    coder, sent = piece_codec.WordCoder(model_bytes()), []

    class Spy:
        def encode_batch_fast(self, texts, **more):
            sent.extend(w for t in texts for w in ([t] if "  " in t else t.split(" ")))
            return real.encode_batch_fast(texts, **more)

    real, coder.tokenizer = coder.tokenizer, Spy()
    coder.ids(["red green red", "green blue  gone"])
    coder.ids(["blue red"])
    assert sorted(sent) == ["blue", "green", "green blue  gone", "red"]


def test_a_word_is_decoded_and_compared_once():
    from ebbtide.llm import piece_codec

    coder, decoded, compared = piece_codec.CheckedCoder(model_bytes()), [], []

    class Spy:
        def decode_batch(self, ids, **more):
            out = real.decode_batch(ids, **more)
            decoded.extend(w for t in out for w in ([t] if "  " in t else t.split(" ")))
            return out

        def encode_batch_fast(self, texts, **more):
            return real.encode_batch_fast(texts, **more)

        def encode(self, text):
            compared.extend([text] if "  " in text else text.split(" "))
            return native.encode(text)

    real, native, coder.coder.tokenizer, coder.native = coder.coder.tokenizer, coder.native, Spy(), Spy()
    for texts in (["red green red", "green blue  gone"], ["blue red"]):
        coded, back, parity = coder.code(texts)
        assert back == texts and all(parity) and [np.frombuffer(x, "<i4").tolist() for x in coded] == native.encode(texts)
    assert sorted(decoded) == sorted(compared) == ["blue", "green", "green blue  gone", "red"]


def test_words_checked_once_give_the_flags_of_whole_texts(monkeypatch):
    from ebbtide.llm import piece_codec

    odd = ["", " ", "a", " a", "a  b", "\u2581", "x \u2581 y", "the \u65e5\u672c \u00e9 \x00 end", "line and \n more", "w" * 90 + " tail", "<s> </s> <0x41>", "\U0001f600 z\U0001f600 x"]
    texts = odd + [" ".join(odd), "bad one", "one two", "two bad", "one lost two", "one bad  lost"]
    real = piece_codec._native(model_bytes())

    class Native:  # codes each word "bad" in another way
        def encode(self, text):
            return real.encode(text) + [0] * text.split().count("bad")

    class Lossy:  # decodes each word "lost" in another way
        def decode_batch(self, ids, **more):
            return [t.replace("lost", "found") for t in tokenizer.decode_batch(ids, **more)]

        def encode_batch_fast(self, texts, **more):
            return tokenizer.encode_batch_fast(texts, **more)

    for kept in (3, 1000):
        monkeypatch.setattr(piece_codec, "KEPT_WORDS", kept)
        coder = piece_codec.CheckedCoder(model_bytes())
        tokenizer, coder.coder.tokenizer, coder.native = coder.coder.tokenizer, Lossy(), Native()
        for part in (texts, texts[::-1], *([t] for t in texts)):
            coded, back, parity = coder.code(part)
            whole = [e.ids if t else [] for e, t in zip(tokenizer.encode_batch(part, add_special_tokens=False), part)]
            assert [np.frombuffer(x, "<i4").tolist() for x in coded] == whole
            assert back == coder.coder.tokenizer.decode_batch(whole, skip_special_tokens=False)
            assert parity == ["bad" not in t for t in part]


def test_scoring_texts_needs_no_pandas():
    import subprocess
    import sys

    code = "import sys; import ebbtide.llm.quality as q; q.statistics('a b'); sys.exit('pandas' in sys.modules)"
    root = __file__.rsplit("/tests/", 1)[0]
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


def test_the_query_encodes_decodes_and_compares_every_text_whole(spark, monkeypatch):
    """Also texts whose words are known from other texts, and by more threads than one."""
    import pyarrow as pa

    from ebbtide.llm import piece_codec, queries

    texts = [*(t or "" for t in ODD), "red green red", "green red", "green red", "blue  red"]
    sent, decoded, compared, threads = [], [], [], []

    class Spy:
        def __init__(self, real):
            self.real = real

        def encode_batch_fast(self, texts, **more):
            sent.extend(texts)
            return self.real.encode_batch_fast(texts, **more)

        def decode_batch(self, ids, **more):
            decoded.extend(ids)
            return [f"{t}!" for t in self.real.decode_batch(ids, **more)]

        def encode_as_numpy(self, text):
            compared.append(text)
            out = self.real.encode_as_numpy(text)
            return out[::-1] if text == "green red" else out

    coder = piece_codec.WholeCoder(model_bytes())
    real = coder.native.encode(texts)
    coder.tokenizer, coder.native = Spy(coder.tokenizer), Spy(coder.native)
    for name in ("RAYON_NUM_THREADS", "TOKENIZERS_PARALLELISM"):
        monkeypatch.setenv(name, "2")
    monkeypatch.setattr(piece_codec, "_once", lambda kind, data, make: coder)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    found = pa.Table.from_batches(piece_codec._coder(b"", 2, True)([batch])).to_pylist()
    assert len(sent) == len(decoded) == len(compared) == len(texts) and compared == texts
    assert decoded == real and [r["ids"] for r in found] == real
    assert [r["parity"] for r in found] == [t != "green red" for t in texts] and not any(r["round_trip"] for r in found)

    monkeypatch.setattr(queries, "table", lambda spark, d, name: frame(spark, [(1, "a")]))
    monkeypatch.setattr(queries, "encode_documents", lambda *a, **more: threads.append(more.get("threads", 1)))
    queries.op10_piece_codec(spark, "")
    assert threads[0] > 1
