"""Classifiers and the language model: held-out figures, brute-force counts, odd rows."""

from __future__ import annotations

import math
import random
import sys
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from cases import ODD_TEXTS, documents, no_documents, odd_documents
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR
from eventlake.llm import language, lm, queries, recurrent, toxicity
from eventlake.llm.common import fold_is, letter_words

MIDDLE_DIR = SAMPLE_DIR.replace("sf0.001", "sf0.01")


def crc(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus if i is not None else None


def test_toxicity_on_held_out_rows(spark):
    found = queries.op4_toxicity(spark, SAMPLE_DIR.replace("sf0.001", "sf0.1")).join(
        spark.read.parquet(f"{SAMPLE_DIR.replace('sf0.001', 'sf0.1')}/labels.parquet"), "doc_id"
    ).where("held_out").toPandas()
    assert (found["predicted"] == found["toxic"]).mean() > 0.96
    toxic = found[found["toxic"] == 1]
    assert toxic["predicted"].mean() > 0.8
    assert found[found["toxic"] == 0]["predicted"].mean() < 0.02


def test_toxicity_scores_chunk_by_chunk_alike():
    s = toxicity.Settings(buckets=1 << 10)
    rng = np.random.default_rng(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    docs = [[words[j].strip("0123456789") for j in rng.integers(0, 400, 60)] for _ in range(60)]
    ids = [np.array([toxicity._buckets(w, s) for w in d], np.int32) for d in docs]
    model = toxicity.train(ids, np.array([i % 3 == 0 for i in range(60)], float), ["en"] * 60, replace(s, epochs=2))
    texts = [" ".join(d) for d in docs] + [" ".join(w for d in docs for w in d), "", None]
    whole = toxicity.Scorer(model).scores(texts)
    model.settings = replace(s, chunk=7, cached_words=50)
    assert np.allclose(toxicity.Scorer(model).scores(texts), whole, atol=1e-4)


def test_toxicity_on_odd_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (1, 0), (6, 0), (7, 1), (None, 1), (8, None), (12, 0)], "doc_id LONG, toxic INT"
    ).withColumn("y", F.lit("clash"))
    model = toxicity.fit(odd_documents(spark), labels)
    found = toxicity.score(odd_documents(spark), model).collect()
    assert len(found) == len(ODD_TEXTS) and all(0 <= r["toxicity"] <= 1 for r in found)
    kept = toxicity.reject_toxic(odd_documents(spark), labels)
    assert kept.columns == odd_documents(spark).columns
    assert kept.count() == sum(r["toxicity"] < 0.5 for r in found)
    assert toxicity.fit(odd_documents(spark), labels.limit(0)) == 0.0
    assert toxicity.fit(odd_documents(spark), labels.where("toxic = 1")) == 1.0
    assert toxicity.fit(no_documents(spark), labels) == 0.0
    assert toxicity.score(no_documents(spark), model).count() == 0
    assert toxicity.reject_toxic(odd_documents(spark), labels.limit(0)).count() == len(ODD_TEXTS)


def test_language_on_held_out_rows(spark):
    found = queries.op3_language(spark, MIDDLE_DIR).join(spark.read.parquet(f"{MIDDLE_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").toPandas()
    assert len(rows) > 100 and (rows["lang_pred"] == rows["lang"]).mean() > 0.98
    assert rows["accepted"].mean() > 0.98


def test_language_on_odd_rows(spark):
    model = language.fit(spark.read.parquet(f"{SAMPLE_DIR}/documents.parquet"))
    found = language.predict(odd_documents(spark), model).collect()
    assert len(found) == len(ODD_TEXTS)
    letters = {i for i, t in ODD_TEXTS if any(c.isalpha() for c in t or "")}
    for r in found:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (r["doc_id"] not in letters)
        assert 0 <= r["score"] <= 1 and (r["accepted"] is False or r["lang_pred"] != "und")
    kept = language.reject_unknown(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert language.fit(odd_documents(spark).withColumn("lang", F.lit(None))) is None
    assert {r["lang_pred"] for r in language.predict(odd_documents(spark), None).collect()} == {"und"}
    assert language.fit(no_documents(spark)) is None
    assert language.predict(no_documents(spark), model).count() == 0


def test_texts_in_no_language_are_rejected(spark):
    """Shuffled letters, another script and a language left out go; held-out documents stay."""
    rng, docs = random.Random(3), spark.read.parquet(f"{MIDDLE_DIR}/documents.parquet").where("text IS NOT NULL")
    learned = docs.where("lang <> 'de'")
    model = language.fit(learned.where(~fold_is("doc_id", 4, 2)))

    def accepted(texts):
        kept = language.predict(documents(spark, list(enumerate(texts))), model).toPandas()["accepted"]
        return kept.mean()

    held = [r["text"] for r in learned.where(fold_is("doc_id", 4, 2)).collect() if len(letter_words(r["text"])) >= 32]
    junk = []
    for text in held:
        letters = list("".join(letter_words(text)))
        rng.shuffle(letters)
        junk.append(" ".join("".join(letters[i : i + 5]) for i in range(0, len(letters), 5)))
    german = [r["text"] for r in docs.where("lang = 'de'").collect() if len(letter_words(r["text"])) >= 32]
    assert len(held) > 50 and len(german) > 50
    assert accepted(held) > 0.98
    assert accepted([" ".join(letter_words(t)[:2]) for t in held]) > 0.98
    assert accepted(junk) < 0.05 and accepted(german) < 0.2
    assert accepted(["αβγδ εζηθικ λμνξ οπρστ " * 10, "привет как дела сегодня " * 10]) == 0


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


SMALL = lm.Settings(words=40, word_classes=5, tails=4, hidden=6, warm_documents=50, every=2, known=60, lanes=7, window=5)


@pytest.fixture(scope="module")
def chatter(spark):
    rng = random.Random(7)
    rows = []
    for i in range(240):
        words = [f"w{rng.randint(0, 30)}" if i % 2 else f"Q{rng.randint(0, 30)}" for _ in range(rng.randint(0, 30))]
        words += [f"rare{rng.randint(0, 400)}" for _ in range(3)]
        rows.append((i, " ".join(words)))
    return rows


def test_base_scores_equal_counting(spark, chatter):
    df = documents(spark, chatter + [(240, None), (241, ""), (None, "w1 w2 w3"), (5, "w1 unseen")])
    held = fold_is("doc_id", 7, 2)
    model, counts = lm.fit(df, ~held, SMALL)
    assert len(model.rows) <= 61  # the rest of the counts is joined
    rows = lm.score(df, model, counts, held.alias("held_out")).collect()
    texts = chatter + [(240, None), (241, ""), (None, "w1 w2 w3"), (5, "w1 unseen")]
    c = Counter(w for i, t in texts if crc(i, 7) != 2 for w in tokens(t))
    total, distinct = sum(c.values()), len(c)
    assert (model.tokens, model.distinct) == (total, distinct)
    expected = sorted(
        (str(i), crc(i, 7) == 2, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 6))
        for i, t in texts
    )
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == expected


def test_held_out_texts_are_likelier_than_by_counts(spark):
    rows = [r for r in queries.op2_lm(spark, MIDDLE_DIR).collect() if r["held_out"]]
    tokens_, base, score = (sum(r[c] for r in rows) for c in ("n_tokens", "base_score", "score"))
    assert len(rows) > 50 and score - base > 0.1 * tokens_


def test_score_is_one_text_at_a_time(spark, chatter):
    """The lanes' sums equal a plain walk through one text with all probabilities adding up to one."""
    df = documents(spark, chatter)
    model, counts = lm.fit(df, F.lit(True), SMALL)
    found = {r["doc_id"]: r["score"] for r in lm.score(df, model, counts).collect()}
    c = Counter(w for _, t in chatter for w in tokens(t))
    net, reader = model.network, lm._Reader(model)
    own = net.layout.class_of()
    for i, text in chatter[:25]:
        symbols = reader.text(text)
        state, total = np.zeros((1, net.hidden), np.float32), 0.0
        before = net.layout.end
        for word, symbol in zip(tokens(text), symbols):
            states, _, _ = recurrent.run(net, np.array([[before]]), np.zeros((1, 1), int), state)
            state = states[0]
            every = np.exp(recurrent.log_probs(net, np.repeat(state, net.layout.symbols, axis=0), np.arange(net.layout.symbols), own))
            assert abs(every.sum() - 1) < 1e-4
            total += math.log10(every[symbol])
            if symbol >= net.layout.words:
                total += math.log10(c[word] + 1) - model.tail_logs[symbol - net.layout.words]
            before = symbol
        assert abs(total - found[i]) < 1e-3 * max(1, abs(total))


def test_gradients_equal_differences():
    layout = recurrent.Layout(6, np.array([0, 2]), 2, 1)
    net = recurrent.start(layout, np.arange(1.0, 9.0), 4, 1)
    for n in recurrent.NAMES:
        setattr(net, n, getattr(net, n).astype(np.float64))
    texts = [np.array([3, 7, 0, 5, 1]), np.array([2, 2, 6, 1])]

    def loss(values):
        trainer = recurrent.Trainer(values, 2, 5, 0.0)
        trainer.feed(iter(texts), last=True)
        return trainer.loss / 10

    trainer = recurrent.Trainer(net.copy(), 2, 5, 1e-9)
    before = {n: q.copy() for n, q in trainer.squares.items()}
    trainer.feed(iter(texts), last=True)
    for n in recurrent.NAMES:
        got = np.sqrt(np.maximum(trainer.squares[n] - before[n], 0))
        flat = getattr(net, n)
        for at in np.ndindex(*flat.shape):
            if np.random.default_rng(hash(at) % 1000).random() < 0.7:
                continue
            up, down = net.copy(), net.copy()
            getattr(up, n)[at] += 1e-2
            getattr(down, n)[at] -= 1e-2
            slope = (loss(up) - loss(down)) / 2e-2
            assert abs(abs(slope) - got[at]) < 2e-3, (n, at)


class Captured:
    """Takes the function that a table would be mapped with."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def select(self, *columns):
        return self

    groupBy = agg = select


def test_words_are_counted_by_column_not_one_by_one(spark):
    texts = [" ".join(f"w{i * k % 7000}" for k in range(400)) for i in range(1, 40)] + [None, "", " A a\n"]
    table = Captured()
    lm.token_counts(table, 5000)
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i : i + 14], pa.string())}) for i in range(0, len(texts), 14)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    made = list(table.run(iter(batches)))
    sys.setprofile(None)
    assert len(made) > 1 and calls < 2000  # of some 4,000 distinct words
    found = Counter()
    for batch in made:
        found.update(dict(zip(*(c.to_pylist() for c in batch.columns))))
    assert found == Counter(w for t in texts for w in [*(t or "").lower().split(), ""])


def test_logits_far_apart_keep_their_probabilities():
    layout = recurrent.Layout(6, np.array([0, 2]), 2, 1)
    net = recurrent.start(layout, np.arange(1.0, 9.0), 4, 1)
    net.class_bias[:] = [-300, 300, 0, 250]
    net.word_bias[:] = [-200, -190, 200, 180, 0, -100]
    states = np.random.default_rng(1).normal(0, 1, (8, 4)).astype(np.float32)
    found = recurrent.log_probs(net, states, np.arange(8), layout.class_of())

    def logs(weights, bias):
        x = states.astype(float) @ weights.T.astype(float) + bias
        top = x.max(axis=1, keepdims=True)
        return x - top - np.log(np.exp(x - top).sum(axis=1, keepdims=True))

    kinds, words = logs(net.class_weights, net.class_bias), [logs(net.word_weights[a:b], net.word_bias[a:b]) for a, b in ((0, 2), (2, 6))]
    expected = [kinds[i, 0] + words[0][i, i] for i in (0, 1)] + [kinds[i, 1] + words[1][i, i - 2] for i in range(2, 6)]
    expected += [kinds[6, 2], kinds[7, 3]]
    assert np.allclose(found, expected, rtol=1e-5, atol=1e-4)


def test_states_are_those_of_a_plain_cell_and_lie_in_rows():
    layout = recurrent.Layout(6, np.array([0, 2]), 2, 1)
    net = recurrent.start(layout, np.arange(1.0, 9.0), 4, 1)
    net.inputs[5], net.inputs[6] = 300, -300  # saturated, without a warning
    rng = np.random.default_rng(1)
    inputs, first = rng.integers(0, 8, (9, 5)), (rng.random((9, 5)) < 0.2).astype(int)
    start = rng.normal(0, 1, (5, 4)).astype(np.float32)
    with np.errstate(all="raise", under="ignore"):
        found, kept, _ = recurrent.run(net, inputs, first, start, keep=True)
        alone, _, _ = recurrent.run(net, inputs, first, start)
    assert (found == alone).all()
    assert found.flags.c_contiguous and kept[0].flags.c_contiguous and kept[3].flags.c_contiguous  # nothing is turned over
    h = start.astype(float)
    for t in range(9):
        h = h * (1 - first[t])[:, None]
        assert np.allclose(kept[0][t], h, atol=1e-5)
        x = net.inputs[inputs[t]].astype(float)
        z, r = np.split(0.5 + 0.5 * np.tanh((x[:, :8] + h @ net.gates) / 2), 2, axis=1)
        c = np.tanh(x[:, 8:] + (r * h) @ net.candidate)
        h = h + z * (c - h)
        assert np.allclose(found[t], h, atol=1e-5)


def test_symbols_are_stored_in_few_bytes(spark, chatter):
    df = documents(spark, chatter + [(240, None), (241, "")])
    model, _ = lm.fit(df, F.lit(True), SMALL)
    rows = lm.encoded(df, model, F.lit(True)).collect()
    reader, texts = lm._Reader(model), dict(chatter) | {240: None, 241: ""}
    assert len(rows) == len(texts)
    for r in rows:
        assert list(r["symbols"]) == reader.text(texts[r["doc_id"]]).tolist() and len(r["symbols"]) == r["n_tokens"]
    layout = recurrent.Layout(2000, np.array([0, 5]), 24, 1)
    lists = [np.arange(5), np.array([1]), np.arange(2023, 1000, -1)]
    packed = lm._packed(np.concatenate(lists), np.cumsum([len(x) for x in lists]), layout)
    batch = pa.RecordBatch.from_arrays([packed], names=["symbols"])
    assert packed.nbytes < 2 * 1029 + 100
    for cut, most in ((batch, 10**6), (batch, 3), (batch.slice(1), 3), (batch.slice(3), 3)):
        parts = [x.tolist() for part in lm._parts(cut, "symbols", layout, most) for x in part]
        assert parts == [x.tolist() for x in lists[3 - cut.num_rows :]]


def test_language_model_on_odd_rows(spark):
    df = odd_documents(spark)
    model, counts = lm.fit(df, ~fold_is("doc_id", 7, 2), SMALL)
    rows = lm.score(df, model, counts).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == sorted((str(i), len(tokens(t))) for i, t in ODD_TEXTS)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    empty, none = lm.fit(no_documents(spark), F.lit(True), SMALL)
    assert (empty.tokens, empty.distinct) == (0, 0)
    assert lm.score(no_documents(spark), empty, none).count() == 0
    untrained = lm.score(df, empty, none).collect()
    assert all(r["base_score"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in untrained)


def test_network_learns_from_every_training_document(spark, chatter):
    df, held = documents(spark, chatter + [(None, "w1 w2 w3")]), fold_is("doc_id", 7, 2)
    model, _ = lm.fit(df, ~held, replace(SMALL, every=lm.Settings().every))
    assert model.trained == model.tokens > 0


def test_a_fifth_language_gets_its_own_markers_and_cut():
    rng = np.random.default_rng(1)
    names = ["aa", "bb", "cc", "dd", "ee"]
    common = [[f"{names[i % 5]}{k}" for k in rng.integers(0, 30, 12)] + ["shared"] for i in range(500)]
    languages = [names[i % 5] if i % 7 else None for i in range(500)]
    s = toxicity.Settings()
    markers = toxicity.learn_markers(common, languages, s)
    assert sorted(markers) == names and all(w.startswith(lang) for lang, own in markers.items() for w in own)
    assert [toxicity.guess_language(c, markers) for c in common] == [names[i % 5] for i in range(500)]
    assert toxicity.guess_language(["unknown"], markers) == "other" == toxicity.guess_language(["x"], {})
    logits = np.concatenate([rng.normal(0, 1, 50), rng.normal(9, 1, 50)])
    cuts = toxicity._cuts(logits, np.repeat([0.0, 1.0], 50), ["ee"] * 100, s)
    assert 2 < cuts["ee"] < 7


def test_one_row_per_repeated_id_reaches_the_driver(spark):
    rows = [(1, f"repeated text number {i}", "en") for i in range(400)] + [(10 + i, f"some words here {i}", "en") for i in range(100)]
    df = documents(spark, rows)
    labels = spark.createDataFrame([(1, 1), *((10 + i, i % 2) for i in range(100))], "doc_id LONG, toxic INT")
    sample = toxicity._sample(df, labels, "toxic", toxicity.Settings())
    assert sorted(sample["doc_id"]) == [1, *range(10, 110)]


def test_every_labelled_row_teaches_toxicity(spark):
    """Words that no row of the warm-up holds are learnt, and markers are those of all rows."""
    bad = [f"bad{chr(97 + i)}" for i in range(10)]
    texts = {i: f"{bad[i % 10] if i % 2 else 'fine'} words here " + ("un deux" if i % 3 else "one two") for i in range(400)}
    df = documents(spark, [(i, t, "fr" if i % 3 else "en") for i, t in texts.items()])
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id LONG, toxic INT")
    s = toxicity.Settings(positives=2, negatives=2, pass_rate=0.1)
    warm = {w for d in toxicity._sample(df, labels, "toxic", s)["doc_id"] for w in texts[d].split()}
    model = toxicity.fit(df, labels, settings=s)
    # odd ids hold only five of the ten words
    assert len(warm & set(bad)) <= 2
    assert all(model.table[toxicity._buckets(w, s)[0]].any() for w in {texts[i].split()[0] for i in range(1, 400, 2)})
    assert model.markers == toxicity.learn_markers([t.split() for t in texts.values()], ["fr" if i % 3 else "en" for i in texts], s)
    found = toxicity.score(df, model).join(labels, "doc_id").toPandas()
    assert ((found["toxicity"] >= 0.5) == (found["toxic"] == 1)).mean() > 0.95


def test_toxicity_trains_long_texts_by_chunks():
    s = toxicity.Settings(buckets=1 << 10)
    rng = np.random.default_rng(2)
    trainer = toxicity._trainer(s, rng)
    ids = rng.integers(0, s.buckets, (500, 3))
    ids[[200, 201, 202, 497, 498, 499]] = -1
    whole, parts = (toxicity._highest(trainer.model, ids, np.array([0, 203]), np.array([201, 295]), chunk) for chunk in (10_000, 64))
    assert np.array_equal(whole[0], parts[0]) and np.allclose(whole[1], parts[1], atol=1e-5)


def test_more_languages_than_there_are_is_an_error(spark):
    df = documents(spark, [(i, f"text {i}", f"lang{i}") for i in range(30)])
    with pytest.raises(ValueError, match="languages"):
        language.fit(df, settings=language.Settings(languages=20))
    assert len(language.fit(df, settings=language.Settings(languages=30, rows=3000)).languages) > 20
