import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import langid, quality, tokens, toxicity
from ledgerline.llm.training import class_sample, id_fold

rng = random.Random(9)
WORDS = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]


def sentence(n, extra=()):
    words = [rng.choice(WORDS) for _ in range(n)]
    for e in extra:
        words[rng.randrange(n)] = e
    return " ".join(words) + "."


# Cross-parsing.


def greedy_phrases(text, known):
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        at = max(at + 1, end - 1)
        n += 1
    return n


def test_phrases_against_brute_force():
    known = "the cat sat on the mat and the rat ran"
    parser = langid.Parser(known)
    texts = ["the cat", "xyz", "that ran on", "mat and the rat ranran", "the rat sat on the cat" * 30, "t"]
    got = langid._phrase_counts([parser], [langid.code_points(t) for t in texts])[:, 0].tolist()
    assert got == [greedy_phrases(t, known) for t in texts]


def test_automaton_knows_all_substrings():
    text = [0, 1, 0, 2, 0, 1, 0, 1, 1]
    go = langid.SuffixAutomaton(text).go
    for a in range(len(text)):
        state = 0
        for c in text[a:]:
            state = go[state][c]
    assert len(go) <= 2 * len(text)


def test_languages(spark):
    langs = {"aa": "abcde", "bb": "vwxyz", "cc": "éèàçù"}
    r = random.Random(1)
    make = lambda cs: " ".join("".join(r.choice(cs) for _ in range(5)) for _ in range(40))
    rows = [(k, make(langs[lang]), lang) for k, lang in enumerate(list(langs) * 20)] + [(100, None, "aa"), (101, "123 !!", "bb"), (102, "", None), (None, make("vwxyz"), "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = langid.training_texts(docs.filter("doc_id % 2 = 0"), characters=2000)
    assert set(texts) == set(langs) and all(len(t) <= 2000 for t in texts.values())
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict_languages(docs, texts).collect()]
    want = {i: "und" if i in (100, 101, 102) else lang for i, _, lang in rows}
    assert len(got) == len(rows) and all(p == want[i] and 0 <= s <= 1 for i, p, s in got)
    assert {r.lang_pred for r in langid.predict_languages(docs, {}).collect()} == {"und"}
    assert langid.training_texts(docs.limit(0)) == {}


def test_long_text_in_pieces():
    model = langid.LanguageModel({"a": "abc " * 100, "b": "xyz " * 100})
    assert [p for p, _ in model.predict(["abc " * 20_000, None, "xyz"])] == ["a", "und", "b"]


# Naive Bayes support vectors.


def quality_sample(n):
    good = [sentence(30) for _ in range(n)]
    bad = [" ".join(w + rng.choice(["###", "***"]) for w in sentence(30).split()) for _ in range(n // 2)] + [sentence(20).upper() + "!!" for _ in range(n // 2)]
    return [(k, y, quality.features(t)) for k, (t, y) in enumerate([(t, 1) for t in good] + [(t, 0) for t in bad])]


def test_quality_on_held_out_texts():
    model, test = quality.fit(quality_sample(200)), quality_sample(100)
    owner = np.repeat(np.arange(len(test)), [len(f) for _, _, f in test])
    margins = model.margins(owner, np.concatenate([f for _, _, f in test]), len(test))
    right = [(1 / (1 + np.exp(-model.slope * m - model.offset)) >= quality.THRESHOLD) == y for m, (_, y, _) in zip(margins, test, strict=True)]
    assert np.mean(right) > 0.97


def test_dual_coordinate_descent_reaches_the_optimum():
    """The dual solution's primal objective can't be bettered by gradient descent."""
    g = np.random.default_rng(0)
    rows = [np.flatnonzero(g.random(12) < 0.4) for _ in range(40)]
    y = g.integers(0, 2, 40)
    cost = np.full(40, 0.5)
    scale = np.ones(12)
    w, b = quality.dual_coordinate_descent(rows, scale, y, cost, 300, 0)
    x = np.zeros((40, 13))
    for k, r in enumerate(rows):
        x[k, r] = 1 / np.sqrt(max(1, len(r)))
    x[:, 12] = 1
    s = np.where(y == 1, 1, -1)
    objective = lambda v: 0.5 * v @ v + (cost * np.maximum(0, 1 - s * (x @ v)) ** 2).sum()
    best = objective(np.append(w, b))
    v = np.append(w, b)
    for _ in range(500):
        slack = np.maximum(0, 1 - s * (x @ v))
        v = v - 0.02 * (v - 2 * x.T @ (cost * s * slack))
    assert best <= objective(v) + 1e-6


def test_logistic_curve_separates():
    slope, offset = quality.logistic_curve(np.array([-2.0, -1.0, 1.0, 2.0]), np.array([0, 0, 1, 1]))
    assert slope > 0 and abs(offset) < 0.1 and quality.logistic_curve(np.zeros(2), np.ones(2)) == (1.0, 0.0)


def test_one_class_and_no_rows():
    assert quality.fit([]).scores(["a b"])[0] == 0.5
    assert quality.fit([(1, 1, quality.features("a b"))]).scores([""])[0] > 0.9
    assert quality.fit([(1, 0, quality.features("a b"))]).scores([""])[0] < 0.1


@pytest.mark.parametrize("text", [None, "", " ", "\n"])
def test_no_features(text):
    assert len(quality.features(text)) == 0 and len(toxicity.word_hashes(text)) == 0


# Positive-unlabelled learning.


def test_toxicity_on_held_out_texts():
    bad = ["grubix", "snarpel", "vextor"]
    toxic = lambda: sentence(40, [rng.choice(bad)])
    positive = [toxicity.word_hashes(toxic()) for _ in range(200)]
    unlabelled = [toxicity.word_hashes(toxic() if k % 10 == 0 else sentence(40)) for k in range(1500)]
    model = toxicity.fit(positive, unlabelled, 0.1)
    scores, clean = model.scores([toxic() for _ in range(100)]), model.scores([sentence(40) for _ in range(300)])
    assert np.mean(scores >= 0.5) > 0.9 and np.mean(clean >= 0.5) < 0.05


def test_all_telling_words_are_in_the_model():
    """The model's words and their strengths against plain counts, far beyond a few hundred."""
    r = random.Random(3)
    positive = [np.array(sorted(r.sample(range(3000), 400))) for _ in range(60)]
    unlabelled = [np.array(sorted(r.sample(range(2000, 6000), 400))) for _ in range(80)]
    every, strength = toxicity.word_strengths(positive, unlabelled)
    for w, s in list(zip(every.tolist(), strength.tolist(), strict=True))[::97]:
        a, b = sum(w in set(t.tolist()) for t in positive), sum(w in set(t.tolist()) for t in unlabelled)
        x, y = (a + 0.5) / 61, (b + 0.5) / 81
        want = abs(x - y) / (x * (1 - x) / 61 + y * (1 - y) / 81) ** 0.5 if a + b >= 4 else -1
        assert s == pytest.approx(want)
    chosen = toxicity.chosen_words(positive, unlabelled)
    assert len(chosen) > 1000 and set(chosen.tolist()) == {w for w, s in zip(every.tolist(), strength.tolist(), strict=True) if s >= 3}


def test_risk_steps_by_finite_differences():
    """The step is the slope of the whole risk; where the negatives' estimate is below zero, that of the estimate, reversed."""
    g = np.random.default_rng(1)
    z, p, prior, eps = g.standard_normal(12), 5, 0.3, 1e-6
    low = z.copy()
    low[:p], low[p:] = 6, -6
    for margins, reversed_step in ((z, False), (low, True)):
        positive, negative, step = toxicity.risk_slopes(margins, p, prior)
        assert (negative < 0) == reversed_step
        for k in range(len(margins)):
            moved = margins.copy()
            moved[k] += eps
            a, b, _ = toxicity.risk_slopes(moved, p, prior)
            slope = -(b - negative) / eps if reversed_step else (a + b - positive - negative) / eps
            assert step[k] == pytest.approx(slope, abs=1e-5)


def test_toxicity_without_positives():
    assert toxicity.fit([], [toxicity.word_hashes("a b")], 0.25).scores(["a"])[0] == pytest.approx(0.25)


# Tokens and features against plain Python.


def plain_tokens(text):
    return re.findall(r"\w+|[^\w\s]+", text or "")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB9_éß!?# \n\u00a0\u0130漢"), max_size=40), st.text(max_size=20)), max_size=6), st.sampled_from([1, 7, 1 << 20]))
def test_tokens_against_a_pattern(texts, characters):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokens, "CHARACTERS", characters)
        got = tokens.tokens(texts)
    want = [(k, w) for k, t in enumerate(texts) for w in plain_tokens(t)]
    assert got.owner.tolist() == [k for k, _ in want] and got.size.tolist() == [len(w) for _, w in want]
    assert got.word.tolist() == [w[0].isalnum() or w[0] == "_" for _, w in want]
    assert [chr(c) for c in got.first] == [w[0] for _, w in want] and [chr(c) for c in got.last] == [w[-1] for _, w in want]
    small = ["".join(c.lower() if len(c.lower()) == 1 else c for c in w) for _, w in want]
    names = {}
    assert all(names.setdefault(w, h) == h for w, h in zip(small, got.hashed.tolist(), strict=True)) and len(set(names.values())) == len(names)
    for (_, w), t in zip(want, got.traits.tolist(), strict=True):
        assert t == sum(bit for bit, has in ((1, str.isupper), (2, str.islower), (4, str.isdigit)) if any(has(c) and (c.isalnum() or c == "_") for c in w))


def test_features_are_those_of_each_text_alone():
    texts = [sentence(30), None, "", "One two, two one!! ##", "x", sentence(5) * 3, "longer words and ==== marks"]
    owner, found = quality.indicators(texts)
    assert (np.diff(owner) >= 0).all()
    for k, t in enumerate(texts):
        assert found[owner == k].tolist() == quality.features(t).tolist()
    assert set(quality.features("red fox")) & set(quality.features("fox red")) and not set(quality.features("red fox")) <= set(quality.features("fox red"))
    # Tokens, pairs, shape pairs and triples: no more than that many, and nearly so many.
    many = [f"w{k}x" for k in range(200)]
    assert 200 + 190 < len(quality.features(" ".join(many))) <= 4 * 200
    long = "=" * 9 + " a"
    assert set(quality.features(long)).isdisjoint(set(quality.features("==== b")) - set(quality.features("b")))


def test_log_count_ratios():
    rows = [np.array([0, 1]), np.array([1]), np.array([2]), np.array([1, 2, 3])]
    got = quality.log_count_ratios(rows, np.array([1, 1, 0, 0]))
    positive, negative = {0: 1, 1: 2}, {1: 1, 2: 2, 3: 1}
    total = [3 + quality.FEATURES, 4 + quality.FEATURES]
    for f in range(6):
        assert got[f] == pytest.approx(np.log((positive.get(f, 0) + 1) / total[0] / ((negative.get(f, 0) + 1) / total[1])))


# Tables.


def test_learning_tables(spark):
    rows = [(k, sentence(20) if k % 3 else sentence(20).upper() + "!!" * 3, "x") for k in range(150)] + [(None, "text", "x"), (900, None, "x"), (901, "", "x"), (5, sentence(20), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), int(k % 7 == 0)) for k in range(150)] + [(None, 1, 1), (3, None, None), (4, 1, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels)
    scored = quality.quality_scores(docs, model, keep=("doc_id", "label")).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored) and {r.kept_label for r in scored} == {"x"}
    right = [(r.score >= 0.7) == (r.doc_id % 3 > 0) for r in scored if r.doc_id is not None and r.doc_id < 150 and r.doc_id != 5]
    assert np.mean(right) > 0.95
    tox = toxicity.fit_toxicity(docs, labels)
    assert toxicity.toxicity_scores(docs, tox).count() == len(rows)
    assert toxicity.toxicity_scores(docs.limit(0), toxicity.fit_toxicity(docs.limit(0), labels.limit(0))).count() == 0
    assert quality.quality_scores(docs.limit(0), quality.fit_quality(docs.limit(0), labels.limit(0))).count() == 0


def test_repeated_ids_and_clashing_columns(spark):
    rows = [(k % 5, f"text {k} here {'!!' * (k % 2)}", 1, 2, "c") for k in range(50)] + [(None, None, 1, 2, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, __score int, kept_text string")
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(5)] + [(2, 1, 1)], "doc_id long, quality int, toxic int")
    sample = class_sample(labels, "quality", 100, 0)
    drawn = quality.sampled_features(docs, sample, quality.indicators)
    assert [(i, y) for i, y, _ in drawn] == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 0)]
    assert [f.tolist() for _, _, f in drawn] == [f.tolist() for _, _, f in quality.sampled_features(docs.repartition(3), sample, quality.indicators)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = quality.quality_scores(docs, quality.fit_quality(docs, labels), keep=tuple(docs.columns))
    assert out.columns == ["doc_id", "score", "kept_doc_id", "kept_text", "kept_score", "kept___score", "kept_kept_text"] and out.count() == len(rows)
    assert {r["kept___score"] for r in out.collect()} == {2}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_samples_are_bounded_and_repeatable(spark):
    labels = spark.range(5000).selectExpr("id doc_id", "cast(id % 4 = 0 as int) quality")
    one = class_sample(labels, "quality", 200, 3)
    counts = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    assert all(120 < counts[y] < 280 for y in (0, 1))
    assert sorted(one.collect()) == sorted(class_sample(labels.repartition(5), "quality", 200, 3).collect())
    import zlib

    folds = {r.doc_id: r.f for r in labels.select("doc_id", id_fold("doc_id", 4).alias("f")).limit(50).collect()}
    assert folds == {k: zlib.crc32(str(k).encode()) % 4 for k in folds}
