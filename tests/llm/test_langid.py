"""Languages of many characters, and of long documents only."""

import random

import pytest

from ledgerline.llm import langid


def plain_phrases(training, text):
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in training:
            size += 1
        count, at = count + 1, at + size
    return count


def test_every_character_of_the_training_text_counts():
    rng = random.Random(3)
    script = [chr(0x4E00 + k) for k in range(600)]
    words = ["".join(rng.choice(script) for _ in range(3)) for _ in range(300)]
    training = [" ".join(rng.choice(words) for _ in range(500)) for _ in range(2)]
    parsers = [langid.Parser(t) for t in training]
    texts = ["".join(rng.choice([rng.choice(words), rng.choice(script), " ", "xü"]) for _ in range(rng.randrange(1, 60))) for _ in range(80)] + [training[0][:900], training[1][300:700]]
    want = [[plain_phrases(t, text) for t in training] for text in texts]
    assert langid._phrase_counts(parsers, [langid.code_points(t) for t in texts]).tolist() == want


@pytest.mark.parametrize("piece", [1, 3, 50, 4096])
def test_long_texts_are_parsed_as_one(monkeypatch, piece):
    """Phrases over the pieces' borders, also where several pieces end within one phrase."""
    monkeypatch.setattr(langid, "PIECE", piece)
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    training = [" ".join(rng.choice(words) for _ in range(400)), "".join(rng.choice("ab ") for _ in range(300))]
    length = 20_000 if piece == 4096 else 900
    text = lambda: " ".join(rng.choice(words) if rng.random() < 0.8 else rng.choice(["xyz", "aabb"]) for _ in range(length))[:length]
    texts = [text(), training[0][:length], "", "a" * 700, text()[:333], training[0][5:705] * 2]
    want = [[plain_phrases(t, x) for t in training] for x in texts]
    assert langid._phrase_counts([langid.Parser(t) for t in training], [langid.code_points(t) for t in texts]).tolist() == want


def test_thousands_of_letters():
    rng = random.Random(7)
    script = [chr(0x4E00 + k) for k in range(3000)]
    training = "".join(rng.sample(script, 3000)) + "".join(rng.choice(script) for _ in range(3000))
    text = "".join(training[k : k + rng.randrange(1, 9)] for k in (rng.randrange(5990) for _ in range(400)))
    assert langid._phrase_counts([langid.Parser(training)], [langid.code_points(text)]).tolist() == [[plain_phrases(training, text)]]


def test_cleaning():
    for t in ("", "  ", "Ab,c  É!1x", "12", "ÄÖ ß", "a\n\tb "):
        assert langid.normalised(t) == " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split())


def test_clashing_columns_and_odd_rows(spark):
    rows = [(1, "the cat sat", "en", 5, "x"), (1, "the cat sat", "en", 5, "x"), (None, "кот", None, None, None), (3, None, "en", 1, "y"), (4, "the cat " * 30_000, "en", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, lang_pred string")
    texts = langid.training_texts(docs)
    assert set(texts) == {"en"}
    got = langid.predict_languages(docs, texts)
    assert got.columns == ["doc_id", "lang_pred", "score"] and sorted(str(r.doc_id) + r.lang_pred for r in got.collect()) == ["1en", "1en", "3und", "4en", "Noneen"]
    assert langid.predict_languages(docs.limit(0), texts).count() == 0


def test_languages_of_one_script_are_told_apart_by_their_rarer_characters():
    rng = random.Random(4)
    common = [chr(0x4E00 + k) for k in range(63)]
    words = {k: ["".join(rng.choice(chars) for _ in range(3)) for _ in range(40)] for k, chars in (("aa", [chr(0x6000 + k) for k in range(90)]), ("bb", [chr(0x7000 + k) for k in range(90)]))}
    text = lambda own: " ".join(rng.choice(own) if rng.random() < 0.3 else "".join(rng.choice(common) for _ in range(6)) for _ in range(900))
    model = langid.LanguageModel({k: text(own) for k, own in words.items()})
    asked = [(" ".join(rng.choice(own) for _ in range(4)), k) for k, own in words.items() for _ in range(20)]
    assert [p for p, _ in model.predict([t for t, _ in asked])] == [k for _, k in asked]


def test_a_language_of_long_texts_only_is_learned(spark):
    rows = [(k, "the cat sat on a mat. " * 3, "en") for k in range(5)] + [(10 + k, "12 " * 300 + "кот сидел на ковре. " * 60, "ru") for k in range(3)] + [(20, "ab " * 100, "edge"), (30, "7 " * 400, "none"), (31, None, "null")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = langid.training_texts(docs, characters=300)
    assert set(texts) == {"en", "ru", "edge"} and all(len(t) < 300 for t in texts.values())
    assert set(texts["ru"]) <= set("кот сидел на ковре")
    got = {r.doc_id: r.lang_pred for r in langid.predict_languages(docs, texts).collect()}
    assert [got[k] for k in (0, 10, 20, 30)] == ["en", "ru", "edge", "und"]
    assert set(langid.training_texts(docs.filter("lang = 'ru'"), characters=300)) == {"ru"}
    assert langid.training_texts(docs, characters=300) == langid.training_texts(docs.repartition(5), characters=300)
