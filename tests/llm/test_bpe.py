import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import bpe, tokens
from ledgerline.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path()
OURS = bpe.tokenizer(PATH)
THEIRS = tokenizers.Tokenizer.from_file(PATH)


def same(text):
    ids = OURS.encode(text)
    want = THEIRS.encode(text, add_special_tokens=False).ids
    assert ids == want, text
    assert OURS.decode(ids) == THEIRS.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", " ", "a", "  a", "a  ", "\n\n a", "don't we'll I'd they're 'tis x's't ''s !'s 's 're' 'r", "a b   c", "<|endoftext|>x<|endoftext|>", "日本語テキスト ½ Ⅷ ٣", "é" * 50, "a" * 1000, "0123456789" * 60, "\x1c\x1d \x85 ", "naïve ʼn don’t", "👩‍👩‍👧 ok", "'lle 'vex 'll", "ab\t\tcd \t e"],
)
def test_cases(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'stremvld  \n\t!?1²é日 ")), max_size=40))
def test_small_alphabet(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FFF, categories=("L", "N", "P", "S", "Z", "Cc")), max_size=40))
def test_unicode(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(st.sampled_from(list("ab'stre  \n!1é日")), max_size=25), st.sampled_from(["", " ", "  ", "\n ", "'s", "x<|endoftext|>y", "a "])), max_size=8), st.sampled_from([1, 9, 1 << 20]))
def test_texts_together_are_as_alone(texts, characters):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokens, "CHARACTERS", characters)
        got = OURS.encode_batch(texts)
    assert got == [THEIRS.encode(t, add_special_tokens=False).ids for t in texts]


def test_fragments_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(bpe, "hashed_spans", lambda cps, starts, ends, which=0: (ends - starts if not which else cps[starts]).astype("uint64"))
    texts = ["the cat sat on a mat", "and one two too"]
    assert bpe.ForcedBoundaryBpe(PATH).encode_batch(texts) == [THEIRS.encode(t).ids for t in texts]


def test_files_that_ask_for_more_are_refused(tmp_path):
    import json

    spec = json.loads(open(PATH, encoding="utf-8").read())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": spec["model"] | {"ignore_merges": True}}):
        (tmp_path / "t.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="doesn't do"):
            bpe.ForcedBoundaryBpe(str(tmp_path / "t.json"))


def test_long_runs_agree_with_short_ones():
    rng = random.Random(1)
    for n in (201, 500):
        raw = "".join(rng.choice("theinganerst") for _ in range(n)).encode()
        assert OURS._long(raw) == OURS._merged(raw)


def test_no_token_joins_a_forced_cut():
    for token in list(OURS.ids)[::37]:
        for a, b in zip(token, token[1:], strict=False):
            assert OURS.joined[a, b]
    assert not OURS.joined.all()


def test_tables(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (3, "", "y"), (4, "word " * 30_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    out = bpe.decode_texts(bpe.encode_texts(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in out) == sorted((i or 0, t or "") for i, t, _ in rows)
    assert all(r.n_tokens == len(r.token_ids) for r in out)
    assert bpe.encode_texts(docs.limit(0), PATH).count() == 0
