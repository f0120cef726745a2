"""The pipeline's stages against brute force on a small table."""

import pytest

import corpus_pipeline
from tests.llm.test_line_dedup import brute
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    rng = random.Random(5)
    words = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(200)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    good = [(k, text(80) + "\nA line that many documents share\n" + text(30), "en", f"s{k % 4}", 1) for k in range(60)]
    bad = [(100 + k, (text(40).upper() + "!! ").replace(" ", "!! "), "en", "s0", 0) for k in range(40)]
    near = [(200, good[7][1].replace("share", "shared"), "fr", "s1", 1), (201, good[3][1], "en", "s1", 1)]
    rows = good + bad + near
    path = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([(i, t, lang, s, len(t)) for i, t, lang, s, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, _, _, _, q in rows[:100]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def test_stages(spark, folder):
    path, rows = folder
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line dedup", "near copies", "mix", "encode"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, path)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _, _, q in rows if q}
    lines = corpus_pipeline.drop_repeated_lines(spark, kept, path)
    want = brute([(i, t) for i, t, _, _, q in rows if q])
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in lines.collect()), key=str) == sorted(((i, t, len(t)) for i, _, _, t in want), key=str)
    lines = lines.cache()
    one = corpus_pipeline.keep_one_of_near_copies(spark, lines, path)
    own = [(r.doc_id, r.text) for r in lines.orderBy("doc_id").collect()]
    labels = plain_components([plain_fingerprint(t) for _, t in own])
    assert sorted(r.doc_id for r in one.collect()) == sorted(min(i for (i, _), h in zip(own, labels, strict=True) if h == g) for g in set(labels))
    mixed = corpus_pipeline.mix_sources(spark, one, path)
    assert mixed.columns == docs.columns
    encoded = corpus_pipeline.encode(spark, mixed, path)
    assert encoded.count() == mixed.count() and encoded.filter("n_tokens <> size(token_ids)").count() == 0
    assert corpus_pipeline.run(spark, path).count() == mixed.count()


def test_odd_rows(spark, folder):
    """Nulls, repeated rows, clashing columns, empty tables."""
    path, _ = folder
    rows = [(None, None, None, None, None, "c"), (1, "a b c", "en", None, 5, "c"), (1, "a b c", "en", None, 5, "c"), (2, "", "en", "s", 0, "c"), (3, "word " * 20_000, "en", "s", 100_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, path)
            assert out.columns == table.columns, name
            assert {r.kept for r in out.collect()} <= {"c", None}, name
    assert corpus_pipeline.keep_one_of_near_copies(spark, docs, path).filter("doc_id = 1").count() == 1
    assert corpus_pipeline.encode(spark, docs, path).count() == len(rows)
