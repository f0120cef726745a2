"""The registered queries as they are: folds, thresholds, columns, and whole results against brute force or SQL."""

import hashlib
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerline.llm import mpegts, quality, toxicity
from ledgerline.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in rows}


def result(spark, n, folder=SF):
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    return QUERIES[name](spark, folder)


def crc(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_op1(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    ids, v = table.column("vec_id").to_numpy(), np.array(table.column("embedding").to_pylist(), float)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = set()
    for k in np.flatnonzero(ids % 50 == 0):
        near = unit @ unit[k]
        near[k] = -2
        want |= {(int(ids[k]), r + 1, int(ids[j])) for r, j in enumerate(np.lexsort([ids, -near])[:5])}
    out = result(spark, 1)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    rows = out.collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in rows} == want
    at = {int(i): k for k, i in enumerate(ids)}
    assert all(r.score == pytest.approx(float(v[at[r.query_id]] @ v[at[r.vec_id]] / np.linalg.norm(v[at[r.query_id]]) / np.linalg.norm(v[at[r.vec_id]])), abs=1e-14) for r in rows)


def test_op2(spark, texts):
    out = result(spark, 2)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    own = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in own]
    labels = plain_components(prints)
    first = {}
    for i, g in zip(own, labels, strict=True):
        first.setdefault(g, i)
    assert sorted(map(tuple, out.collect())) == [(i, f"{p:016x}", first[g]) for i, p, g in zip(own, prints, labels, strict=True)]


def test_op3(spark, texts):
    rows = {r.doc_id: r for r in result(spark, 3).collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        raw = (t or "").encode()
        padded = raw + bytes(-len(raw) % 64 if raw else 64)
        stored = mpegts.to_transport_stream(padded)
        samples = np.frombuffer(padded, np.uint8)
        units = -(-len(padded) // mpegts.UNIT)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(padded[-64:]), len(stored), hashlib.sha256(stored).hexdigest())
        crossings = sum((a >= 64) != (b >= 64) for a, b in zip(padded, padded[1:], strict=False))
        last = (units - 1) * mpegts.UNIT * 90_000 // 8000
        assert r.feature == f"packets={len(stored) // 188};errors=0;streams=256:6;units={units};random_access={units};last_pts={last};sum={int(samples.sum())};crossings={crossings}"


@pytest.mark.parametrize("n", [4, 10])
def test_sql(spark, tmp_path, n):
    """Over the given tables, and over rows with nulls, no words, repeats and sources of all kinds."""
    odd = [(1, None, None, None, 0), (2, "", "a", None, 0), (3, "A line to share\nx\nA line to share", "a", "s", 0), (4, " a LINE to share\t\nb", "a", "s", 0), (5, "w " * 5000, "a", "é", 0), (6, "one two three", "a", None, 0), (7, "\x0b \n", "a", "zero", 0)]
    odd += [(100 + k, "word " * (k % 40), "a", f"s{k % 7}", 0) for k in range(300)]
    spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    for folder, glob in ((SF, "documents.parquet"), (str(tmp_path), "documents.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/{glob}')")
        want = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in want.description]
        out = result(spark, n, folder)
        assert sorted(out.columns) == sorted(names)
        assert sorted(map(tuple, out.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_op5(spark, texts):
    rows = {r.doc_id: r for r in result(spark, 5).collect()}
    assert rows.keys() == texts.keys()
    assert all(r.held_out == (crc(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    # By hand: the model of the learning rows, scoring all.
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    learn = [i for i in sorted(texts) if crc(i, 5)]
    toxic = [toxicity.word_hashes(texts[i]) for i in learn if labels.get(i) == 1]
    known = [y for i, y in labels.items() if crc(i, 5) and y is not None]
    model = toxicity.fit(toxic, [toxicity.word_hashes(texts[i]) for i in learn], sum(known) / len(known))
    assert [rows[i].score for i in sorted(texts)] == pytest.approx(model.scores([texts[i] for i in sorted(texts)]).tolist())


def test_op6(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rows = {r.doc_id: r for r in result(spark, 6).collect()}
    assert rows.keys() == texts.keys()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert tuple(rows[i])[1:] == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))


def test_op7(spark, texts):
    rows = {r.doc_id: r for r in result(spark, 7).collect()}
    langs = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    assert rows.keys() == texts.keys() and all(r.held_out == (crc(i, 4) == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    for i, r in rows.items():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[i] or ""))
    held = [i for i, r in rows.items() if r.held_out and langs[i] is not None and r.lang_pred != "und"]
    assert np.mean([rows[i].lang_pred == langs[i] for i in held]) > 0.95


def test_op8(spark, texts):
    rows = {r.doc_id: r for r in result(spark, 8).collect()}
    assert rows.keys() == texts.keys()
    assert all(r.held_out == (crc(i, 4) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    learn = [(i, labels[i], quality.features(texts[i])) for i in sorted(texts) if crc(i, 4) != 2 and labels.get(i) is not None]
    scores = quality.fit(learn).scores([texts[i] for i in sorted(texts)])
    assert [rows[i].score for i in sorted(texts)] == pytest.approx(scores.tolist())


def test_op9(spark, texts):
    rows = result(spark, 9).collect()
    assert {r.doc_id for r in rows} == texts.keys() and len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    slots = {s: sorted(r.slot for r in rows if r["shard"] == s) for s in range(24)}
    assert all(own == list(range(len(own))) for own in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_the_callers_session_keeps_its_settings(spark):
    before = dict(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll()))
    result(spark, 6).count()
    after = dict(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll()))
    assert {k: v for k, v in after.items() if k != "spark.checkpoint.dir"} == {k: v for k, v in before.items() if k != "spark.checkpoint.dir"}
