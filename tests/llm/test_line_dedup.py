import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import line_dedup
from ledgerline.llm.cuckoo import CuckooFilter, CuckooShards
from ledgerline.llm.store import Shared

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows):
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=200, unique=True), st.randoms(use_true_random=False))
def test_filter_has_no_false_negatives_and_forgets(hashes, rng):
    f = CuckooFilter.of(np.array(hashes, np.int64))
    assert f.contains(np.array(hashes, np.int64)).all()
    gone = set(rng.sample(hashes, len(hashes) // 2))
    assert all(f.delete(h) for h in gone)
    f = CuckooFilter.from_bytes(f.to_bytes())
    left = np.array([h for h in hashes if h not in gone], np.int64)
    assert f.contains(left).all()
    for h in left.tolist():
        f.delete(h)
    assert not f.marks.any()


def test_few_false_positives():
    rng = np.random.default_rng(0)
    f = CuckooFilter.of(rng.integers(-(2**63), 2**63, 20_000))
    assert f.contains(rng.integers(-(2**63), 2**63, 50_000)).mean() < 1e-3


def corpus():
    rng = random.Random(4)
    common = [f"Common line number {k} here" for k in range(6)]
    rows = []
    for i in range(120):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"own line {i} {rng.random()}" for _ in range(rng.randrange(1, 6))]
        rows.append((i, "\n".join(x if rng.random() < 0.7 else f" \t{x.upper()}\r" for x in lines)))
    return rows + [(200, None), (201, ""), (202, "short\n\nshort"), (203, "É accents stay É\u0085"), (204, "é accents stay é\u0085"), (None, "Common line number 1 here"), (5, rows[5][1])]


@pytest.mark.parametrize("filter_bytes", [0, 1 << 20])
def test_against_brute_force(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", filter_bytes)
    monkeypatch.setattr(line_dedup, "LOT_LINES", 40)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], "doc_id long, text string, n_lines string, lost int, __kept int, text_hash int")
    out = line_dedup.dedup_lines(docs)
    got = out.collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=str) == brute(rows)
    assert out.columns == ["doc_id", "text", "lost", "__kept", "text_hash", "n_lines", "n_dropped", "kept"] and {(r["lost"], r["__kept"], r["text_hash"]) for r in got} == {(1, 2, 3)}
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_the_filters_reject_lines_before_they_move(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shared = Shared(spark)
    references = shared.keep(line_dedup.line_references(docs), "references")
    index = line_dedup.build_index(references, shared)
    known = line_dedup.known_to_filters(references, index)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    keys = {(r.h1, r.h2) for r in index.shared_keys().collect()}
    every = references.collect()
    left = known.collect()
    assert {r for r in every if (r.h1, r.h2) in keys} <= set(left) and len(left) < 0.7 * len(every)
    # The filters decide: without the marks of a shard its lines stay.
    index.filters = index.filters.limit(0)
    assert line_dedup.repeated_lines(references, index).count() == 0


def test_documents_of_very_many_lines(spark):
    many = [f"line number {k % 90_000}" for k in range(100_000)]
    rows = [(1, "\n".join(many)), (2, "\n".join(many + ["a line of its own"])), (3, "\n" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert time.monotonic() - began < 40
    assert got[1].n_dropped == 0 and (got[2].n_lines, got[2].n_dropped, got[2].kept) == (100_001, 100_000, "a line of its own") and got[3].n_lines == 50_001


def test_rows_of_one_id_and_different_texts(spark):
    rows = [(1, "a line that two hold\nshort"), (2, "short\na line that two hold"), (2, "a line that two hold\nanother text"), (2, "short\na line that two hold")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(docs).collect()) == brute(rows)


def test_insertions_and_deletions_equal_a_new_index(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    rows = [r for r in corpus() if r[0] is not None and r[0] != 5]
    frame = lambda part: line_dedup.line_references(spark.createDataFrame(part, "doc_id long, text string"))
    shared = Shared(spark)
    first, later = rows[::2], rows[1::2]
    gone, left = first[:20], first[20:] + later
    index = line_dedup.build_index(frame(first), shared)
    index = line_dedup.insert_documents(index, frame(later), shared, "more")
    index = line_dedup.delete_documents(index, frame(gone), frame(left), shared, "less")
    table = lambda x: sorted(map(tuple, x.counts.collect()))
    assert table(index) == table(line_dedup.build_index(frame(left), shared, name="anew"))
    docs = spark.createDataFrame(left, "doc_id long, text string")
    got = line_dedup.without_lines(docs, line_dedup.repeated_lines(frame(left), index)).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=str) == brute(left)
    held = {r.shard: CuckooFilter.from_bytes(r.marks) for r in index.filters.collect()}
    assert sum(int((f.marks > 0).sum()) for f in held.values()) == index.shared_keys().count()
    # All shards asked at once say what each says alone.
    asked = np.random.default_rng(1).integers(-(2**63), 2**63, (2, 500))
    keys = index.shared_keys().select("h1", "h2").toPandas()
    asked = np.concatenate([asked, keys.to_numpy().T], axis=1)
    both = CuckooShards(index.n_shards, {k: f.to_bytes() for k, f in held.items()}).contains(*asked)
    assert both[500:].all() and both.tolist() == [k % index.n_shards in held and bool(held[k % index.n_shards].contains(np.array([h]))[0]) for k, h in asked.T.tolist()]


def test_hash(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    assert hashlib.sha256(line_dedup.dedup_lines(docs).first().kept.encode()).hexdigest() == hashlib.sha256(b"a\nb").hexdigest()
