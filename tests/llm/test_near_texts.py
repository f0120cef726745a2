"""Near-copies of the pipeline against brute-force Jaccard."""

import random

import numpy as np
import pytest

import corpus_pipeline
from ledgerline.llm import near_texts


def plain_kept(rows, overlap=0.8):
    """Smallest id of each component over all pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= overlap * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return sorted(min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in set(group))


@pytest.mark.parametrize("together", [2048, 4])
def test_all_pairs_of_enough_overlap_are_linked(spark, monkeypatch, together):
    """Scattered edits of one word in sixty and in thirty: overlaps about 0.85 and 0.7; with lots of 4 rows as with whole bands."""
    monkeypatch.setattr(near_texts, "TOGETHER", together)
    rng = random.Random(4)
    rows, key = [(900, ""), (901, None), (902, " \t"), (903, "Two words"), (904, "two  words")], 0
    for _ in range(15):
        base = [f"w{rng.randrange(5000)}" for _ in range(240)]
        for every in (1000, 120, 60, 60, 30, 24):
            words = base.copy()
            for at in range(rng.randrange(every), 240, every):
                words[at] = f"x{rng.randrange(10**6)}"
            rows.append((key := key + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, "").collect())
    assert got == plain_kept(rows)


def test_blocks_alone_propose_pairs(spark, monkeypatch):
    """With bands that no two texts share, blocks still find texts of one fingerprint and of a few bits' difference; what overlaps too little is not linked."""
    salt = iter(range(10**9))
    monkeypatch.setattr(near_texts, "bands", lambda own: [hash((next(salt), id(own))) for _ in range(near_texts.BANDS)])
    rng = random.Random(2)
    rows = [(1, "one two"), (2, "One  two"), (3, "three")]
    for k in range(10):
        words = [f"w{rng.randrange(5000)}" for _ in range(4000)]
        rows += [(10 * k + 10, " ".join(words)), (10 * k + 11, " ".join(words[:-1])), (10 * k + 12, " ".join(words) + " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, "").collect())
    assert got == plain_kept(rows)


def test_fingerprint_of_a_set():
    own = near_texts.shingles(" ".join(f"w{k}" for k in range(300)))
    want = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in own) > len(own))
    assert near_texts.set_fingerprint(own) % 2**64 == want
    assert near_texts.set_fingerprint(near_texts.shingles("")) == 0


def test_shared_bands():
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        own = rng.integers(0, 2**63, 180, dtype=np.uint64)
        a, b = near_texts.bands(own[:162]), near_texts.bands(own[18:])
        missed += not set(a) & set(b)
    assert missed <= 1


def test_rows_of_one_id_count_in_their_own_groups(spark):
    """Id 1 has a text of its own and is the smallest of two components; which row stays doesn't depend on the partitioning."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(100)) for x in "abc")
    rows = [(1, a, "s"), (1, b, "s"), (1, b, "t"), (1, b, "t"), (2, a + " more", "s"), (3, b + " more", "s"), (4, c, "s"), (None, c, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted(corpus_pipeline.keep_one_of_near_copies(spark, d, "").collect(), key=str) for d in (docs.coalesce(1), docs.orderBy(docs.text.desc()).repartition(7))]
    assert runs[0] == runs[1]
    assert sorted((str(r.doc_id), r.text) for r in runs[0]) == [("1", a), ("1", b), ("4", c), ("None", c)]
