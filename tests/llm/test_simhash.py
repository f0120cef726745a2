import random

import numpy as np
import pytest
import xxhash

from ledgerline.llm import simhash
from ledgerline.llm.components import connected_components
from ledgerline.llm.store import Shared


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=3):
    group = list(range(len(fps)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return [root(k) for k in range(len(fps))]


def partition(labels):
    out = {}
    for k, g in enumerate(labels):
        out.setdefault(g, []).append(k)
    return sorted(map(tuple, out.values()))


@pytest.mark.parametrize("text", [None, "", "  ", "a", "A b", "a b c", "One word \x1c here", "É é", "w " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def test_masks_are_pigeonholes():
    masks = simhash.block_masks(64, 6, 3)
    assert len(masks) == 20
    rng = random.Random(2)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("direct", [128, 3])
def test_components_against_brute_force(spark, monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT", direct)
    rng = np.random.default_rng(3)
    fps = set()
    for center in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(25):
            flips = rng.choice(64, size=rng.integers(0, 6), replace=False).tolist()
            fps.add(center ^ sum(1 << b for b in flips))
    fps = sorted(fps)
    table = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    shared = Shared(spark)
    reach = {r.node: r.component for r in connected_components(simhash.links(table, shared), shared).collect()}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    assert partition([reach.get(f, f) for f in signed]) == partition(plain_components(fps))


def test_tables(spark):
    base = [f"word{k}" for k in range(400)]
    near = base.copy()
    near[7] = "other"
    rows = [(5, " ".join(base), 1), (3, " ".join(near), 2), (9, " ".join(base).upper(), 3), (9, " ".join(base), 3), (None, None, 4), (8, "", 5), (7, " \t", 6), (1, "quite alone here", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    out = simhash.near_duplicates(docs, width=3).collect()
    ids = [i for i, _, _ in rows]
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    labels = plain_components(fps)
    least = {g: min(i for i, h in zip(ids, labels, strict=True) if h == g and i is not None) for g in labels}
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(((i, f"{f:016x}", least[g]) for i, f, g in zip(ids, fps, labels, strict=True)), key=key)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=key) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_chain(spark):
    shared = Shared(spark)
    chain = spark.range(200).selectExpr("id a", "id + 1 b")
    assert {r.component for r in connected_components(chain, shared).collect()} == {0}
