"""Shards and mixes."""

import zlib
from collections import Counter
from itertools import permutations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing, sharding


def test_hypergeometric_law():
    rng = np.random.default_rng(1)
    for good, bad, drawn in ((5, 7, 4), (50, 3, 20), (1, 1, 1), (30, 30, 30)):
        n = 4000
        got = Counter(sharding.hypergeometric(rng, good, bad, drawn) for _ in range(n))
        low, high = max(0, drawn - bad), min(good, drawn)
        chance = {k: comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn) for k in range(low, high + 1)}
        assert set(got) <= set(chance)
        assert all(abs(got[k] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 4 / n for k, p in chance.items())
    big = [sharding.hypergeometric(rng, 10**9, 23 * 10**9, 10**7) for _ in range(50)]
    assert abs(np.mean(big) / (10**7 / 24) - 1) < 1e-3


def test_matrix_has_exact_margins():
    parts, shards = [7, 0, 13, 100, 1], sharding.even_sizes(121, 6)
    matrix = sharding.communication_matrix(parts, shards, 5)
    assert [sum(r) for r in matrix] == parts and [sum(c) for c in zip(*matrix, strict=True)] == shards


def test_every_permutation_is_alike(spark):
    seen = Counter()
    docs = spark.createDataFrame([(k, str(k)) for k in range(2)], "doc_id long, text string")
    for seed in range(14):
        seen[tuple(r.doc_id for r in sharding.shuffle_into_shards(docs, 2, seed).orderBy("shard", "slot").collect())] += 1
    assert set(seen) == set(permutations(range(2))) and max(seen.values()) < 13


def test_shards_and_slots_follow_nothing(spark, monkeypatch):
    """Over many parts: which shard and slot a row gets doesn't hang on where it lay."""
    monkeypatch.setattr(sharding, "PART_ROWS", 300)
    docs = spark.range(0, 12_000, 1, 5).selectExpr("id doc_id", "cast(id as string) text")
    out = sharding.shuffle_into_shards(docs, 6, 11).toPandas()
    table = np.histogram2d(out.doc_id, out["shard"], [20, 6])[0]
    assert table.sum(axis=0).tolist() == [2000] * 6
    chi = ((table - 100) ** 2 / 100).sum()
    assert abs(chi - 19 * 5) < 5 * np.sqrt(2 * 19 * 5)
    within = np.histogram2d(out.doc_id, out["slot"], [10, 10])[0]
    assert abs(((within - 120) ** 2 / 120).sum() - 81) < 5 * np.sqrt(2 * 81)
    # Neighbours part: as many as chance has it stay in one shard, and next to each other.
    order = out.sort_values("doc_id")
    same = (order["shard"].to_numpy()[1:] == order["shard"].to_numpy()[:-1]).mean()
    assert same == pytest.approx(1 / 6, abs=0.02)
    assert (np.abs(np.diff(order["slot"].to_numpy())) == 1).mean() < 0.005


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 20)
    monkeypatch.setattr(sharding, "SLICE_ROWS", 3)
    rows = [(k, "t" * (k % 50), k) for k in range(200)] + [(None, None, 0), (1, "same", 0), (1, "same", 0), (2, "é" * 10_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = sharding.shuffle_into_shards(docs, 7).collect()
    sizes = Counter(r.shard for r in out)
    assert len(out) == len(rows) and set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(7):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == want
    assert sharding.shuffle_into_shards(docs.limit(0), 7).count() == 0
    monkeypatch.setattr(sharding, "MATRIX", 14)
    assert sorted(Counter(r.shard for r in sharding.shuffle_into_shards(docs, 7).collect()).values()) == sorted(sizes.values())


def water(sizes, weights=(5, 2, 1), most=3):
    """Reshares the excess until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped = set()
    while True:
        left, open_ = sum(sizes.values()) - sum(most * sizes[s] for s in capped), sum(w[s] for s in order if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * w[s] / open_ for s in order}
        over = {s for s in order if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, None: 5}, {"a": 1, "b": 1000, "c": 10, "d": 3, "é": 500}, {"x": 7}, {"a": 0, "b": 10}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICES", 8)
    r = np.random.default_rng(2)
    rows = [(k, " ".join(["w"] * int(r.integers(0, 60))), ["a", "b", "c", None][min(3, k % 5)]) for k in range(800)] + [(None, None, "a"), (3, "x \x0b y z", "b"), (3, "x y", "b"), (9000, "w " * 20_000, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash")).withColumn("copies", F.lit(0))
    out = mixing.pareto_mix(docs, keep=("text",)).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    want = water(sizes)
    largest = {s: max(len((t or "").encode().split()) for _, t, x in rows if x == s) for s in sizes}
    for s in sizes:
        own = [x for x in out if x.source == s]
        assert own[0].target == pytest.approx(want[s]) and own[0].source_size == sizes[s]
        assert abs(sum(x.copies * x["size"] for x in own) - want[s]) <= max(1, largest[s])
        assert all(0 <= x.copies <= 3 for x in own)
    again = mixing.pareto_mix(docs.repartition(5)).collect()
    key = lambda x: (str(x.doc_id), x["size"], x.copies)
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert mixing.pareto_mix(docs.limit(0)).count() == 0


def plain_due(target, cells, most=3):
    """Raises the rate of all that are below the most until the words add up."""
    low, high = 0.0, 1e9
    for _ in range(200):
        rate = (low + high) / 2
        low, high = (rate, high) if sum(n * min(most, rate * w) for w, n in cells.items()) < target else (low, rate)
    return {w: min(most, rate * w) for w in cells}


@pytest.mark.parametrize("target, cells", [(100.0, {1: 40, 2: 30, 7: 10}), (230.0, {1: 40, 2: 30, 7: 10}), (240.0, {1: 40, 2: 30, 7: 10}), (5.0, {3: 50}), (0.0, {1: 4})])
def test_due_copies(spark, target, cells):
    df = spark.createDataFrame([(None, target, w, n) for w, n in cells.items()] + [("x", 1.0, 1, 0), ("x", 1.0, 2, 5)], "source string, target double, weight long, words long")
    got = {r.weight: r.due for r in mixing.due_copies(df).filter("source is null").collect()}
    assert got == pytest.approx(plain_due(target, cells), abs=1e-9)


def test_longer_documents_are_likelier(spark):
    docs = spark.range(6000).selectExpr("id doc_id", "repeat('w ', if(id % 3 = 0, 64, 3)) text", "if(id < 5000, 'a', 'b') source")
    got = mixing.pareto_mix(docs, weights=(1, 6)).filter("source = 'a'")
    mean = {r["size"]: r.c for r in got.groupBy("size").agg(F.avg("copies").alias("c")).collect()}
    assert mean[64] / mean[3] == pytest.approx(7 / 2, rel=0.15) and mean[64] < 1


def test_weights_set_the_chances(spark):
    """Documents of three times the weight are due three times the copies."""
    docs = spark.range(4000).selectExpr("id doc_id", "'w w' text", "if(id < 3000, 'a', 'b') source", "if(id % 2 = 0, 3.0, 1.0) weight")
    got = mixing.pareto_mix(docs, weights=(1, 3), weight_col="weight", keep=("weight",)).filter("source = 'a'").groupBy("weight").agg(F.avg("copies").alias("c")).collect()
    mean = {r.weight: r.c for r in got}
    assert mean[3.0] / mean[1.0] == pytest.approx(3, rel=0.15)
