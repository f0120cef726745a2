import numpy as np
import pyarrow as pa

from ledgerline.llm import ann


def brute(rows, queries, nearest):
    out = []
    for q, v in queries:
        scored = {(i, float(np.dot(v, w) / np.sqrt(np.dot(v, v)) / np.sqrt(np.dot(w, w)))) for i, w in rows if i != q}
        best = sorted(scored, key=lambda x: (-round(x[1], 12), x[0]))[:nearest]
        out += [(q, k + 1, i, round(s, 9)) for k, (i, s) in enumerate(best)]
    return sorted(out)


def test_hilbert_curve_walks_to_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_exact_within_windows_with_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(int(i), rng.standard_normal(6).tolist()) for i in range(60)]
    hot = [(int(i), [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(100, 140)]
    bad = [(200, None), (201, [0.0] * 6), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (203, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0]), (250, [float("inf")] * 6), (None, [1.0] * 6), (251, [1.0, 2.0]), (252, [])]
    rows = good + hot + bad + good[:3]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, same int")
    got = ann.nearest_neighbours(df, df.filter("vec_id % 50 = 0")).collect()
    queries = [(i, v) for i, v in good + hot if i % 50 == 0]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == brute(good + hot, queries, 5)
    assert ann.nearest_neighbours(df.limit(0), df.limit(0)).count() == 0


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id, r.score) for r in ann.nearest_neighbours(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 0.0)]


def test_recall_of_small_windows(spark):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((20_000, 64)).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(range(len(v))), "embedding": pa.array(list(v), pa.list_(pa.float32()))}))
    got = {(r.query_id, r.vec_id) for r in ann.nearest_neighbours(df, df.filter("vec_id % 200 = 0")).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit[::200] @ unit.T
    near[np.arange(100), np.arange(0, 20_000, 200)] = -2
    want = {(200 * q, int(i)) for q, row in enumerate(near) for i in np.argsort(-row)[:5]}
    assert len(got) == 500 and len(got & want) >= 0.9 * len(want)


def windows_alone(v, queries, nearest=5):
    """Without Spark: the share of the true nearest that lie in a window that is met, and the rows that a query meets, as a share of the table."""
    n = len(v)
    rng = np.random.default_rng(3)
    units = ann.half_units(v)
    top = np.concatenate([np.argpartition(-(units[q].astype(np.float32) @ units.astype(np.float32).T), nearest)[: nearest + 1][None] for q in queries])
    shape = ann.Curves(units[rng.choice(n, ann.SAMPLE)], n)
    row, place = shape.lookups(units[queries], ann.places_for(n))
    own = [shape.places(shape.projected(units, c), c) for c in range(shape.curves)]
    every = np.concatenate(own)
    order = np.argsort(every, kind="stable")
    edges, windows, asked = ann._windows_met(every[order], order, place, np.zeros(len(place), np.int64), row, ann.WINDOW)
    window_of = np.empty(len(every), np.int64)
    window_of[order] = np.searchsorted(edges, np.arange(len(every)), side="right") - 1
    found = np.zeros(top.shape, bool)
    for k in range(len(queries)):
        met = windows[asked == k]
        found[k] = np.isin(window_of.reshape(shape.curves, n)[:, top[k]], met).any(axis=0)
    return found[top != np.array(queries)[:, None]].mean(), len(windows) * ann.WINDOW / len(queries) / n


def test_a_falling_share_of_the_table_holds_the_recall():
    rng = np.random.default_rng(1)
    shares = []
    for n in (50_000, 400_000):
        v = rng.standard_normal((n, 64), dtype=np.float32)
        recall, met = windows_alone(v, rng.choice(n, 100, replace=False))
        assert recall >= 0.88
        shares.append(met)
    assert shares[0] < 0.6 and shares[1] < 0.27


def test_vectors_in_groups_need_a_small_share():
    rng = np.random.default_rng(2)
    n = 400_000
    v = np.repeat(rng.standard_normal((n // 50, 64), dtype=np.float32), 50, axis=0) + 0.5 * rng.standard_normal((n, 64), dtype=np.float32)
    queries = rng.choice(n, 100, replace=False)
    few = ann.places_for
    try:
        ann.places_for = lambda n: 48
        recall, met = windows_alone(v, queries)
    finally:
        ann.places_for = few
    assert recall >= 0.9 and met < 0.05


def test_lengths_beyond_the_squares_of_doubles_and_several_widths(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 2e-200]), (2, [3.0, 3.0]), (3, [-1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0]), (5, [0.0, 2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in ann.nearest_neighbours(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, round(3 / 10**0.5, 12)), (0, 3, 3, round(-(0.5**0.5), 12)), (50, 1, 5, 1.0), (50, 2, 4, 0.0)]


def test_a_crowd_in_one_direction_is_parted(spark, monkeypatch):
    """Different vectors of one direction have one place; their salts part them, and each range searches its share."""
    monkeypatch.setattr(ann, "SMALL", 10)
    monkeypatch.setattr(ann, "RANGE", 2000)
    rng = np.random.default_rng(8)
    crowd = [(i, [float(i + 1), 0.0, 0.0]) for i in range(2000)]
    df = spark.createDataFrame(crowd + [(5000 + i, x.tolist()) for i, x in enumerate(rng.standard_normal((500, 3)))], "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(df, df.filter("vec_id in (0, 50)")).collect()
    assert len(got) == 10 and all(r.score == 1.0 and r.vec_id < 2000 for r in got)
