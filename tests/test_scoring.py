import pytest

from ledgerline.operators import recall, scoring


def tables(spark, truth, found):
    ent = spark.createDataFrame([(s,) for s in truth], "s1_id string")
    flat = lambda d: spark.createDataFrame([(s, t) for s, ts in d.items() for t in ts], "s1_id string, target_id string")
    return ent, flat(truth), flat(found)


CASES = [
    (["S2-47", "S3-812"], ["S2-47", "S2-193", "S3-812"], 5 / 7),
    ([], [], 1.0),
    ([], ["S2-1"], 0.0),
    (["S2-1"], [], 0.0),
    (["S2-1"], ["S2-1"], 1.0),
    (["a", "b", "c"], ["a", "b"], 10 / 11),
    (["a", "b"], ["a", "c"], 0.5),
]


def test_each_entity(spark):
    truth = {f"S1-{k}": c[0] for k, c in enumerate(CASES)}
    found = {f"S1-{k}": c[1] for k, c in enumerate(CASES)} | {"S1-unknown": ["S2-9"]}
    rows = {r.source1_entity_id: r for r in scoring.per_entity_scores(*tables(spark, truth, found)).collect()}
    assert len(rows) == len(CASES)
    for k, (t, p, f) in enumerate(CASES):
        r = rows[f"S1-{k}"]
        tp = len(set(t) & set(p))
        assert (r.true_count, r.predicted_count, r.true_positive_count, r.false_positive_count, r.false_negative_count) == (len(t), len(p), tp, len(p) - tp, len(t) - tp)
        assert r.f0_5 == pytest.approx(f, abs=1e-12)


def test_summary(spark):
    truth = {"S1-1": ["S2-1"], "S1-2": [], "S1-3": ["S2-3"], "S1-4": []}
    found = {"S1-1": ["S2-1"], "S1-2": [], "S1-3": [], "S1-4": ["S3-4"]}
    s = scoring.score_summary(scoring.per_entity_scores(*tables(spark, truth, found))).first()
    assert (s.macro_f0_5, s.singleton_accuracy, s.empty_predictions, s.non_empty_predictions, s.exact_set_accuracy) == (0.5, 0.5, 2, 2, 0.5)
    assert (s.pooled_tp, s.pooled_fp, s.pooled_fn, s.num_entities, s.num_singletons) == (1, 1, 1, 4, 2)


def test_empty_truth_and_duplicates(spark):
    ent, truth, found = tables(spark, {"S1-1": ["S2-1"]}, {"S1-1": ["S2-1", "S2-1"]})
    with pytest.raises(ValueError, match="S2-1"):
        scoring.per_entity_scores(ent, truth, found, check_duplicates=True)
    s = scoring.score_summary(scoring.per_entity_scores(ent.limit(0), truth, found)).first()
    assert (s.macro_f0_5, s.num_entities, s.singleton_accuracy, s.pooled_precision) == (0.0, 0, 1.0, 0.0)


def test_recall(spark):
    truth = {"S1-1": ["S2-10", "S3-20"], "S1-2": ["S2-30"], "S1-3": []}
    cand = {"S1-1": ["S2-10", "S2-99"], "S1-2": ["S2-30"], "S1-3": []}
    ent, t, c = tables(spark, truth, cand)
    meta = spark.createDataFrame([("S1-1", "US", "x"), ("S1-2", "India", "y")], "s1_id string, country string, bucket string")
    out = {k: v.collect() for k, v in recall.evaluate_blocking(ent, t, c, meta, 100, 100).items()}
    e = out["edge_recall"][0]
    assert (e.global_edge_recall, e.s2_edge_recall, e.s3_edge_recall) == (pytest.approx(2 / 3), 1.0, 0.0)
    v = out["entity_coverage"][0]
    assert (v.at_least_one_rate, v.all_recovered_rate, v.singleton_entities) == (1.0, 0.5, 1)
    assert out["reduction_ratio"][0].reduction_ratio == pytest.approx(0.995)
    d = out["candidate_distribution"][0]
    assert (d.total_candidates, d.max_candidates, d.min_candidates, d.median_candidates) == (3, 2, 0, 1.0)
    assert {r.bucket for r in out["multiplicity_breakdown"]} == {"x", "y", "bucket_0"}
    assert {r.country: r.total_candidates for r in out["country_breakdown"]} == {"US": 2, "India": 1}


def test_candidate_issues(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "s1_id string, target_id string")
    cand = pairs([("S1-1", "S2-1"), ("S1-1", "S2-1"), ("S1-1", "S1-9"), ("S1-2", "X-1"), ("S1-3", "S3-1")])
    got = {tuple(r) for r in recall.candidate_issues(cand, pairs([("S1-1", ""), ("S1-2", "")]), pairs([("S1-3", "S3-2"), ("S1-3", "S3-1")])).collect()}
    assert got == {("repeated_id", "S1-1", "S2-1"), ("self_match", "S1-1", "S1-9"), ("wrong_prefix", "S1-2", "X-1"), ("unknown_s1", "S1-3", ""), ("match_not_candidate", "S1-3", "S3-2")}


def test_threshold_sweep(spark):
    rows = spark.createDataFrame([(0.95, True), (0.5, False), (0.505, True), (1.0, True)], "score double, is_match boolean")
    got = {round(r.threshold, 2): (r.tp, r.fp, round(r.f0_5, 6)) for r in scoring.threshold_sweep(rows, 4).collect()}
    assert got == {0.99: (1, 0, 0.625), 0.95: (2, 0, round(2.5 / 3, 6)), 0.5: (3, 1, 0.75)}


def test_macro_threshold_sweep_and_classifier(spark):
    import random

    from ledgerline.operators import classifier, scoring

    rng = random.Random(2)
    entities = [f"S1-{k}" for k in range(40)]
    truth = {(e, f"S2-{k}-{j}") for k, e in enumerate(entities) for j in range(k % 3)}
    pairs = [(e, f"S2-{k}-{j}", rng.random()) for k, e in enumerate(entities) for j in range(5) if rng.random() < 0.7]
    scored = spark.createDataFrame(pairs, "s1_id string, target_id string, score double")
    ents, true = spark.createDataFrame([(e,) for e in entities], "s1_id string"), spark.createDataFrame(sorted(truth), "s1_id string, target_id string")
    got = {round(r.threshold, 6): r.macro_f0_5 for r in scoring.macro_threshold_sweep(ents, true, scored, 10).collect()}

    def plain(threshold):
        total = 0
        for e in entities:
            t, p = {b for a, b in truth if a == e}, {b for a, b, s in pairs if a == e and min(int(s * 10), 9) >= threshold}
            total += 1.0 if not t and not p else 0.0 if not t or not p else 1.25 * len(t & p) / (0.25 * len(t) + len(p))
        return total / len(entities)

    assert got == {k / 10: pytest.approx(plain(k)) for k in range(11)}
    assert scoring.macro_threshold_sweep(ents.limit(0), true, scored.limit(0), 10).filter("macro_f0_5 <> 0").count() == 0

    features = spark.createDataFrame([(a, b, 0.5 + 0.5 * rng.random() if (a, b) in truth else 0.6 * rng.random(), 1 - s if (a, b) in truth else s) for a, b, s in pairs], "s1_id string, target_id string, jaccard double, edit_distance double")
    model = classifier.tuned(classifier.fit_pairs(features, true), features, ents, true, 20)
    f = scoring.score_summary(scoring.per_entity_scores(ents, true, model.matches(features))).first().macro_f0_5
    assert f == pytest.approx(max(r.macro_f0_5 for r in scoring.macro_threshold_sweep(ents, true, model.scored(features), 20).collect())) and f > 0.75
    with pytest.raises(ValueError):
        classifier.fit_pairs(features.limit(0), true)
