import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import audits, edges, matching, split
from ledgerline.plans import audit_runs
from ledgerline.sources import sinks, tsv


def edge_table(spark, rows):
    return spark.createDataFrame([(s, t, k) for k, (s, t) in enumerate(rows)], "s1_id string, target_id string, ord long")


def records(spark, rows):
    return spark.createDataFrame([(i, "n", "a", c) for i, c in rows], "entity_id string, business_name string, business_address string, country string")


def test_explode_and_implode(spark):
    lists = spark.createDataFrame([("S1-1", "S2-10, S3-20,,"), (" S1-2 ", ""), ("S1-3", None)], "source1_entity_id string, matched_entity_ids string")
    rows = [tuple(r) for r in edges.explode_lists(lists).orderBy("s1_id", "pos").collect()]
    assert rows == [("S1-1", "S2-10", "S2", 0), ("S1-1", "S3-20", "S3", 1)]
    back = edges.implode_lists(lists.select(F.trim("source1_entity_id").alias("s1_id")), edges.explode_lists(lists))
    assert {tuple(r) for r in back.collect()} == {("S1-1", "S2-10,S3-20"), ("S1-2", ""), ("S1-3", "")}


def test_integrity(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    ent = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    good = edges.integrity(ent, edge_table(spark, [("S1-1", "S2-10"), ("S1-1", "S3-20")]), ids("S1-1", "S1-2"), ids("S2-10"), ids("S3-20")).first()
    assert good.integrity_passed and good.total_gt_edges == 2
    bad = edges.integrity(ent, edge_table(spark, [("S1-1", "X2-10"), ("S1-2", "S2-11")]), ids("S1-1"), ids("S2-10"), ids("S3-20")).first()
    assert not bad.integrity_passed and (bad.invalid_prefix_count, bad.missing_s1_in_source_count, bad.missing_s2_in_source_count) == (1, 1, 1)


def test_split(spark):
    rows = [(f"S1-{i}", "US" if i < 60 else "India", [0, 1, 2, 2, 5][i % 5]) for i in range(100)]
    df = spark.createDataFrame(rows, "s1_id string, country string, m int").withColumn("bucket", F.expr("case when m = 0 then 'bucket_0' when m = 1 then 'bucket_1' when m <= 4 then 'bucket_2_4' else 'bucket_5_plus' end"))
    fold = lambda d: {r.s1_id: r.fold for r in split.stratified_split(d).collect()}
    one = fold(df)
    assert len(one) == 100 and 8 <= sum(f == "val" for f in one.values()) <= 12
    assert one == fold(df.repartition(7, "m").orderBy(F.desc("s1_id")))


def test_leakage(spark):
    folds = spark.createDataFrame([("S1-1", "train"), ("S1-2", "train"), ("S1-3", "val")], "s1_id string, fold string")
    e = edge_table(spark, [("S1-1", "S2-A"), ("S1-1", "S3-A"), ("S1-2", "S2-B"), ("S1-3", "S2-A"), ("S1-3", "S3-C")])
    r = split.leakage_summary(folds, e).first()
    assert (r.shared_s2_target_count, r.shared_s3_target_count, r.s2_targets_under_multiple_s1) == (1, 0, 1) and r.warning
    o = {x.category: tuple(x)[1:] for x in split.target_overlap(folds, e).collect()}
    assert o["S2 Targets in Train"] == (2, 0, 1) and o["S3 Targets in Val"] == (1, 0, 0)


def test_countries(spark):
    s1 = records(spark, [("S1-1", "US"), ("S1-2", "US"), ("S1-3", "India")])
    targets = records(spark, [("S2-101", "India"), ("S2-102", "US"), ("S3-103", "India")])
    e = edge_table(spark, [("S1-1", "S2-101"), ("S1-2", "S2-102"), ("S1-3", "S3-103"), ("S1-3", "S3-404")])
    resolved = audits.country_edges(e, s1, targets)
    rows = {(r.slice_type, r.s1_country, r.target_source): r for r in audits.cross_country_slices(resolved).collect()}
    top = rows["OVERALL", "ALL", "ALL"]
    assert (top.total_edges, top.same_country_edges, top.cross_country_edges, top.cross_country_pct) == (3, 2, 1, 33.333333)
    assert rows["BY_COUNTRY_X_SOURCE", "India", "S2"].total_edges == 0
    assert [r.target_entity_id for r in audits.cross_country_examples(resolved).collect()] == ["S2-101"]
    assert audits.country_verdict(resolved).first().architectural_status == audits.RISK
    assert audits.country_verdict(resolved.filter("same")).first().architectural_status == audits.SAFE
    assert audits.country_verdict(resolved.limit(0)).first().architectural_status == audits.UNRESOLVED


def test_empty_padded_and_missing_countries(spark):
    s1 = records(spark, [("S1-1", " US"), ("S1-2", ""), ("S1-3", None)])
    targets = records(spark, [("S2-1", "US  "), ("S2-2", "  "), ("S2-3", "Unknown"), ("S3-4", "US")])
    e = edge_table(spark, [("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-3", "S2-3"), ("S1-2", "S3-4"), ("S1-9", "S3-4"), ("S1-9", "S2-1"), ("S1-1", "S2-77"), ("S1-1", "X-1")])
    resolved = audits.country_edges(e, s1, targets)
    # A target's last parent that has a record counts; blanks at the ends don't.
    assert {(r.s1_id, r.target_id, r.s1_country, r.target_country, r.same) for r in resolved.collect()} == {
        ("S1-1", "S2-1", "US", "US", True), ("S1-2", "S2-2", "", "", True), ("S1-3", "S2-3", "Unknown", "Unknown", True), ("S1-2", "S3-4", "", "US", False),
    }
    entities = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",), ("S1-9",), ("S1-8",)], "s1_id string")
    assert audits.country_missing(entities, e, s1, targets).first().asDict() == {"missing_s1_rows": 2, "total_s2_edges": 4, "total_s3_edges": 1, "missing_s2_targets": 1, "missing_s3_targets": 0, "s1_entities_resolved": 3}


def test_country_fields_of_files(spark, tmp_path):
    """Empty, cut off before the country, there, padded, and with a field too many."""
    path = tmp_path / "s1.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tn\ta\t\nS1-2\tn\ta\nS1-3\tn\ta\tIN\n\nS1-4\tn\t\"a \"\"q\"\"\"\t IN \nS1-5\tn\ta\t\tmore\nS1-6\n")
    want = {"S1-1": "", "S1-2": "Unknown", "S1-3": "IN", "S1-4": " IN ", "S1-5": "", "S1-6": "Unknown"}
    for multi_line in (False, True):
        assert {r.s1_id: r.country for r in tsv.read_countries(spark, str(path), multi_line).collect()} == want
        rows = {r.entity_id: r for r in tsv.read_records(spark, str(path), multi_line).collect()}
        assert {i: r.country for i, r in rows.items()} == want and rows["S1-4"].business_address == 'a "q"' and rows["S1-6"].business_address == ""
    assert tsv.read_records(spark, str(path), limit=2).count() == 2
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"two\nlines"\ta\tUS\n')
    assert [tuple(r) for r in tsv.read_records(spark, str(path), multi_line=True).collect()] == [("S1-1", "two\nlines", "a", "US")]


def test_naive_edge_count(spark):
    df = spark.createDataFrame([("a,b,,",), ("",), (None,), ("  ",), ("x",)], "matched_entity_ids string")
    assert edges.naive_edge_count(df).first().edges == 5


def test_blocking_lanes_and_crowded_blocks(spark):
    schema = "entity_id string, business_name string, business_address string, country string"
    left = spark.createDataFrame([("S1-1", "Green Garden Cafe", "12 Main St 560001", "IN"), ("S1-2", "Green Garden Cafe", "9 Side Rd 560002 NULL", "IN"), ("S1-3", "", "", "IN")], schema)
    right = spark.createDataFrame([("S2-1", "Greengarden Kafe", "Main St, 560001", "IN"), ("S2-2", "Other", "560002", "IN"), ("S2-3", "Green Garden Cafe", "null", "IN"), ("S2-4", "Green Garden Cafe", "Side", "IN"), ("S2-5", "Green Garden Cafe", "Main", "FR")], schema)
    found = lambda **more: {tuple(r) for r in matching.blocking_pairs(left, right, **more).collect()}
    assert found(lanes=("postcode",)) == {("S1-1", "S2-1", "postcode"), ("S1-2", "S2-2", "postcode")}
    assert ("S1-1", "S2-1", "grams") in found(lanes=("grams", "name")) and ("S1-1", "S2-3", "grams,name") in found(lanes=("grams", "name"))
    assert found(lanes=("name",)) == {(a, b, "name") for a in ("S1-1", "S1-2") for b in ("S2-3", "S2-4")}
    assert [tuple(r) for r in matching.block_sizes(left, right, ("name",)).collect()] == [("IN", "name", "green garden cafe", 2, 2, 4)]
    assert found(lanes=("name",), most_pairs=4) == found(lanes=("name",))
    # Beyond: a word of the addresses must be shared, and NULL is none.
    assert found(lanes=("name",), most_pairs=3) == {("S1-2", "S2-4", "name")}


def test_exclusivity(spark):
    clear = edge_table(spark, [("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S3-1"), ("S1-2", "S3-2"), ("S1-2", "S3-3")])
    stats = audits.exclusivity_stats(clear)
    assert {tuple(r) for r in stats.collect()} == {("S2", 2, 2, 2, 0, 1, 0, 100.0), ("S3", 3, 3, 3, 0, 1, 0, 100.0), ("OVERALL", 5, 5, 5, 0, 1, 0, 100.0)}
    assert audits.assignment_verdict(stats).first().architectural_status == audits.PLAUSIBLE
    shared = edge_table(spark, [("S1-1", "S2-101"), ("S1-2", "S2-101"), ("S1-1", "S2-102"), ("S1-1", "S3-1"), ("S1-9", "S3-2")])
    row = {r.target_source: r for r in audits.exclusivity_stats(shared).collect()}["OVERALL"]
    assert (row.total_edges, row.distinct_targets, row.multi_parent_targets, row.duplicate_references) == (5, 4, 1, 1)
    assert {(r.in_degree, r.target_count) for r in audits.indegree_distribution(shared).collect() if r.target_source == "S2"} == {(1, 1), (2, 1)}
    ex = audits.multi_parent_examples(shared, records(spark, [("S1-1", "US")])).first()
    assert (ex.parent_s1_ids, ex.parent_countries, ex.num_parents) == ("S1-1,S1-2", "US,Unknown", 2)
    assert audits.assignment_verdict(audits.exclusivity_stats(shared)).first().architectural_status == audits.DO_NOT_ENABLE
    empty = {tuple(r)[:3] for r in audits.indegree_distribution(shared.limit(0)).collect()}
    assert empty == {("S2", 1, 0), ("S3", 1, 0), ("OVERALL", 1, 0)}


def test_assignment(spark):
    df = spark.createDataFrame([("S1-1", "t", 0.5), ("S1-2", "t", 0.9), ("S1-3", "t", 0.9), ("S1-3", "u", 0.1)], "s1_id string, target_id string, score double")
    assert {tuple(r) for r in matching.exclusive_assignment(df).collect()} == {("S1-2", "t", 0.9), ("S1-3", "u", 0.1)}


@pytest.fixture
def folder(tmp_path):
    def write(name, rows):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("\n".join("\t".join(r) for r in rows) + "\n", encoding="utf-8")

    for s in ("train", "test"):
        write(f"{s}/{s}_source1.tsv", [tsv.RECORD_HEADER, ("S1-1", "Joe's Cafe", "1 St", "US"), ("S1-2", '"A ""B"" C"', "NULL", "India")])
        write(f"{s}/{s}_source2.tsv", [tsv.RECORD_HEADER, ("S2-1", "JOE'S CAFE", "", "US"), ("S2-2", "other", "x, n/a", "India")])
        write(f"{s}/{s}_source3.tsv", [tsv.RECORD_HEADER, ("S3-1", "joe s cafe", "1 st.", "US"), ("S3-2", "A B C", "y", "India")])
    write("train/train_ground_truth.tsv", [tsv.TRUTH_HEADER, ("S1-1", "S2-1,S3-1"), ("S1-2", "S2-2, S3-2")])
    return tmp_path


def test_sources(spark, folder):
    c = audit_runs.standard_catalog(spark, str(folder))
    assert all(r.passed for r in c.checks().collect())
    assert {r.business_name for r in c.records("train_S1").collect()} == {"Joe's Cafe", 'A "B" C'}
    tsv.ingest_records(c.records("train_S1"), str(folder / "parquet"))
    assert spark.read.parquet(str(folder / "parquet")).filter("country_part = 'US'").select("entity_id").collect()[0][0] == "S1-1"
    assert {r.id for r in tsv.read_ids(spark, c.paths["test_S2"], c.paths["test_S3"]).collect()} == {"S2-1", "S2-2", "S3-1", "S3-2"}
    assert [tuple(r) for r in tsv.numbered_lines(spark, c.paths["train_GT"]).orderBy("line").collect()][1] == (2, "S1-1\tS2-1,S3-1")
    (folder / "dup.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-1\tS2-2\nS1-3\t\n")
    assert {tuple(r) for r in tsv.read_lists(spark, str(folder / "dup.tsv")).collect()} == {("S1-1", "S2-2"), ("S1-3", "")}
    (folder / "bad.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\n")
    with pytest.raises(ValueError):
        tsv.read_lists(spark, str(folder / "bad.tsv"))
    with pytest.raises(ValueError):
        tsv.read_lists(spark, c.paths["train_S1"])


def test_audits_end_to_end(spark, folder):
    c, out = audit_runs.standard_catalog(spark, str(folder)), str(folder / "out")
    pre = audit_runs.preprocessing_audit(c, out)
    assert {r["metric"]: r["count"] for r in pre["s3_exact_summary"]}["both_exact"] == 1 and pre["examples_returned"] == 1
    found = audit_runs.validation_foundation(c, out)
    assert found["split"]["total_s1_entities"] == 2 and found["integrity"]["integrity_passed"]
    expected = {"total_gt_s1": 2, "total_s2_edges": 2, "total_s3_edges": 2, "total_gt_edges": 4}
    report = audit_runs.structure_audit(c, out, expected)
    assert report.status == "PASS WITH FINDINGS" and report.country_verdict["architectural_status"] == audits.SAFE and report.assignment_verdict["architectural_status"] == audits.PLAUSIBLE
    assert "OVERALL,ALL,ALL,4,4,0,100.0,0.0" in (folder / "out/cross_country_summary.csv").read_text().splitlines()
    assert report.missing == {"missing_s1_rows": 0, "total_s2_edges": 2, "total_s3_edges": 2, "missing_s2_targets": 0, "missing_s3_targets": 0, "s1_entities_resolved": 2}
    assert len(report.artifacts) == 8 and len(json.loads((folder / "out/structure_manifest.json").read_text())["artifacts"]) == 8
    assert audit_runs.data_root(folder / "train") == str(folder) and audit_runs.data_root(folder, "dataset") == str(folder)
    (folder / "near/dataset/train").mkdir(parents=True)
    assert audit_runs.data_root(folder / "near") == str(folder / "near/dataset")
    assert audit_runs.structure_audit(c, out, expected | {"total_gt_s1": 3}).status == "FAIL"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "s1_id string, n int")
    sinks.write_id_list(df, str(tmp_path / "ids"))
    assert [r.value for r in spark.read.text(str(tmp_path / "ids")).orderBy("value").collect()] == ["a", "b"]
    sinks.write_dicts_csv([], str(tmp_path / "e.csv"))
    assert (tmp_path / "e.csv").read_text() == ""
    sinks.write_report_csv(df.limit(0), str(tmp_path / "h.csv"))
    assert (tmp_path / "h.csv").read_text() == "s1_id,n\n"
    sinks.write_dicts_csv([{"a": 1, "b": "x"}], f"file://{tmp_path}/far/d.csv")
    assert sinks.read_bytes(f"file://{tmp_path}/far/d.csv") == b"a,b\n1,x\n" and sinks.manifest([f"file://{tmp_path}/far/d.csv"])["d.csv"]["line_count"] == 2
    assert sinks.markdown_table(["a"], []) == "*Empty table*"
    assert sinks.frame_markdown(df.orderBy("n")).splitlines()[2] == "| b | 1 |"
    facts = sinks.file_facts(spark, str(tmp_path / "h.csv")).first()
    assert (facts.size_bytes, facts.line_count, facts.valid_utf8) == (8, 1, True)
    assert facts.sha256 == sinks.manifest([str(tmp_path / "h.csv")])["h.csv"]["sha256"]
