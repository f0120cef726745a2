from ledgerline.operators.audits import placeholder_field_summary
from ledgerline.streaming import counters


def test_streams_agree_with_batches(spark, tmp_path):
    rows = [("S2-1", "US", ""), ("S2-2", "India", "a NULL b"), ("S2-3", "US", "x")]
    for k, (i, c, a) in enumerate(rows):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{k}.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\n{i}\tn\t{a}\t{c}\n")
    stream = counters.record_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    counters.start(counters.running_placeholder_summary(stream, "train", "S2"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    batch = spark.createDataFrame([("train", "S2", a) for _, _, a in rows], "dataset string, source string, business_address string")
    assert counters.latest(spark, str(tmp_path / "out")).collect() == placeholder_field_summary(batch).collect()
    table = spark.createDataFrame([(i, c) for i, c, _ in rows], "entity_id string, country string")
    s1 = spark.createDataFrame([("S1-1", "US")], "entity_id string, country string")
    edges = counters.record_stream(spark, str(tmp_path / "in"), 1).selectExpr("'S1-1' s1_id", "entity_id target_id")
    counters.start(counters.running_country_counts(edges, s1, table), str(tmp_path / "o2"), str(tmp_path / "c2")).awaitTermination(120)
    assert [tuple(r) for r in counters.latest(spark, str(tmp_path / "o2")).collect()] == [("US", "S2", 3, 2)]
    # One whole state is left; one that a crash cut off isn't read, nor in the way.
    assert len(list((tmp_path / "out").iterdir())) == 1
    (tmp_path / "out/99999999999999999999").mkdir()
    assert counters.latest(spark, str(tmp_path / "out")).count() == 1
