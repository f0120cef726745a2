"""The benchmark's stages do their work."""

from ledgerline.plans import audit_runs
from ledgerline.sources import sinks


def test_all_stages_are_timed_and_scores_are_written(spark, tmp_path, monkeypatch):
    (tmp_path / "s1.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"S1-{k}\ta\tb\tUS\n" for k in range(6)))
    (tmp_path / "gt.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{k}\tS2-{k},S3-{k}\n" for k in range(5)) + "S1-5\t\n")
    catalog = audit_runs.Catalog(spark, {"train_S1": str(tmp_path / "s1.tsv"), "train_GT": str(tmp_path / "gt.tsv")})
    entities, truth = audit_runs._truth_tables(catalog.truth())
    countries = catalog.records("train_S1").selectExpr("entity_id s1_id", "country")
    bucketed = audit_runs.edges.multiplicity(entities.join(countries, "s1_id"), truth)
    written, write = [], sinks.write_report_csv

    def kept(df, path, **more):
        write(df, path, **more)
        with open(path) as f:
            written.append(len(f.readlines()))

    monkeypatch.setattr(sinks, "write_report_csv", kept)
    stages = {r["stage"]: r for r in audit_runs.benchmark(bucketed, truth, fraction=1.0, catalog=catalog, folder=str(tmp_path / "bench"))}
    assert list(stages) == ["tsv_reading", "gt_parsing", "validator", "stratified_split", "gt_expansion", "macro_f05_scoring", "blocking_recall", "serialisation"]
    assert [stages[k]["rows_processed"] for k in ("tsv_reading", "gt_parsing", "validator")] == [6, 6, 6] and stages["gt_parsing"]["edges_processed"] == 10
    assert written == [7, 7, stages["serialisation"]["rows_processed"] + 1]
