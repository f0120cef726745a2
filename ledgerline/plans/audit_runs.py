"""Whole audits: files in, metric tables, reports and manifests out.

Heavy tables stay DataFrames; what is collected are summaries whose size
follows from groups, not from rows. Every figure of a report is computed.
"""

from __future__ import annotations

import tempfile
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import audits, edges, recall, scoring, split
from ledgerline.operators.validation import validate_results
from ledgerline.sources import sinks
from ledgerline.sources.tsv import Catalog, read_lists, telemetry


def _truth_tables(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities and edges (``ord`` is the order of arrival) of match lists."""
    rows = edges.explode_lists(lists).withColumn("ord", F.monotonically_increasing_id())
    return lists.select(F.col("source1_entity_id").alias("s1_id")), rows


def _stored(df: DataFrame, output_dir: str, name: str) -> DataFrame:
    """The table as Parquet under the output's ``tables`` folder: parsed and computed once, whatever is made of it, and there when executors are lost."""
    path = f"{output_dir}/tables/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored_inputs(catalog: Catalog, output_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Entities, true edges, and the ids and countries of S1 and of both target sources."""
    lists = _stored(catalog.truth(), output_dir, "truth")
    entities, truth = _truth_tables(lists)
    keys = lambda name: catalog.records(name).select("entity_id", "country")
    s1 = _stored(keys("train_S1"), output_dir, "s1")
    targets = _stored(keys("train_S2").unionByName(keys("train_S3")), output_dir, "targets")
    return entities, _stored(truth, output_dir, "edges"), s1, targets


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def _written(df: DataFrame, path: str, sep: str = ",") -> list[dict]:
    """A small result, computed once: its rows, which are also written as one file."""
    rows = df.collect()
    sinks.write_rows_csv(df.columns, rows, path, sep)
    return [r.asDict(recursive=True) for r in rows]


def _report(path: str, title: str, sections: dict[str, list[dict] | dict | str]) -> None:
    parts = [f"# {title}"]
    for head, body in sections.items():
        if isinstance(body, dict):
            body = [{"measure": k, "value": v} for k, v in body.items()]
        table = body if isinstance(body, str) else sinks.markdown_table(list(body[0]) if body else [], [tuple(r.values()) for r in body])
        parts.append(f"## {head}\n\n{table}")
    sinks.write_text("\n\n".join(parts) + "\n", path)


def preprocessing_audit(catalog: Catalog, output_dir: str, max_examples: int = 50) -> dict[str, object]:
    """Missing and placeholder addresses of every record file, and exact agreement of S1 and S3 over true edges. Raises ValueError where a file or header is wrong, or edges don't reconcile."""
    checks = {r["check"]: r["passed"] for r in catalog.checks().collect()}
    if not all(checks.values()):
        raise ValueError(f"failed checks: {[k for k, ok in checks.items() if not ok]}")
    records = None
    for name in [n for n in catalog.paths if not n.endswith("GT")]:
        dataset, source = name.split("_", 1)
        part = catalog.records(name).withColumn("dataset", F.lit(dataset)).withColumn("source", F.lit(source)).withColumn("file_name", F.lit(catalog.paths[name].rsplit("/", 1)[-1]))
        records = part if records is None else records.unionByName(part)
    fields = audits.placeholder_field_summary(records, ("dataset", "source", "file_name")).orderBy("dataset", "source")
    tokens = audits.placeholder_token_summary(records).orderBy("dataset", "source", "token")
    _, truth = _truth_tables(catalog.truth())
    truth = _stored(truth, output_dir, "edges")
    agreed = _stored(audits.agreement_edges(truth, catalog.records("train_S1"), catalog.records("train_S3")), output_dir, "agreement")
    audits.reconcile(agreed, truth, strict=True)
    tables = {
        "placeholder_summary.csv": fields,
        "placeholder_token_summary.csv": tokens,
        "s3_exact_summary.csv": audits.exact_summary(agreed),
        "s3_exact_by_country.csv": audits.exact_by_country(agreed).orderBy("country"),
        "s3_exact_by_multiplicity.csv": audits.exact_by_multiplicity(agreed).orderBy("multiplicity"),
    }
    out: dict[str, object] = {"checks": checks}
    for name, df in tables.items():
        out[name.removesuffix(".csv")] = _written(df, f"{output_dir}/{name}")
    out["examples_returned"] = len(_written(audits.exact_examples(agreed, max_examples), f"{output_dir}/s3_both_exact_examples.tsv", "\t"))
    sinks.write_json(out, f"{output_dir}/preprocessing_report.json")
    _report(f"{output_dir}/preprocessing_report.md", "Preprocessing audit", {k.replace("_", " ").capitalize(): v for k, v in out.items() if isinstance(v, (list, dict))})
    return out


def timed(stage: str, rows: int, n_edges: int, action: Callable[[], object], share: float = 1.0) -> dict[str, object]:
    """A stage's record: seconds, rows and edges a second, and seconds for all at the sampled share."""
    began = time.perf_counter()
    action()
    s = time.perf_counter() - began
    return {"stage": stage, "rows_processed": rows, "edges_processed": n_edges, "wall_clock_sec": s, "throughput_rows_sec": rows / s, "throughput_edges_sec": n_edges / s, "linear_extrapolation_100pct_sec": s / share}


def _write_scores(scores: DataFrame) -> None:
    """All rows of the scores as one file, which is removed."""
    with tempfile.TemporaryDirectory() as folder:
        sinks.write_report_csv(scores, f"{folder}/scores.csv")


def benchmark(entities: DataFrame, truth: DataFrame, seed: int = 42, fraction: float = 0.01, catalog: Catalog | None = None, folder: str | None = None) -> list[dict[str, object]]:
    """Times the split, explosion, scoring, recall and the writing of scores over a stratified sample. Its predictions are all but one true target, and one false one.

    With a catalog, the reading of as many records of S1 is timed too, and with a
    ``folder``, which executors can read, the parsing of the sample's truth and
    the validator from files there.
    """
    sample = split.stratified_sample(entities, fraction, seed).cache()
    own = truth.join(sample.select("s1_id"), "s1_id", "left_semi").select("s1_id", "target_id").cache()
    n, m = sample.count(), own.count()
    last = own.groupBy("s1_id").agg(F.max("target_id").alias("last"), F.count(F.lit(1)).alias("c"))
    kept = own.join(last, "s1_id").filter((F.col("target_id") != F.col("last")) | (F.col("c") == 1)).select("s1_id", "target_id")
    predictions = kept.unionByName(sample.select("s1_id", F.lit("S2-999999999").alias("target_id"))).cache()
    predictions.count()
    run = lambda df: (lambda: df.write.format("noop").mode("overwrite").save())
    scores = scoring.per_entity_scores(sample.select("s1_id"), own, predictions)
    stages = {}
    if catalog is not None:
        # As many records as the sample has, like the stages after it.
        stages["tsv_reading"] = lambda: run(catalog.records("train_S1", n))()
    if folder is not None:
        sinks.write_report_csv(edges.implode_lists(sample, own), f"{folder}/sample_truth.tsv", sep="\t")
        sinks.write_report_csv(sample.select(F.col("s1_id").alias("entity_id"), F.lit("").alias("business_name")), f"{folder}/sample_source1.tsv", sep="\t")
        stages["gt_parsing"] = lambda: run(edges.explode_lists(read_lists(entities.sparkSession, f"{folder}/sample_truth.tsv")))()
        stages["validator"] = lambda: validate_results(entities.sparkSession, f"{folder}/sample_truth.tsv", f"{folder}/sample_source1.tsv")
    stages |= {
        "stratified_split": run(split.stratified_split(sample, seed=seed)),
        "gt_expansion": run(edges.explode_lists(edges.implode_lists(sample, own))),
        "macro_f05_scoring": run(scoring.score_summary(scores)),
        "blocking_recall": run(recall.edge_recall(own, predictions)),
        "serialisation": lambda: _write_scores(scores),
    }
    out = [timed(k, n, 0 if k == "tsv_reading" else m, f, fraction) for k, f in stages.items()]
    for df in (predictions, own, sample):
        df.unpersist()
    return out


def validation_foundation(catalog: Catalog, output_dir: str, seed: int = 42, val_fraction: float = 0.1) -> dict[str, object]:
    """Integrity of the truth, the stratified split with its id lists, leakage between folds, and a timing of the stages. Raises ValueError where integrity fails."""
    began = time.perf_counter()
    spark = catalog.spark
    entities, truth, s1, targets = _stored_inputs(catalog, output_dir)
    ids = lambda df, source: df.filter(F.col("entity_id").startswith(f"{source}-")).select(F.col("entity_id").alias("id"))
    sound = edges.integrity(entities, truth, s1.select(F.col("entity_id").alias("id")), ids(targets, "S2"), ids(targets, "S3")).first().asDict()
    if not sound["integrity_passed"]:
        raise ValueError(f"integrity failed: {sound}")
    countries = s1.select(F.col("entity_id").alias("s1_id"), "country")
    bucketed = _stored(edges.multiplicity(entities.join(countries, "s1_id"), truth), output_dir, "entities")
    folds = _stored(split.stratified_split(bucketed, val_fraction, seed), output_dir, "folds")
    strata = _written(split.split_summary(folds).orderBy("country", "multiplicity_bucket"), f"{output_dir}/split_summary.csv")
    for fold in ("train", "val"):
        sinks.write_id_list(folds.filter(F.col("fold") == fold), f"{output_dir}/{fold}_s1_ids")
    parents = _stored(split.target_parents(folds, truth), output_dir, "target_parents")
    overlap = _written(split.target_overlap(folds, truth, parents), f"{output_dir}/target_overlap_report.csv")
    total, val = sum(r["total_s1"] for r in strata), sum(r["val_s1"] for r in strata)
    counts = lambda *by: {"/".join(map(str, r[:-1])): r[-1] for r in bucketed.groupBy(*by).count().orderBy(*by).collect()}
    manifest = {
        "seed": seed, "val_fraction": val_fraction, "total_s1_entities": total, "train_s1_entities": total - val, "val_s1_entities": val, "actual_val_percentage": 100.0 * val / total if total else 0.0,
        "stratification_fields": ["country", "multiplicity_bucket"], "counts_by_country": counts("country"), "counts_by_multiplicity_bucket": counts("bucket"), "counts_by_stratum": counts("country", "bucket"),
    }
    leak = split.leakage_summary(folds, truth, parents).first().asDict()
    stages = benchmark(bucketed, truth, seed, catalog=catalog, folder=f"{output_dir}/benchmark")
    sinks.write_dicts_csv(stages, f"{output_dir}/benchmark.csv")
    out = {"telemetry": telemetry(spark), "integrity": sound, "split": manifest, "strata": strata, "leakage": leak, "overlap": overlap, "benchmark": stages, "duration_sec": time.perf_counter() - began}
    sinks.write_json(manifest, f"{output_dir}/split_manifest.json")
    sinks.write_json(out, f"{output_dir}/foundation_manifest.json")
    _report(f"{output_dir}/foundation_report.md", "Validation foundation", {k.capitalize(): out[k] for k in ("telemetry", "integrity", "strata", "leakage", "overlap", "benchmark")})
    return out


@dataclass(frozen=True)
class StructureReport:
    """What a structural audit found."""

    missing: dict
    reconciliation: dict
    cross_country: list[dict]
    country_verdict: dict
    exclusivity: list[dict]
    assignment_verdict: dict
    status: str
    duration_sec: float
    artifacts: dict

    def to_dict(self) -> dict:
        return asdict(self)


def structure_audit(catalog: Catalog, output_dir: str, expected: dict[str, int], max_examples: int = 100) -> StructureReport:
    """Countries and exclusivity of all true edges, their reconciliation with the ``expected`` counts, verdicts, and a manifest of the written files."""
    began = time.perf_counter()
    entities, truth, s1, targets = _stored_inputs(catalog, output_dir)
    resolved = _stored(audits.country_edges(truth, s1, targets), output_dir, "resolved")
    order = F.when(F.col("slice_type") == "OVERALL", 0).when(F.col("slice_type") == "BY_TARGET_SOURCE", 1).when(F.col("slice_type") == "BY_S1_COUNTRY", 2).otherwise(3)
    stats = audits.exclusivity_stats(truth).orderBy(F.when(F.col("target_source") == "OVERALL", 1).otherwise(0), "target_source")
    stats = _stored(stats.coalesce(1), output_dir, "exclusivity")
    tables = {
        "cross_country_summary.csv": audits.cross_country_slices(resolved).orderBy(order, "s1_country", "target_source"),
        "cross_country_missing.csv": audits.country_missing(entities, truth, s1, targets),
        "cross_country_examples.tsv": audits.cross_country_examples(resolved, max_examples),
        "target_exclusivity_summary.csv": stats,
        "target_indegree_distribution.csv": audits.indegree_distribution(truth).orderBy(F.when(F.col("target_source") == "OVERALL", 1).otherwise(0), "target_source", "in_degree"),
        "target_overlap_examples.tsv": audits.multi_parent_examples(truth, s1, max_examples).orderBy("target_source", "target_entity_id"),
    }
    rows = {name: _written(df, f"{output_dir}/{name}", "\t" if name.endswith(".tsv") else ",") for name, df in tables.items()}
    row = audits.reconciliation(entities, truth, s1, targets, expected).first().asDict()
    out = {
        "missing": rows["cross_country_missing.csv"][0], "reconciliation": row, "cross_country": rows["cross_country_summary.csv"], "country_verdict": audits.country_verdict(resolved).first().asDict(),
        "exclusivity": rows["target_exclusivity_summary.csv"], "assignment_verdict": audits.assignment_verdict(stats).first().asDict(), "status": row["status"],
    }
    sinks.write_json(out, f"{output_dir}/structure_report.json")
    _report(f"{output_dir}/structure_report.md", "Structural audit", {k.replace("_", " ").capitalize(): v for k, v in out.items()})
    artifacts = sinks.manifest([f"{output_dir}/{n}" for n in [*tables, "structure_report.json", "structure_report.md"]])
    report = StructureReport(**out, duration_sec=time.perf_counter() - began, artifacts=artifacts)
    sinks.write_json({"telemetry": telemetry(catalog.spark), **report.to_dict()}, f"{output_dir}/structure_manifest.json")
    return report


def data_root(start: str | Path = ".", name: str = "dataset") -> str:
    """The nearest data folder: ``start`` itself where it has ``train``, else a folder ``name`` in it, in a folder of it, or in a folder above. Raises ValueError where there is none."""
    start = Path(start).resolve()
    for base in (start, *start.parents):
        for found in (base, base / name, *sorted(base.glob(f"*/{name}"))):
            if (found / "train").is_dir():
                return str(found)
    raise ValueError(f"no data folder at or above {start}")


def standard_catalog(spark: SparkSession, root: str) -> Catalog:
    """The usual files under a folder: ``train/`` and ``test/`` with three sources each, and the training truth."""
    paths = {f"{s}_S{k}": f"{root}/{s}/{s}_source{k}.tsv" for s in ("train", "test") for k in (1, 2, 3)}
    return Catalog(spark, paths | {"train_GT": f"{root}/train/train_ground_truth.tsv"})
