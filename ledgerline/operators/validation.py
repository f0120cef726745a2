"""Validation of result files: every broken rule as a row, and the report that a person reads."""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators.recall import not_in

#: Examples that a message shows, and malformed rows that have a message each.
EXAMPLES = 5
MALFORMED_SHOWN = 1000
#: Rules in report order.
RULES = ("malformed_row", "duplicate_row", "repeated_id", "self_match", "wrong_prefix", "unknown_id", "missing_s1", "unexpected_s1")
#: Messages.
MESSAGES = {
    "duplicate_row": "duplicate source1_entity_id row(s): {ex}. Each S1 entity may appear on only one row.",
    "repeated_id": "repeated ID inside a {col} list for: {ex}. No duplicate IDs are allowed within a list.",
    "self_match": "{col} contains Source-1 IDs (self-matches): {ex}. Only S2-/S3- IDs are allowed.",
    "wrong_prefix": "{col} contains IDs without an S2-/S3- prefix: {ex}.",
    "unknown_id": "{col} references IDs not in the test Source-2/3 files: {ex}.",
    "missing_s1": "required S1 entity(ies) missing: {ex}. Every entity in test_source1.tsv needs a row (empty = no match).",
    "unexpected_s1": "row(s) using an S1 ID that is not in the test set: {ex}.",
}


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``line, s1_id, ids`` of ``line, value`` (header left out): split at the first tab; ids are not stripped; null where there is no tab."""
    parts = F.split("value", "\t", 2)
    rest = F.try_element_at(parts, F.lit(2))
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return lines.select("line", parts[0].alias("s1_id"), F.when(F.size(parts) == 2, ids).alias("ids"), "value")


def findings(rows: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """``rule, offender`` of ``parsed_lines``, each pair once, whatever their number. ``required`` has ``s1_id``, ``valid_ids`` has ``id``.

    Entities and ids are grouped once each; rules are columns of the groups.
    """
    good = rows.filter(F.col("ids").isNotNull())
    one = lambda df, rule, offender: df.select(F.lit(rule).alias("rule"), F.col(offender).cast("string").alias("offender"))
    malformed = rows.filter(F.col("ids").isNull() & (F.trim("s1_id") != ""))
    seen = good.select("s1_id", F.lit(1).alias("n"), (F.size("ids") != F.size(F.array_distinct("ids"))).cast("int").alias("again"), F.lit(0).alias("asked"))
    asked = required.select("s1_id", F.lit(0).alias("n"), F.lit(0).alias("again"), F.lit(1).alias("asked"))
    entities = seen.unionByName(asked).groupBy("s1_id").agg(F.sum("n").alias("n"), F.max("again").alias("again"), F.max("asked").alias("asked"))
    broken = F.array_compact(
        F.array(
            F.when(F.col("n") > 1, "duplicate_row"), F.when(F.col("again") == 1, "repeated_id"), F.when(F.col("n") == 0, "missing_s1"), F.when(F.col("asked") == 0, "unexpected_s1")
        )
    )
    per_entity = entities.select(F.explode(broken).alias("rule"), F.col("s1_id").alias("offender"))
    ids = good.select(F.explode("ids").alias("id")).distinct()
    own, known_prefix = F.col("id").startswith("S1-"), F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    out = one(malformed, "malformed_row", "line").unionByName(per_entity).unionByName(one(ids.filter(own), "self_match", "id")).unionByName(one(ids.filter(~own & ~known_prefix), "wrong_prefix", "id"))
    if valid_ids is not None:
        out = out.unionByName(one(ids.filter(known_prefix).join(valid_ids.select("id"), "id", "left_anti"), "unknown_id", "id"))
    return out


def row_statistics(rows: DataFrame) -> DataFrame:
    """One row: rows, empty and non-empty ones."""
    good = rows.filter(F.col("ids").isNotNull())
    empty = F.count_if(F.size("ids") == 0)
    return good.agg(F.count(F.lit(1)).alias("n_rows"), empty.alias("n_empty"), (F.count(F.lit(1)) - empty).alias("n_non_empty"))


@dataclass
class Verdict:
    status: str
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    statistics: dict[str, dict] = field(default_factory=dict)

    @property
    def exit_code(self) -> int:
        return 0 if self.status == "PASS" else 1


def _messages(found: DataFrame, name: str, column: str) -> list[str]:
    """One message a rule, with how many offend and the first of them; malformed rows have one each, up to MALFORMED_SHOWN, and one for the number of the others."""
    first = found.withColumn("r", F.row_number().over(Window.partitionBy("rule").orderBy(F.length("offender").isNull(), "offender"))).filter(F.col("r") <= EXAMPLES)
    shown = first.groupBy("rule").agg(F.array_sort(F.collect_list("offender")).alias("ex")).join(found.groupBy("rule").count(), "rule").collect()
    by_rule = {r["rule"]: r for r in shown}
    out = []
    if "malformed_row" in by_rule:
        rows = found.filter("rule = 'malformed_row'").orderBy(F.col("offender").cast("long")).limit(MALFORMED_SHOWN).collect()
        out += [f"{name}: malformed row (no tab) at line {r['offender']}" for r in rows]
        if (more := by_rule["malformed_row"]["count"] - len(rows)) > 0:
            out.append(f"{name}: {more} more malformed row(s) (no tab)")
    for rule in RULES[1:]:
        if rule in by_rule:
            r = by_rule[rule]
            ex = ", ".join(r["ex"]) if r["count"] <= EXAMPLES else f"{r['count']} total, e.g. {', '.join(r['ex'])}"
            out.append(f"{name}: " + MESSAGES[rule].format(ex=ex, col=column))
    return out


def _checked_file(spark: SparkSession, path: str, header: tuple[str, ...], required: DataFrame, valid_ids: DataFrame | None, verdict: Verdict) -> DataFrame | None:
    from ledgerline.sources.tsv import Catalog, numbered_lines

    name = path.rsplit("/", 1)[-1]
    if not Catalog(spark, {"f": path}).exists("f"):
        verdict.errors.append(f"File not found: {path}")
        return None
    # Line by line, so a large file is read in splits.
    if not spark.read.text(path).filter(~F.is_valid_utf8("value")).isEmpty():
        verdict.errors.append(f"{name}: not valid UTF-8.")
        return None
    head = spark.read.text(path).limit(1).collect()
    if not head:
        verdict.errors.append(f"{name} is empty.")
        return None
    if "\t" not in head[0][0] and "," in head[0][0]:
        verdict.errors.append(f"{name}: header has no TAB but contains commas: the file looks COMMA-separated. Submissions must be TAB-separated (.tsv).")
        return None
    columns = [c.strip().lower() for c in head[0][0].split("\t")]
    if columns != list(header):
        verdict.errors.append(f"{name}: unexpected header {columns}. Expected exactly {list(header)} (tab-separated).")
        return None
    rows = parsed_lines(numbered_lines(spark, path).filter(F.col("line") > 1))
    verdict.errors += _messages(findings(rows, required, valid_ids), name, header[1])
    verdict.statistics[name] = row_statistics(rows).first().asDict()
    return rows


def validate_results(spark: SparkSession, matching_path: str, required_path: str, candidate_path: str | None = None, target_paths: tuple[str, ...] = (), check_ids: bool = False) -> Verdict:
    """PASS or FAIL of a results file and, where given, its candidates, with errors and warnings; a file that can't be read is an error."""
    verdict = Verdict("FAIL")
    try:
        _validated(spark, verdict, matching_path, required_path, candidate_path, target_paths, check_ids)
    except (OSError, PySparkException, Py4JJavaError) as failed:
        verdict.errors.append(f"Could not read a file: {str(failed).splitlines()[0]}.")
        verdict.status = "FAIL"
    return verdict


def _validated(spark: SparkSession, verdict: Verdict, matching_path: str, required_path: str, candidate_path: str | None, target_paths: tuple[str, ...], check_ids: bool) -> None:
    from ledgerline.sources.tsv import CANDIDATE_HEADER, TRUTH_HEADER, Catalog, read_ids

    exists = lambda p: Catalog(spark, {"f": p}).exists("f")
    if not exists(required_path):
        verdict.errors.append(f"Test source1 file not found: {required_path}.")
        return
    required = read_ids(spark, required_path).withColumnRenamed("id", "s1_id")
    valid = None
    if not check_ids:
        verdict.warnings.append("ID-existence check is OFF.")
    elif target_paths and all(map(exists, target_paths)):
        valid = read_ids(spark, *target_paths)
    else:
        verdict.warnings.append("Target source files not found: ID-existence check is skipped.")
    matched = _checked_file(spark, matching_path, TRUTH_HEADER, required, valid, verdict)
    candidates = None
    if candidate_path and exists(candidate_path):
        candidates = _checked_file(spark, candidate_path, CANDIDATE_HEADER, required, valid, verdict)
    elif candidate_path:
        verdict.warnings.append(f"{candidate_path} not found: its checks are skipped.")
    if matched is not None and candidates is not None:
        pairs = lambda rows: rows.filter(F.col("ids").isNotNull()).select("s1_id", F.explode("ids").alias("target_id"))
        outside = not_in(pairs(matched), pairs(candidates)).select("s1_id").distinct()
        if n := outside.count():
            ex = ", ".join(r[0] for r in outside.orderBy("s1_id").limit(EXAMPLES).collect())
            verdict.warnings.append(f"{n} S1 entity(ies) have matched IDs not present among the candidates, e.g. {ex}.")
    verdict.status = "FAIL" if verdict.errors else "PASS"
