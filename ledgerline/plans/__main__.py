"""``python -m ledgerline.plans preprocess|foundation|structure|validate ...``"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ledgerline.operators.validation import validate_results
from ledgerline.plans import audit_runs
from ledgerline.sources.sinks import write_validation_log


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerline.plans")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("preprocess", "foundation", "structure"):
        p = commands.add_parser(name)
        p.add_argument("-d", "--data", help="folder with train and test; by default the nearest one")
        p.add_argument("-o", "--output-dir", required=True)
        if name == "foundation":
            p.add_argument("-s", "--seed", type=int, default=42)
        if name == "structure":
            p.add_argument("--expected", default="{}", help="expected counts, as JSON")
    p = commands.add_parser("validate")
    p.add_argument("-m", "--matching", required=True)
    p.add_argument("-c", "--candidate")
    p.add_argument("-t", "--test-dir", required=True)
    p.add_argument("--check-ids", action="store_true")
    p.add_argument("--log")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("ledgerline").getOrCreate()
    if a.command == "validate":
        found = validate_results(spark, a.matching, f"{a.test_dir}/test_source1.tsv", a.candidate, (f"{a.test_dir}/test_source2.tsv", f"{a.test_dir}/test_source3.tsv"), a.check_ids)
        if a.log:
            write_validation_log(found, a.log, " ".join(argv or sys.argv[1:]))
        print("\n".join([found.status, *(f"ERROR: {e}" for e in found.errors), *(f"WARNING: {w}" for w in found.warnings)]))
        return found.exit_code
    catalog = audit_runs.standard_catalog(spark, a.data or audit_runs.data_root())
    if a.command == "preprocess":
        audit_runs.preprocessing_audit(catalog, a.output_dir)
    elif a.command == "foundation":
        audit_runs.validation_foundation(catalog, a.output_dir, a.seed)
    else:
        audit_runs.structure_audit(catalog, a.output_dir, json.loads(a.expected))
    return 0


if __name__ == "__main__":
    sys.exit(main())
