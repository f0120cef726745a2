"""Times the two whole audits over tab-separated files of the reference's own size; prints one JSON line.

The files are made once, under SCALE_DIR: 2,206,821 entities, 5,034,616 and
5,285,603 target records, 7,638,365 true edges. SCALE_SHARE makes them smaller.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

#: Records of the three sources, and true edges into the two target sources.
SIZES = {"S1": 2_206_821, "S2": 5_034_616, "S3": 5_285_603}
EDGES = {"S2": 3_693_619, "S3": 3_944_746}
#: Published seconds of the audits, on eight cores.
PUBLISHED = {"foundation": 35.36, "structure": 27.79}


def make(spark: SparkSession, root: str, share: float) -> None:
    """Source files with names, addresses and countries that follow from the ids; every target has one entity, three in twenty entities have none."""
    n = {k: int(v * share) for k, v in SIZES.items()}
    country = "if({k} % 5 < 3, 'US', 'India')"
    for name, source in (("train", "S1"), ("train", "S2"), ("train", "S3")):
        k = "id" if source == "S1" else f"id % {n['S1']}"
        rows = spark.range(n[source]).selectExpr(
            f"concat('{source}-', id) entity_id", f"concat('Business Number ', {k}, if({k} % 7 = 0, ' Pvt Ltd', ' Cafe')) business_name", f"concat({k} % 900, ' Main Road, Sector ', {k} % 77, if(id % 31 = 0, ', NULL', '')) business_address", f"{country.format(k=f'({k})')} country",
        )
        _one_file(rows, f"{root}/{name}/{name}_source{source[1]}.tsv")
    own = f"id % {n['S1']}"
    edges = None
    for source in ("S2", "S3"):
        part = spark.range(int(EDGES[source] * share)).selectExpr(f"if(({own}) % 20 < 3, ({own}) - ({own}) % 20 + 3, {own}) k", f"concat('{source}-', id) target")
        edges = part if edges is None else edges.unionByName(part)
    lists = edges.groupBy("k").agg({"target": "collect_list"}).toDF("k", "targets")
    truth = spark.range(n["S1"]).withColumnRenamed("id", "k").join(lists, "k", "left")
    _one_file(truth.selectExpr("concat('S1-', k) source1_entity_id", "coalesce(array_join(targets, ','), '') matched_entity_ids"), f"{root}/train/train_ground_truth.tsv")


def _one_file(df, path: str) -> None:
    df.write.mode("overwrite").csv(f"{path}.parts", sep="\t", header=False, quote="", emptyValue="")
    with open(path, "wb") as out:
        out.write(("\t".join(df.columns) + "\n").encode())
        for part in sorted(Path(f"{path}.parts").glob("part-*")):
            out.write(part.read_bytes())
            part.unlink()


def main() -> None:
    root, share, cpus = os.environ.get("SCALE_DIR", "/tmp/ledgerline-scale"), float(os.environ.get("SCALE_SHARE", "1")), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("scale").config("spark.sql.shuffle.partitions", str(4 * int(cpus))).config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerline.plans import audit_runs

    if not Path(f"{root}/train/train_ground_truth.tsv").exists():
        Path(f"{root}/train").mkdir(parents=True, exist_ok=True)
        make(spark, root, share)
    catalog = audit_runs.standard_catalog(spark, root)
    took = {}
    for name, run in (("foundation", lambda: audit_runs.validation_foundation(catalog, f"{root}/out")), ("structure", lambda: audit_runs.structure_audit(catalog, f"{root}/out", {}))):
        began = time.perf_counter()
        run()
        took[name] = round(time.perf_counter() - began, 2)
    print(json.dumps({"metric": "audit_seconds", "value": round(sum(took.values()), 2), "unit": "sec", "stages": took, "published": PUBLISHED, "share": share}))


if __name__ == "__main__":
    main()
