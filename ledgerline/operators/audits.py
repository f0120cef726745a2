"""Audits over records and edges: placeholders, exact agreement, countries, exclusivity, and their verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as tx
from ledgerline.functions.measures import fine_bucket, or_unknown, percentage, source_tag

#: Verdicts.
SAFE = "SAFE FOR HARD PARTITIONING ON TRAINING GT"
RISK = "HARD COUNTRY PARTITION WOULD CREATE A MEASURED RECALL RISK"
UNRESOLVED = "UNRESOLVED"
PLAUSIBLE = "LEGALLY PLAUSIBLE FOR EXPERIMENTATION"
DO_NOT_ENABLE = "DO NOT ENABLE"


def _one(column: str | Column) -> Column:
    return F.coalesce(column, F.lit(0)).cast("long")


# Placeholders in addresses.


def placeholder_flags(records: DataFrame, column: str = "business_address") -> DataFrame:
    """``records`` with what its address is: empty, blank, default-missing, a whole-field placeholder, or tokens (``tok``) of which some are placeholders."""
    raw = F.coalesce(column, F.lit(""))
    stripped = tx.strip(raw)
    rows = records.withColumn("is_empty", raw == "").withColumn("is_blank", (raw != "") & (stripped == ""))
    rows = rows.withColumn("is_default_na", (raw == "") | ((stripped != "") & F.lower(stripped).isin(*tx.DEFAULT_NA))).withColumn("whole_token", tx.whole_field_placeholder(stripped))
    open_text = (stripped != "") & F.col("whole_token").isNull()
    parts = F.when(open_text, tx.tokens(stripped)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("is_missing", ~open_text).withColumn("tok", parts)
    rows = rows.withColumn("has_cleaned", F.exists("tok", lambda t: tx.is_placeholder(tx.clean_token(t))))
    return rows.withColumn("has_raw", F.exists("tok", tx.is_placeholder))


def placeholder_field_summary(records: DataFrame, by: tuple[str, ...] = ("dataset", "source"), column: str = "business_address") -> DataFrame:
    """Missingness of each data set and source in one pass."""
    rows = placeholder_flags(records, column)
    n, filled = F.count(F.lit(1)), F.count_if(~F.col("is_missing"))
    cleaned = F.count_if(F.col("has_cleaned"))
    return rows.groupBy(*by).agg(
        n.alias("total_rows"),
        F.count_if("is_default_na").alias("pandas_nan_count"),
        F.count_if("is_empty").alias("empty_string_count"),
        F.count_if("is_blank").alias("whitespace_only_count"),
        F.count("whole_token").alias("whole_field_placeholder_count"),
        F.count_if("is_missing").alias("effectively_missing_count"),
        percentage(F.count_if("is_missing"), n).alias("effectively_missing_pct"),
        filled.alias("nonempty_address_count"),
        cleaned.alias("rows_with_component_placeholder_cleaned"),
        percentage(cleaned, n).alias("rows_with_component_placeholder_cleaned_pct"),
        F.count_if("has_raw").alias("rows_with_component_placeholder_raw_ws"),
        (filled - cleaned).alias("rows_clean_nonempty"),
        percentage(filled - cleaned, n).alias("rows_clean_nonempty_pct"),
    )


TOKEN_MEASURES = (
    "whole_field_rows", "component_token_occurrences_cleaned", "component_token_occurrences_raw_ws", "component_rows_cleaned", "component_rows_raw_ws",
    "case_uppercase", "case_lowercase", "case_titlecase", "case_other", "punct_surrounded", "whitespace_isolated",
)


def placeholder_token_summary(records: DataFrame, by: tuple[str, ...] = ("dataset", "source"), column: str = "business_address") -> DataFrame:
    """Measures of each placeholder in each data set and source; all placeholders appear.

    Each hit of a row says whether it is the row's first of its token, so rows
    and occurrences come from one grouping without distinct counts.
    """
    rows = placeholder_flags(records, column)
    cleaned = F.filter(F.transform("tok", lambda t: F.struct(t.alias("raw"), tx.clean_token(t).alias("clean"))), lambda t: tx.is_placeholder(t["clean"]))
    rows = rows.select(*by, "whole_token", cleaned.alias("hits"))
    # Most rows have no placeholder at all: they only say that their group is there.
    some = rows.filter((F.size("hits") > 0) | F.col("whole_token").isNotNull())
    some = some.withColumn("tokens", F.transform("hits", lambda h: F.lower(h["clean"]))).withColumn("raws", F.transform("hits", lambda h: F.lower(h["raw"])))
    hits = some.select(*by, "whole_token", "tokens", "raws", F.posexplode_outer("hits").alias("pos", "hit"))
    token, at = F.get("tokens", F.col("pos")), F.col("pos") + 1
    raw, kind = F.get("raws", F.col("pos")) == token, F.when(F.col("pos").isNotNull(), tx.casing(F.col("hit.clean")))
    first, first_raw = F.array_position("tokens", token) == at, raw & (F.array_position("raws", token) == at)
    whole, bare = F.col("pos").isNull(), F.col("hit.raw") == F.col("hit.clean")
    values = [whole, ~whole, raw, first, first_raw, kind == "upper", kind == "lower", kind == "title", kind == "other", ~bare, bare]
    counted = hits.select(*by, F.coalesce(token, "whole_token").alias("token"), *[v.alias(m) for m, v in zip(TOKEN_MEASURES, values, strict=True)])
    groups = rows.select(*by).distinct().withColumn("token", F.explode(F.array(*[F.lit(t) for t in tx.PLACEHOLDERS])))
    sums = counted.groupBy(*by, "token").agg(*[F.count_if(m).alias(m) for m in TOKEN_MEASURES])
    return groups.join(sums, [*by, "token"], "left").select(*by, "token", *[_one(m).alias(m) for m in TOKEN_MEASURES])


# Exact agreement of normalised names and addresses over true edges.


def agreement_edges(edges: DataFrame, s1: DataFrame, other: DataFrame, prefix: str = "S3-", nfkc: bool = True) -> DataFrame:
    """True edges into ``other`` with both records, their normalised fields, and whether they agree.

    ``edges`` has ``s1_id, target_id, ord``; a target under several parents
    belongs to the last. Only records that an edge asks for are normalised.
    """
    m = edges.groupBy("s1_id").agg(F.count(F.lit(1)).alias("multiplicity"))
    own = edges.filter(F.col("target_id").startswith(prefix)).groupBy("target_id").agg(F.max_by("s1_id", "ord").alias("s1_id"))
    left = s1.select(F.col("entity_id").alias("s1_id"), F.col("business_name").alias("s1_name_raw"), F.col("business_address").alias("s1_address_raw"), "country")
    right = other.select(F.col("entity_id").alias("target_id"), F.col("business_name").alias("s3_name_raw"), F.col("business_address").alias("s3_address_raw"))
    rows = own.join(right, "target_id").join(left, "s1_id").join(m, "s1_id")
    for c in ("s1_name", "s1_address", "s3_name", "s3_address"):
        rows = rows.withColumn(c, tx.normalise(F.col(f"{c}_raw"), nfkc))
    rows = rows.withColumn("country", or_unknown(F.col("country"), empty_too=True))
    rows = rows.withColumn("name_exact", (F.col("s1_name") != "") & (F.col("s1_name") == F.col("s3_name")))
    rows = rows.withColumn("addr_exact", (F.col("s1_address") != "") & (F.col("s1_address") == F.col("s3_address")))
    status = F.when((F.col("s1_address") != "") & (F.col("s3_address") != ""), "both_present").when(F.col("s1_address") != "", "s3_missing").when(F.col("s3_address") != "", "s1_missing").otherwise("both_missing")
    return rows.withColumn("address_status", status)


_AGREE = {
    "name_exact": lambda n, a: n,
    "addr_exact": lambda n, a: a,
    "both_exact": lambda n, a: n & a,
    "name_only": lambda n, a: n & ~a,
    "addr_only": lambda n, a: ~n & a,
    "neither_exact": lambda n, a: ~n & ~a,
}


def _agreement(name: str) -> Column:
    return F.count_if(_AGREE[name](F.col("name_exact"), F.col("addr_exact")))


def exact_summary(agreed: DataFrame) -> DataFrame:
    """``metric, count, percentage``: edges, the six ways to agree, the four states of the addresses; one pass, then one row a metric."""
    status = lambda s: F.count_if(F.col("address_status") == s)
    measures = {"total_edges": F.count(F.lit(1))} | {k: _agreement(k) for k in _AGREE} | {f"address_{s}": status(s) for s in ("both_present", "s1_missing", "s3_missing", "both_missing")}
    row = agreed.agg(*[m.alias(k) for k, m in measures.items()])
    one = lambda k: F.struct(F.lit(k).alias("metric"), F.col(k).alias("count"), percentage(F.col(k), F.col("total_edges")).alias("percentage"))
    return row.select(F.explode(F.array(*[one(k) for k in measures])).alias("r")).select("r.*")


def exact_by_country(agreed: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    pairs = [c for k in _AGREE for c in (_agreement(k).alias(k), percentage(_agreement(k), n).alias(f"{k}_pct"))]
    return agreed.groupBy("country").agg(n.alias("total_edges"), *pairs)


def exact_by_multiplicity(agreed: DataFrame) -> DataFrame:
    return agreed.groupBy(fine_bucket(F.col("multiplicity")).alias("multiplicity")).agg(F.count(F.lit(1)).alias("total_edges"), *[_agreement(k).alias(k) for k in _AGREE])


def exact_examples(agreed: DataFrame, k: int = 50) -> DataFrame:
    """The first ``k`` edges, by ids, that agree in both."""
    cols = [F.col("s1_id").alias("source1_entity_id"), F.col("target_id").alias("source3_entity_id"), "country", "multiplicity", "s1_name_raw", "s3_name_raw", "s1_address_raw", "s3_address_raw"]
    rows = agreed.filter(F.col("name_exact") & F.col("addr_exact"))
    return rows.select(*cols, F.col("s1_name").alias("normalized_name"), F.col("s1_address").alias("normalized_address")).orderBy("source1_entity_id", "source3_entity_id").limit(k)


def reconcile(agreed: DataFrame, edges: DataFrame, prefix: str = "S3-", strict: bool = False) -> DataFrame:
    """``parsed, evaluated, reconciled``; ``strict`` raises ValueError where edges were lost to repeated parents or missing records."""
    row = edges.agg(F.count_if(F.col("target_id").startswith(prefix)).alias("parsed")).crossJoin(agreed.agg(F.count(F.lit(1)).alias("evaluated")))
    row = row.withColumn("reconciled", F.col("parsed") == F.col("evaluated"))
    if strict and not (r := row.first())["reconciled"]:
        raise ValueError(f"{r['parsed']} edges parsed, {r['evaluated']} evaluated")
    return row


# Countries over edges.


def _country(records: DataFrame, id_name: str, name: str) -> DataFrame:
    return records.select(F.col("entity_id").alias(id_name), tx.strip(or_unknown(F.col("country"))).alias(name))


def country_edges(edges: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Resolved edges with both countries, stripped, each target under its last parent (``ord``) that has a record: one pass for both target sources."""
    own = edges.withColumn("target_source", source_tag(F.col("target_id"))).filter(F.col("target_source") != "OTHER")
    own = own.join(_country(s1, "s1_id", "s1_country"), "s1_id")
    last = own.groupBy("target_id", "target_source").agg(F.max_by(F.struct("s1_id", "s1_country"), "ord").alias("p")).select("target_id", "target_source", "p.*")
    rows = last.join(_country(targets, "target_id", "target_country"), "target_id")
    return rows.withColumn("same", F.col("s1_country") == F.col("target_country"))


def country_missing(entities: DataFrame, edges: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """One row: truth rows whose entity has no record, edges of the others by target source, their targets without a record, and how many entity records there are."""
    known = s1.select(F.col("entity_id").alias("s1_id")).distinct()
    lost = entities.select("s1_id").join(known, "s1_id", "left_anti").agg(F.count(F.lit(1)).alias("missing_s1_rows"))
    own = edges.withColumn("src", source_tag(F.col("target_id"))).filter(F.col("src") != "OTHER").join(known, "s1_id", "left_semi")
    there = targets.select(F.col("entity_id").alias("target_id")).distinct().withColumn("there", F.lit(1))
    each = own.groupBy("target_id", "src").agg(F.count(F.lit(1)).alias("n")).join(there, "target_id", "left")
    of = lambda s: F.coalesce(F.sum(F.when(F.col("src") == s, F.col("n"))), F.lit(0)).alias(f"total_{s.lower()}_edges")
    gone = lambda s: F.count_if((F.col("src") == s) & F.col("there").isNull()).alias(f"missing_{s.lower()}_targets")
    return lost.crossJoin(each.agg(of("S2"), of("S3"), gone("S2"), gone("S3"))).crossJoin(s1.agg(F.count(F.lit(1)).alias("s1_entities_resolved")))


def cross_country_slices(resolved: DataFrame, sources: tuple[str, ...] = ("S2", "S3")) -> DataFrame:
    """``slice_type, s1_country, target_source`` and counts: over all, by target source, by country, and by both, every pair of them included. One grouping feeds them all."""
    cells = resolved.filter(F.col("target_source").isin(*sources)).groupBy("s1_country", "target_source").agg(F.count(F.lit(1)).alias("total"), F.count_if("same").alias("same"))
    # Pairs without an edge count zero, so every slice is there.
    countries = cells.select("s1_country").distinct().withColumn("target_source", F.explode(F.array(*[F.lit(s) for s in sources])))
    cells = countries.join(cells, ["s1_country", "target_source"], "left").select("s1_country", "target_source", _one("total").alias("total"), _one("same").alias("same"))
    cube = cells.cube("s1_country", "target_source").agg(F.sum("total").alias("total_edges"), F.sum("same").alias("same_country_edges"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 3, "OVERALL").when(F.col("g") == 2, "BY_TARGET_SOURCE").when(F.col("g") == 1, "BY_S1_COUNTRY").otherwise("BY_COUNTRY_X_SOURCE")
    total, same = F.col("total_edges"), F.col("same_country_edges")
    return cube.select(
        kind.alias("slice_type"), F.coalesce("s1_country", F.lit("ALL")).alias("s1_country"), F.coalesce("target_source", F.lit("ALL")).alias("target_source"), _one(total).alias("total_edges"), _one(same).alias("same_country_edges"),
        _one(total - same).alias("cross_country_edges"), percentage(same, total, 6).alias("same_country_pct"), percentage(total - same, total, 6).alias("cross_country_pct"),
    )


def cross_country_examples(resolved: DataFrame, k: int = 100) -> DataFrame:
    """The first ``k`` edges across countries, by target source, then ids."""
    rows = resolved.filter(~F.col("same")).select(F.col("s1_id").alias("source1_entity_id"), F.col("s1_country").alias("source1_country"), F.col("target_id").alias("target_entity_id"), "target_country", "target_source")
    return rows.orderBy("target_source", "target_entity_id", "source1_entity_id").limit(k)


def country_verdict(resolved: DataFrame) -> DataFrame:
    """One row: edges, those across countries, and whether a hard partition by country is safe."""
    row = resolved.agg(F.count(F.lit(1)).alias("total_edges"), F.count_if(~F.col("same")).alias("cross_country_edges"))
    verdict = F.when((F.col("cross_country_edges") == 0) & (F.col("total_edges") > 0), SAFE).when(F.col("cross_country_edges") > 0, RISK).otherwise(UNRESOLVED)
    return row.withColumn("architectural_status", verdict)


# Exclusivity of targets; a target repeated within a row counts as often.


def _degrees(edges: DataFrame) -> DataFrame:
    degrees = edges.groupBy("target_id").agg(F.count(F.lit(1)).alias("in_degree"))
    return degrees.withColumn("target_source", source_tag(F.col("target_id"))).filter(F.col("target_source") != "OTHER")


def _with_overall(rows: DataFrame) -> DataFrame:
    """Each row under its source and under OVERALL: small groups are meant."""
    return rows.withColumn("target_source", F.explode(F.array("target_source", F.lit("OVERALL"))))


def exclusivity_stats(edges: DataFrame) -> DataFrame:
    """For S2, S3 and OVERALL: edges, targets, those under one and several parents, the most parents, repeated references, and the share that is exclusive. Degrees are counted by value first."""
    by_degree = _degrees(edges).groupBy("target_source", "in_degree").agg(F.count(F.lit(1)).alias("targets"))
    d, n = F.col("in_degree"), F.col("targets")
    rows = _with_overall(by_degree).groupBy("target_source").agg(F.sum(d * n).alias("total_edges"), F.sum(n).alias("distinct_targets"), F.sum(F.when(d == 1, n)).alias("single_parent_targets"), F.sum(F.when(d > 1, n)).alias("multi_parent_targets"), F.max(d).alias("max_parent_count"))
    names = edges.sparkSession.createDataFrame([("S2",), ("S3",), ("OVERALL",)], "target_source string")
    rows = names.join(rows, "target_source", "left")
    counts = [_one(c).alias(c) for c in ("total_edges", "distinct_targets", "single_parent_targets", "multi_parent_targets")]
    repeats = _one("total_edges") - _one("distinct_targets")
    return rows.select("target_source", *counts, F.coalesce("max_parent_count", F.lit(1)).cast("long").alias("max_parent_count"), repeats.alias("duplicate_references"), percentage(_one("single_parent_targets"), _one("distinct_targets"), 6).alias("exclusivity_rate_pct"))


def indegree_distribution(edges: DataFrame) -> DataFrame:
    """``target_source, in_degree, target_count, percentage``; degree 1 is always there."""
    counts = _with_overall(_degrees(edges).groupBy("target_source", "in_degree").agg(F.count(F.lit(1)).alias("n"))).groupBy("target_source", "in_degree").agg(F.sum("n").alias("n"))
    ones = edges.sparkSession.createDataFrame([(s, 1, 0) for s in ("S2", "S3", "OVERALL")], "target_source string, in_degree long, n long")
    counts = counts.unionByName(ones).groupBy("target_source", "in_degree").agg(F.sum("n").alias("target_count"))
    totals = counts.groupBy("target_source").agg(F.sum("target_count").alias("total"))
    return counts.join(totals, "target_source").select("target_source", "in_degree", "target_count", percentage(F.col("target_count"), F.col("total"), 6).alias("percentage"))


def multi_parent_examples(edges: DataFrame, s1: DataFrame, k: int = 100) -> DataFrame:
    """The first ``k`` targets, by source and id, under several parents, with the parents and their countries in order of arrival. Only those ``k`` targets' parents are gathered."""
    chosen = _degrees(edges).filter("in_degree > 1").orderBy("target_source", "target_id").limit(k)
    own = edges.select("s1_id", "target_id", "ord").join(F.broadcast(chosen), "target_id")
    countries = s1.select(F.col("entity_id").alias("s1_id"), or_unknown(F.col("country")).alias("c"))
    rows = own.join(countries, "s1_id", "left").groupBy("target_id", "target_source", "in_degree").agg(F.array_sort(F.collect_list(F.struct("ord", "s1_id", F.coalesce("c", F.lit("Unknown")).alias("c")))).alias("p"))
    listed = lambda f: F.array_join(F.transform("p", lambda x: x[f]), ",")
    return rows.select(F.col("target_id").alias("target_entity_id"), "target_source", F.col("in_degree").alias("num_parents"), listed("s1_id").alias("parent_s1_ids"), listed("c").alias("parent_countries"))


def assignment_verdict(stats: DataFrame) -> DataFrame:
    """One row from ``exclusivity_stats``: whether both sources are exclusive, so that a target may be given away once."""
    both = F.count_if(F.col("target_source").isin("S2", "S3") & (F.col("multi_parent_targets") == 0) & (F.col("distinct_targets") > 0)) == 2
    return stats.agg(both.alias("is_structurally_cleared")).select("is_structurally_cleared", F.when(F.col("is_structurally_cleared"), PLAUSIBLE).otherwise(DO_NOT_ENABLE).alias("architectural_status"))


def reconciliation(entities: DataFrame, edges: DataFrame, s1: DataFrame, targets: DataFrame, expected: dict[str, int]) -> DataFrame:
    """One row: edge totals, whether all ids resolve, whether counts are ``expected`` (keys total_gt_s1, total_s2_edges, total_s3_edges, total_gt_edges), and the status."""
    tag = source_tag(F.col("target_id"))
    e = edges.agg(F.count_if(tag == "S2").alias("total_s2_edges"), F.count_if(tag == "S3").alias("total_s3_edges"), F.count_if(tag != "OTHER").alias("total_gt_edges"))
    known = targets.select(F.col("entity_id").alias("target_id"))
    lost = edges.select("target_id").distinct().join(known, "target_id", "left_anti").agg(F.count_if(tag == "S2").alias("lost2"), F.count_if(tag == "S3").alias("lost3"))
    lost1 = entities.select("s1_id").join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_anti").agg(F.count(F.lit(1)).alias("lost1"))
    row = entities.agg(F.count(F.lit(1)).alias("total_gt_s1")).crossJoin(e).crossJoin(lost).crossJoin(lost1)
    same = F.lit(True)
    for k, v in expected.items():
        same = same & (F.col(k) == v)
    resolved = [(F.col(f"lost{k}") == 0).alias(f"s{k}_resolution_passed") for k in (1, 2, 3)]
    row = row.select("total_gt_s1", "total_s2_edges", "total_s3_edges", "total_gt_edges", *resolved, same.alias("counts_reconciled"))
    passed = F.col("counts_reconciled") & F.col("s1_resolution_passed") & F.col("s2_resolution_passed") & F.col("s3_resolution_passed")
    return row.withColumn("status", F.when(passed, "PASS WITH FINDINGS").otherwise("FAIL"))
