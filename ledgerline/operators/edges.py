"""Match edges: nested lists to rows and back, policies for repeats, multiplicity and integrity.

``entities`` has ``s1_id`` (and ``country``), ``edges`` has ``s1_id, target_id``
(and ``ord`` where the order of arrival matters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.measures import multiplicity_bucket, source_tag
from ledgerline.functions.text import strip


def explode_lists(lists: DataFrame, list_col: str = "matched_entity_ids", id_col: str = "source1_entity_id", distinct: bool = False) -> DataFrame:
    """``s1_id, target_id, target_source, pos`` of comma lists: tokens stripped, blanks left out, order kept."""
    parts = F.filter(F.transform(F.split(F.coalesce(list_col, F.lit("")), ","), strip), lambda t: t != "")
    parts = F.array_distinct(parts) if distinct else parts
    rows = lists.select(strip(F.col(id_col)).alias("s1_id"), F.posexplode(parts).alias("pos", "target_id"))
    return rows.select("s1_id", "target_id", source_tag(F.col("target_id")).alias("target_source"), "pos")


def naive_edge_count(lists: DataFrame, list_col: str = "matched_entity_ids") -> DataFrame:
    """One row, ``edges``: the pieces between commas of all lists that aren't blank, whatever they are."""
    filled = F.trim(F.coalesce(list_col, F.lit(""))) != ""
    return lists.agg(F.coalesce(F.sum(F.when(filled, F.size(F.split(list_col, ",")))), F.lit(0)).alias("edges"))


def implode_lists(entities: DataFrame, edges: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    """One row an entity, its distinct targets sorted and comma-joined; empty for those without any."""
    lists = edges.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("target_id")), ",").alias(name))
    return entities.select("s1_id").join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(name, F.lit("")).alias(name))


def repeated_in_list(lists: DataFrame, list_col: str, id_col: str) -> DataFrame:
    """Ids of rows whose list names a target twice."""
    parts = F.filter(F.transform(F.split(F.coalesce(list_col, F.lit("")), ","), strip), lambda t: t != "")
    return lists.filter(F.size(parts) != F.size(F.array_distinct(parts))).select(strip(F.col(id_col)).alias("s1_id"))


def last_row_wins(rows: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """The last row of each key by ``order``, which is unique within a key."""
    packed = F.struct(*[F.col(c) for c in rows.columns if c != key])
    return rows.groupBy(key).agg(F.max_by(packed, order).alias("r")).select(key, "r.*").select(*rows.columns)


def first_and_last_parent(edges: DataFrame, order: str = "ord") -> DataFrame:
    """``target_id, first_parent, last_parent, num_parents``: by order of arrival, repeats counted."""
    grouped = edges.groupBy("target_id")
    return grouped.agg(F.min_by("s1_id", order).alias("first_parent"), F.max_by("s1_id", order).alias("last_parent"), F.count(F.lit(1)).alias("num_parents"))


def multiplicity(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """``entities`` with ``m``, their distinct targets, and its ``bucket``."""
    counts = edges.select("s1_id", "target_id").distinct().groupBy("s1_id").agg(F.count(F.lit(1)).alias("m"))
    joined = entities.join(counts, "s1_id", "left").withColumn("m", F.coalesce("m", F.lit(0)).cast("long"))
    return joined.withColumn("bucket", multiplicity_bucket(F.col("m")))


def integrity(entities: DataFrame, edges: DataFrame, s1_ids: DataFrame, s2_ids: DataFrame, s3_ids: DataFrame) -> DataFrame:
    """One row of edge counts, wrong prefixes, ids missing in their source file, and targets under several parents. Sources have ``id``."""
    distinct = edges.select("s1_id", "target_id", source_tag(F.col("target_id")).alias("src")).distinct()
    targets = distinct.groupBy("target_id", "src").agg(F.count(F.lit(1)).alias("parents"))
    known = s2_ids.select("id").unionByName(s3_ids.select("id")).distinct().withColumn("known", F.lit(True))
    targets = targets.join(known, targets["target_id"] == known["id"], "left")
    of = lambda src, cond=F.lit(True): F.count_if((F.col("src") == src) & cond)
    total = lambda src: F.coalesce(F.sum(F.when(F.col("src") == src, F.col("parents"))), F.lit(0))
    several, missing = F.col("parents") > 1, F.col("known").isNull()
    counts = targets.agg(
        F.coalesce(F.sum("parents"), F.lit(0)).alias("total_gt_edges"),
        total("S2").alias("total_s2_edges"),
        total("S3").alias("total_s3_edges"),
        of("S2").alias("unique_s2_targets"),
        of("S3").alias("unique_s3_targets"),
        of("OTHER").alias("invalid_prefix_count"),
        of("S2", missing).alias("missing_s2_in_source_count"),
        of("S3", missing).alias("missing_s3_in_source_count"),
        of("S2", several).alias("s2_targets_under_multiple_s1_count"),
        of("S3", several).alias("s3_targets_under_multiple_s1_count"),
    )
    ids = entities.select("s1_id").distinct()
    absent = ids.join(s1_ids.select(F.col("id").alias("s1_id")), "s1_id", "left_anti").agg(F.count(F.lit(1)).alias("missing_s1_in_source_count"))
    row = ids.agg(F.count(F.lit(1)).alias("total_gt_s1_entities")).crossJoin(counts).crossJoin(absent)
    sound = sum((F.col(c) for c in ("invalid_prefix_count", "missing_s1_in_source_count", "missing_s2_in_source_count", "missing_s3_in_source_count")), F.lit(0)) == 0
    return row.withColumn("integrity_passed", sound)


def id_set_operations(a: DataFrame, b: DataFrame) -> DataFrame:
    """``side, id``: ids of both, of ``a`` alone and of ``b`` alone, each once; one shuffle for all three."""
    both = a.select("id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select("id", F.lit(0).alias("a"), F.lit(1).alias("b")))
    sides = both.groupBy("id").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return sides.select(F.when(F.col("a") + F.col("b") == 2, "both").when(F.col("a") == 1, "only_a").otherwise("only_b").alias("side"), "id")


def stratum_rollup(entities: DataFrame) -> DataFrame:
    """Counts by country and bucket with subtotals; ``level`` is the grouping id."""
    return entities.rollup("country", "bucket").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level"))


def top_examples(rows: DataFrame, group: str, value: str, k: int = 5) -> DataFrame:
    """``group, total, examples``: how many distinct values a group has, and its first ``k`` in order. A group keeps ``k`` values a task before rows are dealt out."""
    distinct = rows.select(group, value).distinct()
    first = distinct.withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy(value))).filter(F.col("r") <= k)
    shown = first.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(value)), ", ").alias("examples"))
    return distinct.groupBy(group).agg(F.count(F.lit(1)).alias("total")).join(shown, group)
