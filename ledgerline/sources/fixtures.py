"""Entity-resolution views over a TPC-H-like star schema, in SQL that Spark and DuckDB both run.

Customers are the deduplicated source S1; orders (S2) and shipments (S3) are
its noisy copies; truth, predictions and candidates follow from the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

VIEWS = {
    "er_s1": """
SELECT 'S1-' || CAST(c_custkey AS STRING) AS entity_id, c_name AS business_name, n_name || ', ' || c_mktsegment AS business_address, r_name AS country, c_custkey AS k
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "er_s2": """
SELECT 'S2-' || CAST(o_orderkey AS STRING) AS entity_id,
  CASE o_orderkey % 5 WHEN 0 THEN upper(c_name) WHEN 1 THEN replace(c_name, '#', ' # ') WHEN 2 THEN c_name || ' Ltd' WHEN 3 THEN replace(c_name, '#', '') ELSE c_name END AS business_name,
  CASE o_orderkey % 11 WHEN 0 THEN '' WHEN 1 THEN n_name || ', NULL, ' || c_mktsegment WHEN 2 THEN n_name || ' n/a' WHEN 3 THEN '   ' WHEN 4 THEN '<NULL>'
    WHEN 5 THEN n_name || ', Na' WHEN 6 THEN upper(n_name) || ' - ' || lower(c_mktsegment) ELSE n_name || ', ' || c_mktsegment END AS business_address,
  CASE WHEN o_orderkey % 97 = 0 THEN 'OTHER' WHEN o_orderkey % 101 = 0 THEN '' WHEN o_orderkey % 103 = 0 THEN ' ' || r_name || '  ' WHEN o_orderkey % 107 = 0 THEN CAST(NULL AS STRING) ELSE r_name END AS country, o_custkey AS k, o_orderkey AS ok
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "er_s3": """
SELECT 'S3-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS entity_id, max(s_name) AS business_name, max(n_name) AS business_address, max(r_name) AS country,
  max(o_custkey) AS k, l_orderkey AS ok
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY l_orderkey, l_suppkey""",
    "er_truth": """
SELECT DISTINCT s1_id, target_id, k FROM (
  SELECT 'S1-' || CAST(k AS STRING) AS s1_id, entity_id AS target_id, k FROM er_s2 WHERE ok % 7 = 0 AND k % 17 <> 0
  UNION ALL SELECT 'S1-' || CAST(k AS STRING), entity_id, k FROM er_s3 WHERE ok % 20 = 1 AND k % 17 <> 0
  UNION ALL SELECT 'S1-' || CAST(k + 1 AS STRING), entity_id, k + 1 FROM er_s2 WHERE ok % 49 = 0 AND (k + 1) % 17 <> 0 AND k + 1 < (SELECT max(c_custkey) FROM customer)) t""",
    "er_pred": """
SELECT s1_id, target_id FROM er_truth WHERE ascii(substr(md5(s1_id || target_id), 1, 1)) % 5 <> 0
UNION SELECT 'S1-' || CAST(k AS STRING), entity_id FROM er_s2 WHERE ok % 70 = 1""",
    "er_cand": """
SELECT s1_id, target_id FROM er_truth WHERE ascii(substr(md5(target_id || s1_id), 2, 1)) % 9 <> 0
UNION SELECT s1_id, target_id FROM er_pred WHERE ascii(substr(md5(target_id), 1, 1)) % 7 <> 0
UNION SELECT 'S1-' || CAST(k AS STRING), entity_id FROM er_s2 WHERE ok % 5 = 2""",
    "er_gt": """
SELECT a.entity_id AS source1_entity_id, coalesce(l.ids, '') AS matched_entity_ids FROM er_s1 a
LEFT JOIN (SELECT s1_id, {list} AS ids FROM er_truth GROUP BY s1_id) l ON a.entity_id = l.s1_id""",
}

_LIST = {"spark": "array_join(array_sort(collect_list(target_id)), ',')", "duckdb": "string_agg(target_id, ',' ORDER BY target_id)"}


def sql_prelude(dialect: str = "duckdb") -> str:
    """All views as common table expressions, to put before a query."""
    return "WITH " + ",\n".join(f"{name} AS ({sql.replace('{list}', _LIST[dialect])})" for name, sql in VIEWS.items())


class Fixture:
    """The views over one folder of tables, each a DataFrame; what a query doesn't use isn't read."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
        self._done: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        if name not in self._done:
            import re

            sql = VIEWS[name].replace("{list}", _LIST["spark"])
            used = sorted(set(re.findall(rf"\b({'|'.join([*TABLES, *VIEWS])})\b", sql)))
            args = {u: self.tables[u] if u in self.tables else self.view(u) for u in used}
            self._done[name] = self.spark.sql(re.sub(rf"\b({'|'.join(used)})\b", r"{\1}", sql), **args)
        return self._done[name]

    def stored(self, folder: str) -> Fixture:
        """The same views, each computed once, as Parquet under ``folder``, a place that driver and executors share."""
        out = Fixture.__new__(Fixture)
        out.spark, out.tables, out._done = self.spark, self.tables, {}
        for name in VIEWS:
            source = Fixture.view(out, name)
            source.write.mode("overwrite").parquet(f"{folder}/{name}")
            out._done[name] = self.spark.read.schema(source.schema).parquet(f"{folder}/{name}")
        return out

    def __getattr__(self, name: str) -> DataFrame:
        if f"er_{name}" not in VIEWS:
            raise AttributeError(name)
        return self.view(f"er_{name}")
