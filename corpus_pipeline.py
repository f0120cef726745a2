"""The training-corpus pipeline: STAGES apply in order, each to all that its predecessor kept.

Every stage but the last returns the columns of its input. Columns that a stage
doesn't name pass through. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, line_dedup, mixing, near_texts, quality
from ledgerline.llm.queries import quality_model, tokenizer_path
from ledgerline.llm.store import Shared


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores THRESHOLD or more; null and empty texts are scored like others, and repeated rows alike."""
    scored = quality.quality_scores(docs, quality_model(spark, docs, sf_dir), keep=tuple(docs.columns))
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def _own(docs: DataFrame) -> DataFrame:
    """Columns under names of their own, which no result of an operator has."""
    return docs.select(*[F.col(c).alias(f"own_{c}") for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a document of a smaller id holds; a text that loses all lines is empty, and a null text becomes empty. ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(_own(docs), id_col="own_doc_id", text_col="own_text").withColumn("own_text", F.col("kept"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("own_n_chars", F.char_length("kept").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"own_{c}").alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id, then text hash, of each group of near-copies: texts that SimHash blocks or MinHash bands bring together and whose five-word shingles have a Jaccard overlap of 0.8 or more. Rows that share an id but not a group each count in their own; rows without an id can't be told apart and all stay."""
    named = docs.filter(F.col("doc_id").isNotNull())
    others = [F.col(f"own_{c}") for c in docs.columns if c not in ("doc_id", "text")]
    # The row's key: its id, its text's and a hash of its other columns.
    rows = _own(named).withColumn("node", near_texts.text_key(F.col("own_text")))
    rows = rows.withColumn("key", F.struct(F.col("own_doc_id").alias("doc_id"), "node", F.md5(F.to_json(F.struct(F.col("own_text").isNull().alias("none"), *others)).cast("binary")).alias("rest")))
    first = rows.groupBy("node").agg(F.min("key").alias("key"))
    groups = first.join(near_texts.components(named, Shared(spark)), "node", "left")
    chosen = groups.groupBy(F.coalesce("component", "node")).agg(F.min("key").alias("key")).select("key.*")
    rows = rows.drop("node").select(*[F.col(f"own_{c}") for c in docs.columns], "key.*")
    kept = rows.join(chosen, ["doc_id", "node", "rest"], "left_semi").dropDuplicates(["doc_id", "node", "rest"])
    return kept.select(*[F.col(f"own_{c}").alias(c) for c in docs.columns]).unionByName(docs.filter(F.col("doc_id").isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; null sources are one source, null texts have no words."""
    mixed = mixing.pareto_mix(_own(docs), id_col="own_doc_id", text_col="own_text", source_col="own_source", keep=tuple(f"own_{c}" for c in docs.columns))
    taken = mixed.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*[F.col(f"own_{c}").alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids`` of every row; null texts have no tokens."""
    return bpe.encode_texts(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near copies", keep_one_of_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read back."""
    shared = Shared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = shared.keep(docs, f"stage{k}")
    return docs
