"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import ann, bpe, langid, line_dedup, mixing, mpegts, quality, sharding, simhash, toxicity
from ledgerline.llm.store import Shared
from ledgerline.llm.training import id_fold

#: The production tokenizer's file, at one place on every machine.
TOKENIZER = "byte_bpe_50k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every row of ``embeddings`` whose id is divisible by 50; see ``nearest_neighbours`` for vectors that take no part."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op2_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint, over three words, and component of every document; see ``near_duplicates`` for nulls and repeats."""
    return simhash.near_duplicates(_documents(spark, sf_dir), width=3).select("doc_id", "fingerprint", "component_id")


def op3_media_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a transport stream and read back; the feature sums up what the stream says of itself and its samples."""
    read = mpegts.decode_media(mpegts.encode_media(_documents(spark, sf_dir)))
    units = F.col("units")
    feature = F.format_string(
        "packets=%d;errors=%d;streams=%s;units=%d;random_access=%d;last_pts=%d;sum=%d;crossings=%d",
        "n_packets", "continuity_errors", "streams", F.size(units), F.size(F.filter(units, lambda u: u["random_access"])),
        F.element_at(units, -1)["pts"], "sample_sum", "level_crossings",
    )
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines each document has and loses, and the digest of what stays; a document that loses all lines keeps an empty text."""
    kept = line_dedup.dedup_lines(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
held AS (SELECT key, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(h.first_doc < h.last_doc AND k.doc_id <> h.first_doc, false) AS lost
  FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op5_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the rows outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    learnt = id_fold("doc_id", 5) != 0
    model = toxicity.fit_toxicity(docs.filter(learnt), spark.read.parquet(f"{sf_dir}/labels.parquet").filter(learnt))
    scored = toxicity.toxicity_scores(docs, model)
    return scored.select("doc_id", (id_fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again, as digests; a null text is as an empty one."""
    path = tokenizer_path()
    # The ids are written, so a task holds one Python worker, not the encoder's and the decoder's.
    encoded = Shared(spark).keep(bpe.encode_texts(_documents(spark, sf_dir), path), "encoded")
    decoded = bpe.decode_texts(encoded, path)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return decoded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the rows outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    held_out = id_fold("doc_id", 4) == 2
    predicted = langid.predict_languages(docs, langid.training_texts(docs.filter(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.LinearModel:
    """Learns from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.fit_quality(docs, labels.filter(id_fold("doc_id", 4) != 2))


def op8_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    scored = quality.quality_scores(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", (id_fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards, their row counts at most one apart."""
    dealt = sharding.shuffle_into_shards(_documents(spark, sf_dir), 24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and the words that the mix takes of each."""
    mixed = mixing.pareto_mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {"op4_cuckoo_line_dedup": op4_cuckoo_line_dedup, "op1_hilbert_neighbours": op1_hilbert_neighbours, "op7_cross_parsing_language": op7_cross_parsing_language, "op5_nnpu_toxicity": op5_nnpu_toxicity, "op8_nb_svm_quality": op8_nb_svm_quality, "op9_hypergeometric_shards": op9_hypergeometric_shards, "op10_pareto_mix": op10_pareto_mix, "op2_simhash_blocks": op2_simhash_blocks, "op6_forced_boundary_bpe": op6_forced_boundary_bpe, "op3_media_transport_stream": op3_media_transport_stream}

OP10_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0 AS u
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3] AS weight
  FROM sizes),
placed AS (
  SELECT *, row_number() OVER r AS place,
    (SELECT sum(source_size) FROM sizes) - coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM weighed WINDOW r AS (ORDER BY CAST(cap AS DOUBLE) / weight, source IS NULL, encode(source))),
judged AS (SELECT *, cap * open <= rest * weight AS capped FROM placed),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE)
    ELSE (SELECT CAST(arg_min(rest, place) AS DOUBLE) FROM judged WHERE NOT capped) * weight / (SELECT CAST(arg_min(open, place) AS DOUBLE) FROM judged WHERE NOT capped) END AS target
  FROM judged),
weights AS (SELECT *, length(bin(size)) AS weight FROM docs),
cells AS (
  SELECT c.source, target, source_size, weight, words,
    coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
    sum(words * weight) OVER (PARTITION BY c.source) - coalesce(sum(words * weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT source, weight, sum(size) AS words FROM weights GROUP BY source, weight) c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW w AS (PARTITION BY c.source ORDER BY weight DESC)),
rates AS (SELECT *, CASE WHEN below > 0 THEN (target - 3e0 * CAST(above AS DOUBLE)) / CAST(below AS DOUBLE) ELSE 0e0 END AS rate FROM cells),
levels AS (SELECT source, max(weight) AS level, arg_max(rate, weight) AS rate FROM rates WHERE NOT rate * weight >= 3e0 GROUP BY source),
due AS (
  SELECT doc_id, d.source, size, r.source_size, r.target, u,
    CASE WHEN r.source_size <= 0 THEN 0e0 WHEN l.level IS NULL OR d.weight > l.level THEN 3e0 ELSE greatest(l.rate * d.weight, 0e0) END AS due
  FROM weights d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source AND d.weight = r.weight LEFT JOIN levels l ON d.source IS NOT DISTINCT FROM l.source),
ranked AS (SELECT *, floor(due) AS whole, due - floor(due) AS p FROM due),
ordered AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u) * (1 - p) / p) / (1 + u / (1 - u) * (1 - p) / p) END AS rank,
    target - sum(size * whole) OVER (PARTITION BY source) AS rest
  FROM ranked),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) AS through FROM ordered)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * least(whole + CASE WHEN p > 0 AND abs(through - rest) < abs(through - size - rest) THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM summed
"""

ORACLE_SQL: dict[str, str] = {"op4_cuckoo_line_dedup": OP4_SQL, "op10_pareto_mix": OP10_SQL}
