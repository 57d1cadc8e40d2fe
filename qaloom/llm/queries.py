"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm import extraction, lines, mixing, pieces, pii, quality, simhash, token_counts, turns, urls, variants, vectors, warc

from qaloom.session import work_path

Query = Callable[[SparkSession, str], DataFrame]


def piece_model() -> str:
    """Where the public 32k piece model lies."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.simhash_groups(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loading all documents, recounting without license lines, and taking toxic ones out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    ledger = token_counts.TokenLedger(spark, work_path(spark, "token-ledger"))
    rows = token_counts.counted_rows
    load = rows(docs, "insert", "words-1").unionByName(rows(docs, "insert", "words-2"))
    ledger.apply("load", load)
    licensed = docs.where(F.col("text").contains(LICENSE))
    trimmed = F.array_join(F.filter(F.split("text", "\n"), lambda line: ~line.contains(LICENSE)), "\n")
    ledger.apply("trim", rows(licensed, "revise", "words-1", trimmed))
    toxic = labels.where("toxic = 1 AND doc_id IS NOT NULL")
    gone = token_counts.deletions(toxic, "words-2")
    ledger.apply("takedown", gone)
    ledger.apply("load", load)  # a batch that comes again changes nothing
    return ledger.totals()


LICENSE = "Licensed under"

SQL_OP2 = f"""WITH counted AS (
  SELECT 'words-1' AS tokenizer, source, lang, len(regexp_extract_all(
    CASE WHEN contains(text, '{LICENSE}') THEN array_to_string(
      list_filter(string_split(text, chr(10)), lambda x: NOT contains(x, '{LICENSE}')), chr(10))
    ELSE coalesce(text, '') END, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM documents
  UNION ALL
  SELECT 'words-2', source, lang, len(regexp_extract_all(coalesce(text, ''), '[\\p{{L}}\\p{{N}}]+'))
  FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.toxic = 1 AND l.doc_id = d.doc_id))
SELECT tokenizer, source, lang, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counted GROUP BY ALL"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many boilerplate lines each document loses, and the hash of what stays."""
    return lines.drop_boilerplate(read(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_dropped",
        F.md5(F.coalesce("clean", F.lit(""))).alias("clean_md5"),
    )


SQL_OP3 = f"""WITH line AS (
  SELECT doc_id, source, unnest(range(len(parts))) AS i, unnest(parts) AS line
  FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
boilerplate AS (
  SELECT trim(line) AS k, min(doc_id) AS first_id FROM line
  WHERE trim(line) <> '' AND source IS NOT NULL
  GROUP BY 1 HAVING count(DISTINCT source) >= {lines.MIN_SITES}),
marked AS (
  SELECT doc_id, i, line, k IS NOT NULL AND (first_id IS NULL OR doc_id <> first_id) AS gone
  FROM line LEFT JOIN boilerplate ON trim(line) = k)
SELECT doc_id, count(*) FILTER (gone) AS n_dropped,
  md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS clean_md5
FROM marked GROUP BY doc_id"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and hash, and all spans."""
    found = pii.personal_data(read(spark, sf_dir, "documents"))

    def count(k: int, kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(count(k, kind) for k, kind in enumerate(pii.KINDS)),
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and the mixing rate of every document."""
    rated = mixing.mixing_rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rated.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        *(F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(mixing.TARGETS)),
        "rate",
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, and hashes of its ids and of the decoded text."""
    return pieces.round_trip(read(spark, sf_dir, "documents"), piece_model()).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return urls.judge_urls(read(spark, sf_dir, "pages"), keep=("page_id",))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances and verdicts of every document."""
    return quality.quality(read(spark, sf_dir, "documents")).withColumnRenamed("row_id", "doc_id")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extraction.extract(read(spark, sf_dir, "pages"), keep=("url",)).select(
        F.col("id").alias("page_id"), F.col("row.url").alias("url"), "text", F.length("text").cast("long").alias("n_chars")
    )


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return vectors.vector_groups(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back."""
    path = work_path(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    found = warc.page_records(warc.read_archive(spark, path))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of damaged conversations and their cheapest repair."""
    conversations = read(spark, sf_dir, "conversations")
    return turns.repair_report(turns.damaged(conversations), conversations)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents, the near words they have and the form each stands for."""
    found = variants.spelling_variants(variants.word_counts(read(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_line_dedup": op3_line_dedup,
    "op4_pii": op4_pii,
    "op5_mixing": op5_mixing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_url_filters": op7_url_filters,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_warc": op11_warc,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op2_token_counts": SQL_OP2,
    "op3_line_dedup": SQL_OP3,
    "op7_url_filters": urls.judge_sql(),
    "op11_warc": warc.JUDGE_SQL,
}
