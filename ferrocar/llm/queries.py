"""The registered queries of the operators, and the SQL of those that SQL can express."""

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrocar.llm import (
    chat,
    common,
    decontaminate,
    extract,
    jaccard,
    merkle,
    neighbours,
    quality,
    sentencepiece,
    simhash,
    spelling,
    tokenfile,
    toxicity,
    warc,
)
from ferrocar.session import apply_settings

# Where the public tokenizers' files lie; the same on every machine.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return sentencepiece.tokenised(common.table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


PROBE = "</s>[INST] ok [/INST]"
CHAT_SQL = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{PROBE}'
    UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), told AS (
    SELECT
        conv_id,
        count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
        -- Marks by role, a backslash doubled, one more for each control string.
        sum(CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 24 + length(role) END
            + length(text) + length(text) - length(replace(text, chr(92), ''))
            + len(regexp_extract_all(text, '(<|\\[)(/?s>|</?SYS>>|/?INST\\]|/?ROLE\\]|/?TURN\\])'))) AS formatted_chars
    FROM rows GROUP BY conv_id
)
SELECT
    conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars,
    sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM told
"""


@query
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, with digests of what is read back; -1 says control strings."""
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PROBE)
    )
    return chat.digests(rows.union(probe))


SQL["op2_chat"] = CHAT_SQL


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to range-coded files and read back."""
    return tokenfile.summary(common.table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, with the items."""
    return decontaminate.matches(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


WARC_SQL = """
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha,
        min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages
), digits AS (
    -- Five hexadecimal digits are four of base 32.
    SELECT *, [CAST('0x' || substr(sha, 5 * CAST(g AS INTEGER) + 1, 5) AS BIGINT) FOR g IN range(0, 8)] AS groups FROM rows
)
SELECT
    page_id,
    CAST(strlen(html) AS BIGINT) AS payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((groups[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1) FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM digits
"""


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of normalised archives, read back by offset."""
    rows = warc.archived(common.table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_warc"] = WARC_SQL


@query
def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extracted(common.table(spark, sf_dir, "pages"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its labelled neighbours."""
    return quality.scored(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return neighbours.nearest(common.table(spark, sf_dir, "embeddings"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from confirmed and unlabelled texts."""
    return toxicity.scored(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-copies of every document."""
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its tampered leaf still folds to the root."""
    rows = merkle.manifest(common.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source")


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling.variants(common.table(spark, sf_dir, "documents"))


@query
def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and group of near-copies by 5-word shingles of every document."""
    return jaccard.near_duplicates(common.table(spark, sf_dir, "documents"))
