"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import chat, exact_dedup, langid, mixing, packing, phrases, secrets, simhash, toxicity, url_filter
from tracewright.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), tokens=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"), width=4, distance=4).select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.trap(spark))
    return chat.digests(chat.format_chats(rows))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of().alias("domain"))
    return mixing.rates(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def fold(doc_id: str, n: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % n


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit_by_labels(docs, labels.filter(fold("doc_id", 4) != 2))
    found = toxicity.score(docs, model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(fold("doc_id", 3) != 1))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.compare_edited(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(table(spark, sf_dir, "documents")).drop("row_no")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_url_filter, op3_secret_scan, op4_simhash, op5_chat_format, op6_mixing, op7_toxicity, op8_language_id, op9_phrases, op10_exact_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": url_filter.vocabulary_sql(),
        "op5_chat_format": chat.DIGESTS_SQL,
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    }
