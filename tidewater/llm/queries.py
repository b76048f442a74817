"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, conversation_repair, language_id, phrase_mining, quality_rules, toxicity
from .byte_bpe import DIGESTS, bpe_encode, digest_columns
from .common import small_batches, table
from .decontaminate import ORACLE as LEAKS, contained_items
from .embedding_dedup import near_duplicate_vectors
from .html_extract import extract
from .minhash_dedup import near_duplicates
from .suffix_dedup import remove_repeats
from .url_filter import judge_urls


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)
    return out.selectExpr("id AS doc_id", "n_shingles", "component AS component_id", "kept")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabulary
    ranks = vocabulary.path("byte_bpe_50k.tiktoken")
    return bpe_encode(table(spark, sf_dir, "documents"), ranks, vocabulary.PATTERN, then=digest_columns, columns=DIGESTS,
                      take=("n_tokens", "ids_sha256", "decoded_sha256"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings")).selectExpr(
        "id AS vec_id", "n_links", "component AS component_id", "kept")


#: Verdict, and host + path.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role",
                                     f"'{control}' AS text")
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(more)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = "crc32(cast(doc_id AS string)) % 4 = 2"
    model = language_id.fit(*language_id.training_sample(docs, f"NOT {held_out}"))
    return language_id.identify(docs, model).selectExpr(
        "doc_id", f"coalesce({held_out}, false) AS held_out", "lang_pred", "score")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = "crc32(cast(doc_id AS string)) % 5 = 0"
    model = toxicity.learn(docs, labels, f"NOT {held_out}")
    return toxicity.toxicity(docs, model).selectExpr(
        "doc_id", f"coalesce({held_out}, false) AS held_out", "score", "predicted", "sentences")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.round("containment", 6))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def _query(f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return f(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _query(f) for f in (
        op1_minhash_near_dedup, op2_byte_bpe, op3_embedding_near_dedup, op4_url_filter, op5_chat_format,
        op6_language_id, op7_suffix_dedup, op8_html_extract, op9_toxicity, op10_decontaminate,
        op11_phrase_collocations, op12_quality_rules, op13_conversation_repair)
}

ORACLES: dict[str, str] = {"op5_chat_format": chat_format.ORACLE, "op10_decontaminate": LEAKS,
                           "op11_phrase_collocations": phrase_mining.ORACLE, "op12_quality_rules": quality_rules.ORACLE}
