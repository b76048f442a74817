"""Corpus pipeline: toxic documents, near-duplicates, repeated passages and
benchmark leaks go; what stays is encoded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``. Extra columns are kept. Rows
with a null ``doc_id`` or text pass the stages that have nothing to judge them
by. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import toxicity
from tidewater.llm.byte_bpe import DIGESTS, bpe_encode, digest_columns
from tidewater.llm.common import keep, small_batches, table
from tidewater.llm.decontaminate import contained_items
from tidewater.llm.minhash_dedup import near_duplicates
from tidewater.llm.suffix_dedup import remove_repeats


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns besides ``doc_id`` and ``text`` under names that clash with no operator's."""
    names = {c: f"__carried_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5."""
    small_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    hidden, names = _aside(docs)
    clean = hidden.withColumn("__toxic", toxicity.scorer(spark, model)(F.col("text"))).where("__toxic < 0.5")
    return clean.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; rows of one id stay together."""
    small_batches(spark)
    gone = near_duplicates(docs).where("NOT kept").selectExpr("id AS doc_id")
    return docs.join(keep(gone, "pipeline-copies"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier text has; texts of which nothing is left go."""
    small_batches(spark)
    hidden, names = _aside(docs)
    left = remove_repeats(hidden, carry=tuple(names.values()), as_text=True).where("n_removed = 0 OR trim(kept) <> ''")
    made = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return left.select(*[made.get(c, F.col(names.get(c, c))).alias(c) for c in docs.columns])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; a row without an id is judged by its own text."""
    small_batches(spark)
    hidden, names = _aside(docs)
    keyed = hidden.withColumn("__key", F.expr("IF(doc_id IS NULL, concat('text ', sha2(text, 256)), cast(doc_id AS string))"))
    leaks = contained_items(keyed.selectExpr("__key AS doc_id", "text"), table(spark, sf_dir, "benchmark")).selectExpr(
        "doc_id AS __key").distinct()
    left = keyed.join(keep(leaks, "pipeline-leaks"), "__key", "left_anti")
    return left.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with counts and digests."""
    small_batches(spark)
    import public_tokenizers as vocabulary
    return bpe_encode(docs, vocabulary.path("byte_bpe_50k.tiktoken"), vocabulary.PATTERN, then=digest_columns, columns=DIGESTS,
                      share=0.4)  # the workers hold what earlier stages left, too


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("decontaminate", drop_benchmark_leaks),
    ("byte_bpe", encode),
]

#: The stages learn weights, link copies and encode by merges, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
