"""Corpus pipeline: toxicity, near copies, benchmark passages, personal data, token ids.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; ``run`` writes each stage's rows to the shared
folder and reads them again, so a later stage never repeats an earlier one.  The stages keep the columns of ``documents``; the last
returns doc_id, ids and their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import bpe, decontaminate, near_dups, pii, toxicity
from lamina.llm.common import small_batches
from lamina.llm.queries import PII_KEY, held_out
from lamina.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    classifier = toxicity.train(docs, labels, use=~held_out(F.col("doc_id")))
    return toxicity.score(docs, classifier).where("NOT toxic").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity 0.8."""
    small_batches(spark)
    return near_dups.drop_near_duplicates(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark words."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data under keyed pseudonyms, and the length of the text brought up to date."""
    masked = pii.pseudonymise(docs, key=PII_KEY, count="__n_pii")
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("__n_pii") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their number for every document left."""
    import public_tokenizers

    small_batches(spark)
    # ids take the place of the text, which isn't handed back
    coded = bpe.encode(docs.select("doc_id", F.col("text").alias("ids")), public_tokenizers.path("word_bpe_49k.json"), text="ids", room=100_000)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("near_dups", drop_near_copies), ("decontaminate", drop_benchmark), ("pii", mask_private), ("bpe", encode)]

# A trained classifier and a tokenizer file are beyond SQL; tests hold the rows after near copies and after all stages
# against brute force on a table whose toxicity stage rejects nothing, and the classifier against labels of made-up texts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
