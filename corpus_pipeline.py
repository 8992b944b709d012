"""From raw documents to training tokens: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.llm import decontaminate, quality, secrets, sentencepiece, simhash
from quillmine.llm.common import goes_with_driver, passing, scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose probability of good quality is under 0.3.

    Null and empty texts have the probability that no word tells; repeated rows are judged alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays.

    Null and empty texts are one group; null ids come last, and one of repeated rows stays."""
    return simhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold ten consecutive words of a benchmark item, or a whole shorter one.

    Null and empty texts hold none; repeated rows stay or go together."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; all documents stay, and n_chars is that of the text as it is now.

    Null and empty texts stay as they are; repeated rows are masked alike."""
    masked = secrets.mask(docs, secrets.scanner_of(docs))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text; null texts have none, as empty ones."""
    return sentencepiece.encode(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scan", secret_scan),
    ("SentencePiece tokens", sentencepiece_tokens),
]

#: Neither the classifier nor the forest nor the tokenizer can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again.

    A stage's intermediate tables go when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, "stage-" + name.replace(" ", "-"))
        with passing(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        goes_with_driver(spark, path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
