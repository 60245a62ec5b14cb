"""From raw documents to training sequences, in five stages.

Each stage is written as Parquet to the shared folder and read again as the next one's input, so a
lost executor costs no more than the running stage. All stages but the last return the columns of
documents:

1. quality rules drop the documents that they reject;
2. near-duplicate detection keeps one document of each group;
3. the secret scan replaces each secret by a mark;
4. mixing samples documents to their sources' target weights: a row per epoch, and the document at the edge of a
   fraction is cut to the words that are left;
5. packing lays the documents along a curve and cuts them into sequences; it returns a row per piece.

Null texts fail the quality rules. Repeated rows are exact copies, of which one stays. Extra columns are carried
along unread. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import minhash, mixing, packing, rules, secrets
from sievework.session import stored


def _measured_again(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage has changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rules.filter_documents(docs, rules.fit_rules(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured_again(secrets.redact(docs, secrets.fit_field(docs)))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured_again(mixing.mix(docs))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mixing", source_mixing),
    ("packing", sequence_packing),
]
# The field, the signatures and the tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
