"""A corpus pipeline of the operators in ``stagewright.llm``.

Each stage takes the session, the documents that its predecessor kept and the folder of the tables,
and returns a frame; all but the last return the columns of the documents. ``run`` writes every
stage's result as parquet in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewright.llm import mixing, pieces, secrets, simhash, toxicity
from stagewright.llm.common import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on the labels of the folder, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    return simhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret masked; none is dropped."""
    return secrets.redact(docs, written(secrets.scan(docs), "ledger"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix draws them."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their SentencePiece ids in ``pieces`` and their number in ``n_pieces``."""
    coded = pieces.with_pieces(docs)
    return coded.withColumn("n_pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: A trained classifier and hashed fingerprints decide, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the folder through every stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
