"""A corpus pipeline of operators from ``sondage.llm``: language, near-duplicates, personal data, mixture, token ids.

Every stage takes all that its predecessor kept. Its result is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.llm import bagminhash, langid, mixing, pii, sentencepieces
from sondage.llm.queries import PII_KEY, tokenizer_file
from sondage.llm.shared import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept (operator 10); texts without a letter go."""
    return langid.accepted(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 8)."""
    return bagminhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates (operator 2)."""
    out = pii.replaced(docs, PII_KEY, count=None)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them (operator 5)."""
    return mixing.repeated(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document of the mix (operator 6)."""
    return sentencepieces.encoded(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

#: The stages train models, sign texts and search segmentations, which SQL can't express; a test holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
