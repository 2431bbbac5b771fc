"""From raw documents to training sequences, stage by stage.

Each stage takes the documents that the one before it kept and works on all of
them; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.llm import jaccard, packing, pii, spans, toxicity
from wrenchlake.session import materialise, ready_for_python

_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_length(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*_COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labelled ones, does not call toxic."""
    ready_for_python(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.labelled(docs, labels))
    return toxicity.score(docs.select(*_COLUMNS), model).filter("predicted = 0").select(*_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    ready_for_python(spark)
    return jaccard.first_of_each(docs.select(*_COLUMNS))


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences that repeat an earlier span."""
    ready_for_python(spark)
    return _with_length(spans.remove_repeated(docs.select(*_COLUMNS)))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    ready_for_python(spark)
    return _with_length(pii.redact(docs.select(*_COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences with their token ids."""
    ready_for_python(spark)
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_spans),
    ("pii", redact_personal_data),
    ("packing", pack),
]

# Tokenizers, trained models and 64-bit hashes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
