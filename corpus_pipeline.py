"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and returns a frame that
is written as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``. Rows keep their ``doc_id``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import decontam, jaccard, packing, pii, toxicity
from tallyline.llm.common import table
from tallyline.session import materialize, scratch_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from ``labels``, does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (five-word shingles, similarity 0.8): the one with the
    smallest ``doc_id``. Equal rows count once; rows without an id are kept."""
    found = jaccard.join(docs, size=5, percent=80)
    first = found.where("component_id = doc_id").select("doc_id")
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with ``benchmark``."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the names of its kinds."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", remove_benchmark),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: The toxicity model is learned, and near duplicates are a transitive closure: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with scratch_scope(spark):
        for i, (name, stage) in enumerate(STAGES):
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=i == len(STAGES) - 1)
    return docs
