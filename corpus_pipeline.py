"""From raw documents to token ids: five stages, each calling one operator of
``ordermart.llm``.

Every stage works on all rows its predecessor kept and its decisions take
effect: a document without a known language goes, one document of each
near-duplicate group stays, documents that hold a benchmark item go, personal
data is taken out of the texts, and what is left is encoded.  Each result is
written as Parquet to the shared scratch folder and read back by the next
stage, so a lost executor costs a stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermart.llm import bpe, decontam, langid, pii, simhash
from ordermart.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the labelled ones."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.accepted(docs, model)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest id."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and disclosing terms taken out; n_chars
    follows the new text."""
    clean = pii.sanitise(docs, support=1, unit="document")
    n_chars = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    return clean.select(*[n_chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with digests of them and of the text
    decoded from them."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("pii_removal", pii_removal),
    ("bpe_encoding", bpe_encoding),
]

#: Fingerprints, Viterbi labels and merges are beyond SQL; tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
