"""From raw documents to token identifiers: rules, near duplicates, personal data, mixture, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs;
all but the last return the columns of documents. Null and empty texts fall to the rules; rows that repeat a document are
near duplicates of it; columns that documents have besides are carried along, whatever their names. An empty table is one after
every stage. Texts of any length are handled whole, each within one task.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skein.llm import byte_bpe, common, jaccard, mixing, pii, quality_rules

#: Near duplicates: similarity in hundredths and words of a shingle.
NEAR, NEAR_WORDS = 80, 5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the log-likelihood ratio keep. Repeated rows are judged alike, a ratio equal to the
    threshold keeps its text, without labels only the base rules speak; null and empty texts have too few words."""
    trusted = quality_rules.trusted_ids(common.table(spark, sf_dir, "labels"))
    return quality_rules.kept_rows(docs, trusted)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id (of rows with one id the one of the smallest
    hash, without any id one of them); rows without words, null texts included, all stay."""
    return jaccard.one_of_each(docs, NEAR, NEAR_WORDS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kinds; null texts stay null, overlapping spans are one, and a text
    with any number of spans costs its length."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or parts and repetitions of them, that the mixture takes; rows equal in id, size and checksum are ordered
    arbitrarily, texts without words are taken by none."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids, decoded of every text, repeated rows each for itself; null is empty."""
    return byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The ratios rest on a hash, the mixture on a random generator that SQL doesn't have: tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.written(docs)
    return docs
