"""The corpus pipeline: raw documents to token ids, a stage at a time.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads it as a table in the
shared folder. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import bpe, exact, mixing, near, rules
from tributary.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy keeps, by the bits of their ledger entries.

    A null or empty text has no words, so it goes; repeated rows are judged alike and all stay or go; an empty table stays
    empty; extra columns pass through, whatever their names.
    """
    return rules.passing(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text (A-Z in lower case), the one with the largest doc_id.

    Null and empty texts are one text; a null doc_id is less than any other; of rows that have the same doc_id too, the
    one with the least key of its exact text stays, and of equal rows one; an empty table stays empty; extra columns pass
    through.
    """
    return exact.distinct_texts(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least doc_id.

    A text without words, null or empty, is a class of its own row; ties between rows of one doc_id are settled by the key
    of the text, and of equal rows one stays; an empty table stays empty; extra columns pass through.
    """
    return near.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in whole documents, 0 to 3 times.

    A null source is a source of its own; texts without words, null or empty, are in no mix; rows that agree in doc_id and text
    share what they are taken; an empty table stays empty; extra columns pass through.
    """
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, n_tokens, ids (packed, four bytes each) and digests.

    A null text counts as empty, which has no ids; repeated rows are encoded alike; an empty table gives no rows; extra
    columns are not read.
    """
    rows = bpe.encoded(docs, bpe.VOCABULARY)
    return rows.select("doc_id", "ids", *bpe.digest_columns())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

#: The stages' hashes, signatures and merges are beyond SQL; tests hold the rows against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's output written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
