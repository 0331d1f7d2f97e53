"""A training corpus from raw documents: toxic ones go, then repeated lines, then near copies; sources are mixed, and the rest is tokenized.

Each stage works on all that the one before kept, written as Parquet and read again. All stages take a table without rows and give one; other columns than text, doc_id and source are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import lines, mixing, neardup, pieces, toxicity
from cardloom.llm.common import cut, held_out, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples don't call toxic. Null and empty texts have no terms and get the score of such texts; repeated rows stay or go together; of equal cosines the example that stands first in the index comes first."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return toxicity.clean(docs, docs, labels)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each line that is alike another kept once; n_chars follows the text. Null texts stay null and empty ones empty; of alike lines the first by doc_id, text version and place stays, null ids last."""
    kept = lines.without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, and of these one of each that share 0.8 of their five-word shingles or more: the smallest doc_id, null ids last. Of null texts and texts without a word one stays; of rows that repeat doc_id and text one stays."""
    return neardup.alone(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for. Null, empty and blank texts have size 0 and aren't taken; a null source is a source, the last; repeated rows are rounded like single ones; chance comes from hashes, so ties need no rule."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text. A null text gives null ids, an empty one none; repeated rows get equal ids."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix),
    ("sentencepiece", tokenize),
]

#: SQL can't express the stages (nearest neighbours, MinHash components, hashed rounding, a tokenizer); tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
