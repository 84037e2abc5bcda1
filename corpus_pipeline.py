"""From raw documents to token ids, in stages that are written and read again.

Every stage works on all its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantloom.llm import exact_dedup, language_id, mixing, piece_bpe, simhash
from plantloom.llm.tables import packed, read, unpacked
from plantloom.session import materialize

# Python workers outlive a stage, so the last one shares memory with what the others left.
REMEMBERED_PARTS = 1 << 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learnt from the documents' own labels; others go."""
    filters = language_id.learn(docs.filter(~language_id.held_out("doc_id")))
    least = language_id.floors(docs, filters)
    known = language_id.recognizer(spark, filters, least)
    return unpacked(packed(docs, known=known("text")).filter("known"))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-equal fingerprints link."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as their source's target takes them."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its ids, their digest, and the digest of what they decode to."""
    return piece_bpe.digests(docs, REMEMBERED_PARTS)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("simhash_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("piece_encoding", encode_pieces),
]

# Language models, linking and subword merging are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last one written to shared storage."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
