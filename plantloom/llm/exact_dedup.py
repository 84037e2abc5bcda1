"""Exact duplicates, with frequent texts settled before the shuffle.

Texts are equal when they are after each run of ASCII white space became one
space; a SHA-256 digest stands for the text. A Misra-Gries summary (Spark's
``freqItems``) names at most ``1 / SHARE`` digests, among them every one that
more than ``SHARE`` of all rows have. Their exact counts and winners come from
one aggregation with a row per task and digest, are at most that many rows, and
are broadcast: rows of frequent texts are decided, or removed, where they lie.
All other digests go through an ordinary shuffle.

DataFrame functions only. Defined results: null counts as empty, so null and
empty texts are one group, and texts of white space only (one space) another;
the smallest id stays, nulls last; of repeated rows with that id exactly one
stays. Where all ids of a group are null, ``keep_id`` is null and one row stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.tables import first_in_group, packed, quoted, read, text_of, unpacked
from plantloom.session import materialize

SPACES = r"[\x20\x09-\x0D]+"
SHARE = 1 / 256


def digest_of(text: Column) -> Column:
    """Digest of the normalised text, as hex."""
    return F.sha2(F.regexp_replace(text_of(text), SPACES, " ").cast("binary"), 256)


def frequent(digests: DataFrame) -> DataFrame:
    """At most ``1 / SHARE`` values of column ``digest``, among them all frequent ones."""
    found = digests.stat.freqItems(["digest"], SHARE)
    return found.select(F.explode("digest_freqItems").alias("digest"))


def _winner() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row_no"))


def _settled(rows: DataFrame) -> DataFrame:
    """Per digest its number of rows and its winner."""
    return rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), _winner().alias("w")).select(
        "digest", "group_size", F.col("w.doc_id").alias("keep_id"), F.col("w.row_no").alias("keep_no"))


def decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, digest."""
    rows = materialize(docs.select(
        quoted(doc_id).alias("doc_id"), digest_of(quoted(text)).alias("digest"),
        F.monotonically_increasing_id().alias("row_no")))
    heavy = materialize(_settled(rows.join(F.broadcast(frequent(rows)), "digest", "left_semi")))
    here = rows.join(F.broadcast(heavy), "digest")
    others = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    settled = _settled(others).withColumnRenamed("digest", "_digest")
    # null-safe: another key than the grouping's, so both sides are shuffled and can be split
    there = others.join(settled, F.col("digest").eqNullSafe(F.col("_digest"))).drop("_digest")
    return here.unionByName(there).select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_no")).alias("kept"), "digest")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, same columns, of which one of each group of equal texts stays."""
    slim = materialize(docs.select(quoted(doc_id).alias("doc_id"), digest_of(quoted(text)).alias("digest")))
    heavy = materialize(
        slim.join(F.broadcast(frequent(slim)), "digest", "left_semi").groupBy("digest").agg(
            F.min("doc_id").alias("keep_id")))
    rows = packed(docs, doc_id=quoted(doc_id), digest=digest_of(quoted(text)))
    rows = rows.join(F.broadcast(heavy.withColumn("heavy", F.lit(True))), "digest", "left").filter(
        F.col("heavy").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return unpacked(first_in_group(rows.select("row", "doc_id", "digest"), [F.col("digest")],
                                   [F.col("doc_id").isNull(), F.col("doc_id")]))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What happens to every document."""
    return decisions(read(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
