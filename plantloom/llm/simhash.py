"""Near duplicates by SimHash and multi-index hashing.

A fingerprint holds, for each of 64 bits, whether it is set in more than half of
the hashes of a text's shingles. Fingerprints that differ in at most two bits
are linked; a group is what links connect.

Index: a fingerprint is two segments of 32 bits. Two bits at most differ, so
either the first segments differ in at most one bit, or the second ones are
equal. Every distinct fingerprint is filed under each segment, and asks for the
33 values within one bit of its first segment and for its own second segment.
A pair one bit apart is asked for from the side whose bit is not set only, which
halves the questions. What comes back is verified over all 64 bits.

A segment shared by more than ``CROWD`` distinct fingerprints would answer with
all of them. Links into such a crowd are found without candidates instead: the
asking fingerprint names every complete fingerprint within the remaining
distance (a Hamming ball of the other segment), and an equi-join on all 64 bits
answers. The outcome is the same, so ``CROWD`` only trades one cost for another.

Defined results: null counts as empty; texts without words have fingerprint zero
and are linked like any other; repeated rows and equal texts share a fingerprint
and so a group. ``component_id`` is the smallest id of the group, nulls aside;
a group of null ids only has null.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.components import components
from plantloom.llm.tables import (first_in_group, packed, quoted, read, ready_for_python,
                                  unpacked)
from plantloom.session import materialize

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWD = 256
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Hashes whose bits are counted at a time.
CHUNK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint, unsigned."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return 0
    # one string of all words; a shingle is the slice from its first to its last
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    total, digest, counts = len(ends), xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(
            starts[at:min(at + CHUNK, total)], ends[at:at + CHUNK])], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > total)
    return int.from_bytes(set_bits.tobytes(), "big")


def fingerprints(spark: SparkSession, shingle: int = SHINGLE):
    """A column function text -> fingerprint as signed long."""
    ready_for_python(spark)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return simhash


def _first(c: str) -> Column:
    return F.shiftrightunsigned(c, 32)


def _second(c: str) -> Column:
    return F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))


def _bit(i: int) -> Column:
    return F.lit(1 << i if i < 63 else -(1 << 63))


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _flipped(c: str, bits: Iterable[int], most: int) -> Column:
    """All values of ``c`` with at most ``most`` (0, 1 or 2) of the bits changed, as an array."""
    bits = list(bits)
    masks = [0]
    if most > 0:
        masks += [1 << i for i in bits]
    if most > 1:
        masks += [1 << i | 1 << j for n, i in enumerate(bits) for j in bits[n + 1:]]
    known = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)) for m in masks])
    return F.transform(known, lambda m: F.col(c).bitwiseXOR(m))


def links(distinct: DataFrame) -> DataFrame:
    """Pairs a < b of the distinct fingerprints ``fp`` that differ in one or two bits."""
    low = range(32)
    filed = distinct.select("fp", F.explode(F.array(
        F.struct(F.lit(1).alias("part"), _first("fp").alias("value")),
        F.struct(F.lit(2).alias("part"), _second("fp").alias("value")))).alias("k")).select(
        "fp", "k.part", "k.value")
    crowds = materialize(filed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > CROWD).select("part", "value"))
    # first segments equal or one bit apart, the latter asked from the side without the bit
    near = F.concat(F.array(_first("fp")), F.filter(F.array(*[F.when(
        F.col("fp").bitwiseAND(_bit(32 + i)) == 0,
        _first("fp").bitwiseOR(F.lit(1 << i))) for i in low]), lambda v: v.isNotNull()))
    asked = distinct.select("fp", F.explode(F.concat(
        F.transform(near, lambda v: F.struct(F.lit(1).alias("part"), v.alias("value"))),
        F.array(F.struct(F.lit(2).alias("part"), _second("fp").alias("value"))))).alias("k")).select(
        F.col("fp").alias("asks"), "k.part", "k.value")
    key = ["part", "value"]
    found = (asked.join(filed.join(crowds, key, "left_anti"), key)
             .filter((F.col("asks") != F.col("fp")) & (_apart("asks", "fp") <= DISTANCE))
             .select(F.col("asks").alias("x"), F.col("fp").alias("y")))
    # answers from crowds: complete fingerprints within what distance remains
    to_crowd = materialize(asked.join(crowds, key, "left_semi"))
    same = to_crowd.filter((F.col("part") == 1) & (F.col("value") == _first("asks")))
    beside = to_crowd.filter((F.col("part") == 1) & (F.col("value") != _first("asks"))).select(
        "asks", F.shiftleft("value", 32).bitwiseOR(_second("asks")).alias("moved"))
    second = to_crowd.filter(F.col("part") == 2)
    named = (same.select("asks", F.explode(_flipped("asks", low, 2)).alias("fp"))
             .union(beside.select("asks", F.explode(_flipped("moved", low, 1)).alias("fp")))
             .union(second.select("asks", F.explode(_flipped("asks", range(32, 64), 2)).alias("fp"))))
    exact = named.filter("asks <> fp").join(distinct, "fp").select(
        F.col("asks").alias("x"), F.col("fp").alias("y"))
    return found.union(exact).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, fp, group, component_id) per row; ``group`` is a fingerprint of the group.

    Ids may be null or occur in several groups, so ``group`` is what tells groups apart.
    """
    return _grouped(materialize(docs.select(
        quoted(doc_id).alias("doc_id"),
        fingerprints(docs.sparkSession, shingle)(quoted(text)).alias("fp"))))


def _grouped(rows: DataFrame) -> DataFrame:
    """Written rows with ``doc_id`` and ``fp``, and their ``group`` and ``component_id``."""
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(distinct.select("fp")))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = rooted.join(least, "root").select("fp", F.col("root").alias("group"), "component_id")
    # null-safe, so that the join is shuffled anew and a heavy fingerprint can be split
    return rows.join(groups.withColumnRenamed("fp", "_fp"),
                     F.col("fp").eqNullSafe(F.col("_fp"))).drop("_fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, same columns, of which one of each group stays: the smallest id.

    Of several rows with that id the first by a hash of all values stays. Groups
    are decided on narrow rows, written once, in which two hashes stand for a
    row; the documents are shuffled once, by these.
    """
    rows = packed(docs, doc_id=quoted(doc_id), text=quoted(text))
    own = {f"h{n}": F.xxhash64(F.lit(n), "row") for n in (1, 2)}
    narrow = materialize(rows.select(
        "doc_id", fingerprints(docs.sparkSession)("text").alias("fp"),
        *[h.alias(n) for n, h in own.items()]))
    stays = _grouped(narrow).groupBy("group").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no"), "doc_id", *own)).alias("w")).select("w.h1", "w.h2")
    # rows equal in everything go first, in the map tasks already
    distinct = first_in_group(packed(docs).withColumns(own), [F.col(h) for h in own], [])
    return unpacked(distinct.join(stays, list(own), "left_semi"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
