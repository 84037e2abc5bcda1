"""Mixing sources to target weights along a low-discrepancy schedule.

Targets: sources, by code point with null last, share all words by weight; none
gets more than ``EPOCHS`` times what it has, and what it cannot take is shared
among the others by weight.

Schedule: the mix is a row of slots of about ``BLOCK`` words. Slot i lies at the
golden-ratio point frac(i * phi); cumulative targets divide the unit interval
among the sources, and the point's place names the slot's source. Any stretch of
slots thus holds the sources close to their shares. A source's slots are ranked.

Blocks: each source's documents are shuffled (ordered by a hash) and laid end to
end, ``EPOCHS`` times over. That line, up to the source's target, is cut into as
many equal blocks as the source has slots, and the slot of rank j gets block j.
A document stands in the mix where its first word's slot is, once per epoch.

Nothing but the recipe (a row per source) is gathered. Ranks and positions are
running sums, taken within small ranges and then over the ranges' totals, so
that no task holds a source.

Defined results: null text has size 0; documents of size 0 are taken 0 words;
an empty table has an empty mix; repeated rows are documents of their own. The
outcome is a function of the rows' values, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantloom.llm.tables import packed, quoted, read, ready_for_python, text_of, unpacked
from plantloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
EPOCHS = 3
BLOCK = 1024
SEED = 7
# Slots per range, and ranges of each source's shuffled line.
SLOT_RANGE = 1 << 16
LINE_RANGES = 1 << 12
# Slots a file of the laid out mix holds at most, some 16 million words.
FILE_SLOTS = 1 << 14
# The golden ratio's fraction to 30 digits (fixed value), and 2**20 times it, less its whole part.
PHI = Fraction("0.618033988749894848204586834366")
PHI_STEP = float(PHI)
PHI_LEAP = float((PHI * (1 << 20)) % 1)


@dataclass(frozen=True)
class Share:
    """One source's part of the recipe."""

    number: int
    source: str | None
    size: int
    weight: int
    target: float

    @property
    def quota(self) -> int:
        """Whole words to take, at most ``EPOCHS`` times what there is."""
        return min(round(self.target), EPOCHS * self.size)


def recipe(sizes: dict[str | None, int], weights=WEIGHTS, epochs: int = EPOCHS) -> list[Share]:
    """Targets of the sources: all words by weight, capped, the excess reshared."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_weight, level = float(sum(sizes.values())), float(sum(weight.values())), 0.0
    # the sources that reach their cap first, first; the rest share what is left
    for s in sorted(names, key=lambda s: epochs * sizes[s] / weight[s]):
        level = left / open_weight
        if epochs * sizes[s] / weight[s] >= level:
            break
        left -= epochs * sizes[s]
        open_weight -= weight[s]
    return [Share(i, s, sizes[s], weight[s], min(float(epochs * sizes[s]), level * weight[s]))
            for i, s in enumerate(names)]


def sized(docs: DataFrame, text: str, source: str, doc_id: str, **more: Column) -> DataFrame:
    """A row per document, written once: number, source, words, place in the shuffle."""
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("row_no"), quoted(doc_id).alias("doc_id"),
        quoted(source).alias("source"),
        F.regexp_count(text_of(quoted(text)), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(SEED), quoted(doc_id), quoted(text)).alias("key"),
        *[c.alias(n) for n, c in more.items()]))


def schedule(spark: SparkSession, shares: list[Share], block: int = BLOCK) -> DataFrame:
    """Slots (slot, number, rank): the source of each slot and its rank there.

    Every source has one slot more at the end, so that none goes without.
    """
    ready_for_python(spark)
    total = sum(s.quota for s in shares)
    slots = -(-total // block)
    bounds = np.cumsum([s.quota for s in shares]) / max(total, 1)

    @F.pandas_udf("int")
    def source_at(points: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, points.to_numpy(), side="right")
        return pd.Series(np.minimum(found, len(bounds) - 1).astype(np.int32))

    # i * phi in two parts, each small enough to keep its fraction
    point = F.pmod(F.shiftright("id", 20) * F.lit(PHI_LEAP)
                   + F.col("id").bitwiseAND(F.lit((1 << 20) - 1)) * F.lit(PHI_STEP), F.lit(1.0))
    drawn = spark.range(slots).select(F.col("id").alias("slot"), source_at(point).alias("number"))
    ends = spark.range(len(shares)).select((F.col("id") + slots).alias("slot"),
                                           F.col("id").cast("int").alias("number"))
    rows = drawn.union(ends).withColumn("part", F.shiftright("slot", SLOT_RANGE.bit_length() - 1))
    parts = rows.groupBy("number", "part").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("number", "part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy("number", "part").orderBy("slot"))
    return rows.withColumn("here", here - 1).join(parts, ["number", "part"]).select(
        "slot", "number", (F.col("before") + F.col("here")).alias("rank"))


def _recipe_table(spark: SparkSession, shares: list[Share], slots: dict[int, int]) -> DataFrame:
    rows = [(s.number, s.source, s.size, s.target, s.quota,
             max(1, -(-s.quota // slots.get(s.number, 1)))) for s in shares]
    return spark.createDataFrame(
        rows, "number int, source string, source_size long, target double, quota long, step long")


def mix(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """From ``sized`` rows: the recipe as a table, and the pieces of the mix.

    A piece (slot, row_no, epoch, at, start, end) is a run of words of a document
    that begins at word ``at`` of its source's line.
    """
    spark = rows.sparkSession
    sizes = {r.source: r.n for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    shares = recipe(sizes)
    slots = materialize(schedule(spark, shares, block))
    counts = {r.number: r.n for r in slots.groupBy("number").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = _recipe_table(spark, shares, counts)
    plan = table.select(F.col("source").alias("_source"), "number", "source_size", "quota", "step")
    filled = rows.filter("size > 0").join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "part", F.shiftrightunsigned("key", 64 - (LINE_RANGES.bit_length() - 1)))
    # where each document begins on its source's line
    parts = filled.groupBy("number", "part").agg(F.sum("size").alias("n"))
    so_far = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("number", "part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    order = Window.partitionBy("number", "part").orderBy("key", "doc_id", "size", "row_no").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = filled.withColumn("within", F.coalesce(F.sum("size").over(order), F.lit(0))).join(
        parts, ["number", "part"]).withColumn("start", F.col("before") + F.col("within"))
    # once per epoch, as far as the source's quota reaches, then once per block it touches
    laid = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1)))).withColumn(
        "at", F.col("epoch") * F.col("source_size") + F.col("start")).withColumn(
        "until", F.least(F.col("at") + F.col("size"), "quota")).filter("at < until")
    blocks = laid.withColumn("rank", F.explode(F.sequence(
        F.floor(F.col("at") / F.col("step")), F.floor((F.col("until") - 1) / F.col("step")))))
    piece = blocks.join(slots, ["number", "rank"])
    return table, piece.select(
        "slot", "row_no", "epoch", "at",
        (F.greatest("at", F.col("rank") * F.col("step")) - F.col("at")).alias("start"),
        (F.least("until", (F.col("rank") + 1) * F.col("step")) - F.col("at")).alias("end"))


def taken_words(rows: DataFrame) -> DataFrame:
    """``sized`` rows with source_size, target, the words the mix takes of each, and ``first_slot``.

    That is the slot where the document begins for the first time; null if nothing is taken.
    """
    table, pieces = mix(rows)
    taken = pieces.groupBy("row_no").agg(F.sum(F.col("end") - F.col("start")).alias("taken"),
                                         F.min("slot").alias("first_slot"))
    plan = table.select(F.col("source").alias("_source"), "source_size", "target")
    return rows.join(taken, "row_no", "left").join(
        plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source",
          doc_id: str = "doc_id") -> DataFrame:
    """The documents, same columns, each as often as the mix takes it, in the order of the slots.

    Partitions hold consecutive slots, in order, and so any stretch of the result
    is close to the target shares. Documents stay whole: the one at the end of a
    source's target counts if the mix takes at least half of it.
    """
    rows = packed(docs, text=quoted(text), source=quoted(source), doc_id=quoted(doc_id))
    rows = sized(rows, "text", "source", "doc_id", row=F.col("row"))
    pieces = mix(rows.drop("row"))[1]
    # a source's ranks rise with its slots, so the least slot is the first piece's
    copies = materialize(pieces.groupBy("row_no", "epoch").agg(
        F.sum(F.col("end") - F.col("start")).alias("words"), F.min("slot").alias("slot"),
        F.first("at").alias("at")))
    last = copies.agg(F.max("slot")).first()[0] or 0
    files = max(last // FILE_SLOTS + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    laid = rows.join(copies, "row_no").filter(2 * F.col("words") >= F.col("size"))
    file = F.floor(F.col("slot") * F.lit(files) / F.lit(last + 1)).cast("int")
    return unpacked(laid.select("row", "slot", "at", "row_no", file.alias("file")).repartitionById(
        files, "file").sortWithinPartitions("slot", "at", "row_no"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    rows = sized(read(spark, sf_dir, "documents"), "text", "source", "doc_id")
    return taken_words(rows).select("doc_id", "size", "source_size", "target", "taken", "first_slot")
