"""Duplicate counting and removal, with map-side reduction ahead of every shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantloom.checks import require_columns

# Tasks that a heavy key's rows are dealt to where they are counted, a power of two.
SPREAD = 16


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps only the leading row of each key per map task before it shuffles
    (a rank filter on a window becomes a group limit), so a heavy key costs one
    row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def with_group_size(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """All rows, each with the number of rows that share its key.

    The input is read and shuffled once, by key and one of ``SPREAD`` salts, so
    that a heavy key's rows come to several tasks. There they are counted; the
    counts, a row per key and salt, are summed by key and joined back to the same
    shuffled rows. A window would need every row of a key in one task.
    """
    require_columns(df, keys)
    columns = [F.col(_quoted(c)) for c in df.columns]
    # by place and content, so that neither sorted input nor equal rows end in one salt
    salt = (F.spark_partition_id() + F.xxhash64(*columns)).bitwiseAND(F.lit(SPREAD - 1))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # keys as a struct, in which null equals null; the count reads the row, so that both uses of
    # the shuffle want the same columns and share it
    dealt = df.select(F.struct(*[F.col(_quoted(k)) for k in keys]).alias("key"), salt.alias("salt"),
                      F.struct(*columns).alias("row")).withColumn(
        "row", F.when(F.col("salt") >= 0, F.col("row"))).repartition(parts, "key", "salt")
    counts = dealt.groupBy("key", "salt").agg(F.count("row").alias("n"))
    sums = counts.groupBy("key").agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).select(
        F.col("key").alias("_key"), "n", F.explode("salts").alias("_salt"))
    return dealt.join(sums, (F.col("key") == F.col("_key")) & (F.col("salt") == F.col("_salt"))).select(
        "row.*", F.col("n").alias(name))


def collapse(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """One row per key plus the number of rows it stands for.

    The surviving values are the first in order of the remaining columns, left
    to right, nulls last, so the outcome does not depend on partitioning.
    """
    require_columns(df, keys)
    rest = [c for c in df.columns if c not in keys]
    aggregates = [F.count(F.lit(1)).alias(count)]
    if rest:
        ranked = ", ".join(f"'no{i}', {_quoted(c)} IS NULL, 'v{i}', {_quoted(c)}"
                           for i, c in enumerate(rest))
        aggregates.append(F.expr(f"min(named_struct({ranked}))").alias("_first"))
    kept = {c: f"_first.v{i} AS {_quoted(c)}" for i, c in enumerate(rest)}
    return df.groupBy(*keys).agg(*aggregates).selectExpr(
        *[kept.get(c, _quoted(c)) for c in df.columns], _quoted(count))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
