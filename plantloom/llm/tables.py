"""What the operators share: reading tables, batch sizes, packing rows, one row per group."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows handed to Python at a time. Spark bounds its Arrow batches by rows only,
# so texts of a few MB each need few rows.
BATCH_ROWS = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_for_python(spark: SparkSession) -> None:
    """Small batches, whatever the length of the texts, and this package on the workers' path.

    Workers on other machines need the package installed, or shipped with
    ``--py-files``; those beside the driver find it where the driver has it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    here = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (here, path)))


def text_of(column: str | Column) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``docs`` as one struct ``row`` beside the given new ones.

    New columns cannot clash with whatever else the table holds.
    """
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
                       *[c.alias(n) for n, c in columns.items()])


def unpacked(rows: DataFrame) -> DataFrame:
    """The columns that ``packed`` put away."""
    return rows.select("row.*")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def first_in_group(rows: DataFrame, group: list[Column], order: list[Column]) -> DataFrame:
    """One packed row per group, the first in the given order, then by a hash of its values.

    Spark cuts each map task's share to its leading rows before the shuffle, so
    a group that holds much of the table costs one row per task. Rows that are
    equal in everything are interchangeable.
    """
    number = F.row_number().over(
        Window.partitionBy(*group).orderBy(*order, F.xxhash64("row")))
    return rows.withColumn("_n", number).filter("_n = 1").drop("_n")
