"""Process order: one row per order item."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantloom.checks import require_columns, require_distinct, require_frame, require_text
from plantloom.functions.materials import not_deleted, not_retired
from plantloom.functions.orders import (
    PLANNED_MINUS_ACTUAL, as_date, deviation_days, lateness, month_of, on_time, order_type)
from plantloom.operators.columns import pick, pick_present
from plantloom.operators.joins import heavy_right, left_join_many, uneven
from plantloom.plans.keys import add_primary_keys

TABLES = ("AFKO", "AFPO", "AUFK", "MARA")
ENTITY = "PROCESS_ORDER_SCHEMA"

# Columns taken over from each table, in published order.
HEADER = ["SOURCE_SYSTEM_ERP", "MANDT", "AUFNR", "GLTRP", "GSTRP", "FTRMS", "GLTRS", "GSTRS",
          "GSTRI", "GETRI", "GLTRI", "FTRMI", "FTRMP", "DISPO", "FEVOR", "PLGRP", "FHORI",
          "AUFPL"]
ITEM = ["AUFNR", "POSNR", "DWERK", "MATNR", "MEINS", "KDAUF", "KDPOS"]
MASTER = ["AUFNR", "OBJNR", "ERDAT", "ERNAM", "AUART", "ZZGLTRP_ORIG", "ZZPRO_TEXT"]


@dataclass(frozen=True)
class OrderOptions:
    """Switches of the process order run.

    ``as_of`` stands in for unknown order dates (default: the day of the run).
    ``keep_header_key`` fills the order number of orders without master record.
    """

    global_number_column: str = "ZZMDGM"
    as_of: datetime.date | None = None
    lateness_sign: str = PLANNED_MINUS_ACTUAL
    keep_header_key: bool = False


def order_header(afko: DataFrame, as_of: datetime.date | None = None) -> DataFrame:
    """Order headers with the months they start and finish in."""
    require_frame(afko, "afko")
    return pick(afko, HEADER, "AFKO").withColumns({
        "start_date": month_of("GSTRP", as_of), "finish_date": month_of("GLTRP", as_of)})


def order_items(afpo: DataFrame) -> DataFrame:
    """Order items."""
    require_frame(afpo, "afpo")
    return pick(afpo, ITEM, "AFPO")


def order_master(aufk: DataFrame) -> DataFrame:
    """Whatever of the order master columns the input has."""
    require_frame(aufk, "aufk")
    return pick_present(aufk, MASTER, "AUFK")


def order_material(mara: DataFrame, global_number_column: str = "ZZMDGM") -> DataFrame:
    """Number, global number, weight and type of the materials in use."""
    require_frame(mara, "mara")
    require_text(global_number_column, "global_number_column", TypeError)
    require_columns(mara, ["BISMT", "LVORM"], "MARA (filter)")
    require_columns(mara, ["MATNR", global_number_column, "NTGEW", "MTART"], "MARA")
    return mara.filter(not_retired() & not_deleted()).select(
        "MATNR", F.col(global_number_column).alias("global_material_number"), "NTGEW", "MTART")


def planned_finish():
    """The originally planned finish, or the header's where there is none."""
    return F.coalesce(F.col("master.ZZGLTRP_ORIG"), F.col("header.GLTRP"))


def with_master(header: DataFrame, master: DataFrame) -> DataFrame:
    """Headers left-joined to their master records, as ``header`` and ``master``."""
    return left_join_many(header.alias("header"), master, [("header.AUFNR", "AUFNR")], "master")


def _widened(side: DataFrame, more: DataFrame, key: str, name: str, heavy: dict[str, int]) -> DataFrame:
    """``side`` left-joined to ``more`` by ``key``, whose other columns get the prefix ``_name_``."""
    rows = left_join_many(side.alias("side"), more, [(f"side.{key}", key)], name, heavy=heavy)
    return rows.select("side.*", *[F.col(f"{name}.{c}").alias(f"_{name}_{c}")
                                   for c in more.columns if c != key])


def integrate_orders(
    header: DataFrame,
    items: DataFrame,
    master: DataFrame,
    material: DataFrame,
    changes: DataFrame | None = None,
    keep_header_key: bool = False,
) -> DataFrame:
    """Headers left-joined to items, order master, material and, if given, changes.

    The order number of the result is the master's, null where there is no
    master record, unless ``keep_header_key``. Any side may hold any number of
    rows per key. Each side's own key columns are published by one side only.

    Materials join the items and changes the master records before either meets
    the headers: these rows are narrow, and the joins by order number share one
    shuffle of the headers. Whole rows are not shuffled, unless an order number
    is heavy among the headers.
    """
    require_columns(header, ["AUFNR", "GLTRP"], "header")
    require_columns(items, ["AUFNR", "MATNR"], "items")
    require_columns(master, ["AUFNR"], "master")
    for name, kind in (("OBJNR", "string"), ("ZZGLTRP_ORIG", "date")):
        if name not in master.columns:
            master = master.withColumn(name, F.lit(None).cast(kind))

    published = [(f"header.{c}", c) for c in header.columns if c != "AUFNR"]
    published += [(f"item.{c}", c) for c in items.columns if c not in ("AUFNR", "MATNR")]
    published += [(f"master.{c}", c) for c in master.columns]
    published += [(f"item._material_{c}", c) for c in material.columns if c != "MATNR"]
    if changes is not None:
        require_columns(changes, ["OBJNR"], "changes")
        published += [(f"master._change_{c}", c) for c in changes.columns
                      if c not in ("AUFNR", "MATNR", "OBJNR")]
    require_distinct([c for _, c in published], "the integrated orders")

    documents = {} if changes is None else heavy_right(changes, ["OBJNR"])
    known = master if changes is None else _widened(master, changes, "OBJNR", "change", documents)
    numbers = heavy_right(material, ["MATNR"])
    described = _widened(items, material, "MATNR", "material", numbers)
    sides = [("master", known, heavy_right(known if documents else master, ["AUFNR"])),
             ("item", described, heavy_right(described if numbers else items, ["AUFNR"]))]
    # a side with heavy keys joins last, so that their rows stay spread
    (first, one, heavy), (second, two, heavier) = sorted(sides, key=lambda side: bool(side[2]))
    rows = left_join_many(header.alias("header"), one, [("header.AUFNR", "AUFNR")], first, heavy=heavy)
    rows = left_join_many(rows, two, [("header.AUFNR", "AUFNR")], second, heavy=heavier,
                          again=not heavier and uneven(header, ["AUFNR"]))

    number = F.col("master.AUFNR")
    values = {
        "master.ZZGLTRP_ORIG": planned_finish(),
        "master.AUFNR": F.coalesce(number, F.col("header.AUFNR")) if keep_header_key else number,
    }
    return rows.select(*[values.get(source, F.col(source)).alias(c) for source, c in published])


def order_times() -> dict[str, Column]:
    """Actual finish and start as timestamps."""
    return {"order_finish_timestamp": F.col("FTRMI").cast("timestamp"),
            "order_start_timestamp": F.col("GSTRI").cast("timestamp")}


def finish_process_order(df: DataFrame, lateness_sign: str = PLANNED_MINUS_ACTUAL) -> DataFrame:
    """Keys, punctuality, order type and timestamps on integrated orders."""
    require_frame(df, "df")
    keyed = add_primary_keys(df, "SOURCE_SYSTEM_ERP", ["AUFNR", "POSNR", "DWERK"])
    dated = keyed.withColumns({c: as_date(c) for c in ("ZZGLTRP_ORIG", "FTRMI", "GSTRI")})
    return dated.withColumns({
        "on_time_flag": on_time(),
        "actual_on_time_deviation": deviation_days(),
    }).withColumns({
        "late_delivery_bucket": lateness(sign=lateness_sign),
        "mto_vs_mts_flag": order_type(),
        **order_times(),
    })


def process_order(
    tables: Mapping[str, DataFrame], options: OrderOptions = OrderOptions()
) -> DataFrame:
    """The process order entity from one system's tables."""
    integrated = integrate_orders(
        order_header(tables["AFKO"], options.as_of),
        order_items(tables["AFPO"]),
        order_master(tables["AUFK"]),
        order_material(tables["MARA"], options.global_number_column),
        keep_header_key=options.keep_header_key)
    return finish_process_order(integrated, options.lateness_sign)
