"""Local material: one row per source system, material and plant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from plantloom.checks import require_columns, require_distinct, require_frame
from plantloom.functions.materials import (
    global_material_id, not_deleted, not_retired, not_split_valued, plant_label)
from plantloom.operators.columns import first_present, pick
from plantloom.operators.dedup import collapse, first_by
from plantloom.operators.joins import left_join_many, left_lookup, uneven
from plantloom.plans.keys import add_primary_keys

TABLES = ("MARA", "MARC", "MBEW", "T001W", "T001K", "T001")
ENTITY = "LOCAL_MATERIAL"
GRAIN = ["SOURCE_SYSTEM_ERP", "MATNR", "WERKS"]
# The valuation columns that are published.
VALUATION = ["MANDT", "MATNR", "BWKEY", "VPRSV", "VERPR", "STPRS", "PEINH", "BKLAS"]
# Rows that one task, or a list in one row, holds together where whole materials meet.
MET = (("T001", "BUKRS"), ("T001K", "BWKEY"), ("T001W", "WERKS"), ("MARC", "MATNR"), ("MBEW", "MATNR"))


@dataclass(frozen=True)
class MaterialOptions:
    """Switches of the local material run.

    ``additional`` columns of the plant data follow the grain. The entity then is
    not the published shape any more, so the schema gate refuses it.
    """

    global_number_columns: Sequence[str] = ("ZZMDGM",)
    check_old_number: bool = True
    check_material_deleted: bool = True
    check_plant_deleted: bool = True
    drop_duplicate_plants: bool = False
    additional: Sequence[str] = ()


def general_material(
    mara: DataFrame,
    global_number_columns: Sequence[str] = ("ZZMDGM",),
    check_old_number: bool = True,
    check_deleted: bool = True,
) -> DataFrame:
    """Client, number, unit and global number of the materials in use."""
    global_number = first_present(mara, global_number_columns)
    require_columns(mara, ["MANDT", "MATNR", "MEINS", "BISMT", "LVORM"], "MARA")
    if check_old_number:
        mara = mara.filter(not_retired())
    if check_deleted:
        mara = mara.filter(not_deleted())
    return mara.select("MANDT", "MATNR", "MEINS",
                       F.col(global_number).alias("global_material_number"))


def latest_price(mbew: DataFrame) -> DataFrame:
    """The most recently priced valuation of each material and valuation area.

    Equal price dates are settled by the record's surrogate key where the input
    has one, then by the remaining valuation columns.
    """
    keys = ["MATNR", "BWKEY"]
    settle = [c for c in ("sur_pkey", *VALUATION) if c in mbew.columns and c not in keys]
    return first_by(mbew, keys, [
        F.col("LAEPR").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in settle]])


def material_valuation(mbew: DataFrame, by_material: bool = False) -> DataFrame:
    """Current valuation per material and area, without deleted or split valuations.

    ``by_material`` leaves all of a material's in one partition.
    """
    require_columns(mbew, [*VALUATION, "LAEPR", "LVORM", "BWTAR"], "MBEW")
    valid = mbew.filter(not_deleted() & not_split_valued())
    carried = [c for c in (*VALUATION, "LAEPR", "sur_pkey") if c in mbew.columns]
    valid = valid.select(*carried)
    return latest_price(valid.repartition("MATNR") if by_material else valid).select(*VALUATION)


def plant_data(
    marc: DataFrame,
    check_deleted: bool = True,
    drop_duplicates: bool = False,
    additional: Sequence[str] | None = None,
) -> DataFrame:
    """Materials per plant, with any additional MARC columns asked for.

    Duplicates are removed while the deletion flag is still there, so rows that
    differ by null and empty flag both stay.
    """
    columns = [*GRAIN, *(additional or ())]
    plant = pick(marc, [*columns, *(c for c in ["LVORM"] if c not in columns)], "MARC")
    if check_deleted:
        plant = plant.filter(not_deleted())
    if drop_duplicates:
        plant = plant.dropDuplicates()
    return plant.select(*[c for c in columns if c != "LVORM"])


def plants(t001w: DataFrame) -> DataFrame:
    """Plants with their valuation area and name."""
    return pick(t001w, ["MANDT", "WERKS", "BWKEY", "NAME1"], "T001W")


def valuation_areas(t001k: DataFrame) -> DataFrame:
    """Distinct assignments of valuation areas to company codes."""
    return pick(t001k, ["MANDT", "BWKEY", "BUKRS"], "T001K").dropDuplicates()


def company_codes(t001: DataFrame) -> DataFrame:
    """Company codes and their currency."""
    return pick(t001, ["MANDT", "BUKRS", "WAERS"], "T001")


def area_currency(areas: DataFrame, companies: DataFrame) -> DataFrame:
    """Currency per client and valuation area; null where the company is unknown."""
    return (areas.alias("a")
            .join(companies.alias("c"),
                  (F.col("a.MANDT") == F.col("c.MANDT")) & (F.col("a.BUKRS") == F.col("c.BUKRS")),
                  "left")
            .select("a.MANDT", "a.BWKEY", "c.WAERS"))


def with_material(plant: DataFrame, material: DataFrame) -> DataFrame:
    """Plant data left-joined to the material, as ``plant`` and ``material``."""
    return left_join_many(plant.alias("plant"), material, [("plant.MATNR", "MATNR")], "material")


def with_plant(known: DataFrame, plants: DataFrame) -> DataFrame:
    """The result of ``with_material`` left-joined to the plant of the material's client, as ``site``."""
    return left_join_many(known, plants, [
        ("material.MANDT", "MANDT"), ("plant.WERKS", "WERKS")], "site")


def _enrich(
    plant: DataFrame,
    material: DataFrame,
    plants: DataFrame,
    valuation: DataFrame,
    currency: DataFrame,
) -> DataFrame:
    """Plant data left-joined to everything known about it, sides aliased.

    Each step needs a hit in the one before: without material no client, without
    client no plant, without plant no valuation, without valuation no currency.
    The material number is taken from the always-filled plant side, so rows
    without material spread over all partitions instead of meeting as nulls.
    """
    known = with_plant(with_material(plant, material), plants)
    valued = left_lookup(known, valuation.alias("value"), [
        ("material.MANDT", "value.MANDT"), ("plant.MATNR", "value.MATNR"),
        ("site.BWKEY", "value.BWKEY")])
    return left_lookup(valued, currency.alias("currency"), [
        ("material.MANDT", "currency.MANDT"), ("value.BWKEY", "currency.BWKEY")])


def _sites(plants: DataFrame, areas: DataFrame, companies: DataFrame) -> DataFrame:
    """Per plant (``_werks``) the list of its records of all clients, each with its area's currencies."""
    currency = area_currency(areas, companies).groupBy(
        F.col("MANDT").alias("_mandt"), F.col("BWKEY").alias("_bwkey")).agg(
        F.collect_list(F.struct("WAERS")).alias("currencies"))
    known = left_lookup(plants.dropna(subset=["MANDT"]), currency, [("MANDT", "_mandt"), ("BWKEY", "_bwkey")])
    return known.groupBy(F.col("WERKS").alias("_werks")).agg(
        F.collect_list(F.struct("MANDT", "BWKEY", "NAME1", "currencies")).alias("_sites"))


def _integrate_by_material(
    plant: DataFrame,
    material: DataFrame,
    plants: DataFrame,
    valuation: DataFrame,
    areas: DataFrame,
    companies: DataFrame,
) -> DataFrame:
    """``integrate_material`` where the rows of a material may meet in one task.

    Plants and currencies are looked up first, for all clients and as lists,
    while a row is three keys wide. With them it is dealt out by material
    number, as ``valuation`` is, and there the material's client picks from the
    list. The valuation of a client, material and area, of which there is one,
    is put in a group with the rows that want it: a join by three keys would
    shuffle both sides once more, a window takes the rows as they lie, and so
    does what is grouped by material and plant thereafter.
    """
    published = _published(plant)
    wanted = [c for c in VALUATION if c not in ("MANDT", "MATNR", "BWKEY")]
    placed = left_lookup(plant, _sites(plants, areas, companies), [("WERKS", "_werks")]).drop("_werks")
    known = with_material(placed.repartition("MATNR"), material)
    own = F.filter("plant._sites", lambda site: site["MANDT"] == F.col("material.MANDT"))
    asking = known.withColumn("_site", F.explode_outer(own)).select(
        F.lit(True).alias("_asks"), F.col("material.MANDT").alias("_client"),
        F.col("_site.BWKEY").alias("_area"), *[F.col(f"plant.{c}").alias(f"_plant_{c}") for c in plant.columns],
        F.struct("material.MEINS", "material.global_material_number").alias("material"),
        F.col("_site").alias("site"))
    valued = valuation.dropna(subset=["MANDT", "MATNR", "BWKEY"]).select(
        F.col("MANDT").alias("_client"), F.col("BWKEY").alias("_area"), F.col("MATNR").alias("_plant_MATNR"),
        F.struct(*wanted).alias("value"))
    group = Window.partitionBy("_client", "_plant_MATNR", "_area")
    rows = asking.unionByName(valued, allowMissingColumns=True).withColumn(
        "value", F.max("value").over(group)).filter(F.col("_asks"))
    paid = F.when(F.col("value").isNotNull(), F.col("site.currencies"))
    rows = rows.withColumn("currency", F.explode_outer(paid))
    return rows.select(*[F.col(f"_plant_{name}" if side == "plant" else f"{side}.{name}").alias(name)
                         for side, _, name in (c.partition(".") for c in published)])


def _published(plant: DataFrame) -> list[str]:
    """Qualified columns of the enriched row that survive, in published order."""
    columns = [f"plant.{c}" for c in plant.columns if c != "BWKEY"] + [
        "material.MEINS", "material.global_material_number",
        "site.BWKEY", "site.NAME1",
        "value.VPRSV", "value.VERPR", "value.STPRS", "value.PEINH", "value.BKLAS",
        "currency.WAERS"]
    require_distinct([c.partition(".")[2] for c in columns], "the integrated material")
    return columns


def integrate_material(
    plant: DataFrame,
    material: DataFrame,
    plants: DataFrame,
    valuation: DataFrame,
    areas: DataFrame,
    companies: DataFrame,
    by_material: bool = False,
) -> DataFrame:
    """Every plant row with material, plant, valuation and currency, nothing removed.

    ``by_material`` says that all rows of a material may meet in one task. ``valuation`` then has one
    row per material and area and was dealt out by material number.
    """
    if by_material:
        return _integrate_by_material(plant, material, plants, valuation, areas, companies)
    rows = _enrich(plant, material, plants, valuation, area_currency(areas, companies))
    return rows.select(*_published(plant))


def finish_local_material(df: DataFrame) -> DataFrame:
    """One row per system, material and plant, with labels, keys and duplicate count."""
    require_frame(df, "df")
    require_columns(df, ["WERKS", "NAME1", "global_material_number", "MATNR",
                         "SOURCE_SYSTEM_ERP"])
    single = collapse(df, GRAIN, "no_of_duplicates")
    labelled = add_primary_keys(
        single.withColumns({
            "mtl_plant_emd": plant_label(),
            "global_mtl_id": global_material_id(),
        }), "SOURCE_SYSTEM_ERP", ["MATNR", "WERKS"])
    return labelled.select(
        *[c for c in labelled.columns if c != "no_of_duplicates"], "no_of_duplicates")


def local_material(
    tables: Mapping[str, DataFrame], options: MaterialOptions = MaterialOptions()
) -> DataFrame:
    """The local material entity from one system's tables.

    Plant data and valuations are dealt out by material number while their rows
    are narrow, and all that follows happens there, in tasks that hold whole
    materials. Where a material, plant, area or company is heavy, every join
    shuffles for itself. Copies are counted after the joins, in one aggregation.
    """
    sides = dict(
        plant=plant_data(tables["MARC"], options.check_plant_deleted, options.drop_duplicate_plants,
                         options.additional),
        material=general_material(tables["MARA"], options.global_number_columns,
                                  options.check_old_number, options.check_material_deleted),
        plants=plants(tables["T001W"]),
        valuation=material_valuation(tables["MBEW"]),
        areas=valuation_areas(tables["T001K"]),
        companies=company_codes(tables["T001"]))
    even = not any(uneven(tables[name], [key]) for name, key in MET)
    if even:
        sides["valuation"] = material_valuation(tables["MBEW"], by_material=True)
    return finish_local_material(integrate_material(**sides, by_material=even))


def dedup_metrics(df: DataFrame) -> DataFrame:
    """Rows before and after duplicate removal, as one row."""
    before, after = F.coalesce(F.sum("no_of_duplicates"), F.lit(0)), F.count(F.lit(1))
    return df.agg(before.alias("rows_before"), after.alias("rows_after"),
                  (before - after).alias("duplicates_removed"))


def observe_dedup(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with the counts of ``dedup_metrics`` taken while it is written."""
    seen = Observation("local_material")
    return df.observe(
        seen, F.coalesce(F.sum("no_of_duplicates"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after")), seen
