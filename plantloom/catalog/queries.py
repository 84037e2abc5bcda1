"""One query per operator: (session, folder of the driver's tables) to DataFrame."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.catalog.views import view, views
from plantloom.contracts import SOURCE_DDL, SYSTEMS, source_contract
from plantloom.functions import materials as mat
from plantloom.functions import orders as odr
from plantloom.operators.columns import prefix_columns, strip_prefixes
from plantloom.operators.dedup import collapse, with_group_size
from plantloom.operators.joins import left_join_many
from plantloom.operators.union import harmonize
from plantloom.plans import material, orders, system
from plantloom.plans.keys import add_primary_keys
from plantloom.session import remove, scratch_folder
from plantloom.sources.entities import read_entity, write_entity
from plantloom.sources.extracts import load_system, read_table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.date(2024, 1, 15)
OPTIONS = orders.OrderOptions(as_of=AS_OF)
EXTRA = "EISBE double, AUSDT date, WEBAZ int"
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def tables(spark: SparkSession, sf_dir: str, names: Iterable[str], only: str | None = None):
    """The named ERP tables; with ``only``, base tables hold that system's rows."""
    found = views(spark, sf_dir, names)
    if only is not None:
        for base in ("MARC", "AFKO"):
            if base in found:
                found[base] = found[base].filter(F.col("SOURCE_SYSTEM_ERP") == only)
    return found


# ---- extracts in, entities out -------------------------------------------------------------

def write_extract(df: DataFrame, path: str) -> None:
    """One table as a CSV extract, compressed; a packed file is read by one task, so files stay small."""
    (df.write.option("maxRecordsPerFile", 1_000_000).option("zlib.compress.level", "BEST_SPEED")
     .csv(path, header=True, compression="gzip"))


def write_extracts(spark: SparkSession, sf_dir: str, folder: str, only: str,
                   names: Iterable[str]) -> dict[str, str]:
    """Write a system's tables as CSV extracts, side by side, with columns the contracts do not know."""
    system.side_by_side(spark, {
        name: partial(write_extract, df.withColumn("LOADED_BY", F.lit("batch")),
                      f"{folder}/{only}_{name}.csv")
        for name, df in tables(spark, sf_dir, names, only).items()})
    return {"name": only, "path": f"{folder}/"}


def dropping(spark: SparkSession) -> dict[str, Callable]:
    """For a run: remove a system's extracts as soon as they are not read any more."""
    return {"release": lambda config: remove(spark, config["path"]),
            "release_table": lambda config, table: remove(spark, f"{config['path']}{config['name']}_{table}.csv")}


@query
def scan_typed_csv(spark, sf_dir):
    folder = scratch_folder(spark)
    # header order differs from the contract's on purpose
    mbew = view(spark, sf_dir, "MBEW")
    write_extract(mbew.select(*reversed(mbew.columns), F.lit("x").alias("LOADED_BY")),
                  f"{folder}/PRD_MBEW.csv")
    return read_table(spark, f"{folder}/PRD_MBEW.csv", "PRD", "MBEW").select(*mbew.columns)


@query
def load_system_tables(spark, sf_dir):
    """Every typed cell of every table of both systems, a row's cells as one text."""
    folder, rows = scratch_folder(spark), []
    for name in SYSTEMS:
        config = write_extracts(spark, sf_dir, folder, name, SOURCE_DDL)
        for table, df in load_system(spark, config, SOURCE_DDL).items():
            cells = [F.col(f.name).cast("decimal(18,2)") if f.dataType.simpleString() == "double"
                     else F.col(f.name) for f in source_contract(name, table) if f.name in df.columns]
            rows.append(df.select(
                F.lit(name).alias("system_name"), F.lit(table).alias("table_name"),
                F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cells])
                .alias("cells")))
    return reduce(DataFrame.union, rows)


@query
def load_extra_columns(spark, sf_dir):
    """Columns no contract knows, typed as declared, carried by the plant data."""
    folder, rows = scratch_folder(spark), []
    for name in SYSTEMS:
        wide = view(spark, sf_dir, "MARC_WIDE").filter(F.col("SOURCE_SYSTEM_ERP") == name)
        write_extract(wide, f"{folder}/{name}_MARC.csv")
        loaded = load_system(spark, {"name": name, "path": f"{folder}/"}, ["MARC"], {"MARC": EXTRA})
        rows.append(material.plant_data(loaded["MARC"], additional=["EISBE", "AUSDT", "WEBAZ"]))
    return reduce(DataFrame.unionByName, rows)


@query
def load_own_columns(spark, sf_dir):
    """Columns that one system alone has, typed by its contract: dates and a number of either."""
    folder, rows = scratch_folder(spark), []
    dates = {"PRE": ("T001W", "ZGOLIVEDATE"), "PRD": ("MARC", "ZZREVIEWDT")}
    for name in SYSTEMS:
        own = {"MARC": view(spark, sf_dir, f"MARC_{name}").filter(F.col("SOURCE_SYSTEM_ERP") == name)}
        if name == "PRE":
            own["T001W"] = view(spark, sf_dir, "T001W_PRE")
        for table, df in own.items():
            write_extract(df, f"{folder}/{name}_{table}.csv")
        for table, df in load_system(spark, {"name": name, "path": f"{folder}/"}, own).items():
            day = F.col(dates[name][1]) if table == dates[name][0] else F.lit(None).cast("date")
            number = F.col("ZZPSPER") if "ZZPSPER" in df.columns else F.lit(None).cast("int")
            rows.append(df.select(F.lit(name).alias("system_name"), F.lit(table).alias("table_name"),
                                  "WERKS", day.alias("own_date"), number.alias("own_number")))
    return reduce(DataFrame.union, rows)


@query
def validated_write_roundtrip(spark, sf_dir):
    root = scratch_folder(spark)
    built = _per_system(spark, sf_dir, material.local_material, material.TABLES)
    done = system.side_by_side(spark, {
        name: partial(write_entity, entity, root, material.ENTITY, name)
        for name, entity in built.items()})
    if not all(done.values()):
        raise RuntimeError("local material breaks its contract")
    return reduce(DataFrame.union, [read_entity(spark, root, material.ENTITY, s) for s in SYSTEMS])


# ---- preparation of the material side ------------------------------------------------------

@query
def prep_general_material(spark, sf_dir):
    return material.general_material(view(spark, sf_dir, "MARA"), ["ZZMDGM_NEW", "ZZMDGM"])


@query
def filter_old_material_number(spark, sf_dir):
    return material.general_material(view(spark, sf_dir, "MARA"), check_deleted=False)


@query
def filter_not_deleted(spark, sf_dir):
    return material.general_material(view(spark, sf_dir, "MARA"), check_old_number=False)


@query
def prep_material_valuation(spark, sf_dir):
    return material.material_valuation(view(spark, sf_dir, "MBEW"))


@query
def dedup_latest_price(spark, sf_dir):
    return material.latest_price(view(spark, sf_dir, "MBEW"))


@query
def prep_plant_data(spark, sf_dir):
    return material.plant_data(view(spark, sf_dir, "MARC"))


@query
def prep_plant_data_extra(spark, sf_dir):
    return material.plant_data(view(spark, sf_dir, "MARC"), check_deleted=False,
                               additional=["sur_pkey"])


@query
def distinct_plant_data(spark, sf_dir):
    return material.plant_data(view(spark, sf_dir, "MARC"), drop_duplicates=True)


@query
def prep_plants(spark, sf_dir):
    return material.plants(view(spark, sf_dir, "T001W"))


@query
def prep_valuation_area(spark, sf_dir):
    return material.valuation_areas(view(spark, sf_dir, "T001K"))


@query
def prep_company_codes(spark, sf_dir):
    return material.company_codes(view(spark, sf_dir, "T001"))


# ---- column shape --------------------------------------------------------------------------

@query
def prefix_columns_(spark, sf_dir):
    return prefix_columns(view(spark, sf_dir, "T001W"), "t001w")


@query
def prefix_columns_exclude(spark, sf_dir):
    return prefix_columns(view(spark, sf_dir, "MARC"), "marc", ["SOURCE_SYSTEM_ERP", "MATNR"])


@query
def strip_prefixes_(spark, sf_dir):
    return strip_prefixes(prefix_columns(view(spark, sf_dir, "MARC"), "marc", ["sur_pkey"]))


# ---- local material ------------------------------------------------------------------------

def _material_sides(spark, sf_dir):
    t = tables(spark, sf_dir, material.TABLES)
    return dict(
        plant=material.plant_data(t["MARC"]),
        material=material.general_material(t["MARA"]),
        plants=material.plants(t["T001W"]),
        valuation=material.material_valuation(t["MBEW"]),
        areas=material.valuation_areas(t["T001K"]),
        companies=material.company_codes(t["T001"]))


@query
def join_plant_material(spark, sf_dir):
    side = _material_sides(spark, sf_dir)
    return material.with_material(side["plant"], side["material"]).select(
        "plant.*", "material.MANDT", "material.MEINS", "material.global_material_number")


@query
def local_material_integrated(spark, sf_dir):
    return material.integrate_material(**_material_sides(spark, sf_dir))


@query
def count_duplicates(spark, sf_dir):
    return with_group_size(material.plant_data(view(spark, sf_dir, "MARC"),
                                               additional=["sur_pkey"]),
                           material.GRAIN, "no_of_duplicates")


@query
def dedup_material_plant(spark, sf_dir):
    return collapse(material.plant_data(view(spark, sf_dir, "MARC"), additional=["sur_pkey"]),
                    material.GRAIN, "no_of_duplicates")


@query
def material_plant_label(spark, sf_dir):
    return view(spark, sf_dir, "T001W").select(
        "WERKS", "NAME1", mat.plant_label().alias("mtl_plant_emd"))


@query
def global_material_id(spark, sf_dir):
    return view(spark, sf_dir, "MARA").select(
        "MATNR", "ZZMDGM", mat.global_material_id("ZZMDGM").alias("global_mtl_id"))


@query
def derive_primary_keys(spark, sf_dir):
    plant = view(spark, sf_dir, "MARC").withColumn("WERKS", F.nullif("WERKS", F.lit("7")))
    return add_primary_keys(plant, "SOURCE_SYSTEM_ERP", ["MATNR", "WERKS"])


@query
def finish_integrated_material(spark, sf_dir):
    return material.finish_local_material(
        material.integrate_material(**_material_sides(spark, sf_dir)))


@query
def local_material(spark, sf_dir):
    return material.local_material(tables(spark, sf_dir, material.TABLES))


@query
def local_material_distinct_plants(spark, sf_dir):
    return material.local_material(
        tables(spark, sf_dir, material.TABLES),
        material.MaterialOptions(check_old_number=False, check_material_deleted=False,
                                 check_plant_deleted=False, drop_duplicate_plants=True))


@query
def dedup_metrics(spark, sf_dir):
    return material.dedup_metrics(local_material(spark, sf_dir))


# ---- preparation of the order side ---------------------------------------------------------

@query
def prep_order_header(spark, sf_dir):
    return orders.order_header(view(spark, sf_dir, "AFKO"), AS_OF)


@query
def order_month_start(spark, sf_dir):
    return view(spark, sf_dir, "AFKO").select(
        "AUFNR", "GSTRP", odr.month_of("GSTRP", AS_OF).alias("start_date"))


@query
def order_month_finish(spark, sf_dir):
    return view(spark, sf_dir, "AFKO").select(
        "AUFNR", "GLTRP", odr.month_of("GLTRP", AS_OF).alias("finish_date"))


@query
def prep_order_item(spark, sf_dir):
    return orders.order_items(view(spark, sf_dir, "AFPO"))


@query
def prep_order_master(spark, sf_dir):
    return orders.order_master(view(spark, sf_dir, "AUFK"))


@query
def prep_order_master_partial(spark, sf_dir):
    return orders.order_master(view(spark, sf_dir, "AUFK").drop("ZZGLTRP_ORIG", "ERNAM"))


@query
def prep_order_material(spark, sf_dir):
    return orders.order_material(view(spark, sf_dir, "MARA"))


# ---- process order -------------------------------------------------------------------------

def _order_sides(spark, sf_dir):
    t = tables(spark, sf_dir, orders.TABLES)
    return (orders.order_header(t["AFKO"], AS_OF), orders.order_items(t["AFPO"]),
            orders.order_master(t["AUFK"]), orders.order_material(t["MARA"]))


@query
def join_order_items(spark, sf_dir):
    header, items, _, _ = _order_sides(spark, sf_dir)
    return left_join_many(header.select("SOURCE_SYSTEM_ERP", "AUFNR"),
                          prefix_columns(items, "item"), [("AUFNR", "item_AUFNR")])


@query
def process_order_integrated(spark, sf_dir):
    return orders.integrate_orders(*_order_sides(spark, sf_dir))


@query
def join_change_docs(spark, sf_dir):
    return orders.integrate_orders(*_order_sides(spark, sf_dir),
                                   changes=view(spark, sf_dir, "CDPOS"))


@query
def process_order_partial_master(spark, sf_dir):
    header, items, master, general = _order_sides(spark, sf_dir)
    return orders.finish_process_order(orders.integrate_orders(
        header, items, master.drop("ZZGLTRP_ORIG"), general, keep_header_key=True))


def _dated(spark, sf_dir):
    """Order numbers with planned finish and the header's own dates."""
    t = tables(spark, sf_dir, ["AFKO", "AUFK"])
    return orders.with_master(t["AFKO"], t["AUFK"]).select(
        "header.AUFNR", orders.planned_finish().alias("ZZGLTRP_ORIG"), "header.FTRMI", "header.GSTRI")


@query
def coalesce_planned_finish(spark, sf_dir):
    return _dated(spark, sf_dir).select("AUFNR", "ZZGLTRP_ORIG")


@query
def normalise_dates(spark, sf_dir):
    # dates as text, as timestamps, and text that is no date
    text = view(spark, sf_dir, "AFKO").select(
        "AUFNR", F.col("FTRMI").cast("string").alias("FTRMI"),
        F.col("GSTRI").cast("timestamp").alias("GSTRI"), F.col("DISPO").alias("ZZGLTRP_ORIG"))
    return text.select("AUFNR", *[odr.as_date(c).alias(c)
                                  for c in ("FTRMI", "GSTRI", "ZZGLTRP_ORIG")])


@query
def on_time_flag(spark, sf_dir):
    return _dated(spark, sf_dir).select("AUFNR", odr.on_time().alias("on_time_flag"))


@query
def on_time_deviation(spark, sf_dir):
    return _dated(spark, sf_dir).select(
        "AUFNR", odr.deviation_days().alias("actual_on_time_deviation"))


@query
def late_delivery_bucket(spark, sf_dir):
    days = _dated(spark, sf_dir).withColumn("actual_on_time_deviation", odr.deviation_days())
    return days.select("AUFNR", "actual_on_time_deviation",
                       odr.lateness().alias("late_delivery_bucket"))


@query
def late_delivery_bucket_actual_minus_planned(spark, sf_dir):
    days = _dated(spark, sf_dir).withColumn("actual_on_time_deviation", odr.deviation_days())
    return days.select("AUFNR", "actual_on_time_deviation",
                       odr.lateness(sign=odr.ACTUAL_MINUS_PLANNED).alias("late_delivery_bucket"))


@query
def mto_vs_mts(spark, sf_dir):
    return view(spark, sf_dir, "AFPO").select(
        "AUFNR", "POSNR", "KDAUF", odr.order_type().alias("mto_vs_mts_flag"))


@query
def order_timestamps(spark, sf_dir):
    return view(spark, sf_dir, "AFKO").select(
        "AUFNR", *[c.alias(name) for name, c in orders.order_times().items()])


@query
def process_order(spark, sf_dir):
    return orders.process_order(tables(spark, sf_dir, orders.TABLES), OPTIONS)


# ---- both systems --------------------------------------------------------------------------

def _per_system(spark, sf_dir, build, names):
    return {s: build(tables(spark, sf_dir, names, s)) for s in SYSTEMS}


@query
def harmonize_local_material(spark, sf_dir):
    built = _per_system(spark, sf_dir, material.local_material, material.TABLES)
    return harmonize(built["PRE"], built["PRD"])


@query
def harmonize_process_order(spark, sf_dir):
    built = _per_system(spark, sf_dir, lambda t: orders.process_order(t, OPTIONS), orders.TABLES)
    return harmonize(built["PRE"], built["PRD"])


@query
def union_missing_columns(spark, sf_dir):
    plant = view(spark, sf_dir, "MARC")
    pre = plant.filter(F.col("SOURCE_SYSTEM_ERP") == "PRE").drop("LVORM")
    prd = plant.filter(F.col("SOURCE_SYSTEM_ERP") == "PRD").drop("sur_pkey")
    return harmonize(pre, prd)


def _run_both(spark, sf_dir, entity):
    """Extracts of both systems to the harmonised entity, by way of files throughout."""
    folder = scratch_folder(spark)
    configs = list(system.side_by_side(spark, {
        s: partial(write_extracts, spark, sf_dir, f"{folder}/{s}", s, SOURCE_DDL)
        for s in ("PRE", "PRD")}).values())
    options = {s: system.SystemOptions(orders=OPTIONS) for s in ("PRE", "PRD")}
    done = system.run(spark, configs, f"{folder}/output", options, **dropping(spark))
    if not done[entity]:
        raise RuntimeError(f"{entity} was not written")
    return read_entity(spark, f"{folder}/output", entity)


@query
def harmonized_local_material(spark, sf_dir):
    return _run_both(spark, sf_dir, "local_material")


@query
def harmonized_process_order(spark, sf_dir):
    return _run_both(spark, sf_dir, "process_order")


@query
def process_system(spark, sf_dir):
    """All rows of both entities of both systems; each row has the columns of its entity."""
    folder, rows = scratch_folder(spark), []
    for name in SYSTEMS:
        config = write_extracts(spark, sf_dir, f"{folder}/{name}", name, SOURCE_DDL)
        built = system.process_system(spark, config, f"{folder}/output",
                                      system.SystemOptions(orders=OPTIONS), stage=False,
                                      **dropping(spark))
        rows += [df.select(F.lit(entity).alias("entity"), "*") for entity, df in built.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)

