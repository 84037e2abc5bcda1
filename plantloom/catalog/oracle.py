"""SQL that states each query's result directly: join chains, windows, CASE."""

from __future__ import annotations

from plantloom.catalog.views import VIEWS, view_sql
from plantloom.contracts import SOURCE_DDL, SYSTEMS

AS_OF = "DATE '2024-01-15'"

# What a CSV round trip does to the derived tables: empty text comes back as null.
EMPTY_TO_NULL = {"MARA": ["LVORM", "ZZMDGM"], "MARC": ["LVORM"], "MBEW": ["LVORM"],
                 "AFPO": ["KDAUF"]}

# Fixed values, here and in the steps: retirement marks, lateness labels and their limits in days.
IN_USE = "(LVORM IS NULL OR LVORM = '')"
OLD_OK = "(BISMT IS NULL OR BISMT NOT IN ('ARCHIVE', 'DUPLICATE', 'RENUMBERED'))"
# Published columns of valuations, order headers and order masters.
VALUATION = "MANDT, MATNR, BWKEY, VPRSV, VERPR, STPRS, PEINH, BKLAS"
PRICE_ORDER = ("LAEPR DESC NULLS LAST, sur_pkey NULLS LAST, "
               + ", ".join(f"{c} NULLS LAST" for c in VALUATION.split(", ")))
LATEST = f"ROW_NUMBER() OVER (PARTITION BY MATNR, BWKEY ORDER BY {PRICE_ORDER})"
HEADER = ("SOURCE_SYSTEM_ERP, MANDT, AUFNR, GLTRP, GSTRP, FTRMS, GLTRS, GSTRS, GSTRI, GETRI, "
          "GLTRI, FTRMI, FTRMP, DISPO, FEVOR, PLGRP, FHORI, AUFPL")
MASTER = "AUFNR, OBJNR, ERDAT, ERNAM, AUART, ZZGLTRP_ORIG, ZZPRO_TEXT"


def month(column: str) -> str:
    return f"CAST(DATE_TRUNC('month', COALESCE({column}, {AS_OF})) AS DATE)"


# Steps of both entities; a query names those it needs, in any order.
STEPS = {
    "general": f"""SELECT MANDT, MATNR, MEINS, ZZMDGM AS global_material_number
        FROM MARA WHERE {OLD_OK} AND {IN_USE}""",
    "plant": f"SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS FROM MARC WHERE {IN_USE}",
    "valuation": f"""SELECT {VALUATION} FROM (
        SELECT *, {LATEST} AS rn FROM MBEW WHERE {IN_USE} AND BWTAR IS NULL) WHERE rn = 1""",
    "area": "SELECT DISTINCT MANDT, BWKEY, BUKRS FROM T001K",
    "integrated": """SELECT p.SOURCE_SYSTEM_ERP, p.MATNR, p.WERKS, m.MEINS,
            m.global_material_number, w.BWKEY, w.NAME1, v.VPRSV, v.VERPR, v.STPRS, v.PEINH,
            v.BKLAS, c.WAERS
        FROM plant p
        LEFT JOIN general m ON p.MATNR = m.MATNR
        LEFT JOIN T001W w ON m.MANDT = w.MANDT AND p.WERKS = w.WERKS
        LEFT JOIN valuation v ON m.MANDT = v.MANDT AND m.MATNR = v.MATNR AND w.BWKEY = v.BWKEY
        LEFT JOIN area k ON m.MANDT = k.MANDT AND v.BWKEY = k.BWKEY
        LEFT JOIN T001 c ON m.MANDT = c.MANDT AND k.BUKRS = c.BUKRS""",
    "local": """SELECT * EXCLUDE (rn), CONCAT_WS('-', WERKS, NAME1) AS mtl_plant_emd,
            CASE WHEN global_material_number IS NOT NULL AND global_material_number <> ''
                 THEN global_material_number ELSE MATNR END AS global_mtl_id,
            CONCAT_WS('_', MATNR, WERKS) AS primary_key_intra,
            CONCAT_WS('_', SOURCE_SYSTEM_ERP, MATNR, WERKS) AS primary_key_inter
        FROM (SELECT *,
                COUNT(*) OVER (PARTITION BY SOURCE_SYSTEM_ERP, MATNR, WERKS) AS no_of_duplicates,
                ROW_NUMBER() OVER (PARTITION BY SOURCE_SYSTEM_ERP, MATNR, WERKS
                    ORDER BY MEINS NULLS LAST, global_material_number NULLS LAST,
                        BWKEY NULLS LAST, NAME1 NULLS LAST, VPRSV NULLS LAST, VERPR NULLS LAST,
                        STPRS NULLS LAST, PEINH NULLS LAST, BKLAS NULLS LAST,
                        WAERS NULLS LAST) AS rn
              FROM integrated)
        WHERE rn = 1""",
    "header": f"""SELECT {HEADER}, {month('GSTRP')} AS start_date,
            {month('GLTRP')} AS finish_date FROM AFKO""",
    "order_material": f"""SELECT MATNR, ZZMDGM AS global_material_number, NTGEW, MTART
        FROM MARA WHERE {OLD_OK} AND {IN_USE}""",
    "master": f"SELECT {MASTER} FROM AUFK",
    "order_rows": """SELECT h.* EXCLUDE (AUFNR), i.POSNR, i.DWERK, i.MEINS, i.KDAUF, i.KDPOS,
            a.* REPLACE (COALESCE(a.ZZGLTRP_ORIG, h.GLTRP) AS ZZGLTRP_ORIG),
            m.* EXCLUDE (MATNR)
        FROM header h
        LEFT JOIN AFPO i ON h.AUFNR = i.AUFNR
        LEFT JOIN master a ON h.AUFNR = a.AUFNR
        LEFT JOIN order_material m ON i.MATNR = m.MATNR""",
    "finished": """SELECT * REPLACE (CAST(actual_on_time_deviation AS INTEGER)
                AS actual_on_time_deviation),
            CASE WHEN actual_on_time_deviation <= 0 THEN 'On time or early'
                 WHEN actual_on_time_deviation <= 5 THEN '1-5 days late'
                 WHEN actual_on_time_deviation <= 10 THEN '6-10 days late'
                 WHEN actual_on_time_deviation > 10 THEN '>10 days late'
                 END AS late_delivery_bucket
        FROM (SELECT *,
                CONCAT_WS('_', AUFNR, POSNR, DWERK) AS primary_key_intra,
                CONCAT_WS('_', SOURCE_SYSTEM_ERP, AUFNR, POSNR, DWERK) AS primary_key_inter,
                CASE WHEN ZZGLTRP_ORIG IS NOT NULL AND FTRMI IS NOT NULL
                     THEN CASE WHEN ZZGLTRP_ORIG >= FTRMI THEN 1 ELSE 0 END
                     END AS on_time_flag,
                ZZGLTRP_ORIG - FTRMI AS actual_on_time_deviation,
                CASE WHEN KDAUF IS NOT NULL THEN 'MTO' ELSE 'MTS' END AS mto_vs_mts_flag,
                CAST(FTRMI AS TIMESTAMP) AS order_finish_timestamp,
                CAST(GSTRI AS TIMESTAMP) AS order_start_timestamp
              FROM order_rows)""",
    "dated": """SELECT h.AUFNR, COALESCE(a.ZZGLTRP_ORIG, h.GLTRP) AS ZZGLTRP_ORIG, h.FTRMI,
            h.GSTRI
        FROM AFKO h LEFT JOIN AUFK a ON h.AUFNR = a.AUFNR""",
}
ORDER = [*VIEWS, *STEPS]

MATERIAL = "MARA MARC MBEW T001W T001K T001 general plant valuation area integrated"
LOCAL = f"{MATERIAL} local"
ORDERS = "MARA AFKO AFPO AUFK header order_material master order_rows"
FINISHED = f"{ORDERS} finished"


def sql(steps: str, select: str, via_csv: bool = False, **other: str) -> str:
    """``select`` over the named tables and steps; ``other`` replaces single steps."""
    parts = []
    for name in sorted(steps.split(), key=ORDER.index):
        text = other.get(name) or STEPS.get(name) or view_sql(name)
        if via_csv and name in EMPTY_TO_NULL:
            cleared = ", ".join(f"NULLIF({c}, '') AS {c}" for c in EMPTY_TO_NULL[name])
            text = f"SELECT * REPLACE ({cleared}) FROM ({text})"
        parts.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + select


def _cells() -> str:
    def cell(column: str) -> str:
        name, kind = column.split()
        value = f"CAST({name} AS DECIMAL(18,2))" if kind == "double" else name
        return f"COALESCE(CAST({value} AS VARCHAR), '~')"

    def rows(system: str, table: str) -> str:
        cells = ", ".join(map(cell, SOURCE_DDL[table].split(", ")))
        mine = f" WHERE SOURCE_SYSTEM_ERP = '{system}'" if table in ("MARC", "AFKO") else ""
        return (f"SELECT '{system}' AS system_name, '{table}' AS table_name, "
                f"CONCAT_WS('|', {cells}) AS cells FROM {table}{mine}")

    return sql(" ".join(SOURCE_DDL), "\nUNION ALL ".join(
        rows(s, t) for s in SYSTEMS for t in SOURCE_DDL), via_csv=True)


SAME_KEY = "PARTITION BY SOURCE_SYSTEM_ERP, MATNR, WERKS"
PLANT_KEYED = f"SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS, sur_pkey FROM MARC WHERE {IN_USE}"
ALL_MARA = "SELECT MANDT, MATNR, MEINS, ZZMDGM AS global_material_number FROM MARA"

ORACLE = {
    "scan_typed_csv": sql("MBEW", "SELECT * FROM MBEW", via_csv=True),
    "load_system_tables": _cells(),
    "load_extra_columns": sql("MARC_WIDE", "SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS, EISBE, AUSDT, "
                                           f"WEBAZ FROM MARC_WIDE WHERE {IN_USE}"),
    "load_own_columns": sql(
        "MARC_PRE MARC_PRD T001W_PRE",
        "SELECT 'PRE' AS system_name, 'MARC' AS table_name, WERKS, CAST(NULL AS DATE) AS own_date, "
        "ZZPSPER AS own_number FROM MARC_PRE WHERE SOURCE_SYSTEM_ERP = 'PRE' UNION ALL "
        "SELECT 'PRE', 'T001W', WERKS, ZGOLIVEDATE, NULL FROM T001W_PRE UNION ALL "
        "SELECT 'PRD', 'MARC', WERKS, ZZREVIEWDT, NULL FROM MARC_PRD WHERE SOURCE_SYSTEM_ERP = 'PRD'"),
    "validated_write_roundtrip": sql(LOCAL, "SELECT * FROM local"),

    "prep_general_material": sql("MARA general", "SELECT * FROM general"),
    "filter_old_material_number": sql("MARA", f"{ALL_MARA} WHERE {OLD_OK}"),
    "filter_not_deleted": sql("MARA", f"{ALL_MARA} WHERE {IN_USE}"),
    "prep_material_valuation": sql("MBEW valuation", "SELECT * FROM valuation"),
    "dedup_latest_price": sql(
        "MBEW", f"SELECT * EXCLUDE (rn) FROM (SELECT *, {LATEST} AS rn FROM MBEW) WHERE rn = 1"),
    "prep_plant_data": sql("MARC plant", "SELECT * FROM plant"),
    "prep_plant_data_extra": sql(
        "MARC", "SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS, sur_pkey FROM MARC"),
    "distinct_plant_data": sql(
        "MARC", "SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS FROM (SELECT DISTINCT "
                f"SOURCE_SYSTEM_ERP, MATNR, WERKS, LVORM FROM MARC WHERE {IN_USE})"),
    "prep_plants": sql("T001W", "SELECT MANDT, WERKS, BWKEY, NAME1 FROM T001W"),
    "prep_valuation_area": sql("T001K area", "SELECT * FROM area"),
    "prep_company_codes": sql("T001", "SELECT MANDT, BUKRS, WAERS FROM T001"),

    "prefix_columns": sql("T001W", "SELECT MANDT AS t001w_MANDT, WERKS AS t001w_WERKS, "
                                   "BWKEY AS t001w_BWKEY, NAME1 AS t001w_NAME1 FROM T001W"),
    "prefix_columns_exclude": sql(
        "MARC", "SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS AS marc_WERKS, LVORM AS marc_LVORM, "
                "sur_pkey AS marc_sur_pkey FROM MARC"),
    "strip_prefixes": sql("MARC", "SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS, LVORM, "
                                  "sur_pkey AS pkey FROM MARC"),

    "join_plant_material": sql(
        "MARA MARC general plant",
        "SELECT p.*, m.MANDT, m.MEINS, m.global_material_number "
        "FROM plant p LEFT JOIN general m ON p.MATNR = m.MATNR"),
    "local_material_integrated": sql(MATERIAL, "SELECT * FROM integrated"),
    "count_duplicates": sql(
        "MARC", f"SELECT *, COUNT(*) OVER ({SAME_KEY}) AS no_of_duplicates FROM ({PLANT_KEYED})"),
    "dedup_material_plant": sql(
        "MARC", "SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS, MIN(sur_pkey) AS sur_pkey, "
                f"COUNT(*) AS no_of_duplicates FROM ({PLANT_KEYED}) GROUP BY ALL"),
    "material_plant_label": sql(
        "T001W", "SELECT WERKS, NAME1, WERKS || COALESCE('-' || NAME1, '') AS mtl_plant_emd "
                 "FROM T001W"),
    "global_material_id": sql(
        "MARA", "SELECT MATNR, ZZMDGM, CASE WHEN ZZMDGM IS NOT NULL AND ZZMDGM <> '' "
                "THEN ZZMDGM ELSE MATNR END AS global_mtl_id FROM MARA"),
    "derive_primary_keys": sql(
        "MARC", "SELECT * REPLACE (NULLIF(WERKS, '7') AS WERKS), "
                "MATNR || CASE WHEN WERKS = '7' THEN '' ELSE '_' || WERKS END "
                "AS primary_key_intra, SOURCE_SYSTEM_ERP || '_' || MATNR || "
                "CASE WHEN WERKS = '7' THEN '' ELSE '_' || WERKS END AS primary_key_inter "
                "FROM MARC"),
    "finish_integrated_material": sql(LOCAL, "SELECT * FROM local"),
    "local_material": sql(LOCAL, "SELECT * FROM local"),
    "local_material_distinct_plants": sql(
        LOCAL, "SELECT * FROM local", general=ALL_MARA,
        plant="SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS FROM (SELECT DISTINCT "
              "SOURCE_SYSTEM_ERP, MATNR, WERKS, LVORM FROM MARC)"),
    "dedup_metrics": sql(
        LOCAL, "SELECT (SELECT COUNT(*) FROM integrated) AS rows_before, "
               "(SELECT COUNT(*) FROM local) AS rows_after, "
               "(SELECT COUNT(*) FROM integrated) - (SELECT COUNT(*) FROM local) "
               "AS duplicates_removed"),

    "prep_order_header": sql("AFKO header", "SELECT * FROM header"),
    "order_month_start": sql(
        "AFKO", f"SELECT AUFNR, GSTRP, {month('GSTRP')} AS start_date FROM AFKO"),
    "order_month_finish": sql(
        "AFKO", f"SELECT AUFNR, GLTRP, {month('GLTRP')} AS finish_date FROM AFKO"),
    "prep_order_item": sql("AFPO", "SELECT * FROM AFPO"),
    "prep_order_master": sql("AUFK master", "SELECT * FROM master"),
    "prep_order_master_partial": sql(
        "AUFK master", "SELECT * EXCLUDE (ZZGLTRP_ORIG, ERNAM) FROM master"),
    "prep_order_material": sql("MARA order_material", "SELECT * FROM order_material"),

    "join_order_items": sql(
        "AFKO AFPO", "SELECT h.SOURCE_SYSTEM_ERP, h.AUFNR, i.AUFNR AS item_AUFNR, "
                     "i.POSNR AS item_POSNR, i.DWERK AS item_DWERK, i.MATNR AS item_MATNR, "
                     "i.MEINS AS item_MEINS, i.KDAUF AS item_KDAUF, i.KDPOS AS item_KDPOS "
                     "FROM AFKO h LEFT JOIN AFPO i ON h.AUFNR = i.AUFNR"),
    "process_order_integrated": sql(ORDERS, "SELECT * FROM order_rows"),
    "join_change_docs": sql(
        f"{ORDERS} CDPOS", "SELECT r.*, c.CHANGENR, c.CHNGIND FROM order_rows r "
                           "LEFT JOIN CDPOS c ON r.OBJNR = c.OBJNR"),
    "process_order_partial_master": sql(
        FINISHED, "SELECT * FROM finished",
        master=f"SELECT {MASTER} FROM (SELECT * REPLACE (CAST(NULL AS DATE) AS ZZGLTRP_ORIG) "
               "FROM AUFK)",
        order_rows=STEPS["order_rows"].replace(
            "AS ZZGLTRP_ORIG)", "AS ZZGLTRP_ORIG, h.AUFNR AS AUFNR)")),
    "coalesce_planned_finish": sql("AFKO AUFK dated", "SELECT AUFNR, ZZGLTRP_ORIG FROM dated"),
    "normalise_dates": sql(
        "AFKO", "SELECT AUFNR, FTRMI, GSTRI, CAST(NULL AS DATE) AS ZZGLTRP_ORIG FROM AFKO"),
    "on_time_flag": sql(
        "AFKO AUFK dated", "SELECT AUFNR, CASE WHEN ZZGLTRP_ORIG >= FTRMI THEN 1 "
                           "WHEN ZZGLTRP_ORIG < FTRMI THEN 0 END AS on_time_flag FROM dated"),
    "on_time_deviation": sql(
        "AFKO AUFK dated", "SELECT AUFNR, CAST(ZZGLTRP_ORIG - FTRMI AS INTEGER) "
                           "AS actual_on_time_deviation FROM dated"),
    "late_delivery_bucket": sql(
        "AFKO AUFK dated",
        "SELECT AUFNR, CAST(ZZGLTRP_ORIG - FTRMI AS INTEGER) AS actual_on_time_deviation, "
        "CASE WHEN ZZGLTRP_ORIG - FTRMI <= 0 THEN 'On time or early' "
        "WHEN ZZGLTRP_ORIG - FTRMI BETWEEN 1 AND 5 THEN '1-5 days late' "
        "WHEN ZZGLTRP_ORIG - FTRMI BETWEEN 6 AND 10 THEN '6-10 days late' "
        "WHEN ZZGLTRP_ORIG - FTRMI >= 11 THEN '>10 days late' END AS late_delivery_bucket "
        "FROM dated"),
    "late_delivery_bucket_actual_minus_planned": sql(
        "AFKO AUFK dated",
        "SELECT AUFNR, CAST(ZZGLTRP_ORIG - FTRMI AS INTEGER) AS actual_on_time_deviation, "
        "CASE WHEN FTRMI - ZZGLTRP_ORIG <= 0 THEN 'On time or early' "
        "WHEN FTRMI - ZZGLTRP_ORIG BETWEEN 1 AND 5 THEN '1-5 days late' "
        "WHEN FTRMI - ZZGLTRP_ORIG BETWEEN 6 AND 10 THEN '6-10 days late' "
        "WHEN FTRMI - ZZGLTRP_ORIG >= 11 THEN '>10 days late' END AS late_delivery_bucket "
        "FROM dated"),
    "mto_vs_mts": sql(
        "AFPO", "SELECT AUFNR, POSNR, KDAUF, CASE WHEN KDAUF IS NOT NULL THEN 'MTO' "
                "ELSE 'MTS' END AS mto_vs_mts_flag FROM AFPO"),
    "order_timestamps": sql(
        "AFKO", "SELECT AUFNR, CAST(FTRMI AS TIMESTAMP) AS order_finish_timestamp, "
                "CAST(GSTRI AS TIMESTAMP) AS order_start_timestamp FROM AFKO"),
    "process_order": sql(FINISHED, "SELECT * FROM finished"),

    "harmonize_local_material": sql(LOCAL, "SELECT * FROM local"),
    "harmonize_process_order": sql(FINISHED, "SELECT * FROM finished"),
    "union_missing_columns": sql(
        "MARC", "SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS, "
                "CASE WHEN SOURCE_SYSTEM_ERP = 'PRD' THEN LVORM END AS LVORM, "
                "CASE WHEN SOURCE_SYSTEM_ERP = 'PRE' THEN sur_pkey END AS sur_pkey FROM MARC"),
    "harmonized_local_material": sql(LOCAL, "SELECT * FROM local", via_csv=True),
    "harmonized_process_order": sql(FINISHED, "SELECT * FROM finished", via_csv=True),
    "process_system": sql(
        f"{LOCAL} {ORDERS} finished".replace(" MARA AFKO", " AFKO"),
        "SELECT 'local_material' AS entity, * FROM local UNION ALL BY NAME "
        "SELECT 'process_order' AS entity, * FROM finished",
        via_csv=True),
}
