"""ERP-shaped tables derived from the driver's star schema.

One SQL text per table, understood alike by Spark and by the checking engine.
Whole tables go in; records that must find no partner keep their row and get a
key of their own. Planted on purpose: retired old numbers, deletion flags that
are set, empty and null, split valuations, unknown price dates, repeated plant
rows, plants, valuation areas and companies without partner, null and empty
global numbers, orders without item or master record, and deviations on both
sides of every lateness limit. There are two clients: materials, plants,
valuations, areas and companies belong to either by their number, some materials
and plants to both, and some plants and companies have copies that differ.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "MARA": """
        SELECT CASE WHEN p_partkey % 9 = 4 THEN '200' ELSE '100' END AS MANDT,
               CAST(p_partkey AS STRING) AS MATNR,
               CASE p_partkey % 13 WHEN 0 THEN 'X' WHEN 1 THEN '' ELSE NULL END AS LVORM,
               p_type AS MTART,
               CASE p_partkey % 11 WHEN 0 THEN 'ARCHIVE' WHEN 1 THEN 'DUPLICATE'
                    WHEN 2 THEN 'RENUMBERED' WHEN 3 THEN NULL ELSE p_name END AS BISMT,
               CASE p_size % 3 WHEN 0 THEN 'EA' WHEN 1 THEN 'KG' ELSE 'L' END AS MEINS,
               p_retailprice AS NTGEW,
               CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ''
                    ELSE 'G' || CAST(p_partkey AS STRING) END AS ZZMDGM
        FROM {part}
        UNION ALL
        SELECT '200', CAST(p_partkey AS STRING), NULL, p_type, p_name, 'PC', p_retailprice,
               'S' || CAST(p_partkey AS STRING)
        FROM {part} WHERE p_partkey % 9 = 2""",
    "MARC": """
        SELECT CASE l_suppkey % 2 WHEN 0 THEN 'PRE' ELSE 'PRD' END AS SOURCE_SYSTEM_ERP,
               CAST(l_partkey AS STRING) AS MATNR, CAST(l_suppkey AS STRING) AS WERKS,
               CASE l_orderkey % 9 WHEN 0 THEN 'X' WHEN 1 THEN '' ELSE NULL END AS LVORM,
               CAST(l_orderkey AS STRING) AS sur_pkey
        FROM {lineitem}""",
    "MBEW": """
        SELECT CASE WHEN l_orderkey % 6 = 5 THEN '200' ELSE '100' END AS MANDT,
               CAST(l_partkey AS STRING) AS MATNR,
               CAST(l_suppkey AS STRING) AS BWKEY,
               CASE WHEN l_linenumber = 7 THEN 'SPLIT' ELSE NULL END AS BWTAR,
               CASE l_orderkey % 10 WHEN 3 THEN 'X' WHEN 4 THEN '' ELSE NULL END AS LVORM,
               l_linestatus AS VPRSV, l_extendedprice AS VERPR, l_quantity AS STPRS,
               l_tax AS PEINH, l_returnflag AS BKLAS,
               CASE WHEN l_orderkey % 8 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS LAEPR,
               CAST(l_orderkey AS STRING) AS sur_pkey
        FROM {lineitem}""",
    "T001W": """
        SELECT CASE WHEN s_suppkey % 8 = 1 THEN '200' ELSE '100' END AS MANDT,
               CASE WHEN s_suppkey % 23 = 5 THEN 'closed-' ELSE '' END
                    || CAST(s_suppkey AS STRING) AS WERKS,
               CAST(s_suppkey AS STRING) AS BWKEY,
               CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_name END AS NAME1
        FROM {supplier}
        UNION ALL
        SELECT CASE WHEN s_suppkey % 8 = 1 THEN '100' ELSE '200' END,
               CAST(s_suppkey AS STRING), CAST(s_suppkey AS STRING), 'Branch ' || s_name
        FROM {supplier} WHERE s_suppkey % 5 = 2
        UNION ALL
        SELECT CASE WHEN s_suppkey % 8 = 1 THEN '200' ELSE '100' END,
               CAST(s_suppkey AS STRING), CAST(s_suppkey AS STRING), s_name || ' annex'
        FROM {supplier} WHERE s_suppkey % 6 = 0""",
    "T001K": """
        SELECT CASE WHEN s_suppkey % 7 = 0 THEN '200' ELSE '100' END AS MANDT,
               CAST(s_suppkey AS STRING) AS BWKEY,
               CAST(s_nationkey AS STRING) AS BUKRS FROM {supplier}
        UNION ALL
        SELECT CASE WHEN s_suppkey % 7 = 0 THEN '200' ELSE '100' END AS MANDT,
               CAST(s_suppkey AS STRING) AS BWKEY,
               CAST(s_nationkey AS STRING) AS BUKRS FROM {supplier}""",
    "T001": """
        SELECT CASE WHEN n_nationkey % 5 = 1 THEN '200' ELSE '100' END AS MANDT,
               CASE WHEN n_nationkey % 8 = 3 THEN 'closed-' ELSE '' END
                    || CAST(n_nationkey AS STRING) AS BUKRS,
               'CUR' || CAST(n_regionkey AS STRING) AS WAERS
        FROM {nation}
        UNION ALL
        SELECT CASE WHEN n_nationkey % 5 = 1 THEN '200' ELSE '100' END,
               CAST(n_nationkey AS STRING), 'ALT' || CAST(n_regionkey AS STRING)
        FROM {nation} WHERE n_nationkey % 6 = 0""",
    "AFKO": """
        SELECT CASE o_orderkey % 2 WHEN 0 THEN 'PRE' ELSE 'PRD' END AS SOURCE_SYSTEM_ERP,
               CASE WHEN o_orderkey < 0 THEN '000' ELSE '100' END AS MANDT,
               CAST(o_orderkey AS STRING) AS AUFNR,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + 30 END AS GLTRP,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) END AS GSTRP,
               CAST(o_orderdate AS DATE) + 1 AS FTRMS, CAST(o_orderdate AS DATE) + 28 AS GLTRS,
               CAST(o_orderdate AS DATE) + 2 AS GSTRS, CAST(o_orderdate AS DATE) + 3 AS GSTRI,
               CAST(o_orderdate AS DATE) + 25 AS GETRI, CAST(o_orderdate AS DATE) + 27 AS GLTRI,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(10 + (o_orderkey * 7) % 41 AS INT)
                    END AS FTRMI,
               CAST(o_orderdate AS DATE) + 4 AS FTRMP, o_orderpriority AS DISPO,
               o_orderstatus AS FEVOR, CAST(NULL AS STRING) AS PLGRP,
               CAST(o_custkey AS STRING) AS FHORI, CAST(o_orderkey AS STRING) AS AUFPL
        FROM {orders}""",
    "AFPO": """
        SELECT CAST(l_orderkey AS STRING) AS AUFNR, CAST(l_linenumber AS STRING) AS POSNR,
               CAST(l_suppkey AS STRING) AS DWERK, CAST(l_partkey AS STRING) AS MATNR,
               'EA' AS MEINS,
               CASE l_returnflag WHEN 'R' THEN NULL WHEN 'A' THEN ''
                    ELSE 'SO' || CAST(l_orderkey AS STRING) END AS KDAUF,
               CAST(l_linenumber AS STRING) AS KDPOS
        FROM {lineitem}""",
    "AUFK": """
        SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'lost-' ELSE '' END
                    || CAST(o_orderkey AS STRING) AS AUFNR,
               'OR' || CAST(o_orderkey AS STRING) AS OBJNR,
               CAST(o_orderdate AS DATE) AS ERDAT, CAST(o_custkey AS STRING) AS ERNAM,
               o_orderstatus AS AUART,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + 30 END AS ZZGLTRP_ORIG,
               o_orderpriority AS ZZPRO_TEXT
        FROM {orders}""",
    "CDPOS": """
        SELECT 'OR' || CAST(l_orderkey AS STRING) AS OBJNR,
               CAST(l_linenumber AS STRING) AS CHANGENR, l_linestatus AS CHNGIND
        FROM {lineitem}""",
}

# Plant data with columns of their own types that no contract knows.
VIEWS["MARC_WIDE"] = VIEWS["MARC"].replace(
    "AS sur_pkey", "AS sur_pkey, CAST(l_quantity AS DOUBLE) AS EISBE, "
    "CAST(l_shipdate AS DATE) AS AUSDT, CAST(l_linenumber AS INT) AS WEBAZ")

# Plant data and plants with columns that one system alone has.
VIEWS["MARC_PRE"] = VIEWS["MARC"].replace(
    "AS sur_pkey", "AS sur_pkey, CAST(l_linenumber AS INT) AS ZZPSPER, l_returnflag AS ZZPSREV")
VIEWS["MARC_PRD"] = VIEWS["MARC"].replace(
    "AS sur_pkey", "AS sur_pkey, CAST(l_shipdate AS DATE) AS ZZREVIEWDT, l_returnflag AS ZZMSDS_REQ")
VIEWS["T001W_PRE"] = """
        SELECT '100' AS MANDT, CAST(s_suppkey AS STRING) AS WERKS, s_name AS NAME1,
               CAST(s_suppkey AS STRING) AS BWKEY,
               CASE WHEN s_suppkey % 7 <> 0
                    THEN CAST('2020-01-01' AS DATE) + CAST(s_suppkey % 900 AS INT) END AS ZGOLIVEDATE,
               CAST(s_nationkey AS STRING) AS ZVKORG
        FROM {supplier}"""

INPUTS = ("part", "lineitem", "supplier", "nation", "orders")


def views(spark: SparkSession, sf_dir: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    """The named ERP tables over the parquet files in ``sf_dir``."""
    texts = {t: VIEWS[t] for t in tables}
    inputs = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in INPUTS
              if any("{" + name + "}" in text for text in texts.values())}
    return {t: spark.sql(text, **{n: df for n, df in inputs.items() if "{" + n + "}" in text})
            for t, text in texts.items()}


def view(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One ERP table over the parquet files in ``sf_dir``."""
    return views(spark, sf_dir, [table])[table]


def view_sql(table: str) -> str:
    """The same table as plain SQL over views named like the parquet files."""
    return VIEWS[table].format(**{name: name for name in INPUTS})
