"""Rejected arguments, missing columns and schema comparison."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plantloom.contracts import (
    contract_violations, entity_contract, schema_diff, source_contract)
from plantloom.operators.columns import first_present, pick_present, prefix_columns, strip_prefixes
from plantloom.operators.dedup import collapse
from plantloom.plans import material, orders
from plantloom.plans.keys import add_primary_keys
from tests.frames import frame


def test_unknown_system_or_table():
    with pytest.raises(KeyError):
        source_contract("DEV", "MARA")
    with pytest.raises(KeyError):
        entity_contract("DEV", "LOCAL_MATERIAL")


def test_unknown_table(spark):
    with pytest.raises(KeyError):
        source_contract("PRE", "VBAK")


def test_missing_columns_are_named(spark):
    df = frame(spark, "MANDT string", ("1",))
    for build in (material.plants, material.valuation_areas, material.company_codes,
                  material.plant_data, material.material_valuation, orders.order_header,
                  orders.order_items, orders.order_material):
        with pytest.raises(ValueError, match="lacks required columns"):
            build(df)
    with pytest.raises(ValueError, match="ZZMDGM"):
        material.general_material(df)
    with pytest.raises(ValueError, match="EXTRA"):
        material.plant_data(frame(spark, "SOURCE_SYSTEM_ERP string, MATNR string, "
                                         "WERKS string, LVORM string"), additional=["EXTRA"])
    with pytest.raises(ValueError, match="none of the columns"):
        orders.order_master(df)
    with pytest.raises(ValueError):
        material.finish_local_material(df)
    with pytest.raises(ValueError):
        collapse(df, ["MATNR"], "n")


def test_wrong_argument_types(spark):
    df = frame(spark, "a string", ("1",))
    for build in (orders.order_header, orders.order_items, orders.order_master,
                  orders.order_material, material.finish_local_material,
                  orders.finish_process_order):
        with pytest.raises(TypeError):
            build("no frame")
    with pytest.raises(TypeError):
        orders.order_material(df, 7)
    for bad in (lambda: prefix_columns(df, 1), lambda: prefix_columns(df, "p", "a"),
                lambda: prefix_columns(df, "p", [1]), lambda: add_primary_keys(df, 1, ["a"]),
                lambda: add_primary_keys(df, "a", "a"), lambda: add_primary_keys(df, "a", [1]),
                lambda: add_primary_keys(df, "a", ["b"])):
        with pytest.raises(ValueError):
            bad()


def test_first_and_present_columns(spark):
    df = frame(spark, "b string, a string", ("1", "2"))
    assert first_present(df, ["x", "a", "b"]) == "a"
    for none in (["x"], [], None):
        with pytest.raises(ValueError):
            first_present(df, none)
    assert pick_present(df, ["a", "x", "b"]).columns == ["a", "b"]


def test_prefixes(spark):
    df = frame(spark, "MATNR string, ZZ_X string", ("1", "2"))
    prefixed = prefix_columns(df, "marc")
    assert prefixed.columns == ["marc_MATNR", "marc_ZZ_X"]
    assert strip_prefixes(prefixed).columns == df.columns
    assert prefix_columns(df, "p", ["MATNR"]).columns == ["MATNR", "p_ZZ_X"]
    # cut at the first underscore, also where there was no prefix
    assert strip_prefixes(df).columns == ["MATNR", "X"]


def test_schema_diff():
    one, two = (StructType.fromDDL(d) for d in (
        "a int, b string NOT NULL, c date", "c timestamp, d double, b string"))
    assert schema_diff(one, two) == [
        ("a", "only in one", "int", None), ("c", "type", "date", "timestamp"),
        ("d", "only in two", None, "double")]
    assert schema_diff(one, one) == []


def test_contract_violations(spark):
    contract = StructType.fromDDL("a int, b string NOT NULL")
    df = frame(spark, "a int, b string", (1, "x"))
    assert contract_violations(df.schema, contract) == ["b may be null, contract forbids it"]
    filled = df.withColumn("b", F.coalesce("b", F.lit("")))
    assert contract_violations(filled.schema, contract) == []
    # promising more than asked is fine
    assert contract_violations(filled.withColumn("a", F.lit(1)).schema, contract) == []
    assert "columns are" in contract_violations(filled.select("b", "a").schema, contract)[0]
    assert "a is bigint" in contract_violations(
        filled.withColumn("a", F.col("a").cast("long")).schema, contract)[0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_entities_honour_their_contracts(spark, ansi):
    from plantloom.catalog.views import views
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        sf = "/root/testdata/sf0.001"
        local = material.local_material(views(spark, sf, material.TABLES))
        order = orders.process_order(views(spark, sf, orders.TABLES))
        assert contract_violations(
            local.schema, entity_contract("PRE", material.ENTITY)) == []
        assert contract_violations(order.schema, entity_contract("PRD", orders.ENTITY)) == []
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("hidden", ["ahocorasick", "plantloom.llm", "corpus_pipeline", "xxhash"])
def test_entry_goes_on_without_the_optional_part(hidden):
    """A library of the training-data part that is not installed, or the part itself deleted."""
    code = (f"import sys; sys.modules[{hidden!r}] = None\n"
            "import __spark_entry__ as entry\n"
            "from plantloom.catalog.queries import QUERIES\n"
            "assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())\n")
    here = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", code], cwd=here, timeout=120, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert "without the training-data queries" in done.stderr
