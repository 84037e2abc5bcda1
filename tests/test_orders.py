"""Join chaining, dates, punctuality and order type."""

import datetime

import pytest
from pyspark.sql import functions as F

from plantloom.functions import orders as rules
from plantloom.operators import joins
from plantloom.operators.joins import left_join_many
from plantloom.plans import orders
from tests.frames import frame, rows, table

DAY = datetime.date
AS_OF = DAY(2024, 5, 17)


def world(spark):
    base = {"SOURCE_SYSTEM_ERP": "PRD", "MANDT": "100", "GLTRP": DAY(2024, 2, 20)}
    return {
        "AFKO": table(
            spark, "AFKO",
            base | {"AUFNR": "1", "GSTRP": DAY(2024, 2, 11), "FTRMI": DAY(2024, 2, 10)},
            base | {"AUFNR": "2"}, base | {"AUFNR": "3", "GLTRP": None},
            base | {"AUFNR": None}),
        "AFPO": table(
            spark, "AFPO", {"AUFNR": "1", "POSNR": "1", "MATNR": "m", "KDAUF": "so"},
            {"AUFNR": "1", "POSNR": "2", "MATNR": "old", "KDAUF": ""},
            {"AUFNR": "3", "POSNR": "1", "DWERK": "P"},
            {"AUFNR": None, "POSNR": "lost"}, {"AUFNR": "9", "POSNR": "lost"}),
        "AUFK": table(
            spark, "AUFK",
            {"AUFNR": "1", "OBJNR": "o1", "ZZGLTRP_ORIG": DAY(2024, 2, 16)},
            {"AUFNR": "3", "OBJNR": "o3"}),
        "MARA": table(
            spark, "MARA", {"MATNR": "m", "ZZMDGM": "g", "NTGEW": 1.0, "MTART": "t"},
            {"MATNR": "old", "BISMT": "ARCHIVE", "ZZMDGM": "h"}),
    }


def sides(spark):
    t = world(spark)
    return (orders.order_header(t["AFKO"], AS_OF), orders.order_items(t["AFPO"]),
            orders.order_master(t["AUFK"]), orders.order_material(t["MARA"]))


def test_join_chain(spark):
    df = orders.integrate_orders(*sides(spark))
    assert rows(df, "AUFNR", "POSNR", "global_material_number", "ZZGLTRP_ORIG") == [
        ("1", "1", "g", DAY(2024, 2, 16)),
        # archived material: nothing known about it
        ("1", "2", None, DAY(2024, 2, 16)),
        # planned finish known to neither side
        ("3", "1", None, None),
        # no item and no master record, hence no order number; plan from the header
        (None, None, None, DAY(2024, 2, 20)),
        (None, None, None, DAY(2024, 2, 20))]
    assert "MATNR" not in df.columns


def test_header_key_can_be_kept(spark):
    df = orders.integrate_orders(*sides(spark), keep_header_key=True)
    assert rows(df, "AUFNR", "POSNR") == [
        ("1", "1"), ("1", "2"), ("2", None), ("3", "1"), (None, None)]


def test_change_documents(spark):
    changes = frame(spark, "OBJNR string, CHANGENR string", ("o1", "c1"), ("o1", "c2"),
                    (None, "c3"), ("o9", "c4"))
    df = orders.integrate_orders(*sides(spark), changes=changes)
    assert df.columns.count("OBJNR") == 1
    assert rows(df, "OBJNR", "POSNR", "CHANGENR") == [
        ("o1", "1", "c1"), ("o1", "1", "c2"), ("o1", "2", "c1"), ("o1", "2", "c2"),
        ("o3", "1", None), (None, None, None), (None, None, None)]
    with pytest.raises(ValueError, match="POSNR"):
        orders.integrate_orders(*sides(spark), changes=changes.withColumnRenamed(
            "CHANGENR", "POSNR"))


def test_master_without_planned_finish(spark):
    header, items, master, material = sides(spark)
    df = orders.integrate_orders(header, items, master.drop("ZZGLTRP_ORIG"), material)
    assert set(rows(df, "ZZGLTRP_ORIG")) == {(DAY(2024, 2, 20),), (None,)}


def test_month_start(spark):
    header = sides(spark)[0]
    assert rows(header, "AUFNR", "start_date", "finish_date") == [
        ("1", DAY(2024, 2, 1), DAY(2024, 2, 1)), ("2", DAY(2024, 5, 1), DAY(2024, 2, 1)),
        ("3", DAY(2024, 5, 1), DAY(2024, 5, 1)), (None, DAY(2024, 5, 1), DAY(2024, 2, 1))]
    today = orders.order_header(world(spark)["AFKO"]).select(
        (F.col("start_date") == F.trunc(F.current_date(), "month")).alias("now"),
        "GSTRP").filter("GSTRP IS NULL")
    assert set(rows(today, "now")) == {(True,)}
    far = spark.range(1).select(F.expr("date '+10000-01-19'").alias("d")).select(
        rules.month_of("d").cast("string"))
    assert rows(far) == [("+10000-01-01",)]


def test_lateness_limits(spark):
    days = [None, -11, -10, -6, -5, -1, 0, 1, 5, 6, 10, 11]
    df = frame(spark, "d int", *[(d,) for d in days])

    def labels(sign):
        return {r[0]: r[1] for r in
                df.select("d", rules.lateness("d", sign).alias("x")).collect()}

    late = {1: "1-5 days late", 5: "1-5 days late", 6: "6-10 days late",
            10: "6-10 days late", 11: ">10 days late", None: None}
    assert labels(rules.PLANNED_MINUS_ACTUAL) == {
        d: late.get(d, "On time or early") for d in days}
    assert labels(rules.ACTUAL_MINUS_PLANNED) == {
        d: late.get(None if d is None else -d, "On time or early") for d in days}
    with pytest.raises(ValueError):
        rules.lateness(sign="sideways")


def test_finish(spark):
    df = orders.process_order(world(spark), orders.OrderOptions(as_of=AS_OF))
    by = {r.primary_key_inter: r for r in df.collect()}
    one = by["PRD_1_1"]
    assert (one.on_time_flag, one.actual_on_time_deviation, one.late_delivery_bucket) == (
        1, 6, "6-10 days late")
    assert one.order_finish_timestamp == datetime.datetime(2024, 2, 10)
    assert one.order_start_timestamp is None
    # an empty sales order still counts as one
    assert [by[k].mto_vs_mts_flag for k in ("PRD_1_1", "PRD_1_2", "PRD_3_1_P", "PRD")] == [
        "MTO", "MTO", "MTS", "MTS"]
    other = by["PRD_3_1_P"]
    assert (other.on_time_flag, other.actual_on_time_deviation,
            other.late_delivery_bucket) == (None, None, None)
    fixed = orders.process_order(world(spark), orders.OrderOptions(
        as_of=AS_OF, lateness_sign=rules.ACTUAL_MINUS_PLANNED))
    assert {r.late_delivery_bucket for r in fixed.collect()} == {"On time or early", None}


def test_text_dates(spark):
    df = frame(spark, "ZZGLTRP_ORIG string, FTRMI string, GSTRI string, SOURCE_SYSTEM_ERP string, "
                      "AUFNR string, POSNR string, DWERK string, KDAUF string",
               ("2024-01-05", "2024-01-07", "soon", "PRE", "1", "1", "P", None))
    got = orders.finish_process_order(df).first()
    assert (got.on_time_flag, got.actual_on_time_deviation, got.GSTRI) == (0, -2, None)
    assert got.FTRMI == DAY(2024, 1, 7)


@pytest.mark.parametrize("heavy", [False, True])
def test_many_join_equals_outer_join(spark, monkeypatch, heavy):
    left = frame(spark, "k string, l int", ("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5),
                 ("c", 6), ("c", 7))
    right = frame(spark, "r string, v int", ("a", 1), ("a", 2), ("c", None), (None, 9), ("z", 8))
    outer = left.join(right, F.col("k") == F.col("r"), "left")
    salted = []
    monkeypatch.setattr(joins, "_may_be_skewed", lambda df: heavy)
    real = joins.heavy_keys
    monkeypatch.setattr(joins, "heavy_keys", lambda *a: salted.append(real(*a)) or salted[-1])
    for again in (False, True):
        got = left_join_many(left, right, [("k", "r")], again=again)
        assert got.columns == outer.columns
        assert rows(got) == rows(outer)
    # at eight partitions every key of this table is a heavy one
    assert salted == ([{"a": 8, "c": 4, "z": 4}] * 2 if heavy else [])
    assert rows(left_join_many(left, right.limit(0), [("k", "r")])) == rows(
        left.join(right.limit(0), F.col("k") == F.col("r"), "left"))
