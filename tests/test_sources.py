"""Reading extracts, checked output, whole runs."""

import datetime
import logging
import subprocess
import sys
import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plantloom import session
from plantloom.catalog import queries as catalog
from plantloom.contracts import OWN_DDL, SOURCE_DDL, source_contract
from plantloom.plans import material, orders, system
from plantloom.session import children, materialize, scratch, scratch_folder, shared_root
from plantloom.sources import entities
from plantloom.sources.entities import manifest, read_entity, write_entity
from plantloom.sources.extracts import load_system, read_table, stage_tables
from tests.frames import rows

SF = "/root/testdata/sf0.001"
BOM = "﻿"


def write(path, *lines, end="\r\n"):
    path.write_bytes((BOM + end.join(lines) + end).encode())
    return str(path)


def test_types_follow_the_header(spark, tmp_path):
    path = write(
        tmp_path / "PRE_MBEW.csv",
        "LAEPR,UNKNOWN,VERPR,MATNR,LVORM,MANDT,STPRS",
        '2024-01-31,u,1.50,M1,"",100,',
        'no date,v," 7e2", M 2 ,X,100,abc',
        '+10000-01-17,,NaN,"a,b",,200,-0.5')
    df = read_table(spark, path, "PRE", "MBEW")
    assert dict(df.dtypes) == {"LAEPR": "date", "UNKNOWN": "string", "VERPR": "double",
                               "MATNR": "string", "LVORM": "string", "MANDT": "string",
                               "STPRS": "double"}
    got = rows(df.select("MATNR", F.col("LAEPR").cast("string"), "LVORM", "STPRS", "UNKNOWN"))
    assert got == [(" M 2 ", None, "X", None, "v"), ("M1", "2024-01-31", None, None, "u"),
                   ("a,b", "+10000-01-17", None, -0.5, None)]
    assert rows(df.filter("MATNR = 'M1'"), "VERPR") == [(1.5,)]


def test_first_column_behind_a_byte_order_mark(spark, tmp_path):
    df = read_table(spark, write(tmp_path / "a.csv", "MANDT,BUKRS,WAERS", "100,1,EUR"),
                    "PRE", "T001")
    assert rows(df, "MANDT", "WAERS") == [("100", "EUR")]
    assert df.select("WAERS").count() == 1


def test_declared_extra_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", "MATNR,PLIFZ,STAWN,ANZ", "1,2.5,9,302.21", "2,x,8,3")
    df = read_table(spark, path, "PRD", "MARC", extra="PLIFZ double, ANZ int")
    assert rows(df) == [("1", 2.5, "9", None), ("2", None, "8", 3)]


def test_part_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "PRE_T001.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("MANDT,BUKRS,WAERS\n100,1,EUR\n")
    (folder / "part-1.csv").write_text("MANDT,BUKRS,WAERS\n100,2,USD\n")
    assert rows(read_table(spark, str(folder), "PRE", "T001"), "BUKRS") == [("1",), ("2",)]
    (folder / "part-2.csv").write_text("BUKRS,MANDT,WAERS\n3,100,USD\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(folder), "PRE", "T001").collect()


def test_only_wanted_columns_are_parsed(spark, tmp_path):
    path = write(tmp_path / "a.csv", "MANDT,BUKRS,WAERS,REST", "100,1,EUR,x")
    plan = read_table(spark, path, "PRE", "T001").select(
        "WAERS").filter("WAERS = 'EUR'")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<WAERS:string>" in plan
    assert "PushedFilters: [IsNotNull(WAERS), EqualTo(WAERS,EUR)]" in plan


def test_load_system_needs_path_and_files(spark, tmp_path):
    with pytest.raises(KeyError, match="path"):
        load_system(spark, {"name": "PRE"}, ["MARA"])
    with pytest.raises(KeyError):
        load_system(spark, {"name": "DEV", "path": f"{tmp_path}/"}, ["MARA"])
    with pytest.raises(AnalysisException):
        load_system(spark, {"name": "PRE", "path": f"{tmp_path}/"}, ["MARA"])


def test_write_is_refused_when_the_contract_is_broken(spark, tmp_path, caplog):
    good = material.local_material(catalog.tables(spark, SF, material.TABLES))
    root = str(tmp_path / "out")
    nullable = good.withColumn("primary_key_intra", F.nullif("primary_key_intra", F.lit("")))
    turned = good.select(*reversed(good.columns))
    other = good.withColumn("VERPR", F.col("VERPR").cast("float"))
    with caplog.at_level(logging.ERROR):
        for bad in (nullable, turned, other, good.drop("WAERS")):
            assert not write_entity(bad, root, material.ENTITY, "PRE")
    assert "may be null" in caplog.text and not (tmp_path / "out").exists()
    with pytest.raises(KeyError):
        write_entity(good, root, material.ENTITY, "DEV")
    # without a system there is no check
    assert write_entity(turned, root, "local_material")
    assert read_entity(spark, root, "local_material").columns == turned.columns


def test_write_replaces_and_partitions(spark, tmp_path):
    good = material.local_material(catalog.tables(spark, SF, material.TABLES))
    root, folder, versions = str(tmp_path), tmp_path / "PRE" / material.ENTITY, []
    for _ in range(3):
        assert write_entity(good, root, material.ENTITY, "PRE",
                            partition_by=["SOURCE_SYSTEM_ERP"])
        versions.append(manifest(spark, root, material.ENTITY, "PRE")["version"])
    assert read_entity(spark, root, material.ENTITY, "PRE").count() == good.count()
    assert (folder / versions[-1] / "SOURCE_SYSTEM_ERP=PRD").exists()
    # the version before stays for its readers, older ones go
    assert {f.name for f in folder.iterdir() if not f.name.endswith(".crc")} == {"_current", *versions[1:]}


def test_failed_write_leaves_the_published_entity(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        read_entity(spark, root, "t")
    assert write_entity(spark.range(100).toDF("n"), root, "t", made_from="a")
    # some tasks write their files, one fails
    halfway = spark.range(0, 100, 1, 8).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("disk full"))).alias("n"))
    with pytest.raises(Exception, match="disk full"):
        write_entity(halfway, root, "t", made_from="b")
    assert read_entity(spark, root, "t").count() == 100
    assert manifest(spark, root, "t")["made_from"] == "a"
    # a reader of the old version goes on while a new one is published
    old = read_entity(spark, root, "t")
    assert write_entity(spark.range(7).toDF("n"), root, "t")
    assert old.count() == 100 and read_entity(spark, root, "t").count() == 7
    assert len([f for f in (tmp_path / "t").iterdir() if f.is_dir()]) == 2


def test_failure_before_the_switch_leaves_the_published_entity(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert write_entity(spark.range(5), root, "t")

    def broken(*_):
        raise OSError("no connection")

    monkeypatch.setattr(entities, "replace_small", broken)
    with pytest.raises(OSError, match="no connection"):
        write_entity(spark.range(9), root, "t")
    assert read_entity(spark, root, "t").count() == 5


def test_staged_copies_are_narrow_and_equal(spark, tmp_path):
    folder = str(tmp_path / "in")
    config = catalog.write_extracts(spark, SF, folder, "PRE", ["MARA", "MBEW"])
    loaded = load_system(spark, config, ["MARA", "MBEW"])
    staged = stage_tables(loaded, "PRE", str(tmp_path / "staged"))
    assert "LOADED_BY" in loaded["MARA"].columns
    for name, df in staged.items():
        assert set(df.columns) == {c.split()[0] for c in SOURCE_DDL[name].split(", ")}  # no own ones here
        assert df.exceptAll(loaded[name].select(*df.columns)).isEmpty()
        assert df.count() == loaded[name].count()


def test_scratch_lies_in_shared_storage(spark):
    one, two = scratch_folder(spark), scratch_folder(spark)
    assert one != two
    assert one.startswith(f"{spark.conf.get('spark.checkpoint.dir')}/plantloom-")
    assert shared_root("hdfs://shared/tmp/", "hdfs://shared/warehouse", "yarn") == "hdfs://shared/tmp"
    assert shared_root("file:/mnt/shared", "file:/warehouse", "spark://host:7077") == "file:/mnt/shared"
    # without that setting the warehouse's storage, unless it is some machine's own disk
    assert shared_root(None, "s3a://bucket/warehouse", "yarn") == "s3a://bucket/warehouse"
    assert shared_root(None, "file:/warehouse", "local[4]") == "file:/warehouse"
    for own in ("file:/warehouse", "/warehouse"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(None, own, "yarn")


def test_scratch_of_a_block_is_removed(spark):
    with scratch(spark) as folder:
        spark.range(5).write.parquet(f"{folder}/rows")
        assert children(spark, folder) == ["rows"]
    assert children(spark, folder) == []


def test_scratch_goes_with_the_application(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from plantloom.session import materialize\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
        "kept = materialize(spark.range(5))\n"
        "import os\n"
        f"assert kept.count() == 5 and len(os.listdir('{tmp_path}')) > 0\n"
        "spark.stop()\n")
    here = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=here, timeout=120)
    deadline = time.monotonic() + 30  # the JVM ends after Python
    while (left := [p for p in tmp_path.glob("plantloom-*")]) and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not left


def test_materialized_rows_are_read_back(spark):
    df = materialize(spark.range(5).selectExpr("id", "CAST(NULL AS string) AS none"))
    assert df.count() == 5 and df.columns == ["id", "none"]
    assert "Range" not in df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def extracts(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("extracts"))
    return [catalog.write_extracts(spark, SF, f"{folder}/{s}", s, SOURCE_DDL)
            for s in ("PRE", "PRD")]


OPTIONS = {s: system.SystemOptions(
    orders=orders.OrderOptions(as_of=datetime.date(2024, 1, 15))) for s in ("PRE", "PRD")}


def test_run_harmonizes_both_systems(spark, extracts, tmp_path, caplog):
    root = str(tmp_path)
    with caplog.at_level(logging.INFO):
        done = system.run(spark, extracts, root, OPTIONS)
    assert done == {"local_material": True, "process_order": True}
    for entity, name in system.ENTITIES.items():
        both = read_entity(spark, root, entity)
        parts = {s: read_entity(spark, root, name, s) for s in ("PRE", "PRD")}
        assert both.count() == sum(p.count() for p in parts.values())
        for s, part in parts.items():
            assert {r[0] for r in part.select("SOURCE_SYSTEM_ERP").distinct().collect()} == {s}
    # counts seen while writing equal those of the output
    local = read_entity(spark, root, "LOCAL_MATERIAL", "PRE")
    seen = material.dedup_metrics(local).first()
    assert (f"PRE local material: {seen.rows_after} rows, "
            f"{seen.duplicates_removed} duplicates removed") in caplog.text


def test_run_with_one_system_harmonizes_nothing(spark, extracts, tmp_path):
    done = system.run(spark, extracts[:1], str(tmp_path), OPTIONS)
    assert done == {"local_material": False, "process_order": False}
    assert (tmp_path / "PRE" / "PROCESS_ORDER_SCHEMA").exists()


def test_run_is_taken_up_where_it_failed(spark, extracts, tmp_path, monkeypatch):
    loaded = []
    real = system.load_system
    monkeypatch.setattr(system, "load_system", lambda spark, config, names, extra: (
        loaded.append((config["name"], set(names))) or real(spark, config, names, extra)))
    root = str(tmp_path)
    with pytest.raises(AnalysisException):
        system.run(spark, [extracts[0], {"name": "PRD", "path": f"{tmp_path}/none/"}], root, OPTIONS)
    # PRE is published all the same, and the next run leaves it alone
    first = {e: manifest(spark, root, n, "PRE")["version"] for e, n in system.ENTITIES.items()}
    loaded.clear()
    done = system.run(spark, extracts, root, OPTIONS)
    assert done == {"local_material": True, "process_order": True}
    assert {name for name, _ in loaded} == {"PRD"}
    assert first == {e: manifest(spark, root, n, "PRE")["version"] for e, n in system.ENTITIES.items()}
    whole = {e: manifest(spark, root, e)["version"] for e in system.ENTITIES}
    # a third run has nothing to do, harmonising included
    loaded.clear()
    assert system.run(spark, extracts, root, OPTIONS) == done and not loaded
    assert whole == {e: manifest(spark, root, e)["version"] for e in system.ENTITIES}
    # other options build what they concern again
    later = system.SystemOptions(orders=orders.OrderOptions(as_of=datetime.date(2024, 3, 1)))
    system.run(spark, extracts, root, OPTIONS | {"PRD": later})
    assert loaded == [("PRD", set(orders.TABLES))]
    assert manifest(spark, root, "local_material")["version"] == whole["local_material"]
    assert manifest(spark, root, "process_order")["version"] != whole["process_order"]


def test_changed_extracts_are_built_again(spark, tmp_path):
    config = catalog.write_extracts(spark, SF, str(tmp_path / "in"), "PRE", SOURCE_DDL)
    made = {e: system.made_from(spark, config, e, OPTIONS["PRE"]) for e in system.ENTITIES}
    assert made == {e: system.made_from(spark, config, e, OPTIONS["PRE"]) for e in system.ENTITIES}
    (tmp_path / "in" / "PRE_AUFK.csv" / "part-late.csv").write_text("AUFNR\n")
    now = {e: system.made_from(spark, config, e, OPTIONS["PRE"]) for e in system.ENTITIES}
    assert now["local_material"] == made["local_material"]
    assert now["process_order"] != made["process_order"]


def test_failing_harmonization_is_reported(spark, extracts, tmp_path, monkeypatch, caplog):
    def broken(df, root, table, system=None, partition_by=(), made_from=None):
        if system is None and table == "process_order":
            raise OSError("disk full")
        return write_entity(df, root, table, system, partition_by, made_from)

    monkeypatch.setattr(system, "write_entity", broken)
    done = system.run(spark, extracts, str(tmp_path), OPTIONS)
    assert done == {"local_material": True, "process_order": False}
    assert "disk full" in caplog.text


def test_unwritten_entity_is_still_harmonized(spark, extracts, tmp_path, monkeypatch):
    def refuse(df, root, table, system=None, partition_by=(), made_from=None):
        return system is None and write_entity(df, root, table)

    monkeypatch.setattr(system, "write_entity", refuse)
    done = system.run(spark, extracts, str(tmp_path), OPTIONS)
    assert done == {"local_material": True, "process_order": True}
    assert not (tmp_path / "PRE").exists()


def test_own_columns_are_typed_in_their_system_only(spark, tmp_path):
    for name in ("PRE", "PRD"):
        (tmp_path / f"{name}_MARC.csv").write_text(
            "MATNR,ZZREVIEWDT,ZZPSPER,ZZPLT_ICM\n1,2024-01-31,7,x\n2,none,none,\n")
        (tmp_path / f"{name}_T001W.csv").write_text("WERKS,ZGOLIVEDATE\n1,2020-02-29\n")
    kinds = {}
    for name in ("PRE", "PRD"):
        for table, df in load_system(spark, {"name": name, "path": f"{tmp_path}/"}, ["MARC", "T001W"]).items():
            kinds[name, table] = dict(df.dtypes)
            if (name, table) == ("PRE", "MARC"):
                assert rows(df, "MATNR", "ZZPSPER") == [("1", 7), ("2", None)]
    assert kinds["PRE", "MARC"]["ZZPSPER"] == "int" and kinds["PRD", "MARC"]["ZZPSPER"] == "string"
    assert kinds["PRD", "MARC"]["ZZREVIEWDT"] == "date" and kinds["PRE", "MARC"]["ZZREVIEWDT"] == "string"
    assert kinds["PRE", "T001W"]["ZGOLIVEDATE"] == "date" and kinds["PRD", "T001W"]["ZGOLIVEDATE"] == "string"
    # declared anew by the caller: that type counts
    wide = source_contract("PRE", "MARC", "ZZPSPER string, PLIFZ double")
    assert wide["ZZPSPER"].dataType.simpleString() == "string" and "ZZREVIEWDT" not in wide.names
    assert sum(len(ddl.split(", ")) for own in OWN_DDL.values() for ddl in own.values()) == 21


def test_declared_columns_are_typed_and_staged(spark, tmp_path):
    (tmp_path / "PRE_MARA.csv").write_text("MATNR,BRGEW,ERSDA,OTHER\n1,2.5,2024-01-31,x\n")
    extra = {"MARA": "BRGEW double, ERSDA date"}
    loaded = load_system(spark, {"name": "PRE", "path": f"{tmp_path}/"}, ["MARA"], extra)
    staged = stage_tables(loaded, "PRE", str(tmp_path / "staged"), extra)["MARA"]
    assert dict(loaded["MARA"].dtypes) == {
        "MATNR": "string", "BRGEW": "double", "ERSDA": "date", "OTHER": "string"}
    assert staged.columns == ["MATNR", "BRGEW", "ERSDA"]
    assert [tuple(map(str, r)) for r in staged.collect()] == [("1", "2.5", "2024-01-31")]


def test_extracts_are_written_packed(spark, tmp_path):
    words = ["a,b", 'say "x"', "é", "", None] + ["the same plant"] * 20000
    df = spark.createDataFrame([("100", str(i), w, "1") for i, w in enumerate(words)],
                               SOURCE_DDL["T001W"]).coalesce(1)
    catalog.write_extract(df, f"{tmp_path}/PRE_T001W.csv")
    parts = [p for p in (tmp_path / "PRE_T001W.csv").iterdir() if p.name.startswith("part-")]
    text = sum(len(",".join(filter(None, r))) + 1 for r in df.collect())
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    assert sum(p.stat().st_size for p in parts) * 3 < text
    got = load_system(spark, {"name": "PRE", "path": f"{tmp_path}/"}, ["T001W"])["T001W"]
    assert rows(got) == rows(df.replace("", None, ["NAME1"]))


def test_both_systems_are_published_side_by_side(spark, monkeypatch):
    meet, real = threading.Barrier(2, timeout=120), catalog.write_entity

    def met(*args):
        meet.wait()  # fails unless the other system's write has begun too
        return real(*args)

    monkeypatch.setattr(catalog, "write_entity", met)
    assert catalog.QUERIES["validated_write_roundtrip"](spark, SF).count() > 0


def test_entities_are_written_packed(spark, tmp_path):
    df = spark.range(0, 30000, 1, 1).selectExpr(
        "concat('OR', id * 7919) AS k", "timestamp_seconds(id % 9 * 86400) AS at", "'EA' AS unit",
        "IF(id % 3 = 0, NULL, date_from_unix_date(int(id))) AS day")
    for partition_by in ((), ("unit",)):
        root = str(tmp_path / f"by{len(partition_by)}")
        assert write_entity(df, root, "t", partition_by=partition_by)
        assert rows(read_entity(spark, root, "t").select(*df.columns)) == rows(df)
        for part in Path(root).rglob("part-*.parquet"):
            group = pq.ParquetFile(part).metadata.row_group(0)
            columns = [group.column(i) for i in range(group.num_columns)]
            assert {c.compression for c in columns} == {"ZSTD"}
            assert not any("DICTIONARY" in e for c in columns for e in c.encodings)


def test_extracts_and_harmonised_entities_are_written_side_by_side(spark, monkeypatch):
    def meeting(real, counts):
        meet = threading.Barrier(2, timeout=120)

        def met(*args, **options):
            if counts(*args, **options):
                meet.wait()  # fails unless the other one has begun too
            return real(*args, **options)
        return met

    monkeypatch.setattr(catalog, "write_extracts", meeting(catalog.write_extracts, lambda *_: True))
    monkeypatch.setattr(system, "write_entity", meeting(
        write_entity, lambda df, root, table, system=None, **_: system is None))
    assert catalog.QUERIES["harmonized_process_order"](spark, SF).count() > 0


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*")}


def test_written_entities_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    grouped = spark.range(0, 50000, 1, 8).groupBy((F.col("id") % 20000).alias("k")).count()
    assert write_entity(grouped, str(tmp_path), "t")
    deadline = time.monotonic() + 20  # they are deleted beside what comes next
    while (left := shuffle_files(spark) - before) and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not left and read_entity(spark, str(tmp_path), "t").count() == 20000
    assert spark.conf.get(session.CLEANUP) == "false"


def test_blocks_without_shuffle_files_may_overlap(spark):
    one, two = session.shuffles_dropped(spark), session.shuffles_dropped(spark)
    for step, now in ((one.__enter__, "true"), (two.__enter__, "true"),
                      (lambda: one.__exit__(None, None, None), "true"),
                      (lambda: two.__exit__(None, None, None), "false")):
        step()
        assert spark.conf.get(session.CLEANUP) == now


def test_one_entity_is_built_at_a_time_and_extracts_go(spark, monkeypatch):
    configs, busy, order = [], threading.Lock(), []
    real, extract = system.write_entity, catalog.write_extracts

    def alone(df, root, table, system=None, partition_by=(), made_from=None):
        if system is None:
            return real(df, root, table, system, partition_by, made_from)
        assert busy.acquire(blocking=False), "another entity is being built"
        order.append((system, table, {c["name"] for c in configs if children(spark, c["path"])}))
        try:
            return real(df, root, table, system, partition_by, made_from)
        finally:
            busy.release()

    def kept(*args):
        configs.append(extract(*args))
        return configs[-1]

    monkeypatch.setattr(system, "write_entity", alone)
    monkeypatch.setattr(catalog, "write_extracts", kept)
    for name in ("harmonized_local_material", "harmonized_process_order"):
        configs.clear(), order.clear()
        assert catalog.QUERIES[name](spark, SF).count() > 0
        # the first system's extracts are gone while the second is built, and all in the end
        assert [(s, there) for s, _, there in order] == [("PRE", {"PRE", "PRD"})] * 2 + [("PRD", {"PRD"})] * 2
        assert not any(children(spark, c["path"]) for c in configs)


def test_extracts_of_refused_entities_stay(spark, extracts, tmp_path, monkeypatch):
    told = []
    monkeypatch.setattr(system, "write_entity", lambda *_, **__: False)
    system.process_system(spark, extracts[0], str(tmp_path), OPTIONS["PRE"], release=told.append)
    assert not told
    monkeypatch.undo()
    for _ in range(2):  # built, then up to date
        system.process_system(spark, extracts[0], str(tmp_path), OPTIONS["PRE"], release=told.append)
    assert told == [extracts[0]] * 2


def test_process_system_holds_one_systems_extracts(spark, monkeypatch):
    there, real = [], catalog.write_extracts

    def kept(*args):
        config = real(*args)
        there.append(config["path"])
        # the system before has been built and its extracts are gone
        assert [bool(children(spark, path)) for path in there] == [False] * (len(there) - 1) + [True]
        return config

    monkeypatch.setattr(catalog, "write_extracts", kept)
    df = catalog.QUERIES["process_system"](spark, SF)
    assert len(there) == 2 and not any(children(spark, path) for path in there) and df.count() > 0


def test_extracts_only_one_entity_reads_go_with_it(spark, monkeypatch, tmp_path, extracts):
    there, real = {}, system.write_entity

    def seen(df, root, table, entity_system=None, **options):
        if entity_system and table == orders.ENTITY:
            there[entity_system] = {p for c in configs if c["name"] == entity_system
                                    for p in children(spark, c["path"])}
        return real(df, root, table, entity_system, **options)

    configs, extract = [], catalog.write_extracts

    def kept(*args):
        configs.append(extract(*args))
        return configs[-1]

    monkeypatch.setattr(system, "write_entity", seen)
    monkeypatch.setattr(catalog, "write_extracts", kept)
    for name in ("harmonized_local_material", "process_system"):
        configs.clear(), there.clear()
        assert catalog.QUERIES[name](spark, SF).count() > 0
        assert there == {s: {f"{s}_{t}.csv" for t in orders.TABLES} for s in ("PRE", "PRD")}
    # what a refused entity still reads stays
    told = []
    monkeypatch.setattr(system, "write_entity", lambda df, root, table, *args, **options: (
        table != material.ENTITY and real(df, root, table, *args, **options)))
    built = system.process_system(spark, extracts[0], str(tmp_path), OPTIONS["PRE"], stage=False,
                                  release_table=lambda config, table: told.append(table))
    assert told == [t for t in orders.TABLES if t not in material.TABLES]
    assert built["local_material"].count() > 0
