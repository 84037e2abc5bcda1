"""Process orders from files shaped like real extracts: BOM, CRLF, blank cells, an extra column."""

import datetime

from plantloom.contracts import SOURCE_DDL, contract_violations, entity_contract
from plantloom.plans import orders
from plantloom.sources.extracts import load_system


def extract(folder, table, rows):
    names = [part.split()[0] for part in SOURCE_DDL[table].split(", ")]
    header = ["ROW_ID", *names] + ([] if "SOURCE_SYSTEM_ERP" in names else ["SOURCE_SYSTEM_ERP"])
    lines = [header] + [[str(i), *[r.get(n, "PRD" if n == "SOURCE_SYSTEM_ERP" else "")
                                   for n in header[1:]]] for i, r in enumerate(rows)]
    text = "".join(",".join(line) + "\r\n" for line in lines)
    (folder / f"PRD_{table}.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())


def test_process_order_from_sample_files(spark, tmp_path):
    numbers = [f"{i:064x}" for i in range(7)]
    extract(tmp_path, "AFKO", [{"AUFNR": n, "MANDT": "100"} for n in numbers])
    extract(tmp_path, "AFPO", [{"AUFNR": n, "POSNR": "1", "DWERK": "W", "MATNR": f"m{i % 5}"}
                               for i, n in enumerate(numbers)])
    extract(tmp_path, "AUFK", [{"AUFNR": n, "OBJNR": f"o{i}", "AUART": "ZP"}
                               for i, n in enumerate(numbers)])
    extract(tmp_path, "MARA", [{"MANDT": "100", "MATNR": f"m{i}", "NTGEW": "1.5"} for i in range(5)])
    tables = load_system(spark, {"name": "PRD", "path": f"{tmp_path}/"}, orders.TABLES)
    made = orders.process_order(tables, orders.OrderOptions(as_of=datetime.date(2024, 1, 15)))
    assert contract_violations(made.schema, entity_contract("PRD", orders.ENTITY)) == []
    got = made.collect()
    assert sorted(r.AUFNR for r in got) == numbers
    for r in got:
        assert r.SOURCE_SYSTEM_ERP == "PRD" and r.NTGEW == 1.5 and r.mto_vs_mts_flag == "MTS"
        assert r.start_date == r.finish_date == datetime.date(2024, 1, 1)
        assert {r.ZZGLTRP_ORIG, r.FTRMI, r.GSTRI, r.on_time_flag, r.actual_on_time_deviation,
                r.late_delivery_bucket, r.order_start_timestamp} == {None}


def test_headers_are_read_in_full_once(spark):
    from plantloom.catalog.queries import QUERIES
    made = QUERIES["process_order"](spark, "/root/testdata/sf0.001")
    # the joins read the headers again for their numbers, not for their dates
    assert made._jdf.queryExecution().optimizedPlan().toString().count("AS finish_date") == 1
