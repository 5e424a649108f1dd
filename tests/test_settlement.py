from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from conftest import plan_of
from pyspark.sql import functions as F

from ledgerflow.operators.settlement import (
    REPORT_HEADER,
    map_labels,
    unmapped_labels,
    read_reports,
    scan_records,
    split_lines,
    table_column,
    to_report_table,
)
from ledgerflow.plans.jobs import import_reports
from ledgerflow.sources.lines import read_lines

SAMPLE = """
ACME CLEARING HOUSE
SYSTEM DATE 05/17/24   CPD 05/18/24
DAILY DETAIL

TCR 0 Record
Destination Identifier      5550001234
Source Identifier           QWERTY

TCR 1 Record
Transaction ID              31337
Account Number              4000000000000002
Purchase Date               20240515
Settlement amount - Inter  -000000987
Source Amount              +000054321
Interchange Fee Amount     000000456
"""


def put(tmp_path, name, text):
    folder = tmp_path / "reports"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_sample_report(spark, tmp_path):
    path = put(tmp_path, "20240519_REPORT.TXT", SAMPLE)
    put(tmp_path, "notes.txt", "TCR 0 Record\nTransaction ID  1\nTransaction ID  2\n")
    out = {r["Transaction ID"]: r for r in read_reports(spark, path).collect()}
    assert set(out) == {"31337", "1"}
    row = out["31337"]
    assert tuple(row.asDict()) == REPORT_HEADER and len(REPORT_HEADER) == 51
    dates = (row["Record Date"], row["CPD"], row["System Date"])
    assert dates == ("20240519", "20240518", "20240517")
    assert row["Destination Identifier"] == "5550001234" and row["Source Identifier"] == "QWERTY"
    assert row["Account Number"] == "4000000000000002"
    assert row["Purchase Date"] == dt.datetime(2024, 5, 15)
    assert row["Source Amount"] == Decimal(54321)
    assert row["Settlement amount - Inter"] == Decimal(-987)
    assert row["Interchange Fee Amount"] == Decimal(456)
    assert out["1"]["Record Date"] is None and out["1"]["CPD"] is None


def test_labels(spark):
    asked = ["Transaction ID", "terminal id", "TCQ", "Account Num", "Account Number",
             "account-number  Extension", "settlement amount inter", "nothing like it"]
    rows = spark.createDataFrame([(a,) for a in asked], "label string")
    found = {r.label: r.header for r in map_labels(rows, "label").collect()}
    assert found == dict(zip(asked, [
        "Transaction ID", "Terminal ID", "TCQ of financial tran", "Account Number", "Account Number",
        "Account Number Extension", "Settlement amount - Inter",
    ]))


def test_single_letters_mean_nothing_and_cut_headers_are_met(spark):
    cut = next(h for h in REPORT_HEADER if len(h) == max(map(len, REPORT_HEADER)))
    asked = ["T", "S", "C", "p", "Acc", "Account N", f"{cut}rest", "CPD", "nothing like it"]
    rows = spark.createDataFrame([(a,) for a in asked], "label string")
    found = {r.label: r.header for r in map_labels(rows, "label").collect()}
    assert found == {f"{cut}rest": cut, "CPD": "CPD"}
    left = {r.label: r.lines for r in unmapped_labels(rows.unionAll(rows), "label").collect()}
    assert left == {a: 2 for a in asked if a not in found}


def test_table_names():
    assert [table_column(h) for h in REPORT_HEADER[:4]] == [
        "RECORD_DATE", "CPD", "SYSTEM_DATE", "DESTINATION_IDENTIFIER",
    ]
    assert table_column("Leaf Level SRE-ID") == "LEAF_LEVEL_SRE_ID"
    assert table_column("Settlement amount - Inter") == "SETTLEMENT_AMOUNT_INTER"


def test_records_and_pages_run_across_blocks(spark, tmp_path, small_blocks):
    draw = random.Random(5)
    wanted = []
    for f in range(3):
        lines, day = ["TITLE"], None
        for i in range(60):
            if draw.random() < 0.2:
                day = f"{draw.randint(1, 12):02}/{draw.randint(1, 28):02}/24"
                lines += ["", f"SYSTEM DATE {day}   CPD {day}", "PAGE HEADING"]
            lines.append("TCR 0 Record")
            lines += [f"Product Id   p{i}"] * draw.randint(0, 4)
            lines += ["TCR 1 Record", f"Transaction ID   {f}-{i}", f"Merchant Name   shop  no {i}"]
            month_first = None if day is None else f"2024{day[:2]}{day[3:5]}"
            wanted.append((f"{f}-{i}", f"shop  no {i}", month_first, f"2024010{f}"))
        path = put(tmp_path, f"2024010{f}_X.TXT", "\n".join(lines) + "\n")
    out = read_reports(spark, path).select("Transaction ID", "Merchant Name", "CPD", "Record Date")
    assert sorted(tuple(r) for r in out.collect()) == sorted(wanted)


def test_year_first_page_dates(spark, tmp_path):
    path = put(tmp_path, "20251103_R.TXT", "SYSTEM DATE 24/11/03   ...   CPD 24/11/03\nTCR 0 Record\nVMID  1\n")
    row = read_reports(spark, path).collect()[0]
    assert row["System Date"] == "20241103" and row["CPD"] == "20241103"


def test_job_writes_the_report_table(spark, tmp_path):
    path = put(tmp_path, "20251103_R.TXT", SAMPLE)
    target = str(tmp_path / "table")
    import_reports(spark, path, lambda rows: rows.write.mode("append").parquet(target))
    import_reports(spark, path, lambda rows: rows.write.mode("append").parquet(target))
    assert spark.read.parquet(target).count() == 2
    import_reports(spark, path, lambda rows: rows.write.mode("overwrite").parquet(target))
    assert spark.read.parquet(target).count() == 1


def test_only_small_tables_are_broadcast_and_no_nested_loop(spark, tmp_path):
    path = put(tmp_path, "20251103_R.TXT", SAMPLE)
    plan = plan_of(to_report_table(read_reports(spark, path)))
    assert "NestedLoop" not in plan and "SinglePartition" not in plan


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    """A third of all lines in one record, page dates from far above, blocks without any record."""
    day = ["SYSTEM DATE 05/17/24   CPD 05/18/24", *["heading"] * 60]
    long = ["TCR 0 Record", "VMID  first", *[f"No such label   {k}" for k in range(300)], "VMID  second",
            *[f"filler line {k}" for k in range(100)], "Product Id  late", "CPD 01/02/24",
            *[f"filler line {k}" for k in range(100)], "Merchant Name  last  one"]
    rest = [line for k in range(150) for line in ("TCR 0 Record", f"VMID  v{k}", "Product Id  p")]
    above = ["VMID  above all", *[f"line {k}" for k in range(80)]]
    put(tmp_path, "20240519_A.TXT", "\n".join([*above, *day, *long, *rest]))
    path = put(tmp_path, "20240520_B.TXT", "\n".join([*above, *above]))
    out = read_reports(spark, path).select("VMID", "Product Id", "Merchant Name", "CPD", "System Date")
    wanted = [("first", "late", "last  one", "20240518", "20240517")]
    wanted += [(f"v{k}", "p", None, "20240102", "20240517") for k in range(150)]
    assert sorted(map(tuple, out.collect())) == sorted(wanted)


def test_small_arrow_batches_split_no_record(spark, tmp_path):
    path = put(tmp_path, "20240519_REPORT.TXT", SAMPLE * 3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = sorted(map(str, read_reports(spark, path).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert sorted(map(str, read_reports(spark, path).collect())) == wanted and len(wanted) == 3
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_only_records_across_blocks_are_exchanged(spark, tmp_path):
    """Lines are read once and never laid out anew; records are exchanged once, by their opener."""
    path = put(tmp_path, "20251103_R.TXT", SAMPLE)
    lines = split_lines(read_lines(spark, path), F.lit("x"))
    assert "Exchange" not in plan_of(scan_records(lines)) and plan_of(scan_records(lines)).count("MapInArrow") == 1
    plan = plan_of(read_reports(spark, path))
    assert "FileScan text" not in plan
    assert plan.count("Exchange hashpartitioning(_file") == 1 and "_opener" in plan
