from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F, types as T

from ledgerflow.operators import clean, regression, udfs
from ledgerflow.plans import jobs
from ledgerflow.session import SESSION_DEFAULTS, scratch_path, shared_dir
from ledgerflow.sinks import files as out, jdbc as jdbc_out
from ledgerflow.sinks.export import dataset_paths, export_datasets
from ledgerflow.sources import files as src, jdbc
from ledgerflow.streaming import ingest
from ledgerflow.templates import ExportTemplate, SheetTemplate, pick_template


def test_in_line_sources(spark):
    declared = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])
    assert src.from_rows(spark, [("a", 1)], declared).schema == declared
    assert src.from_rows(spark, [("a", 1)], ["name", "n"]).dtypes == [("name", "string"), ("n", "bigint")]
    assert src.from_pandas(spark, pd.DataFrame({"v": [1.5, 2.5]})).count() == 2
    assert src.number_range(spark, 5).count() == 5


def test_csv_forms(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.sql("SELECT 1 AS id, 'a;b' AS t, TIMESTAMP_NTZ '2024-01-02 03:04:05.123456' AS at")
    out.write_csv(rows, path, sep=";")
    back = src.read_csv(spark, path, "id int, t string, at timestamp_ntz", sep=";").collect()[0]
    assert tuple(back) == (1, "a;b", dt.datetime(2024, 1, 2, 3, 4, 5, 123456))
    assert src.read_csv(spark, path, sep=";").dtypes[0] == ("id", "string")
    assert src.read_csv(spark, path, sep=";", infer=True).dtypes[0] == ("id", "int")


def test_missing_rows_and_reports(spark):
    flights = spark.createDataFrame(
        [(11, "QX", "HAN", 80.0, 2.0), (12, "QY", None, 75.0, 9.0), (13, "QX", "SGN", 61.0, None),
         (14, "QZ", "DAD", 44.0, 0.0), (15, "QZ", "HUI", 52.0, None), (16, "QY", "PQC", None, 31.0)],
        "id int, carrier string, org string, duration double, delay double",
    )
    assert clean.count_missing(flights, "delay").collect()[0].missing == 2
    valid = clean.drop_missing(flights, ["delay"])
    assert valid.count() == 4 and clean.drop_missing(valid).count() == 2
    assert tuple(clean.drop_report(flights).collect()[0]) == (6, 2, 4)
    assert clean.fill_sentinel(flights).filter("org = '<NULL>'").count() == 1
    bad = clean.cast_columns(spark.sql("SELECT '1.5' AS v UNION ALL SELECT 'x'"), {"v": "double"})
    assert {r.v for r in bad.collect()} == {1.5, None}


def test_writes_keep_the_stage_before_them_wide(spark):
    """The exchange before the write, not the source, takes on the number of connections."""
    rows = spark.range(0, 100, 1, 12)
    assert jdbc_out.spread(rows, 3).rdd.getNumPartitions() == 3
    assert "Exchange RoundRobinPartitioning(3)" in plan_of(jdbc_out.spread(rows, 3))
    db = jdbc.Database("postgresql", "db.example", 5432, "dwh", "loader", "secret")
    assert jdbc_out.write_options(db, "t", connections=7)["numPartitions"] == "7"


@pytest.mark.parametrize("kind, values", [
    ("int", [3, 1, 1, 1, 1, 1, 2, 9, None]),
    ("string", ["b", "it's", "a", None, "", "é", "a", "a"]),
    ("date", [dt.date(2024, 1, 1), dt.date(2023, 5, 6), None, dt.date(2024, 1, 1)]),
    ("timestamp_ntz", [dt.datetime(2024, 1, 1, 12), dt.datetime(2023, 5, 6, 1, 2, 3, 400), None]),
    ("decimal(9,2)", [Decimal("1.50"), Decimal("-7.25"), Decimal("0.00")]),
    ("string", [None, None]),
])
def test_every_row_meets_one_range(spark, kind, values):
    """Bounds as the database would compute them; a common value begins one range only."""
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    rows.createOrReplaceTempView("source_of_ranges")
    lows = [r[0] for r in spark.sql(jdbc.quantile_query("source_of_ranges", "v", 4)).collect()]
    predicates = jdbc.range_predicates("v", lows)
    assert len(predicates) <= 4
    met = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    if met:
        assert {r[0] for r in rows.select(sum(met[1:], met[0])).collect()} == {1}
    else:
        assert len({v for v in values if v is not None}) <= 1


def test_hash_predicates():
    db = jdbc.Database("oracle", "h", 1521, "svc", "u")
    assert jdbc.hash_predicates(db, "ACC", 2) == [
        "ACC IS NULL OR (ACC IS NOT NULL AND ORA_HASH(ACC, 1) = 0)", "ACC IS NOT NULL AND ORA_HASH(ACC, 1) = 1",
    ]
    other = jdbc.Database("postgresql", "h", 5432, "svc", "u")
    assert "HASHTEXT" in jdbc.hash_predicates(other, "acc", 3)[2] and len(jdbc.hash_predicates(other, "acc", 3)) == 3
    with pytest.raises(ValueError, match="two splits"):
        jdbc.hash_predicates(db, "ACC", 1)
    with pytest.raises(TypeError, match="bytes"):
        jdbc.range_predicates("v", [b"a", b"b"])


def test_jdbc_options():
    db = jdbc.Database("postgresql", "db.example", 5432, "dwh", "loader", "secret")
    assert db.url == "jdbc:postgresql://db.example:5432/dwh" and "secret" not in repr(db)
    plain = jdbc.read_options(db, table="ods.t")
    assert plain["dbtable"] == "ods.t" and plain["driver"] == "org.postgresql.Driver"
    assert jdbc.read_options(db, query="SELECT 1")["query"] == "SELECT 1"
    split = jdbc.read_options(db, query="SELECT 1", split_column="id", bounds=(0, 10), splits=4)
    assert split["dbtable"] == "(SELECT 1) source_rows" and split["numPartitions"] == "4"
    assert jdbc.Database("oracle", "h", 1521, "svc", "u").url == "jdbc:oracle:thin:@//h:1521/svc"
    assert jdbc_out.write_options(db, "t", truncate=True)["truncate"] == "true"
    assert "truncate" not in jdbc_out.write_options(db, "t")
    with pytest.raises(ValueError):
        jdbc.read_options(db)
    with pytest.raises(ValueError):
        jdbc.read_options(db, table="t", split_column="id")


REPORTS = ExportTemplate(
    "csv", "|",
    {"BANK": SheetTemplate(True, "Totals per bank", "Banks", {"NO": "STT", "RPT_SESSION": "Session"})},
)


def export_rows(spark):
    banks = spark.createDataFrame(
        [(1, "20250101", "AA", 10), (2, "20250102", "BB", 20)],
        "NO int, RPT_SESSION string, ACQ_BANK string, NUM_OF_TXN int",
    )
    return banks, banks.filter("NO > 5")


def test_export_writes_maps_and_skips(spark, tmp_path):
    banks, nothing = export_rows(spark)
    base = str(tmp_path / "out")
    manifest = export_datasets([banks, nothing, banks], ["BANK", "EMPTY", "OTHER"], base, REPORTS)
    found = {r.dataset: (r.sheet_name, r.title, r.row_count, r.written) for r in manifest.collect()}
    assert found == {
        "BANK": ("Banks", "Totals per bank", 2, True),
        "EMPTY": ("EMPTY", "", 0, False),
        "OTHER": ("OTHER", "", 2, True),
    }
    assert dataset_paths(base, ["BANK", "EMPTY", "OTHER"]) == [
        f"{base}_BANK", f"{base}_1_EMPTY", f"{base}_2_OTHER",
    ]
    assert not (tmp_path / "out_1_EMPTY").exists()
    back = src.read_csv(spark, f"{base}_BANK", sep="|")
    assert back.columns == ["STT", "Session", "ACQ_BANK", "NUM_OF_TXN"] and back.count() == 2


@pytest.mark.parametrize("extension", ["txt", "json", "dat"])
def test_export_formats(spark, tmp_path, extension):
    banks, _ = export_rows(spark)
    base = str(tmp_path / "out")
    template = ExportTemplate(extension, "|", REPORTS.sheets)
    export_datasets([banks], ["BANK"], base, template, map_columns=False)
    lines = sorted(r.value for r in spark.read.text(f"{base}_BANK").collect())
    if extension == "json":
        assert lines[0] == '{"NO":1,"RPT_SESSION":"20250101","ACQ_BANK":"AA","NUM_OF_TXN":10}'
    else:
        assert lines[0] == "1|20250101|AA|10" and len(lines) == 2


def test_export_checks_and_templates(spark):
    banks, nothing = export_rows(spark)
    with pytest.raises(ValueError):
        export_datasets([banks, banks], ["BANK"], "/nowhere", REPORTS)
    made = ExportTemplate.from_dict({"extension": "txt", "sheets": {"A": {"has_header": "y", "title": "T"}}})
    assert made.sheet("A").has_header and made.sheet("B").title == ""
    templates = {"DEFAULT": REPORTS, "OWN": made}
    assert pick_template(templates, "OWN") is made
    assert pick_template(templates, "missing") is REPORTS and pick_template(templates, None) is REPORTS


def messages(spark, path, values, mode="append"):
    rows = spark.createDataFrame([(str(i).encode(), v.encode()) for i, v in enumerate(values)], ingest.MESSAGE)
    rows.coalesce(1).write.mode(mode).parquet(path)


def test_stream_ingest_restarts_without_doubles(spark, tmp_path):
    base = str(tmp_path)
    for values in (['{"timestamp": 1.5}', "broken"], ['{"timestamp": 2.5}']):
        messages(spark, f"{base}/in", values)
        for _ in range(2):
            jobs.bronze_stream(spark, f"{base}/lake", f"{base}/cp", source="parquet", path=f"{base}/in")
    raw = spark.read.parquet(f"{base}/lake")
    assert sorted(r.raw_json for r in raw.collect()) == sorted(
        ['{"timestamp": 1.5}', "broken", '{"timestamp": 2.5}']
    )
    good, bad = ingest.split_corrupt(ingest.decode_json(raw, "timestamp double"))
    assert sorted(r.timestamp for r in good.collect()) == [1.5, 2.5]
    assert [r.raw_json for r in bad.collect()] == ["broken"]


def test_key_value_stream_to_memory(spark, tmp_path):
    messages(spark, str(tmp_path / "in"), ["x", "y"])
    pairs = ingest.key_value_text(ingest.read_messages(spark, "parquet", str(tmp_path / "in")))
    query = ingest.console_stream(pairs, "memory", queryName="pairs_seen")
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("pairs_seen").collect())) == [("0", "x"), ("1", "y")]
    assert ingest.kafka_options("h:1", "t")["startingOffsets"] == "latest"


def test_user_functions_and_regression(spark):
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate([10, 20, 35])], "id int, value double")
    plus = udfs.apply_series_function(rows, "value", "more", lambda s: s + 10, T.DoubleType())
    assert [r.more for r in plus.orderBy("id").collect()] == [20.0, 30.0, 45.0]
    one = udfs.apply_row_function(rows, "value", "twice", lambda v: v * 2, T.DoubleType())
    assert [r.twice for r in one.orderBy("id").collect()] == [20.0, 40.0, 70.0]
    points = spark.range(200).select("id", F.col("id").cast("double").alias("x"), (F.col("id") * 3.0 + 7).alias("y"))
    train, test = regression.key_split(points, "id")
    assert train.count() + test.count() == 200 and 100 < train.count() < 180
    model = regression.fit_linear(regression.assemble(train, ["x"]), "y")
    found = regression.coefficients(spark, model, ["x"]).collect()[0]
    assert abs(found.coef_x - 3) < 1e-6 and abs(found.intercept - 7) < 1e-4
    scored = regression.score(model, regression.assemble(test, ["x"]))
    assert scored.filter(F.abs(F.col("prediction") - F.col("y")) > 1e-3).count() == 0


def test_golden_record_keeps_one_row_per_identity(spark):
    def source(rows, name):
        frame = spark.createDataFrame(rows, "full_name string, phone string, email string, address string, n int")
        return clean.add_source(frame, name)

    core = source([("A", "1", "a@x", "old", 1), ("B", "2", "b@x", "b", 2), ("A", "1", "a@x", "new", 3)], "core")
    crm = source([("A", "1", "a@y", "other", 1), ("B", "2", "b@x", "crm", 2), (None, "3", "c@x", "c", 3)], "crm")
    golden = jobs.golden_record(
        [core, crm], ["email", "phone"], ["full_name", "phone", "email", "address"],
        ["full_name", "phone"], [F.desc("load_time")], [F.asc("source"), F.desc("n")],
        {"full_name": "customer_name"}, created=True,
    )
    assert golden.columns[-1] == "created_at"
    found = sorted((r.customer_name, r.email, r.address) for r in golden.collect())
    assert found == [("A", "a@x", "new"), ("A", "a@y", "other"), ("B", "b@x", "b")]


def test_checked_load_and_staged_copy(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(4).write.parquet(source)
    how = dict(
        read=spark.read.parquet, write=lambda d: out.write_parquet(d, target),
        read_back=lambda: spark.read.parquet(target), table="t",
    )
    for _ in range(2):
        audit = jobs.checked_load(spark, source, **how)
        assert tuple(audit.collect()[0]) == ("t", 4, "SUCCESS")
    with pytest.raises(FileNotFoundError):
        jobs.checked_load(spark, str(tmp_path / "nowhere"), **how)
    copied = []
    jobs.copy_through_staging(spark.read.parquet(source), str(tmp_path / "st"), ["id"], copied.append)
    assert copied[0].count() == 4


def test_shared_folder_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (folder or shared_dir(spark))
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))
    assert SESSION_DEFAULTS["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_lake_format_follows_the_session(spark):
    assert out.lake_format(spark) == "parquet"


def test_sums_of_money_are_exact(spark):
    from ledgerflow.operators.reports import fee_summary

    rows = spark.createDataFrame([("a", 0.1, 0.1)] * 10, "acct string, fee double, vat double")
    row = fee_summary(rows, ["acct"], F.col("fee"), F.col("vat")).collect()[0]
    assert (row.FEE_AMOUNT, row.FEE_VAT_AMT, row.FEE_TOTAL_AMT) == (
        Decimal("1.0000"), Decimal("0.1000"), Decimal("1.1000"),
    )


def test_a_restarted_split_stream_doubles_neither_side(spark, tmp_path):
    """Killed after its second batch was written and before that was noted; then run again."""
    schema = "n int"
    texts = [f'{{"n": {k}}}' if k % 3 else f"bad {k}" for k in range(30)]
    for k in range(0, 30, 10):
        rows = spark.createDataFrame([(None, t.encode()) for t in texts[k : k + 10]], "key binary, value binary")
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def start():
        messages = ingest.read_messages(spark, "parquet", str(tmp_path / "in"), maxFilesPerTrigger="1")
        return ingest.split_stream(ingest.raw_text(messages), schema, out, checkpoint, available_now=True)

    ingest.run_to_end(start())
    wanted = sorted(str(r) for side in ingest.read_split(spark, out, schema) for r in side.collect())
    good, bad = ingest.read_split(spark, out, schema)
    assert sorted(r.n for r in good.collect()) == [k for k in range(30) if k % 3]
    assert sorted(r.raw_json for r in bad.collect()) == sorted(t for t in texts if t.startswith("bad"))
    # Forget that the last two batches were committed, as a kill between write and commit leaves it.
    for batch in (1, 2):
        for name in (f"{batch}", f".{batch}.crc"):
            (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    ingest.run_to_end(start())
    again = sorted(str(r) for side in ingest.read_split(spark, out, schema) for r in side.collect())
    assert again == wanted
