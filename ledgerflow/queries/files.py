"""Readers, writers, templated import and export, report import, streams.

Each query first writes the table it reads back, to a fresh path in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.operators.aggregates import load_audit
from ledgerflow.operators.settlement import REPORT_HEADER, table_column
from ledgerflow.plans.jobs import import_reports
from ledgerflow.queries.registry import query
from ledgerflow.session import scratch_path
from ledgerflow.sinks.export import export_datasets
from ledgerflow.sinks.files import write_csv, write_json, write_lake, write_parquet
from ledgerflow.sources import files as src
from ledgerflow.sources.delimited import (
    fit_staging_slots,
    import_delimited,
    import_summary,
    source_files,
)
from ledgerflow.sources.files import read_table as table
from ledgerflow.streaming import ingest
from ledgerflow.templates import ExportTemplate, ImportTemplate, SheetTemplate

CUSTOMER_SCHEMA = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)
CUSTOMER_SQL = "SELECT * FROM customer"


@query(CUSTOMER_SQL)
def csv_declared_schema(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf, "customer"), path, header=False)
    return src.read_csv(spark, path, CUSTOMER_SCHEMA, header=False)


@query("""SELECT cast(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf, "customer"), path)
    found = src.read_csv(spark, path, infer=True)
    return found.withColumn("c_custkey", F.col("c_custkey").cast("int"))


@query(CUSTOMER_SQL)
def csv_separator(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf, "customer"), path, header=False, sep=";")
    return src.read_csv(spark, path, CUSTOMER_SCHEMA, header=False, sep=";")


@query("""SELECT c_custkey, c_name, CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS c_nationkey
FROM customer""")
def csv_null_token(spark, sf):
    path = scratch_path(spark, "csv")
    nation = F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string"))
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.coalesce(nation, F.lit("NA")).alias("c_nationkey")
    )
    write_csv(rows, path)
    return src.read_csv(
        spark, path, "c_custkey bigint, c_name string, c_nationkey int", null_token="NA"
    )


@query("""SELECT cast(c_custkey AS VARCHAR) AS c_custkey, c_name,
       cast(c_nationkey AS VARCHAR) AS c_nationkey FROM customer""")
def csv_all_text(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), path)
    return src.read_csv(spark, path)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_lines(spark, sf):
    path = scratch_path(spark, "json")
    events = table(spark, sf, "events")
    write_json(events, path)
    return src.read_json(spark, path, events.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def parquet_round_trip(spark, sf):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, sf, "documents"), path)
    return src.read_parquet(spark, path)


@query("SELECT * FROM nation")
def lake_write(spark, sf):
    path = scratch_path(spark, "lake")
    write_lake(table(spark, sf, "nation"), path, "parquet")
    return spark.read.parquet(path)


def write_with_heading(
    df: DataFrame, file_key: str, order: str, line: str, heading: list[str], path: str
) -> None:
    """One text file per ``file_key`` value, lines in order under the heading lines."""

    def add_heading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = None
        for batch in batches:
            pieces = []
            for key, rows in batch.groupby(file_key, sort=False):
                if key != current:
                    pieces.append(pd.DataFrame({file_key: key, line: heading}))
                    current = key
                pieces.append(rows[[file_key, line]])
            yield pd.concat(pieces)

    ordered = (
        df.select(file_key, order, line)
        .repartition(file_key)
        .sortWithinPartitions(file_key, order)
    )
    kind = df.schema[file_key].dataType.simpleString()
    lines = ordered.mapInPandas(add_heading, f"{file_key} {kind}, {line} string")
    lines.write.partitionBy(file_key).text(path)


PART_TEMPLATE = ImportTemplate(
    table_name="part_import",
    header=("Part No", "Name", "Brand", "Kind", "Size"),
    column_mapping={
        "Part No": "part_no", "Name": "part_name", "Brand": "brand", "Kind": "kind", "Size": "size",
    },
    separator="|",
    start_row=2,
)


def part_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as delimited lines, a thousand per file."""
    cells = F.concat_ws("|", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return table(spark, sf, "part").select(
        "p_partkey", F.expr("p_partkey div 1000").alias("file_no"), cells.alias("text")
    )


@query("""SELECT cast(p_partkey AS VARCHAR) AS "PART_NO", p_name AS "PART_NAME", p_brand AS "BRAND",
       p_type AS "KIND", cast(p_size AS VARCHAR) AS "SIZE" FROM part""")
def import_template(spark, sf):
    path = scratch_path(spark, "import")
    write_with_heading(part_lines(spark, sf), "file_no", "p_partkey", "text", ["heading"], path)
    return import_delimited(spark, path, PART_TEMPLATE)


@query("""SELECT p_name AS "NAME", p_brand AS "BRAND", p_type AS "KIND" FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey // 1000 ORDER BY p_partkey) AS n FROM part)
WHERE n <= 700""")
def import_window(spark, sf):
    path = scratch_path(spark, "import")
    heading = ["a heading", "", "c|d"]
    write_with_heading(part_lines(spark, sf), "file_no", "p_partkey", "text", heading, path)
    template = ImportTemplate(
        table_name="part_import", header=("Name", "Brand", "Kind"), start_row=4, end_row=703,
        start_col=2, end_col=4,
    )
    return import_delimited(spark, path, template)


@query("""SELECT cast(p_partkey AS VARCHAR) AS "C1", p_name AS "C2", p_brand AS "C3",
       p_type AS "C4", cast(p_size AS VARCHAR) AS "C5" FROM part WHERE p_partkey % 1000 < 600""")
def import_stop_empty(spark, sf):
    path = scratch_path(spark, "import")
    empty = F.col("p_partkey") % 1000 == 600
    lines = part_lines(spark, sf).withColumn(
        "text", F.when(empty, F.lit("||||")).otherwise(F.col("text"))
    )
    write_with_heading(lines, "file_no", "p_partkey", "text", ["heading"], path)
    template = ImportTemplate(
        table_name="part_import", start_row=2, sheet_rules=True, read_to_empty_row=True
    )
    return import_delimited(spark, path, template)


#: Columns of parts, in files of two, four and six columns.
PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_container")


@query("""SELECT cast(p_partkey AS VARCHAR) AS "C1", p_name AS "C2",
       CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS "C3", CASE WHEN p_partkey % 3 > 0 THEN p_type END AS "C4",
       CASE WHEN p_partkey % 3 = 2 THEN cast(p_size AS VARCHAR) END AS "C5",
       CASE WHEN p_partkey % 3 = 2 THEN 'box ' || p_brand END AS "C6" FROM part""")
def import_mixed_width(spark, sf):
    """Headerless files of two, four and six columns in one import; each file's first row rules."""
    path = scratch_path(spark, "import")
    parts = table(spark, sf, "part").withColumn("p_container", F.concat(F.lit("box "), "p_brand"))
    for kind in range(3):
        rows = parts.filter(F.col("p_partkey") % 3 == kind).select(*PART_COLUMNS[: 2 * kind + 2])
        write_csv(rows, f"{path}/{kind}", header=False, sep="|")
    template = ImportTemplate(table_name="part_import", start_row=1, sheet_rules=True)
    return import_delimited(spark, [f"{path}/{kind}" for kind in range(3)], template)


def flat(c: str):
    """Line breaks and tabs to blanks, since an import line is one row."""
    return F.trim(F.regexp_replace(c, r"[\r\n\t]", " "))


FLAT_SQL = r"trim(regexp_replace(text, '[\r\n\t]', ' ', 'g'), ' ')"


@query(f"""SELECT cast(doc_id AS VARCHAR) AS "DOC_ID", nullif(
  CASE WHEN lang IN ('fr', 'de') THEN regexp_replace({FLAT_SQL}, '[^\\x{{00}}-\\x{{FF}}]', '?', 'g')
       ELSE {FLAT_SQL} END, '') AS "TEXT" FROM documents""")
def import_encoding(spark, sf):
    path = scratch_path(spark, "import")
    docs = table(spark, sf, "documents").select("doc_id", flat("text").alias("text"), "lang")
    latin = F.coalesce(F.col("lang").isin("fr", "de"), F.lit(False))
    how = dict(header=False, sep="\t", escape='"')
    write_csv(docs.filter(latin).drop("lang"), f"{path}/latin", encoding="ISO-8859-1", **how)
    write_csv(docs.filter(~latin).drop("lang"), f"{path}/utf8", **how)
    template = ImportTemplate(
        table_name="docs", header=("doc_id", "text"), separator="\t", start_row=1
    )
    return import_delimited(spark, [f"{path}/latin", f"{path}/utf8"], template)


#: Letters of windows-1252 where Latin-1 has control characters, and those control characters.
PAGE_LETTERS, PAGE_BYTES = "€šŽ“”", "\x80\x9a\x8e\x93\x94"


@query("""SELECT cast(p_partkey AS VARCHAR) AS "NO", CASE p_partkey % 3
  WHEN 0 THEN p_name || ' € šŽ “' || p_brand || '” é' WHEN 1 THEN p_name || ' € Đ “' || p_brand || '” 漢'
  ELSE p_name || ' ' || chr(129) || p_brand || ' é' END AS "TEXT" FROM part""")
def import_code_pages(spark, sf):
    """Three encodings in one import that is set to windows-1252: its own, UTF-8, and Latin-1."""
    path = scratch_path(spark, "import")
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_partkey") % 3
    rows = table(spark, sf, "part")
    # Written as Latin-1, whose control characters are the code page's letters.
    page = F.translate(F.concat(name, F.lit(" € šŽ “"), brand, F.lit("” é")), PAGE_LETTERS, PAGE_BYTES)
    texts = [
        (page, "ISO-8859-1"),
        (F.concat(name, F.lit(" € Đ “"), brand, F.lit("” 漢")), "UTF-8"),
        (F.concat(name, F.lit(" \x81"), brand, F.lit(" é")), "ISO-8859-1"),
    ]
    for k, (text, encoding) in enumerate(texts):
        chosen = rows.filter(kind == k).select("p_partkey", text.alias("text"))
        write_csv(chosen, f"{path}/{k}", header=False, sep="|", encoding=encoding)
    template = ImportTemplate(
        table_name="parts", header=("no", "text"), separator="|", start_row=1, encoding="windows-1252"
    )
    return import_delimited(spark, [f"{path}/{k}" for k in range(3)], template)


@query("""SELECT cast(c_custkey AS VARCHAR) AS "FIELD_01_15", substr(c_name, 1, 12) AS "FIELD_02_12",
       c_mktsegment AS "FIELD_01_20" FROM customer""")
def staging_slots(spark, sf):
    path = scratch_path(spark, "import")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    write_csv(rows, path)
    template = ImportTemplate(
        table_name="staging", header=("Id", "Name", "Segment"), separator=",",
        column_mapping={"Id": "Field_01_15", "Name": "Field_02_12", "Segment": "Field_01_20"},
    )
    return fit_staging_slots(import_delimited(spark, path, template))


@query("""SELECT p_partkey // 1000 AS file_no, count(*) AS row_count, 5 AS column_count,
  'string' AS column_type FROM part GROUP BY 1""")
def import_audit(spark, sf):
    path = scratch_path(spark, "import")
    write_with_heading(part_lines(spark, sf), "file_no", "p_partkey", "text", ["heading"], path)
    imported = import_delimited(spark, path, PART_TEMPLATE, file_column="FILE")
    summary = import_summary(imported, "FILE", source_files(spark, path, "FILE"))
    number = F.regexp_extract("FILE", r"file_no=(\d+)", 1).cast("bigint")
    kinds = F.array_distinct(F.transform(F.split("column_types", ", "), lambda t: F.element_at(F.split(t, " "), -1)))
    return summary.select(
        number.alias("file_no"), "row_count", "column_count", F.array_join(kinds, " ").alias("column_type")
    )


def brand_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("NUM"), F.sum("p_size").alias("TOTAL")
    )


REPORTS = ExportTemplate(
    extension="csv",
    separator="|",
    sheets={
        "BRANDS": SheetTemplate(
            title="Parts per brand", sheet_name="Brands",
            column_mapping={"p_brand": "Brand", "NUM": "Parts", "TOTAL": "Total size"},
        ),
        "NATIONS": SheetTemplate(has_header=False, title="Nations"),
    },
)


@query("""SELECT 'BRANDS' AS dataset, 'Brands' AS sheet_name, 'Parts per brand' AS title,
       (SELECT count(DISTINCT p_brand) FROM part) AS row_count, TRUE AS written
UNION ALL SELECT 'NATIONS', 'NATIONS', 'Nations', (SELECT count(*) FROM nation), TRUE
UNION ALL SELECT 'NONE', 'NONE', '', 0, FALSE""")
def export_manifest(spark, sf):
    datasets = [
        brand_totals(spark, sf),
        table(spark, sf, "nation"),
        table(spark, sf, "part").filter(F.col("p_size") < 0),
    ]
    base = scratch_path(spark, "export")
    manifest = export_datasets(datasets, ["BRANDS", "NATIONS", "NONE"], base, REPORTS)
    return manifest.drop("path")


BRANDS_SQL = """SELECT p_brand AS "Brand", cast(count(*) AS VARCHAR) AS "Parts",
       cast(sum(p_size) AS VARCHAR) AS "Total size" FROM part GROUP BY p_brand"""


@query(BRANDS_SQL)
def export_csv(spark, sf):
    base = scratch_path(spark, "export")
    export_datasets([brand_totals(spark, sf)], ["BRANDS"], base, REPORTS)
    return src.read_csv(spark, f"{base}_BRANDS", sep="|")


@query(BRANDS_SQL)
def export_text(spark, sf):
    base = scratch_path(spark, "export")
    template = ExportTemplate("txt", "|", REPORTS.sheets)
    export_datasets([brand_totals(spark, sf)], ["BRANDS"], base, template)
    schema = "`Brand` string, `Parts` string, `Total size` string"
    return src.read_csv(spark, f"{base}_BRANDS", schema, header=False, sep="|")


@query("""SELECT p_brand, count(*) AS "NUM", cast(sum(p_size) AS BIGINT) AS "TOTAL" FROM part
GROUP BY p_brand""")
def export_json(spark, sf):
    base = scratch_path(spark, "export")
    template = ExportTemplate("json", sheets=REPORTS.sheets)
    export_datasets([brand_totals(spark, sf)], ["BRANDS"], base, template, map_columns=False)
    return src.read_json(spark, f"{base}_BRANDS", "p_brand string, NUM bigint, TOTAL bigint")


def write_reports(spark: SparkSession, sf: str, path: str) -> None:
    """Orders as settlement reports, one per order date's year, a page heading above each record."""
    orders = table(spark, sf, "orders")
    cents = F.lpad((F.abs(F.col("o_totalprice").cast("decimal(18,2)")) * 100).cast("bigint").cast("string"), 9, "0")
    sign = F.when(F.col("o_orderstatus") == "F", "-").otherwise("+")
    day = F.col("o_orderdate")
    lines = [
        F.concat(F.lit("SYSTEM DATE "), F.date_format(day, "MM/dd/yy"), F.lit("   CPD "),
                 F.date_format(day, "MM/dd/yy")),
        F.lit("SOME PAGE HEADING"),
        F.lit("TCR 0 Record"),
        F.concat(F.lit("Destination Identifier     "), F.col("o_custkey").cast("string")),
        F.concat(F.lit("Source-Identifier  \u0001"), F.col("o_orderpriority")),
        F.lit(""),
        F.lit("TCR 1 Record"),
        F.concat(F.lit("  transaction-id          "), F.col("o_orderkey").cast("string")),
        F.concat(F.lit("Account Num               "), F.lpad(F.col("o_custkey").cast("string"), 16, "4")),
        F.concat(F.lit("Settlement amount - Inter  "), sign, cents),
        F.concat(F.lit("TCQ                       "), F.col("o_orderstatus")),
        F.concat(F.lit("Purchase Date             "), F.date_format(day, "yyyyMMdd")),
        F.lit("No such label             x"),
    ]
    report = F.concat(F.date_format(day, "yyyy"), F.lit("0131_REPORT.TXT"))
    text = F.concat_ws("\n", *lines)
    orders.select(report.alias("report"), text.alias("value")).write.partitionBy("report").text(path)


def _report_sql() -> str:
    day = "strftime(o_orderdate, '%Y%m%d')"
    known = {
        "Record Date": "strftime(o_orderdate, '%Y') || '0131'",
        "CPD": day,
        "System Date": day,
        "Destination Identifier": "cast(o_custkey AS VARCHAR)",
        "Source Identifier": "o_orderpriority",
        "Transaction ID": "cast(o_orderkey AS VARCHAR)",
        "Account Number": "lpad(cast(o_custkey AS VARCHAR), 16, '4')",
        "TCQ of financial tran": "o_orderstatus",
        "Settlement amount - Inter": """cast(cast(cast(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)
            * (CASE o_orderstatus WHEN 'F' THEN -1 ELSE 1 END) AS BIGINT)""",
        "Source Amount": "cast(NULL AS BIGINT)",
        "Interchange Fee Amount": "cast(NULL AS BIGINT)",
        "Purchase Date": "o_orderdate",
    }
    columns = [f'{known.get(h, "cast(NULL AS VARCHAR)")} AS "{table_column(h)}"' for h in REPORT_HEADER]
    return f"SELECT {', '.join(columns)} FROM orders"


@query(_report_sql())
def report_import(spark, sf):
    path, target = scratch_path(spark, "reports"), scratch_path(spark, "report-table")
    write_reports(spark, sf, path)
    import_reports(spark, path, lambda rows: write_parquet(rows, target, mode="append"), "report")
    found = src.read_parquet(spark, target)
    amounts = ("SOURCE_AMOUNT", "SETTLEMENT_AMOUNT_INTER", "INTERCHANGE_FEE_AMOUNT")
    return found.withColumns({c: F.col(c).cast("bigint") for c in amounts})


@query("""SELECT 'report_table' AS table_name, count(*) AS row_count, 'SUCCESS' AS status FROM orders""")
def report_audit(spark, sf):
    """The audit row of a report import: what the report table holds against the records sent."""
    path, target = scratch_path(spark, "reports"), scratch_path(spark, "report-table")
    write_reports(spark, sf, path)
    sent = import_reports(spark, path, lambda rows: write_parquet(rows, target), "report")
    return load_audit(src.read_parquet(spark, target), "report_table", sent.count())


def write_messages(spark: SparkSession, sf: str, path: str) -> None:
    """Events as binary key/value messages."""
    events = table(spark, sf, "events")
    payload = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    broken = F.concat(F.lit("not json "), F.col("event_id").cast("string"))
    value = F.when(F.col("event_type") == "error", broken).otherwise(payload)
    events.select(
        F.encode(F.col("event_id").cast("string"), "UTF-8").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
    ).write.parquet(path)


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Messages through the raw ingest stream, as they land in the lake."""
    base = scratch_path(spark, "stream")
    write_messages(spark, sf, f"{base}/in")
    stream = ingest.raw_text(ingest.read_messages(spark, "parquet", f"{base}/in"))
    ingest.run_to_end(
        ingest.append_stream(stream, f"{base}/lake", f"{base}/checkpoint", available_now=True)
    )
    return spark.read.schema("raw_json string").parquet(f"{base}/lake")


@query("""SELECT event_id::VARCHAR AS event_id, event_type <> 'error' AS is_json FROM events""")
def stream_bronze(spark, sf):
    raw = _bronze(spark, sf)
    broken = F.regexp_extract("raw_json", r"^not json (\d+)$", 1)
    own = F.get_json_object("raw_json", "$.event_id")
    return raw.select(
        F.when(broken != "", broken).otherwise(own).alias("event_id"),
        (broken == "").alias("is_json"),
    )


@query("""SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'""")
def stream_json(spark, sf):
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    good, _ = ingest.split_corrupt(ingest.decode_json(_bronze(spark, sf), schema))
    return good


@query("""SELECT 'not json ' || event_id AS raw_json FROM events WHERE event_type = 'error'""")
def stream_corrupt(spark, sf):
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    _, bad = ingest.split_corrupt(ingest.decode_json(_bronze(spark, sf), schema))
    return bad


@query("""SELECT event_id, user_id, event_type, value, NULL::VARCHAR AS raw_json FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, NULL, NULL, 'not json ' || event_id FROM events WHERE event_type = 'error'""")
def stream_split(spark, sf):
    """Readable and corrupt rows of one stream, kept apart in one write per batch; run again at the
    end, which adds nothing."""
    base = scratch_path(spark, "stream")
    write_messages(spark, sf, f"{base}/in")
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    for _ in range(2):
        raw = ingest.raw_text(ingest.read_messages(spark, "parquet", f"{base}/in", maxFilesPerTrigger="1"))
        ingest.run_to_end(ingest.split_stream(raw, schema, f"{base}/lake", f"{base}/checkpoint", available_now=True))
    good, bad = ingest.read_split(spark, f"{base}/lake", schema)
    return good.unionByName(bad, allowMissingColumns=True)


@query("SELECT event_id::VARCHAR AS key, event_type = 'error' AS broken FROM events")
def stream_key_value(spark, sf):
    base = scratch_path(spark, "stream")
    write_messages(spark, sf, f"{base}/in")
    stream = ingest.key_value_text(ingest.read_messages(spark, "parquet", f"{base}/in"))
    ingest.run_to_end(
        ingest.append_stream(stream, f"{base}/lake", f"{base}/checkpoint", available_now=True)
    )
    found = spark.read.parquet(f"{base}/lake")
    return found.select("key", F.col("value").startswith("not json").alias("broken"))
