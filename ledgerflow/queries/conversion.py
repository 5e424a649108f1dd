"""Warehouse type conversion."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ledgerflow.functions import convert, dates, text
from ledgerflow.operators import conform as shape
from ledgerflow.operators.conform import CatalogColumn
from ledgerflow.queries.registry import query
from ledgerflow.sources.files import from_rows, read_table as table

CATALOG = [
    ("C_CUSTKEY", "VARCHAR2", None, None, 6),
    ("C_NAME", "VARCHAR2", None, None, 12),
    ("C_NATIONKEY", "NUMBER", 10, 0, None),
    ("C_ACCTBAL", "NUMBER", 10, 1, None),
    ("C_MKTSEGMENT", "NUMBER", 10, 2, None),
    ("NOT_THERE", "DATE", None, None, None),
]


@query("""SELECT substr(cast(c_custkey AS VARCHAR), 1, 6) AS "C_CUSTKEY",
       substr(c_name, 1, 12) AS "C_NAME", cast(c_nationkey AS BIGINT) AS "C_NATIONKEY",
       trunc(c_acctbal * 10::DOUBLE) / 10::DOUBLE AS "C_ACCTBAL",
       0::DOUBLE AS "C_MKTSEGMENT" FROM customer""")
def conform_table(spark, sf):
    rows = table(spark, sf, "customer")
    rows = rows.toDF(*[c.upper() for c in rows.columns])
    schema = "COLUMN_NAME string, DATA_TYPE string, PRECISION int, SCALE int, MAX_LENGTH int"
    return shape.conform(rows, from_rows(spark, CATALOG, schema))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus,
       regexp_replace(cast(o_totalprice AS VARCHAR), '\\.0$', '') AS o_totalprice,
       strftime(o_orderdate, '%Y%m%d') AS o_orderdate,
       try_cast(o_orderpriority AS BOOLEAN) AS o_orderpriority FROM orders""")
def conform_orders(spark, sf):
    return shape.conform(
        table(spark, sf, "orders"),
        [
            CatalogColumn("o_totalprice", "VARCHAR2", max_length=20),
            CatalogColumn("o_orderdate", "VARCHAR2", max_length=8),
            CatalogColumn("o_orderkey", "NUMBER", scale=0),
            CatalogColumn("o_orderpriority", "BOOLEAN"),
        ],
    )


@query("""SELECT l_orderkey, l_linenumber,
       trunc((l_extendedprice * (1 - l_discount)) * 100::DOUBLE) / 100::DOUBLE AS net
FROM lineitem""")
def number_truncate(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", convert.truncate_number(net, 2).alias("net")
    )


@query("""SELECT o_orderkey, cast(trunc(coalesce(price, 0)) AS BIGINT) AS price FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)""")
def number_to_integer(spark, sf):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        "o_orderkey", convert.truncate_number(price, 0).alias("price")
    )


@query("""SELECT o_orderkey, trunc(o_totalprice * 10::DOUBLE) / 10::DOUBLE AS cut_double,
       cast(trunc(cast(o_totalprice AS DECIMAL(18,2)) * 10) / 10 AS DECIMAL(18,1))::DOUBLE AS cut_exact
FROM orders""")
def number_truncate_exact(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        convert.truncate_number("o_totalprice", 1).alias("cut_double"),
        convert.truncate_number("o_totalprice", 1, exact=True).cast("double").alias("cut_exact"),
    )


@query("""SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber IN (1, 3, 4) THEN 0::DOUBLE
       ELSE trunc(l_extendedprice * 10::DOUBLE) / 10::DOUBLE END AS number,
  CASE WHEN l_linenumber IN (1, 3) THEN 0::DOUBLE
       ELSE (CASE WHEN l_linenumber = 4 THEN -1 ELSE 1 END) * (trunc(l_extendedprice * 10::DOUBLE) / 10::DOUBLE)
  END AS signed_number
FROM lineitem""")
def text_to_number(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    line = F.col("l_linenumber")
    raw = (
        F.when(line == 1, "n/a")
        .when(line == 3, F.concat(price, F.lit(" ")))
        .when(line == 4, F.concat(F.lit("-"), price))
        .otherwise(price)
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        convert.text_to_number(raw, 1).alias("number"),
        convert.text_to_number(raw, 1, signed=True).alias("signed_number"),
    )


@query("""SELECT l_orderkey, l_linenumber,
       cast(cast(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
       substr(regexp_replace(cast(l_extendedprice AS VARCHAR), '\\.0$', ''), 1, 8) AS price
FROM lineitem""")
def number_to_text(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        convert.number_to_text("l_quantity", T.DoubleType()).alias("quantity"),
        convert.number_to_text("l_extendedprice", T.DoubleType(), 8).alias("price"),
    )


@query("""SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 END::BIGINT AS flag_number,
       CASE WHEN l_linestatus = 'O' THEN 'True' ELSE 'False' END AS flag_text
FROM lineitem""")
def flag_conversion(spark, sf):
    word = (
        F.when(F.col("l_returnflag") == "A", "Yes")
        .when(F.col("l_returnflag") == "R", "FALSE")
        .otherwise("maybe")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        convert.flag_to_number(word).alias("flag_number"),
        convert.flag_to_text(F.col("l_linestatus") == "O").alias("flag_text"),
    )


@query("SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM events")
def timestamp_to_text(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", convert.timestamp_to_text("ts", 14).alias("stamp")
    )


@query("""SELECT o_orderkey, CASE o_orderkey % 9 WHEN 6 THEN NULL WHEN 7 THEN NULL WHEN 8 THEN NULL
       ELSE o_orderdate END AS order_time FROM orders""")
def date_mixed(spark, sf):
    layouts = [
        "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd", "yyyyMMddHHmmss", "yyyy/MM/dd",
        "yyyy-MM-dd", "dd.MM.yyyy", "yyyy-MM-dd'T'HH:mm:ss", "MMM yyyy",
    ]
    day = F.col("o_orderdate")
    raw = F.lit(None).cast("string")
    for i, layout in enumerate(layouts):
        raw = F.when(F.col("o_orderkey") % 9 == i, F.date_format(day, layout)).otherwise(raw)
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.timestamp_from_text(F.concat(F.lit(" "), raw)).alias("order_time")
    )


@query("""SELECT event_id, date_trunc('day', ts) AS by_day, date_trunc('day', ts) AS by_short_day,
       date_trunc('minute', ts) AS by_minute, date_trunc('second', ts) AS by_second,
       cast(ts AS TIMESTAMP) AS by_nanos FROM events""")
def date_from_integer(spark, sf):
    def digits(layout):
        return F.date_format("ts", layout).cast("bigint")

    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    nanos = F.timestamp_diff("MICROSECOND", epoch, F.col("ts")) * 1000
    made = dates.timestamp_from_integer
    return table(spark, sf, "events").select(
        "event_id",
        made(digits("yyyyMMdd")).alias("by_day"),
        made(digits("yyMMdd")).alias("by_short_day"),
        made(digits("yyyyMMddHHmm")).alias("by_minute"),
        made(digits("yyyyMMddHHmmss")).alias("by_second"),
        made(nanos).alias("by_nanos"),
    )


@query("""SELECT o_orderkey, o_orderdate + INTERVAL 12 HOUR AS order_time,
       CAST(NULL AS TIMESTAMP) AS too_small FROM orders""")
def date_from_serial(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.timestamp_from_serial(days + 0.5).alias("order_time"),
        dates.timestamp_from_serial(days / 1000000).alias("too_small"),
    )


@query("""SELECT doc_id, replace(replace(strip_accents(text), 'Đ', 'D'), 'đ', 'd') AS plain
FROM documents""")
def strip_accents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip_accents("text").alias("plain"))


@query("""SELECT c_custkey, least(greatest(c_acctbal, 0), 5000) AS held,
       CASE WHEN c_nationkey < 5 THEN c_mktsegment WHEN c_acctbal > 5000 THEN '5000.0'
            WHEN c_acctbal < 0 THEN '0.0' ELSE c_acctbal::VARCHAR END AS held_text FROM customer""")
def clamp(spark, sf):
    few = F.col("c_nationkey") < 5
    mixed = F.when(few, F.col("c_mktsegment")).otherwise(F.col("c_acctbal").cast("string"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        convert.clamp("c_acctbal", T.DoubleType(), 5000.0, 0.0).alias("held"),
        convert.clamp(mixed, T.StringType(), 5000.0, 0.0).alias("held_text"),
    )


@query("""SELECT o_orderkey, cast(cast(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price
FROM orders""")
def decimal_to_text(spark, sf):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return table(spark, sf, "orders").select(
        "o_orderkey", convert.decimal_to_text(price).alias("price")
    )


@query("""SELECT p_partkey AS "PART_ID", p_name AS "PART_NAME", p_brand AS "BRAND",
       p_type AS "KIND", p_size AS "P_SIZE", p_retailprice AS "P_RETAILPRICE" FROM part""")
def header_map(spark, sf):
    return shape.rename_by_position(
        table(spark, sf, "part"),
        ["Part No", " name ", "brand", "kind"],
        {"part no": "part_id", "NAME": "Part_Name"},
    )


@query(r"""SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B-\x1F\x7F]', '', 'g') AS cleaned
FROM documents""")
def clean_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_line("text").alias("cleaned"))


@query(r"""SELECT conv_id, turn,
       trim(regexp_replace(lower(role || ' -  ' || replace(strip_accents(text), 'Đ', 'D')),
                           '[\s\-]+', ' ', 'g'), ' ') AS label
FROM conversations""")
def normalise_labels(spark, sf):
    plain = F.replace(text.strip_accents("text"), F.lit("Đ"), F.lit("D"))
    label = F.concat("role", F.lit(" -  "), plain)
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.normalise_label(label).alias("label")
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS file_date, CAST(NULL AS VARCHAR) AS none
FROM orders""")
def file_dates(spark, sf):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.file_date(F.concat(day, F.lit("_REPORT.TXT"))).alias("file_date"),
        text.file_date(F.concat(F.lit("REPORT_"), day)).alias("none"),
    )


@query("""SELECT o_orderkey, (o_orderkey::HUGEINT * 1000000000000000000)::VARCHAR AS number
FROM orders""")
def text_to_number_wide(spark, sf):
    """Whole numbers of more than 18 digits."""
    raw = F.concat(F.col("o_orderkey").cast("string"), F.lit("000000000000000000.9"))
    number = convert.text_to_number(raw, 0, wide=True)
    return table(spark, sf, "orders").select("o_orderkey", number.cast("string").alias("number"))


@query("""SELECT o_orderkey, cast(o_totalprice AS DECIMAL(18,2))::VARCHAR AS cents,
  cast(trunc(cast(o_totalprice AS DECIMAL(18,2)) * 10) / 10 AS DECIMAL(18,1))::VARCHAR AS tenths,
  trunc(cast(o_totalprice AS DECIMAL(18,2)))::BIGINT AS whole FROM orders""")
def conform_decimals(spark, sf):
    """Decimal columns are cut as decimals, so no cent is lost."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", price.alias("cents"), price.alias("tenths"), price.alias("whole")
    )
    entries = [("cents", 18, 2), ("tenths", 18, 1), ("whole", 18, 0)]
    catalog = [shape.CatalogColumn(name, "NUMBER", *size) for name, *size in entries]
    done = shape.conform(rows, catalog)
    texts = [F.col(n).cast(f"decimal(18,{s})").cast("string").alias(n) for n, _, s in entries[:2]]
    return done.select("o_orderkey", *texts, "whole")


@query("""SELECT o_orderkey, TIMESTAMP '9999-12-31' AS open_end,
  TIMESTAMP '1899-12-30' + to_days(CAST(2900000 + o_orderkey % 50000 AS INT)) AS serial,
  make_timestamp(1000 + o_orderkey % 600, 1, 2, 3, 4, 5) AS early FROM orders""")
def date_open_end(spark, sf):
    """Dates far from today, as open end dates are."""
    year = (F.lit(1000) + F.col("o_orderkey") % 600).cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.timestamp_from_integer(F.lit(99991231)).alias("open_end"),
        dates.timestamp_from_serial((F.lit(2900000) + F.col("o_orderkey") % 50000).cast("double")).alias("serial"),
        dates.timestamp_from_text(F.concat(year, F.lit("-01-02 03:04:05"))).alias("early"),
    )
