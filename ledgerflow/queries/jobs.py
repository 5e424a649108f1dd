"""Whole jobs over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.operators.aggregates import load_audit as audit
from ledgerflow.operators.conform import CatalogColumn
from ledgerflow.operators.clean import add_source
from ledgerflow.plans import golden, jobs
from ledgerflow.plans.golden import GoldenRules
from ledgerflow.queries.registry import query
from ledgerflow.session import scratch_path
from ledgerflow.sinks.files import write_csv, write_parquet
from ledgerflow.sinks.snapshots import read_snapshot
from ledgerflow.sources.files import read_csv, read_parquet, read_table as table
from ledgerflow.templates import INCREMENTAL, ExportTemplate, ImportTemplate, LoadSettings


GOLDEN_SQL = """WITH bronze AS (
  SELECT c_name AS full_name, c_custkey::VARCHAR AS phone, lower(c_name) AS email,
         'nation ' || c_nationkey AS address, 'CoreBanking' AS source,
         TIMESTAMP '1997-06-01' AS load_time, c_custkey AS row_id FROM customer
  UNION ALL
  SELECT CASE WHEN o_orderstatus <> 'P' THEN 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') END,
         o_custkey::VARCHAR, 'customer#' || lpad(o_custkey::VARCHAR, 9, '0'), o_orderpriority, 'CRM',
         o_orderdate, o_orderkey FROM orders),
ranked AS (
  SELECT *, sha256(concat_ws('_', email, phone)) AS unique_key, row_number() OVER (
    PARTITION BY email, phone ORDER BY load_time DESC, source, row_id DESC) AS n FROM bronze)
SELECT unique_key, full_name AS "customer_name", phone, email, address
FROM ranked WHERE n = 1 AND full_name IS NOT NULL AND phone IS NOT NULL"""


def _golden_sources(spark, sf) -> list[DataFrame]:
    """Customers, and what their orders say about them."""
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("full_name"),
        F.col("c_custkey").cast("string").alias("phone"),
        F.lower("c_name").alias("email"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("address"),
        F.lit("1997-06-01 00:00:00").cast("timestamp_ntz").alias("load_time"),
        F.col("c_custkey").alias("row_id"),
    )
    owner = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    name = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Customer#"), owner))
    orders = table(spark, sf, "orders").select(
        name.alias("full_name"),
        F.col("o_custkey").cast("string").alias("phone"),
        F.concat(F.lit("customer#"), owner).alias("email"),
        F.col("o_orderpriority").alias("address"),
        F.col("o_orderdate").alias("load_time"),
        F.col("o_orderkey").alias("row_id"),
    )
    return [
        add_source(customers, "CoreBanking", load_time=False),
        add_source(orders, "CRM", load_time=False),
    ]


def _golden_rules() -> GoldenRules:
    return GoldenRules(
        identity=("email", "phone"),
        keep=("full_name", "phone", "email", "address"),
        required=("full_name", "phone"),
        newest_first=(F.desc("load_time"),),
        tie_break=(F.asc("source"), F.desc("row_id")),
        renames={"full_name": "customer_name"},
    )


@query(GOLDEN_SQL)
def golden_record(spark, sf):
    """Customers, and what their orders say about them, to one record per customer."""
    rules = _golden_rules()
    return jobs.golden_record(
        _golden_sources(spark, sf), list(rules.identity), list(rules.keep), list(rules.required),
        list(rules.newest_first), list(rules.tie_break), rules.renames,
    )


@query(GOLDEN_SQL)
def golden_record_batches(spark, sf):
    """The same records from four batches, out of order, one of them loaded twice, then compacted."""
    base, rules = scratch_path(spark, "golden"), _golden_rules()
    customers, orders = _golden_sources(spark, sf)
    batch = F.pmod(F.xxhash64("row_id"), F.lit(3))
    parts = [[orders.filter(batch == k)] for k in (2, 0, 1)]
    for sources in (*parts[:2], [customers], parts[0], parts[2]):
        golden.fold(sources, base, rules, buckets=4)
    golden.compact(spark, base, rules, most=3)
    return golden.golden_view(spark, base, rules)


ORDER_TEMPLATE = ImportTemplate(
    table_name="order_import",
    header=("Order", "Customer", "Status", "Price", "Day"),
    column_mapping={
        "Order": "order_no", "Customer": "customer_no", "Status": "status", "Price": "price",
        "Day": "order_day",
    },
    separator="|",
    load=LoadSettings(INCREMENTAL, "orders", ("ORDER_NO",), "ORDER_DAY < TIMESTAMP_NTZ '1999-01-01 00:00:00'"),
)
ORDER_CATALOG = [
    CatalogColumn("ORDER_NO", "NUMBER", scale=0),
    CatalogColumn("CUSTOMER_NO", "VARCHAR2", max_length=8),
    CatalogColumn("STATUS", "VARCHAR2", max_length=1),
    CatalogColumn("PRICE", "NUMBER", scale=2),
    CatalogColumn("ORDER_DAY", "DATE"),
]


@query("""SELECT o_orderkey AS "ORDER_NO", o_custkey::VARCHAR AS "CUSTOMER_NO",
       o_orderstatus AS "STATUS", trunc(o_totalprice * 100::DOUBLE) / 100::DOUBLE AS "PRICE",
       o_orderdate AS "ORDER_DAY" FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def incremental_load(spark, sf):
    """Orders from delimited files, less those the target table already holds."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    write_csv(
        orders.select(
            "o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"),
            F.date_format("o_orderdate", "yyyy/MM/dd").alias("day"),
        ),
        path,
        sep="|",
    )
    target = orders.select(
        F.col("o_orderkey").alias("ORDER_NO"), F.col("o_orderdate").alias("ORDER_DAY")
    )
    return jobs.incremental_load(spark, path, ORDER_TEMPLATE, ORDER_CATALOG, target)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def database_copy(spark, sf):
    """Source to staging files to target; files stand in for both databases."""
    path = scratch_path(spark, "copy")
    jobs.copy_through_staging(
        table(spark, sf, "customer"),
        f"{path}/staging",
        ["c_custkey", "c_name", "c_acctbal"],
        lambda rows: write_parquet(rows, f"{path}/target", mode="append"),
    )
    return read_parquet(spark, f"{path}/target")


@query("SELECT 'orders_copy' AS table_name, count(*) AS row_count, 'SUCCESS' AS status FROM orders")
def load_audit(spark, sf):
    target = scratch_path(spark, "orders_copy")
    return jobs.checked_load(
        spark,
        f"{sf}/orders.parquet",
        lambda path: read_parquet(spark, path),
        lambda rows: write_parquet(rows, target),
        lambda: read_parquet(spark, target),
        "orders_copy",
    )


@query("""SELECT 'orders_2' AS table_name, count(*) AS row_count, 'SUCCESS' AS status FROM orders
UNION ALL SELECT 'orders_1', count(*), 'SUCCESS' FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'seen', count(*), 'SUCCESS' FROM orders WHERE o_orderstatus = 'F'""")
def safe_load(spark, sf):
    """A load, one that fails half-way and leaves readers what they had, and one that replaces all."""
    base = scratch_path(spark, "safe")
    finished = F.col("o_orderstatus") == "F"

    def broken(path: str) -> DataFrame:
        price = F.when(finished, F.raise_error("broken input").cast("double")).otherwise(F.col("o_totalprice"))
        return read_parquet(spark, path).withColumn("o_totalprice", price)

    def load(read, name: str) -> DataFrame:
        return jobs.safe_load(spark, f"{sf}/orders.parquet", read, base, name)

    first = load(lambda path: read_parquet(spark, path).filter(finished), "orders_1")
    try:
        load(broken, "never")
    except Exception as error:
        if "broken input" not in str(error):
            raise
    seen = audit(read_snapshot(spark, base), "seen")
    return load(lambda path: read_parquet(spark, path), "orders_2").unionByName(first).unionByName(seen)


@query("""SELECT c_custkey::BIGINT AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def bronze_batch(spark, sf):
    path = scratch_path(spark, "bronze")
    write_csv(table(spark, sf, "customer"), f"{path}/in")
    jobs.bronze_batch(spark, f"{path}/in", f"{path}/lake", "parquet")
    found = read_parquet(spark, f"{path}/lake")
    return found.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("""SELECT c_custkey::VARCHAR AS c_custkey, c_acctbal, c_acctbal * 2 AS value_double
FROM customer""")
def derive_csv(spark, sf):
    path = scratch_path(spark, "derive")
    write_csv(table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_name"), f"{path}/in")
    return jobs.derive_csv(spark, f"{path}/in", f"{path}/out", "c_custkey", "c_acctbal")


def _ours_and_theirs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Returned lines as one party's book, all shipped lines as the other's."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
    )
    return lines.filter(F.col("l_returnflag") != "N"), lines.filter(F.col("l_linestatus") == "O")


PACK_SQL = """WITH lines AS (SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN -l_extendedprice
         ELSE l_extendedprice END AS l_extendedprice) FROM lineitem),
     a AS (SELECT * FROM lines WHERE l_returnflag <> 'N'),
     b AS (SELECT * FROM lines WHERE l_linestatus = 'O'),
     ta AS (SELECT l_orderkey, l_linenumber, sum(cast(l_extendedprice AS DECIMAL(18,2))) AS x, count(*) AS n
            FROM a GROUP BY 1, 2),
     da AS (SELECT l_orderkey, l_linenumber, l_extendedprice < 0 AS refund,
              sum(cast(l_extendedprice AS DECIMAL(18,2))) AS x FROM a GROUP BY 1, 2, 3),
     db AS (SELECT l_orderkey, l_linenumber, l_extendedprice < 0 AS refund,
              sum(cast(l_extendedprice AS DECIMAL(18,2))) AS x FROM b GROUP BY 1, 2, 3),
     differing AS (SELECT refund FROM da JOIN db USING (l_orderkey, l_linenumber, refund)
                   WHERE da.x <> db.x)"""


@query(f"""{PACK_SQL},
     counts AS (
  SELECT 'SUMMARY' AS dataset, (SELECT count(DISTINCT l_returnflag) FROM a) AS row_count
  UNION ALL SELECT 'DUPLICATE', (SELECT count(*) FROM ta WHERE n > 1)
  UNION ALL SELECT 'IMP_VS_SYNC', (SELECT count(*) FROM a ANTI JOIN b USING (l_orderkey, l_linenumber))
  UNION ALL SELECT 'SYNC_VS_IMP', (SELECT count(*) FROM b ANTI JOIN a USING (l_orderkey, l_linenumber))
  UNION ALL SELECT 'AMOUNT_DIFF', (SELECT count(*) FROM differing WHERE NOT refund)
  UNION ALL SELECT 'REFUND_DIFF', (SELECT count(*) FROM differing WHERE refund))
SELECT dataset, row_count, row_count > 0 AS written FROM counts""")
def report_pack(spark, sf):
    return _write_pack(spark, sf, scratch_path(spark, "pack")).select("dataset", "row_count", "written")


def _write_pack(spark: SparkSession, sf: str, base: str) -> DataFrame:
    ours, theirs = _ours_and_theirs(spark, sf)
    fee = F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(6,2)")
    return jobs.report_pack(
        ours,
        theirs,
        keys=["l_orderkey", "l_linenumber"],
        group_by=["l_returnflag"],
        amount="l_extendedprice",
        fee=fee,
        base=base,
        template=ExportTemplate("csv"),
    )


#: Columns of each sheet: two that name the row, then up to four figures.
SHEETS = {
    "SUMMARY": (("NO", "l_returnflag"), ("NUM_OF_TXN", "TXN_AMT", "FEE_AMT", "NET_AMT")),
    "DUPLICATE": (("l_orderkey", "l_linenumber"), ("CN",)),
    "IMP_VS_SYNC": (("l_orderkey", "l_linenumber"), ("l_extendedprice",)),
    "SYNC_VS_IMP": (("l_orderkey", "l_linenumber"), ("l_extendedprice",)),
    "AMOUNT_DIFF": (("l_orderkey", "l_linenumber"), ("left_amount", "right_amount", "difference", "unreadable")),
    "REFUND_DIFF": (("l_orderkey", "l_linenumber"), ("left_amount", "right_amount", "difference", "unreadable")),
}


def _sheet_sql(kind: str, refund: bool) -> str:
    return f"""SELECT '{kind}', l_orderkey::VARCHAR, l_linenumber::VARCHAR, da.x::DOUBLE, db.x::DOUBLE,
         (da.x - db.x)::DOUBLE, 0::DOUBLE
  FROM da JOIN db USING (l_orderkey, l_linenumber, refund) WHERE da.x <> db.x AND refund = {refund}"""


@query(f"""{PACK_SQL}
SELECT 'SUMMARY' AS dataset, (row_number() OVER (ORDER BY l_returnflag))::VARCHAR AS one, l_returnflag AS two,
       count(*)::DOUBLE AS a, sum(cast(l_extendedprice AS DECIMAL(28,4)))::DOUBLE AS b,
       sum(cast(l_extendedprice AS DECIMAL(18,2)) * 0.01)::DOUBLE AS c,
       (sum(cast(l_extendedprice AS DECIMAL(28,4)))
        - sum(cast(l_extendedprice AS DECIMAL(18,2)) * 0.01))::DOUBLE AS d FROM a GROUP BY l_returnflag
UNION ALL SELECT 'DUPLICATE', l_orderkey::VARCHAR, l_linenumber::VARCHAR, n::DOUBLE, NULL, NULL, NULL
  FROM ta WHERE n > 1
UNION ALL SELECT 'IMP_VS_SYNC', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_extendedprice, NULL, NULL, NULL
  FROM a ANTI JOIN b USING (l_orderkey, l_linenumber)
UNION ALL SELECT 'SYNC_VS_IMP', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_extendedprice, NULL, NULL, NULL
  FROM b ANTI JOIN a USING (l_orderkey, l_linenumber)
UNION ALL {_sheet_sql("AMOUNT_DIFF", False)}
UNION ALL {_sheet_sql("REFUND_DIFF", True)}""")
def report_pack_content(spark, sf):
    """Every row of every sheet, read back from the files of the pack."""
    manifest = _write_pack(spark, sf, scratch_path(spark, "pack")).collect()
    out = None
    for sheet in manifest:
        if sheet.written:
            names, figures = SHEETS[sheet.dataset]
            values = [F.col(c).cast("double") for c in figures] + [F.lit(None).cast("double")] * 4
            rows = read_csv(spark, sheet.path, sep="|").select(
                F.lit(sheet.dataset).alias("dataset"), F.col(names[0]).alias("one"),
                F.col(names[1]).alias("two"), *[v.alias(c) for v, c in zip(values, "abcd")],
            )
            out = rows if out is None else out.unionByName(rows)
    return out
