"""Joins, incremental filters, reconciliation and summary reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.operators import joins, reports
from ledgerflow.operators.known_keys import KnownKeys, new_by_known_keys, remember_keys
from ledgerflow.queries.registry import query
from ledgerflow.session import scratch_path
from ledgerflow.sources.files import read_table as table
from ledgerflow.sources.jdbc import target_keys
from ledgerflow.templates import INCREMENTAL, LoadSettings


@query("""SELECT o_orderkey, c_name, n_name, o_totalprice FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def join_dim(spark, sf):
    customers = joins.join_dimension(
        table(spark, sf, "customer")
        .select("c_custkey", "c_name", "c_nationkey")
        .withColumnRenamed("c_nationkey", "n_nationkey"),
        table(spark, sf, "nation").select("n_nationkey", "n_name"),
        "n_nationkey",
    )
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = joins.join_dimension(orders, customers, "c_custkey")
    return joined.select("o_orderkey", "c_name", "n_name", "o_totalprice")


@query("""SELECT o_orderkey AS tx_id, c_custkey AS account_id, o_totalprice AS amount,
       o_orderdate AS tx_time
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 7) ON o_custkey = c_custkey""")
def star_key_lookup(spark, sf):
    accounts = table(spark, sf, "customer").filter(F.col("c_nationkey") != 7)
    accounts = accounts.select(
        F.col("c_name").alias("account_no"), F.col("c_custkey").alias("account_id")
    )
    owner = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    facts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tx_id"),
        owner.alias("account_no"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("tx_time"),
    )
    keyed = joins.attach_surrogate_key(facts, accounts, "account_no", "account_id")
    return keyed.select("tx_id", "account_id", "amount", "tx_time")


NEW_ROWS_SQL = """WITH i AS (SELECT o_orderkey, nullif(o_custkey, 5) AS o_custkey,
           nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders),
     t AS (SELECT nullif(o_custkey, 5) AS o_custkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')
SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderpriority AS "O_ORDERPRIORITY"
FROM i WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_custkey IS NOT DISTINCT FROM i.o_custkey
                         AND t.o_orderpriority IS NOT DISTINCT FROM i.o_orderpriority)"""


def _orders_and_keys(spark, sf):
    """Orders to load, and the target that holds the later ones, with missing key parts."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_custkey", F.lit(5)).alias("o_custkey"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        "o_orderdate",
    )
    load = LoadSettings(
        INCREMENTAL, "orders", ("o_custkey", "o_orderpriority"),
        "o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'",
    )
    return orders.drop("o_orderdate"), target_keys(orders, load), list(load.key_columns)


@query(NEW_ROWS_SQL)
def incremental_new_rows(spark, sf):
    return joins.new_rows(*_orders_and_keys(spark, sf))


@query(NEW_ROWS_SQL)
def incremental_known_keys(spark, sf):
    """The same load against keys kept in buckets beside the target, added in two batches."""
    incoming, target, keys = _orders_and_keys(spark, sf)
    known = KnownKeys(scratch_path(spark, "known-keys"), tuple(keys), buckets=8)
    early = F.coalesce(F.col("o_custkey") % 2 == 0, F.lit(True))
    for part in (target.filter(early), target.filter(~early)):
        remember_keys(part, known)
    return new_by_known_keys(incoming, known)


@query("""SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""")
def target_key_projection(spark, sf):
    load = LoadSettings(
        INCREMENTAL, "orders", ("o_orderkey",), "o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'"
    )
    return target_keys(table(spark, sf, "orders"), load)


@query("""WITH l AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
     r AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(l.k, r.k) AS id, coalesce(l.n, 0)::BIGINT AS left_rows,
       coalesce(r.n, 0)::BIGINT AS right_rows,
       CASE WHEN r.k IS NULL THEN 'ONLY_LEFT' ELSE 'ONLY_RIGHT' END AS side
FROM l FULL JOIN r ON l.k = r.k WHERE l.k IS NULL OR r.k IS NULL""")
def recon_two_way(spark, sf):
    return joins.two_way_difference(
        table(spark, sf, "orders").select(F.col("o_custkey").alias("id")),
        table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")),
        ["id"],
    )


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def recon_missing_rows(spark, sf):
    returned = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return joins.missing_from(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        returned.select(F.col("l_orderkey").alias("o_orderkey")),
        ["o_orderkey"],
    )


@query("""WITH l AS (SELECT o_orderkey AS txn_id, sum(cast(o_totalprice AS DECIMAL(18,2))) AS a
           FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
     r AS (SELECT l_orderkey AS txn_id, sum(cast(l_extendedprice AS DECIMAL(18,2))) AS a
           FROM lineitem GROUP BY 1)
SELECT coalesce(l.txn_id, r.txn_id) AS txn_id, l.a::DOUBLE AS left_amount, r.a::DOUBLE AS right_amount,
       (coalesce(l.a, 0) - coalesce(r.a, 0))::DOUBLE AS difference,
       CASE WHEN r.txn_id IS NULL THEN 'ONLY_LEFT' WHEN l.txn_id IS NULL THEN 'ONLY_RIGHT'
            WHEN l.a = r.a THEN 'MATCH' ELSE 'AMOUNT_DIFF' END AS status, 0::BIGINT AS unreadable
FROM l FULL JOIN r ON l.txn_id = r.txn_id""")
def recon_amount_diff(spark, sf):
    ours = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    theirs = table(spark, sf, "lineitem")
    found = joins.amount_difference(
        ours.select(F.col("o_orderkey").alias("txn_id"), "o_totalprice"),
        theirs.select(F.col("l_orderkey").alias("txn_id"), "l_extendedprice"),
        ["txn_id"],
        "o_totalprice",
        "l_extendedprice",
    )
    amounts = ("left_amount", "right_amount", "difference")
    return found.withColumns({c: F.col(c).cast("double") for c in amounts})


@query("""WITH raw AS (SELECT o_orderkey AS txn_id, CASE o_orderkey % 5 WHEN 0 THEN 'n/a'
             WHEN 1 THEN NULL WHEN 2 THEN '99999999999999999999.5' ELSE o_totalprice::VARCHAR END AS a,
           CASE o_orderkey % 7 WHEN 0 THEN NULL ELSE o_totalprice END AS b FROM orders),
     money AS (SELECT txn_id, a, TRY_CAST(a AS DECIMAL(38,2)) AS x, cast(b AS DECIMAL(38,2)) AS y FROM raw)
SELECT txn_id, x::DOUBLE AS left_amount, y::DOUBLE AS right_amount,
       (coalesce(x, 0) - coalesce(y, 0))::DOUBLE AS difference,
       CASE WHEN a IS NOT NULL AND x IS NULL THEN 'UNREADABLE'
            WHEN x IS NOT DISTINCT FROM y THEN 'MATCH' ELSE 'AMOUNT_DIFF' END AS status,
       (a IS NOT NULL AND x IS NULL)::BIGINT AS unreadable FROM money""")
def recon_amount_unreadable(spark, sf):
    """Amounts that are no number, missing or very large never pass for a match."""
    orders = table(spark, sf, "orders")
    case = F.col("o_orderkey") % 5
    text = (
        F.when(case == 0, "n/a").when(case == 1, F.lit(None)).when(case == 2, "99999999999999999999.5")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    other = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    found = joins.amount_difference(
        orders.select(F.col("o_orderkey").alias("txn_id"), text.alias("a")),
        orders.select(F.col("o_orderkey").alias("txn_id"), other.alias("b")),
        ["txn_id"], "a", "b",
    )
    return _doubles(found, "left_amount", "right_amount", "difference")


@query("""WITH lines AS (SELECT l_orderkey AS txn_id, l_linestatus,
         CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * cast(l_extendedprice AS DECIMAL(18,2)) AS x
       FROM lineitem),
     sums AS (SELECT txn_id, CASE WHEN x < 0 THEN 'REFUND' ELSE 'TRANSACTION' END AS kind,
         sum(x) AS a, sum(x) FILTER (WHERE l_linestatus = 'F') AS b,
         count(*) FILTER (WHERE l_linestatus = 'F') AS n FROM lines GROUP BY 1, 2)
SELECT txn_id, kind, a::DOUBLE AS left_amount, b::DOUBLE AS right_amount,
       (a - coalesce(b, 0))::DOUBLE AS difference,
       CASE WHEN n = 0 THEN 'ONLY_LEFT' WHEN a = b THEN 'MATCH' ELSE 'AMOUNT_DIFF' END AS status,
       0::BIGINT AS unreadable FROM sums""")
def recon_refunds(spark, sf):
    """All lines against the finished ones; returned lines count as refunds."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    signed = F.when(F.col("l_returnflag") == "R", -price).otherwise(price)
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("txn_id"), signed.alias("amount"), "l_linestatus"
    )
    found = joins.reconcile_amounts(
        lines, lines.filter(F.col("l_linestatus") == "F"), ["txn_id"], "amount", "amount"
    )
    return _doubles(found, "left_amount", "right_amount", "difference")


@query("""SELECT o_orderkey, o_custkey, account_name, c_name AS core_name
FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN ' customer#' || o_custkey::VARCHAR
        ELSE lower(c_name) END AS account_name, c_name AS told FROM orders JOIN customer ON o_custkey = c_custkey)
LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey
WHERE c_name IS NULL OR upper(trim(account_name)) <> upper(trim(c_name))""")
def invalid_accounts(spark, sf):
    """Orders whose customer name differs from the customer table's, or that have no customer."""
    customers = table(spark, sf, "customer")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    named = orders.join(customers.select("c_custkey", "c_name"), "c_custkey")
    wrong = F.concat(F.lit(" customer#"), F.col("c_custkey").cast("string"))
    told = F.when(F.col("o_orderkey") % 3 == 0, wrong).otherwise(F.lower("c_name"))
    found = joins.invalid_accounts(
        named.select("o_orderkey", "c_custkey", told.alias("account_name")),
        customers.filter(F.col("c_mktsegment") != "BUILDING"), "c_custkey", "account_name", "c_name",
    )
    return found.withColumnRenamed("c_custkey", "o_custkey")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS "CN" FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_report(spark, sf):
    return reports.duplicate_report(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _lines_with_bank(spark, sf):
    suppliers = joins.join_dimension(
        table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"),
        table(spark, sf, "nation").select("n_nationkey", "n_name"),
        "n_nationkey",
    ).select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("n_name").alias("bank"))
    return joins.join_dimension(
        table(spark, sf, "lineitem").select(
            "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
        ),
        suppliers,
        "l_suppkey",
    )


FEE_SQL = "cast(cast(l_extendedprice AS DECIMAL(18,2)) * cast(l_discount AS DECIMAL(6,2)) AS DECIMAL(28,4))"
VAT_SQL = f"cast({FEE_SQL} * cast(l_tax AS DECIMAL(6,4)) AS DECIMAL(28,4))"
BANK_LINES = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"


def _fee():
    return F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(6,2)")


def _doubles(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _summary_sql(keys: str) -> str:
    return f"""WITH s AS (SELECT {keys}, count(*) AS n,
       sum(cast(l_extendedprice AS DECIMAL(18,2))) AS amount, sum({FEE_SQL}) AS fee
  FROM {BANK_LINES} GROUP BY ALL)
SELECT row_number() OVER (ORDER BY ALL) AS "NO", * FROM (
  SELECT * EXCLUDE (n, amount, fee), n AS "NUM_OF_TXN", amount::DOUBLE AS "TXN_AMT",
         fee::DOUBLE AS "FEE_AMT", (amount - fee)::DOUBLE AS "NET_AMT" FROM s)"""


@query(_summary_sql("n_name AS bank, l_returnflag AS channel").replace(
    "ORDER BY ALL", "ORDER BY bank, channel"))
def settlement_by_bank(spark, sf):
    rows = _lines_with_bank(spark, sf).withColumnRenamed("l_returnflag", "channel")
    found = reports.settlement_summary(
        rows, ["bank", "channel"], F.col("l_extendedprice"), _fee()
    )
    return _doubles(found, "TXN_AMT", "FEE_AMT", "NET_AMT")


@query(_summary_sql("n_name AS bank, s_name AS merchant, strftime(l_shipdate, '%Y%m%d') AS session").replace(
    "ORDER BY ALL", "ORDER BY bank, merchant, session"))
def settlement_by_merchant(spark, sf):
    rows = _lines_with_bank(spark, sf).select(
        "bank", F.col("s_name").alias("merchant"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("session"), "l_extendedprice", "l_discount",
    )
    found = reports.settlement_summary(
        rows, ["bank", "merchant", "session"], F.col("l_extendedprice"), _fee()
    )
    return _doubles(found, "TXN_AMT", "FEE_AMT", "NET_AMT")


def _fee_sql(keys: str) -> str:
    return f"""SELECT {keys}, sum({FEE_SQL})::DOUBLE AS "FEE_AMOUNT",
       sum({VAT_SQL})::DOUBLE AS "FEE_VAT_AMT",
       (sum({FEE_SQL}) + sum({VAT_SQL}))::DOUBLE AS "FEE_TOTAL_AMT"
FROM {BANK_LINES} GROUP BY ALL"""


@query(_fee_sql("s_name AS account"))
def fee_summary(spark, sf):
    rows = _lines_with_bank(spark, sf).withColumnRenamed("s_name", "account")
    found = reports.fee_summary(rows, ["account"], _fee(), F.col("l_tax"))
    return _doubles(found, "FEE_AMOUNT", "FEE_VAT_AMT", "FEE_TOTAL_AMT")


@query(_fee_sql("s_name AS account, l_returnflag AS device"))
def fee_detail(spark, sf):
    rows = _lines_with_bank(spark, sf).withColumnsRenamed(
        {"s_name": "account", "l_returnflag": "device"}
    )
    found = reports.fee_summary(rows, ["account", "device"], _fee(), F.col("l_tax"))
    return _doubles(found, "FEE_AMOUNT", "FEE_VAT_AMT", "FEE_TOTAL_AMT")


@query("""SELECT l_suppkey, count(*) AS "NUM_OF_TXN", sum(cast(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS "TXN_AMT",
  coalesce(sum(f), 0)::DOUBLE AS "FEE_AMT",
  (sum(cast(l_extendedprice AS DECIMAL(18,2))) - coalesce(sum(f), 0))::DOUBLE AS "NET_AMT"
FROM (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN cast(l_discount AS DECIMAL(28,4)) END AS f FROM lineitem)
GROUP BY 1""")
def settlement_without_fee(spark, sf):
    """Every other supplier has no fee at all; its net amount is its amount."""
    fee = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_discount"))
    found = reports.settlement_summary(
        table(spark, sf, "lineitem"), ["l_suppkey"], F.col("l_extendedprice"), fee, number_rows=False
    )
    return _doubles(found, "TXN_AMT", "FEE_AMT", "NET_AMT")
