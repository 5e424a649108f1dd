"""Projection, filters, missing values, aggregates, windows, sorting, sets, user functions, ML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerflow.operators import aggregates as agg, clean, regression, udfs, windows
from ledgerflow.queries.registry import money, query
from ledgerflow.sources.files import read_table as table

NULLED_ORDERS = """
    SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
           nullif(o_orderpriority, '5-LOW') AS o_orderpriority
    FROM orders
"""


def nulled_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with missing values, which the table itself does not have."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        "o_totalprice",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )


@query("SELECT c_custkey AS id, c_name AS full_name, c_acctbal AS balance FROM customer")
def select_alias(spark, sf):
    return clean.select_as(
        table(spark, sf, "customer"),
        {"c_custkey": "id", "c_name": "full_name", "c_acctbal": "balance"},
    )


@query("""SELECT l_orderkey, l_linenumber, upper(l_returnflag) AS flag,
       l_extendedprice * (1 - l_discount) AS net FROM lineitem""")
def select_expr(spark, sf):
    return clean.project_sql(
        table(spark, sf, "lineitem"),
        "l_orderkey",
        "l_linenumber",
        "upper(l_returnflag) AS flag",
        "l_extendedprice * (1 - l_discount) AS net",
    )


@query("""SELECT c_custkey, c_acctbal, c_acctbal / 52 AS weekly, c_acctbal * 2 AS doubled
FROM customer""")
def project_derive(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return clean.derive(rows, weekly=F.col("c_acctbal") / 52, doubled=F.col("c_acctbal") * 2)


@query("""SELECT p_partkey, try_cast(p_type AS DOUBLE) AS p_type,
       try_cast(replace(p_brand, 'Brand#', '') AS INTEGER) AS p_brand FROM part""")
def cast_try(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey", "p_type", F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("p_brand")
    )
    return clean.cast_columns(rows, {"p_type": "double", "p_brand": "int"})


@query("SELECT p_partkey AS part_id, p_name AS part_name, p_brand, p_size FROM part")
def rename_map(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return clean.rename_columns(rows, {"p_partkey": "part_id", "p_name": "part_name"})


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def drop_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "supplier"), "s_acctbal")


@query("""SELECT c_custkey, c_name, 'CoreBanking' AS source, TRUE AS has_load_time,
       TRUE AS same_as_text FROM customer""")
def tag_source(spark, sf):
    rows = clean.add_source(table(spark, sf, "customer"), "CoreBanking")
    as_text = F.date_format("load_time", "yyyy-MM-dd HH:mm:ss")
    return rows.select(
        "c_custkey",
        "c_name",
        "source",
        F.col("load_time").isNotNull().alias("has_load_time"),
        (as_text == clean.load_time_text()).alias("same_as_text"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_quantity > 40""")
def filter_compare(spark, sf):
    rows = clean.where_all(table(spark, sf, "lineitem"), F.col("l_quantity") > 40)
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_equal(spark, sf):
    return agg.sql_query(
        spark,
        {"people": table(spark, sf, "customer")},
        "SELECT c_custkey, c_name FROM {people} WHERE c_mktsegment == 'BUILDING'",
    )


@query("""SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice > 250000""")
def filter_and(spark, sf):
    rows = clean.where_all(
        table(spark, sf, "orders"), F.col("o_orderstatus") == "O", F.col("o_totalprice") > 250000
    )
    return rows.select("o_orderkey", "o_totalprice")


@query("""SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_returnflag = 'R' AND l_discount >= 0.05 AND l_shipdate >= TIMESTAMP '1998-01-01'""")
def filter_chain(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .filter(F.col("l_discount") >= 0.05)
        .filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        .select("l_orderkey", "l_linenumber", "l_shipdate")
    )


@query(f"SELECT count(*) AS missing FROM ({NULLED_ORDERS}) WHERE o_orderstatus IS NULL")
def null_count(spark, sf):
    return clean.count_missing(nulled_orders(spark, sf), "o_orderstatus")


@query(f"""SELECT * FROM ({NULLED_ORDERS})
WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL""")
def not_null_filter(spark, sf):
    return clean.where_present(nulled_orders(spark, sf), "o_orderstatus", "o_orderpriority")


@query(f"""SELECT * FROM ({NULLED_ORDERS})
WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL""")
def na_drop_any(spark, sf):
    return clean.drop_missing(nulled_orders(spark, sf))


@query(f"SELECT * FROM ({NULLED_ORDERS}) WHERE o_orderpriority IS NOT NULL")
def na_drop_subset(spark, sf):
    return clean.drop_missing(nulled_orders(spark, sf), ["o_orderpriority"])


@query(f"""SELECT count(*) AS rows_before,
       count(*) FILTER (o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL) AS rows_after,
       count(*) FILTER (o_orderstatus IS NULL OR o_orderpriority IS NULL) AS rows_removed
FROM ({NULLED_ORDERS})""")
def drop_report(spark, sf):
    return clean.drop_report(nulled_orders(spark, sf))


@query(f"""SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, '<NULL>') AS o_orderstatus,
       o_totalprice, coalesce(o_orderpriority, '<NULL>') AS o_orderpriority
FROM ({NULLED_ORDERS})""")
def sentinel_fill(spark, sf):
    return clean.fill_sentinel(nulled_orders(spark, sf))


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return agg.row_count(table(spark, sf, "lineitem"))


@query("""SELECT min(c_acctbal) AS lowest FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 10""")
def min_filtered(spark, sf):
    where = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") < 10)
    return agg.summarise(table(spark, sf, "customer"), where=where, lowest=F.min("c_acctbal"))


@query("""SELECT max(c_acctbal) AS highest FROM customer
WHERE c_mktsegment = 'MACHINERY' AND c_nationkey < 10""")
def max_filtered(spark, sf):
    where = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_nationkey") < 10)
    return agg.summarise(table(spark, sf, "customer"), where=where, highest=F.max("c_acctbal"))


@query("SELECT round(avg(o_totalprice), 4) AS mean FROM orders WHERE o_orderstatus = 'F'")
def avg_filtered(spark, sf):
    return agg.summarise(
        table(spark, sf, "orders"),
        where=F.col("o_orderstatus") == "F",
        mean=F.round(F.avg("o_totalprice"), 4),
    )


@query("""SELECT round(avg(l_quantity), 4) AS avg_quantity,
       cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       count(*) AS lines
FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'""")
def multi_agg(spark, sf):
    return agg.summarise(
        table(spark, sf, "lineitem"),
        where=(F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"),
        avg_quantity=F.round(F.avg("l_quantity"), 4),
        total_price=money("l_extendedprice"),
        lines=F.count(F.lit(1)),
    )


@query("""SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean_balance FROM customer
GROUP BY c_mktsegment""")
def group_avg(spark, sf):
    return agg.summarise(
        table(spark, sf, "customer"),
        ["c_mktsegment"],
        mean_balance=F.round(F.avg("c_acctbal"), 4),
    )


@query("""SELECT p_brand, cast(sum(p_size) AS BIGINT) AS "sum(p_size)" FROM part GROUP BY p_brand""")
def group_sum(spark, sf):
    return agg.group_sum(table(spark, sf, "part"), ["p_brand"], "p_size")


@query("""SELECT o_orderpriority, max(o_totalprice) AS "max(o_totalprice)" FROM orders
GROUP BY o_orderpriority""")
def group_max_dict(spark, sf):
    return agg.group_by_spec(table(spark, sf, "orders"), ["o_orderpriority"], {"o_totalprice": "max"})


@query("""SELECT l_returnflag, cast(sum(cast(l_quantity AS BIGINT)) AS BIGINT) AS total
FROM lineitem GROUP BY l_returnflag""")
def kv_sum(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_quantity").cast("bigint").cast("string").alias("amount")
    )
    return agg.sum_text_amounts(rows, "l_returnflag", "amount")


@query("""SELECT p_type, cast(sum(p_size) AS BIGINT) AS total_size FROM part GROUP BY p_type
ORDER BY total_size DESC, p_type""")
def sql_group_order(spark, sf):
    return agg.sql_query(
        spark,
        {"parts": table(spark, sf, "part")},
        """SELECT p_type, sum(p_size) AS total_size FROM {parts} GROUP BY p_type
           ORDER BY total_size DESC, p_type""",
    )


@query("""SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_k(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return agg.first_rows(rows, 100, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("""WITH s AS (SELECT * FROM customer)
SELECT 'count' AS summary, cast(count(c_name) AS DOUBLE) AS c_name, cast(count(c_acctbal) AS DOUBLE) AS c_acctbal FROM s
UNION ALL SELECT 'mean', NULL, round(avg(c_acctbal), 2) FROM s
UNION ALL SELECT 'stddev', NULL, round(stddev_samp(c_acctbal), 2) FROM s
UNION ALL SELECT 'min', NULL, round(min(c_acctbal), 2) FROM s
UNION ALL SELECT 'max', NULL, round(max(c_acctbal), 2) FROM s""")
def describe_table(spark, sf):
    rows = table(spark, sf, "customer")
    summary = agg.describe(rows, "c_name", "c_acctbal")
    return summary.select(
        "summary",
        *[F.round(F.col(c).try_cast("double"), 2).alias(c) for c in ("c_name", "c_acctbal")],
    )


@query("""SELECT full_name, nation, source FROM (
  SELECT c_name AS full_name, c_nationkey AS nation, 'customer' AS source FROM customer
  UNION ALL SELECT s_name, s_nationkey, 'supplier' FROM supplier)""")
def union_sources(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("full_name"), F.col("c_nationkey").alias("nation")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("full_name")
    )
    return agg.union_sources(
        clean.add_source(customers, "customer", load_time=False),
        clean.add_source(suppliers, "supplier", load_time=False),
    )


@query("""SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM orders) WHERE n = 1""")
def latest_per_key(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return windows.latest_per_key(
        rows, ["o_custkey"], [F.desc("o_orderdate")], [F.desc("o_orderkey")]
    )


@query("""SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS "NO",
       o_orderkey, o_totalprice FROM orders""")
def running_number(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return windows.running_number(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("""SELECT event_id, value, cast(('0x' || substr(md5(event_id::VARCHAR), 1, 6)) AS INT) % 97
  AS check_number FROM events""")
def udf_vectorised(spark, sf):
    """A rule of a Python library, over whole batches."""
    import hashlib

    def check(ids):
        return ids.map(lambda v: int(hashlib.md5(str(v).encode()).hexdigest()[:6], 16) % 97).astype("int32")

    rows = table(spark, sf, "events").select("event_id", "value")
    return udfs.apply_series_function(rows, "event_id", "check_number", check, T.IntegerType())


@query("""SELECT s_suppkey, s_name,
  length(s_name) - length(replace(replace(s_name, '0', ''), '#', '')) AS zeros_and_marks
FROM supplier""")
def udf_row(spark, sf):
    """A plain Python rule, row by row, with Arrow transfer."""

    def marks(name: str) -> int:
        return sum(1 for letter in name if letter in "0#")

    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return udfs.apply_row_function(rows, "s_name", "zeros_and_marks", marks, T.LongType())


def _prices(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", F.col("l_extendedprice").alias("price")
    )


@query("""SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS coef_l_quantity,
       round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""")
def linreg_one_feature(spark, sf):
    data = regression.assemble(_prices(spark, sf), ["l_quantity"])
    model = regression.fit_linear(data, "price")
    found = regression.coefficients(spark, model, ["l_quantity"])
    return found.select(
        F.round("coef_l_quantity", 3).alias("coef_l_quantity"),
        F.round("intercept", 2).alias("intercept"),
    )


BUCKET = "(('0x' || substr(md5(cast(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 10)"


@query(f"""WITH fit AS (
  SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
  FROM lineitem WHERE {BUCKET} < 7)
SELECT l_orderkey, l_quantity, l_extendedprice AS price, round(a * l_quantity + b, 2) AS prediction
FROM lineitem, fit WHERE {BUCKET} >= 7""")
def linreg_score(spark, sf):
    train, test = regression.key_split(_prices(spark, sf), "l_orderkey")
    model = regression.fit_linear(regression.assemble(train, ["l_quantity"]), "price")
    scored = regression.score(model, regression.assemble(test, ["l_quantity"]))
    return scored.select(
        "l_orderkey", "l_quantity", "price", F.round("prediction", 2).alias("prediction")
    )


@query("""SELECT count(*) AS split_rows, count(*) AS distinct_rows, 0::BIGINT AS in_both,
  TRUE AS near_share FROM events""")
def random_split(spark, sf):
    """Both parts of a random split hold every row once, and the first about its share."""
    events = table(spark, sf, "events").select("event_id", "value")
    train, test = regression.random_split(events)
    both = train.withColumn("first", F.lit(1)).unionByName(test.withColumn("first", F.lit(0)))
    parts = both.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("first").alias("first")
    )
    share = F.sum("first") / F.sum("rows")
    return parts.agg(
        F.sum("rows").alias("split_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(F.col("first").between(1, F.col("rows") - 1).cast("long")).alias("in_both"),
        (F.abs(share - 0.7) < 0.05).alias("near_share"),
    )
