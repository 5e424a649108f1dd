from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import plan_of, run_plan
from pyspark.sql import functions as F

from ledgerflow.operators import aggregates as agg, joins, reports, windows
from ledgerflow.operators.known_keys import KnownKeys, new_by_known_keys, remember_keys
from ledgerflow.plans.jobs import report_pack
from ledgerflow.session import release_staged, stage, staging
from ledgerflow.sources.jdbc import target_keys
from ledgerflow.templates import FULL, INCREMENTAL, ExportTemplate, LoadSettings


def test_new_rows_drops_known_keys(spark):
    incoming = spark.createDataFrame([("A",), ("B",), ("C",)], "Bank_Name string")
    target = spark.createDataFrame([("B",)], "bank_name string")
    out = joins.new_rows(incoming, target, ["bank_name"])
    assert sorted(r.BANK_NAME for r in out.collect()) == ["A", "C"]


def test_new_rows_equals_a_plain_model(spark):
    draw = random.Random(3)
    keys = [None, "1", "2", "3", "x"]
    left = [(draw.choice(keys), draw.choice([None, 1, 2]), i) for i in range(200)]
    right = [(draw.choice(keys[:3]), draw.choice([None, 1])) for _ in range(40)]
    incoming = spark.createDataFrame(left, "a string, b int, n int")
    # The target holds b as text: keys are compared as text.
    target = spark.createDataFrame(
        [(a, None if b is None else str(b)) for a, b in right], "a string, b string"
    )
    out = joins.new_rows(incoming, target, ["a", "b"]).collect()
    assert sorted(r.N for r in out) == [n for a, b, n in left if (a, b) not in set(right)]


def test_number_keys_are_compared_without_text(spark):
    incoming = spark.createDataFrame([(1, 1.0), (2, 2.5), (None, None)], "k bigint, v double")
    target = spark.createDataFrame([(2, 2.5), (None, 7.0)], "k int, v double")
    out = joins.new_rows(incoming, target, ["k"])
    assert [r.K for r in out.collect()] == [1] and "as string" not in plan_of(out)
    both = joins.new_rows(incoming, target, ["k", "v"])
    assert {r.K for r in both.collect()} == {1, None}


def test_new_rows_needs_its_keys(spark):
    rows = spark.sql("SELECT 1 AS a")
    with pytest.raises(KeyError, match="B"):
        joins.new_rows(rows, rows, ["b"])


def test_target_keys_only_for_incremental_loads(spark):
    target = spark.sql("SELECT 1 AS k, 2 AS v UNION ALL SELECT 3, 4")
    assert target_keys(target, LoadSettings(FULL, "t", ("k",))) is None
    assert target_keys(target, LoadSettings(INCREMENTAL, "t")) is None
    found = target_keys(target, LoadSettings(INCREMENTAL, "t", ("k",), "v > 2"))
    assert [tuple(r) for r in found.collect()] == [(3,)]


@pytest.fixture
def no_broadcast(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_rows(spark, n=40_000):
    """A third of the rows share one key, spread over several tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    return spark.range(0, n, 1, 8).select(key.alias("K"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_a_hot_incoming_key_is_split(spark, no_broadcast):
    target = spark.range(0, 4000, 1, 4).select(F.col("id").cast("string").alias("K"))
    out = joins.new_rows(hot_rows(spark), target, ["K"])
    plan = run_plan(out)
    assert "skew=true" in plan and "NestedLoop" not in plan
    model = sum(1 for i in range(40_000) if i % 3 == 0 or i >= 4000)
    assert out.count() == model


def test_a_hot_token_is_split(spark, no_broadcast):
    vault = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("token"),
        F.col("id").alias("value"),
    )
    asked = hot_rows(spark).withColumnRenamed("K", "token")
    out = joins.detokenise(asked, vault)
    assert "skew=true" in run_plan(out)
    assert out.filter("found").count() == sum(1 for i in range(40_000) if i % 3 == 0 or 0 < i < 4000)


def test_two_way_difference_equals_sets(spark):
    left = [(1,), (1,), (2,), (None,)]
    right = [(2,), (3,), (3,), (3,)]
    out = joins.two_way_difference(
        spark.createDataFrame(left, "k int"), spark.createDataFrame(right, "k int"), ["k"]
    )
    found = {r.k: (r.left_rows, r.right_rows, r.side) for r in out.collect()}
    assert found == {1: (2, 0, "ONLY_LEFT"), None: (1, 0, "ONLY_LEFT"), 3: (0, 3, "ONLY_RIGHT")}
    assert "Join" not in plan_of(out)


def test_missing_from_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(None,), (3,), (3,)], "k int")
    out = joins.missing_from(left, right, ["k"])
    assert [tuple(r) for r in out.collect()] == [(1, "a")]


def test_amount_difference_states(spark):
    ours = spark.createDataFrame([(1, 10.1), (1, 0.2), (2, 5.0), (3, 1.0), (5, None)], "id int, a double")
    theirs = spark.createDataFrame([(1, 10.3), (2, 5.01), (4, 2.0), (5, 0.0)], "id int, b double")
    out = joins.amount_difference(ours, theirs, ["id"], "a", "b")
    found = {r.id: (r.status, r.difference) for r in out.collect()}
    assert found == {
        1: ("MATCH", Decimal("0.00")),
        2: ("AMOUNT_DIFF", Decimal("-0.01")),
        3: ("ONLY_LEFT", Decimal("1.00")),
        4: ("ONLY_RIGHT", Decimal("-2.00")),
        5: ("AMOUNT_DIFF", Decimal("0.00")),
    }
    assert "Join" not in plan_of(out)


def test_surrogate_key_of_an_unknown_account_is_null(spark):
    facts = spark.createDataFrame([("a", 1), ("z", 2)], "account_no string, tx int")
    dim = spark.createDataFrame([("a", 7)], "account_no string, account_id int")
    out = joins.attach_surrogate_key(facts, dim, "account_no", "account_id")
    assert {r.tx: r.account_id for r in out.collect()} == {1: 7, 2: None}


def test_duplicate_report(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "k int, v string")
    out = reports.duplicate_report(rows, ["k", "v"])
    assert {(r.k, r.v): r.CN for r in out.collect()} == {(1, "a"): 2, (None, None): 2}
    assert reports.duplicate_report(rows.limit(0), ["k"]).isEmpty()


def test_settlement_summary(spark):
    rows = spark.createDataFrame(
        [("b", 10.0, 0.1), ("a", 5.0, 0.2), ("b", 20.0, 0.3)], "bank string, amount double, fee double"
    )
    out = reports.settlement_summary(rows, ["bank"], F.col("amount"), F.col("fee")).collect()
    found = {r.NO: (r.bank, r.NUM_OF_TXN, float(r.TXN_AMT), float(r.FEE_AMT), float(r.NET_AMT)) for r in out}
    assert found == {1: ("a", 1, 5.0, 0.2, 4.8), 2: ("b", 2, 30.0, 0.4, 29.6)}


def test_latest_per_key_prunes_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "rows")
    hot_rows(spark).write.parquet(path)
    out = windows.latest_per_key(spark.read.parquet(path), ["K"], [F.length("pad").desc()], [F.desc("id")])
    plan = plan_of(out)
    assert "WindowGroupLimit" in plan and ", Partial" in plan
    found = {r.K: r.id for r in out.filter("K = 'hot'").collect()}
    assert found == {"hot": 39_999}
    assert out.count() == 1 + sum(1 for i in range(40_000) if i % 3)


def test_latest_per_key_needs_a_tie_break(spark):
    with pytest.raises(ValueError):
        windows.latest_per_key(spark.range(1), ["id"], [F.desc("id")], [])


def test_running_number_counts_over_all_parts(spark):
    rows = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("v"), F.lit("x").alias("w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = windows.running_number(rows, [F.desc("v")])
        assert out.columns == ["NO", "v", "w"]
        assert sorted((r.NO, r.v) for r in out.collect()) == [(i + 1, 999 - i) for i in range(1000)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    empty = windows.running_number(rows.filter("v < 0"), [F.desc("v")])
    assert empty.count() == 0
    assert release_staged(spark) >= 2 and release_staged(spark) == 0


def test_a_job_removes_what_it_staged_and_nothing_else(spark):
    def there(frame):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.inputFiles()[0])
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    with staging(spark):
        outer = stage(spark.range(3).toDF("id"), "outer")
        with staging(spark):
            inner = stage(outer, "inner")
            files = inner.inputFiles()
            assert inner.count() == 3 and there(inner)
        assert outer.count() == 3 and there(outer)
    with pytest.raises(Exception):
        outer.collect()
    assert files


def test_load_audit_states(spark):
    rows = spark.range(3)
    assert agg.load_audit(rows, "t").collect()[0].status == "SUCCESS"
    assert agg.load_audit(rows, "t", expected=4).collect()[0].status == "MISMATCH"
    assert tuple(agg.load_audit(rows.limit(0), "t").collect()[0]) == ("t", 0, "EMPTY")


def test_text_amounts_that_are_no_number_add_nothing(spark):
    rows = spark.createDataFrame([("north", "120"), ("south", "75"), ("north", "x"), ("north", "30")], "d string, s string")
    assert {r.d: r.total for r in agg.sum_text_amounts(rows, "d", "s").collect()} == {"north": 150, "south": 75}


def test_unreadable_and_lost_amounts_are_no_match(spark):
    big = "99999999999999999999.00"
    ours = spark.createDataFrame([(1, big), (2, "abc"), (3, big), (4, None), (5, "1e40")], "id int, a string")
    theirs = spark.createDataFrame([(1, None), (2, None), (3, big), (4, None), (5, "1e40")], "id int, b string")
    found = {r.id: (r.status, r.unreadable) for r in joins.amount_difference(ours, theirs, ["id"], "a", "b").collect()}
    assert found == {
        1: ("AMOUNT_DIFF", 0), 2: ("UNREADABLE", 1), 3: ("MATCH", 0), 4: ("MATCH", 0), 5: ("UNREADABLE", 2),
    }


def test_refunds_are_reconciled_apart(spark):
    ours = spark.createDataFrame([(1, 10.0), (1, -4.0), (2, -1.0)], "id int, a double")
    theirs = spark.createDataFrame([(1, 6.0), (2, -1.0)], "id int, b double")
    found = {(r.id, r.kind): r.status for r in joins.reconcile_amounts(ours, theirs, ["id"], "a", "b").collect()}
    assert found == {
        (1, "TRANSACTION"): "AMOUNT_DIFF", (1, "REFUND"): "ONLY_LEFT", (2, "REFUND"): "MATCH",
    }


def test_totals_without_fee_or_rate_are_numbers(spark):
    rows = spark.createDataFrame([("a", 10.0, None, None)], "bank string, amount double, fee double, rate double")
    row = reports.settlement_summary(rows, ["bank"], F.col("amount"), F.col("fee"), number_rows=False).collect()[0]
    assert (row.FEE_AMT, row.NET_AMT) == (0, 10)
    row = reports.fee_summary(rows, ["bank"], F.col("amount"), F.col("rate")).collect()[0]
    assert (row.FEE_AMOUNT, row.FEE_VAT_AMT, row.FEE_TOTAL_AMT) == (10, 0, 10)
    with pytest.raises(Exception, match="does not fit"):
        reports.settlement_summary(rows, ["bank"], F.lit(1e40), F.col("fee")).collect()


def test_lookups_refuse_a_key_with_two_values(spark):
    twice = spark.createDataFrame([("t", "a"), ("t", "b"), ("u", "c"), ("u", "c"), (None, "d")], "token string, value string")
    asked = spark.createDataFrame([("u",), (None,)], "token string")
    with pytest.raises(Exception, match="more than one value for token t"):
        joins.detokenise(asked, twice).collect()
    found = joins.detokenise(asked, twice.filter("token <> 't'")).collect()
    assert sorted((r.value, r.found) for r in found if r.found) == [("c", True)] and len(found) == 2
    with pytest.raises(Exception, match="more than one value"):
        joins.attach_surrogate_key(asked, twice, "token", "value").collect()


def test_accounts_with_another_name_or_none(spark):
    rows = spark.createDataFrame([(1, " ann "), (2, "bob"), (3, "cy"), (4, None)], "id int, told string")
    core = spark.createDataFrame([(1, "Ann"), (2, "Rob"), (4, "Di")], "id int, name string")
    found = joins.invalid_accounts(rows, core, "id", "told", "name").collect()
    assert sorted((r.id, r.core_name) for r in found) == [(2, "Rob"), (3, None), (4, "Di")]


def test_known_keys_are_the_target_and_stay_where_they_are(spark, tmp_path):
    draw = random.Random(8)
    keys = [None, "1", "2", "3", "x", ""]
    left = [(draw.choice(keys), draw.choice([None, 1, 2]), i) for i in range(300)]
    right = [(draw.choice(keys[:4]), draw.choice([None, 1])) for _ in range(60)]
    incoming = spark.createDataFrame(left, "a string, b int, n int")
    target = spark.createDataFrame(right, "A string, b long")
    known = KnownKeys(str(tmp_path / "keys"), ("a", "b"), 4)
    for part in (target.limit(30), target):
        remember_keys(part, known)
    out = new_by_known_keys(incoming, known)
    wanted = joins.new_rows(incoming, target, ["a", "b"])
    assert sorted(map(str, out.collect())) == sorted(map(str, wanted.collect()))
    # Between the join and the scan of the known keys there is no exchange.
    for setting in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", setting)
        try:
            plan = run_plan(new_by_known_keys(incoming, known))
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        final = plan.split("== Initial Plan ==")[0].splitlines()
        at = next(k for k, line in enumerate(final) if "Bucketed: true" in line)
        depth, above = final[at].index("FileScan"), []
        while "Join" not in final[at]:
            at -= 1
            here = len(final[at]) - len(final[at].lstrip(" :+-"))
            if here < depth:
                depth, above = here, [*above, final[at]]
        assert above and not any("Exchange" in line for line in above), "\n".join(final)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("known_keys")]


def test_a_key_book_says_what_the_reports_say(spark):
    draw = random.Random(5)
    amounts = ["1.50", "-2.25", "3", None, "x", "-1e33", "7.005"]
    sides = [
        spark.createDataFrame(
            [(draw.choice([None, "a", "b", "c", "d", "e"]), draw.randrange(3), draw.choice(amounts)) for _ in range(40)],
            "k string, m int, v string",
        )
        for _ in range(2)
    ]
    book = joins.key_book(*sides, ["k", "m"], "v", "v")
    told = joins.reconcile_amounts(*sides, ["k", "m"], "v", "v")
    for kind in ("TRANSACTION", "REFUND"):
        found = joins.book_differences(book, ["k", "m"], kind)
        wanted = told.filter(F.col("kind") == kind).select(*found.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert plan_of(book).count("Exchange") == 1
    for rows, other, missing in ((*sides, "_rn = 0"), (*sides[::-1], "_ln = 0")):
        found = joins.rows_of_keys(rows, book.filter(missing), ["k", "m"])
        wanted = joins.missing_from(rows, other, ["k", "m"])
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_wide_refunds_are_refunds(spark):
    rows = spark.createDataFrame([("a", "-1e33"), ("b", "5"), ("c", None), ("d", "x")], "k string, v string")
    refunds = joins.split_refunds(rows, "v")[1]
    assert [r.k for r in refunds.collect()] == ["a"]


def test_a_report_pack_reads_each_side_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    shape = "k string, g string, v string"
    ours = spark.createDataFrame([("a", "x", "1"), ("a", "x", "2"), ("b", "y", "-3"), ("c", "y", "4")], shape)
    theirs = spark.createDataFrame([("a", "x", "1"), ("b", "y", "-5"), ("d", "z", "9"), ("d", "z", "9")], shape)
    sides = [side.mapInArrow(seen, shape) for side in (ours, theirs)]
    fee = F.lit("0.5").cast("decimal(4,2)")
    manifest = report_pack(*sides, ["k"], ["g"], "v", fee, str(tmp_path / "pack"), ExportTemplate("json"))
    assert reads.value == 8
    assert {r.dataset: r.row_count for r in manifest.collect()} == {
        "SUMMARY": 2, "DUPLICATE": 1, "IMP_VS_SYNC": 1, "SYNC_VS_IMP": 2, "AMOUNT_DIFF": 1, "REFUND_DIFF": 1,
    }
