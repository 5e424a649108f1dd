from __future__ import annotations

from decimal import ROUND_DOWN, Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from ledgerflow.functions import convert
from ledgerflow.templates import resolve_names
from ledgerflow.operators.conform import CatalogColumn, conform, rename_by_position

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def values(spark, items, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.o for r in rows.select("i", expr.alias("o")).orderBy("i").collect()]


def test_truncates_and_never_rounds(spark):
    items = [1.234, 9999.99, 9999.999, None, -1.239, 1.15, 456.78]
    out = values(spark, items, "double", convert.truncate_number("v", 2))
    assert out == [1.23, 9999.99, 9999.99, 0, -1.23, 1.14, 456.78]


def test_whole_numbers(spark):
    out = values(spark, [1.234, 9999.99, None, float("nan")], "double", convert.truncate_number("v", 0))
    assert out == [1, 9999, 0, 0]
    big = [2**62 + 1, None]
    assert values(spark, big, "bigint", convert.truncate_number("v", 0)) == [2**62 + 1, 0]


def test_exact_truncation_uses_decimals(spark):
    out = values(spark, [1.15, -1.239, None], "double", convert.truncate_number("v", 2, exact=True))
    assert [str(v) for v in out] == ["1.15", "-1.23", "0.00"]


def test_text_to_number(spark):
    items = ["123", "456.78", "abc", None, "-5", "+5", " 5", "1e3", ".5", "5.", "1.239"]
    out = values(spark, items, "string", convert.text_to_number("v", 2))
    assert out == [123, 456.78, 0, 0, 0, 0, 0, 0, 0, 0, 1.23]
    signed = values(spark, items, "string", convert.text_to_number("v", 2, signed=True))
    assert signed[4:6] == [-5, 5]


def test_number_to_text(spark):
    items = [123.0, 456.0, 789.10, None, 12345678.9, 1e22, 1.5e-7, -0.5]
    out = values(spark, items, "double", convert.number_to_text("v", T.DoubleType(), 30))
    assert out == ["123", "456", "789.1", "", "12345678.9", "1" + "0" * 22, "1.5e-07", "-0.5"]
    cut = values(spark, items[:3], "double", convert.number_to_text("v", T.DoubleType(), 2))
    assert cut == ["12", "45", "78"]


@RELAXED
@given(st.lists(st.decimals(-(10**12), 10**12, places=5) | st.none(), min_size=1, max_size=60))
def test_decimals_lose_no_cent(spark, items):
    for scale in (0, 2):
        out = values(spark, items, "decimal(38,5)", convert.truncate_number("v", scale, exact=True))
        unit = Decimal(1).scaleb(-scale)
        assert out == [(v or Decimal(0)).quantize(unit, ROUND_DOWN) for v in items]


@RELAXED
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=60))
def test_doubles_of_eighths_are_cut_to_halves_of_nothing(spark, items):
    """Eighths are exact in doubles, so the cut is known without a model of doubles."""
    out = values(spark, [n / 8 for n in items], "double", convert.truncate_number("v", 1))
    assert out == [int(Decimal(n) / 8 * 10) / 10 for n in items]


def test_wide_numbers_are_kept(spark):
    items = [1e17, 1e19, -4e15 - 0.5, 1e300, 0.129]
    out = values(spark, items, "double", convert.truncate_number("v", 2))
    assert out == [1e17, 1e19, -4e15 - 0.5, 1e300, 0.12]
    out = values(spark, [1e19, None], "double", convert.truncate_number("v", 0, wide=True))
    assert [int(v) for v in out] == [10**19, 0]
    digits = ["12345678901234567890", "9" * 38, "5.9", "x", None]
    out = values(spark, digits, "string", convert.text_to_number("v", 0, wide=True))
    assert [int(v) for v in out] == [12345678901234567890, 10**38 - 1, 5, 0, 0]


@pytest.mark.parametrize("expr, items, kind", [
    (lambda: convert.truncate_number("v", 0), [1e19], "double"),
    (lambda: convert.text_to_number("v", 0), ["12345678901234567890"], "string"),
    (lambda: convert.text_to_number("v", 0, wide=True), ["1" * 39], "string"),
])
def test_what_does_not_fit_stops_the_job(spark, expr, items, kind):
    with pytest.raises(Exception, match="does not fit"):
        values(spark, items, kind, expr())


def test_a_line_feed_is_no_digit(spark):
    assert values(spark, ["123\n"], "string", convert.text_to_number("v", 2)) == [0]
    assert values(spark, ["7\n"], "string", convert.flag_to_number("v")) == [None]


def test_conform_keeps_decimals_and_drops_dates(spark):
    rows = spark.sql(
        "SELECT 1.15BD AS a, 99999999999999999999.99BD AS b, timestamp_ntz'2024-01-02' AS c, "
        "timestamp_ntz'2024-01-02' AS d"
    )
    catalog = [CatalogColumn("a", "NUMBER", 18, 2), CatalogColumn("b", "NUMBER", 38, 1),
               CatalogColumn("c", "NUMBER", 18, 2), CatalogColumn("d", "BOOLEAN")]
    row = conform(rows, catalog).collect()[0]
    assert (row.a, row.b, row.c, row.d) == (Decimal("1.15"), Decimal("99999999999999999999.9"), None, None)


def test_a_catalog_is_read_for_one_table_and_refuses_repeats(spark):
    catalog = spark.createDataFrame(
        [("T1", "ID", "NUMBER", 9, 0, None), ("T2", "ID", "VARCHAR2", None, None, 5)],
        "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, PRECISION int, SCALE int, MAX_LENGTH int",
    )
    rows = spark.createDataFrame([("12",)], "ID string")
    assert conform(rows, catalog, table="t1").collect()[0].ID == 12
    assert conform(rows, catalog, table="T2").collect()[0].ID == "12"
    with pytest.raises(ValueError, match="more than one ID"):
        conform(rows, catalog)


@RELAXED
@given(st.lists(st.floats(min_value=-1e15, max_value=1e15).filter(lambda v: v == 0 or abs(v) > 1e-300), min_size=1, max_size=60))
def test_number_text_reads_back_as_the_number(spark, items):
    out = values(spark, items, "double", convert.number_to_text("v", T.DoubleType()))
    assert [float(o) for o in out] == [float(repr(v)) for v in items]
    assert not any(o.endswith(".0") for o in out)


def test_flags(spark):
    items = ["Yes", "no", "TRUE", "false", "1", "0", "7", "maybe", None]
    assert values(spark, items, "string", convert.flag_to_number("v")) == [1, 0, 1, 0, 1, 0, 7, None, 0]
    assert values(spark, [True, False], "boolean", convert.flag_to_text("v")) == ["True", "False"]


def test_clamp(spark):
    held = convert.clamp("v", T.DoubleType(), 10.0, 0.0)
    assert values(spark, [5.0, 11.0, -1.0, None], "double", held) == [5.0, 10.0, 0.0, None]
    text = convert.clamp("v", T.StringType(), 10.0, 0.0)
    assert values(spark, ["5", "11", "abc", None], "string", text) == ["5", "10.0", "abc", None]


CATALOG = [
    CatalogColumn("ID", "VARCHAR2", max_length=3),
    CatalogColumn("AMOUNT", "NUMBER", scale=1),
    CatalogColumn("DAY", "DATE"),
    CatalogColumn("NAME", "VARCHAR2", max_length=4),
    CatalogColumn("STAMP", "VARCHAR2", max_length=8),
    CatalogColumn("OK", "NUMBER", scale=0),
    CatalogColumn("ABSENT", "NUMBER", scale=0),
]


def test_conform_converts_every_column(spark):
    rows = spark.sql(
        """SELECT 12345L AS ID, '7.89' AS AMOUNT, 20240229 AS DAY, 'Đặng Văn' AS NAME,
                  TIMESTAMP_NTZ '2024-02-29 10:11:12' AS STAMP, true AS OK, 'kept' AS OTHER"""
    )
    row = conform(rows, CATALOG).collect()[0]
    assert (row.ID, row.AMOUNT, str(row.DAY)) == ("123", 7.8, "2024-02-29 00:00:00")
    assert (row.NAME, row.STAMP, row.OK, row.OTHER) == ("Dang", "20240229", 1, "kept")


def test_conform_reads_the_catalog_from_a_frame(spark):
    catalog = spark.createDataFrame(
        [(c.column_name, c.data_type, None, c.scale, c.max_length) for c in CATALOG],
        "COLUMN_NAME string, DATA_TYPE string, PRECISION int, SCALE int, MAX_LENGTH int",
    )
    row = conform(spark.sql("SELECT '1.25' AS AMOUNT"), catalog).collect()[0]
    assert row.AMOUNT == 1.2


def test_one_null_does_not_change_how_a_column_is_read(spark):
    rows = spark.createDataFrame([(20240102, -5.5), (None, None)], "DAY int, AMOUNT double")
    out = conform(rows, CATALOG).orderBy("AMOUNT").collect()
    assert out[0].AMOUNT == -5.5 and str(out[0].DAY)[:10] == "2024-01-02"
    assert out[1].AMOUNT == 0 and out[1].DAY is None


def test_conform_names_the_failing_column_and_rejects_repeats(spark):
    with pytest.raises(ValueError, match="AMOUNT"):
        conform(spark.sql("SELECT 1 AS AMOUNT"), [CatalogColumn("AMOUNT", "NUMBER")])
    with pytest.raises(ValueError, match="more than one A"):
        conform(spark.sql("SELECT 1 AS A, 2 AS A"), [])


def test_header_map(spark):
    rows = spark.sql("SELECT 1 AS A, 2 AS B, 3 AS extra")
    named = rename_by_position(
        rows, ["Bank Name", "Bank Code"], {" bank name ": "bank_name", "BANK CODE": "acq_bank_code"}
    )
    assert named.columns == ["BANK_NAME", "ACQ_BANK_CODE", "EXTRA"]
    assert resolve_names(["x ", "y"], {}, loose=True) == ["X", "Y"]
    assert rename_by_position(rows).columns == ["A", "B", "EXTRA"]


def test_conversion_stays_in_the_jvm(spark):
    from conftest import plan_of

    rows = spark.range(3).select(
        F.col("id").alias("ID"), F.col("id").cast("string").alias("NAME"), F.col("id").alias("DAY")
    )
    assert "Python" not in plan_of(conform(rows, CATALOG))
