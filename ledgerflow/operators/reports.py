"""Settlement, fee and duplicate reports.

The source procedures of these reports are not public; the shapes follow the report layouts
(group columns, counts, amounts, fees, net amounts, running number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerflow.functions.convert import must_cast
from ledgerflow.operators.windows import running_number

MONEY = "decimal(38,4)"


def duplicate_report(df: DataFrame, keys: list[str], name: str = "CN") -> DataFrame:
    """Keys that occur more than once, with their number; empty when there are none."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def _money(c: Column) -> Column:
    """Exact sum; 0 without any amount. An amount that cannot be read stops the report."""
    return F.coalesce(F.sum(must_cast(c, "decimal(28,4)")).cast(MONEY), F.lit(0).cast(MONEY))


def settlement_summary(
    df: DataFrame, group_by: list[str], amount: Column, fee: Column, number_rows: bool = True
) -> DataFrame:
    """Transactions, amount, fee and amount after fee per group, numbered in group order.

    A missing amount or fee counts as 0.
    """
    totals = df.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("NUM_OF_TXN"),
        _money(amount).alias("TXN_AMT"),
        _money(fee).alias("FEE_AMT"),
    )
    report = totals.withColumn("NET_AMT", (F.col("TXN_AMT") - F.col("FEE_AMT")).cast(MONEY))
    return running_number(report, [F.col(c) for c in group_by]) if number_rows else report


def fee_summary(df: DataFrame, accounts: list[str], fee: Column, vat_rate: Column) -> DataFrame:
    """Fee, VAT on it and their sum per posting account; add device columns for the detail form."""
    vat = must_cast(fee, "decimal(24,4)") * must_cast(vat_rate, "decimal(10,6)")
    totals = df.groupBy(*accounts).agg(
        _money(fee).alias("FEE_AMOUNT"), _money(vat).alias("FEE_VAT_AMT")
    )
    both = (F.col("FEE_AMOUNT") + F.col("FEE_VAT_AMT")).cast(MONEY)
    return totals.withColumn("FEE_TOTAL_AMT", both)
