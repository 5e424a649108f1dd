"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from check_queries import TABLES, compare
from conftest import SMALL, plan_of

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

from ledgerflow.queries import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck.sql(ORACLES[name])) == []


def test_contract_lists_every_query_and_its_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


NATIVE = [
    "conform_table", "conform_orders", "number_truncate", "text_to_number", "number_to_text",
    "date_mixed", "date_from_integer", "strip_accents", "header_map", "sha_token", "hmac_token",
    "aes_round_trip", "recode_columns", "coerce_columns", "classify_paths", "mask_hash",
]


@pytest.mark.parametrize("name", NATIVE)
def test_expressions_run_without_python_or_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize(
    "name",
    ["incremental_new_rows", "recon_two_way", "recon_missing_rows", "recon_amount_diff",
     "star_key_lookup", "detokenise", "golden_record", "latest_per_key", "duplicate_report"],
)
def test_joins_and_groups_have_no_nested_loop_or_single_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["filter_and"](spark, SMALL))
    assert "EqualTo(o_orderstatus,O)" in plan and "GreaterThan(o_totalprice,250000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    keys = plan_of(QUERIES["target_key_projection"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in keys and "o_totalprice" not in keys


def test_top_rows_are_not_fully_sorted(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_k"](spark, SMALL))


def test_the_contract_holds_without_the_optional_folder(tmp_path):
    """Also where an empty cache folder is left of it, or the pipeline's file alone is there."""
    root = Path(contract.__file__).parent
    shutil.copytree(root / "ledgerflow", tmp_path / "ledgerflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "ledgerflow" / "llm" / "__pycache__").mkdir(parents=True)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    for name in (None, "corpus_pipeline.py"):
        if name:
            (tmp_path / name).write_text("from ledgerflow.llm.common import table\n")
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
        assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], done.stderr
