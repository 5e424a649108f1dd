"""Tables by snapshot, and what is built on them: safe loads, golden records by batch, vaults."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.masking import clashing_tokens, grow_vault
from ledgerflow.plans.golden import GoldenRules, compact, fold, golden_state, golden_view
from ledgerflow.plans.jobs import golden_record, safe_load
from ledgerflow.sinks.snapshots import (
    Conflict,
    Mismatch,
    expire,
    publish,
    read_snapshot,
    snapshot,
    versions,
)


def ids(df):
    return sorted(r.id for r in df.collect())


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "t" / "data").iterdir())


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, base)
    assert publish(spark.range(10), base).rows == 10
    before = folders(tmp_path)
    broken = spark.range(100).select(
        F.when(F.col("id") == 77, F.raise_error("no").cast("long")).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="no"):
        publish(broken, base)
    with pytest.raises(Mismatch):
        publish(spark.range(5), base, check=lambda rows: rows.count() > 5)
    assert versions(spark, base) == [1] and ids(read_snapshot(spark, base)) == list(range(10))
    assert folders(tmp_path) == before


def test_versions_follow_each_other(spark, tmp_path):
    base = str(tmp_path / "t")
    publish(spark.range(3), base, seen=0)
    publish(spark.range(3, 5), base, append=True, seen=1)
    with pytest.raises(Conflict):
        publish(spark.range(9), base, seen=1)
    assert ids(read_snapshot(spark, base)) == [0, 1, 2, 3, 4] and snapshot(spark, base).rows == 5
    publish(spark.range(0), base, append=True)
    assert len(snapshot(spark, base).folders) == 2
    publish(spark.range(0), base)
    assert read_snapshot(spark, base).columns == ["id"] and ids(read_snapshot(spark, base)) == []
    assert ids(read_snapshot(spark, base, 1)) == [0, 1, 2]
    assert expire(spark, base, keep=2) == 0 and versions(spark, base) == [3, 4]
    assert expire(spark, base, keep=1) == 2 and ids(read_snapshot(spark, base)) == []
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, base, 1)


def test_of_two_writers_one_begins_anew(spark, tmp_path):
    """Both look at version 1; the one that enters last finds its place taken."""
    base = str(tmp_path / "t")
    publish(spark.range(3), base)

    def meanwhile(rows):
        publish(spark.range(7), base, append=True)
        return True

    with pytest.raises(Conflict):
        publish(spark.range(9), base, check=meanwhile)
    assert ids(read_snapshot(spark, base)) == sorted([*range(3), *range(7)]) and len(folders(tmp_path)) == 2


def test_safe_load_audits_what_readers_see(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "t")
    spark.range(6).write.parquet(source)
    audit = safe_load(spark, source, spark.read.parquet, base, "t").collect()
    assert [tuple(r) for r in audit] == [("t", 6, "SUCCESS")]
    with pytest.raises(FileNotFoundError):
        safe_load(spark, str(tmp_path / "nowhere"), spark.read.parquet, base, "t")
    with pytest.raises(Mismatch):
        safe_load(spark, source, spark.read.parquet, base, "t", check=lambda rows: False)
    assert versions(spark, base) == [1]


def test_golden_records_by_batch_are_those_of_one_run(spark, tmp_path):
    rules = GoldenRules(
        identity=("mail",), keep=("name", "mail"), required=("name",),
        newest_first=(F.desc("day"),), tie_break=(F.asc("row"),), null_marker="-",
    )
    draw = random.Random(3)
    rows = [(draw.choice([None, "n1", "n2", "n3"]), draw.choice([None, *"abcdefgh"]), draw.randrange(9), k)
            for k in range(120)]
    shape = "name string, mail string, day int, row int"
    whole = golden_record([spark.createDataFrame(rows, shape)], ["mail"], ["name", "mail"], ["name"],
                          [F.desc("day")], [F.asc("row")], null_marker="-")
    wanted = sorted(map(tuple, whole.collect()))
    base = str(tmp_path / "t")
    cut = sorted(draw.sample(range(120), 3))
    parts = [rows[a:b] for a, b in zip([0, *cut], [*cut, 120])]
    draw.shuffle(parts)
    for part in [*parts, parts[0], rows[30:50]]:
        fold([spark.createDataFrame(part, shape)], base, rules, buckets=3)
    assert sorted(map(tuple, golden_view(spark, base, rules).collect())) == wanted
    done = compact(spark, base, rules, most=2)
    assert len(done.folders) == 1 and compact(spark, base, rules, most=2) == done
    assert sorted(map(tuple, golden_view(spark, base, rules).collect())) == wanted
    fold([spark.createDataFrame([("late", "a", -1, 500)], shape)], base, rules, buckets=3)
    assert sorted(map(tuple, golden_view(spark, base, rules).collect())) == wanted
    state = golden_state(spark, base, rules)
    assert state.count() == len({r[1] for r in rows}) and state.filter("_bucket = 0").count() < state.count()


def test_a_vault_grows_by_unseen_values_only(spark, tmp_path):
    base = str(tmp_path / "t")
    names = lambda *values: spark.createDataFrame([(v,) for v in values], "name string")
    grow_vault(names("a", "b", None, "a"), "name", F.uuid(), base)
    first = {r.value: r.token for r in read_snapshot(spark, base).collect()}
    assert set(first) == {"a", "b"}
    grow_vault(names("b", "c"), "name", F.uuid(), base)
    second = {r.value: r.token for r in read_snapshot(spark, base).collect()}
    assert set(second) == {"a", "b", "c"} and {k: second[k] for k in first} == first
    assert grow_vault(names("c"), "name", F.uuid(), base).version == 2
    with pytest.raises(ValueError, match="several values"):
        grow_vault(names("x1", "x2"), "name", F.substring("name", 1, 1), base)
    with pytest.raises(ValueError, match="several values"):
        grow_vault(names("new"), "name", F.lit(second["a"]), base)
    assert versions(spark, base) == [1, 2] and clashing_tokens(read_snapshot(spark, base)).count() == 0
