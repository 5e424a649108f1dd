"""Tables published by snapshot: written aside, counted, then switched to.

A table is a folder of data folders and a log. Entry n of the log is a small JSON file that lists the
data folders the table consists of; it is renamed into place and never replaced, so of two writers
that both started from entry n - 1 one is told to begin anew. Readers take the last entry. A write
that fails, or that does not hold what was sent, leaves no entry, and the old rows stay readable.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerflow.session import remove_path

ENTRY = re.compile(r"^(\d{12})\.json$")


class Conflict(RuntimeError):
    """Another writer has published since this one looked."""


class Mismatch(RuntimeError):
    """What was written is not what was sent, or a check refused it."""


@dataclass(frozen=True)
class Snapshot:
    """One entry of the log; ``folders`` are relative to the table."""

    version: int
    folders: tuple[str, ...]
    rows: int


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def _files(spark: SparkSession, base: str):
    path = _hadoop(spark).Path(base)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_hadoop(spark).Path(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, base: str) -> list[int]:
    """Versions of a table that can be read, oldest first; none where there is no table."""
    folder = _hadoop(spark).Path(f"{base}/log")
    files = _files(spark, base)
    if not files.exists(folder):
        return []
    found = (ENTRY.match(status.getPath().getName()) for status in files.listStatus(folder))
    return sorted(int(m.group(1)) for m in found if m)


def snapshot(spark: SparkSession, base: str, version: int | None = None) -> Snapshot | None:
    """The entry of a version, by default the last; None where there is none."""
    known = versions(spark, base)
    if not known or (version is not None and version not in known):
        return None
    version = known[-1] if version is None else version
    entry = json.loads(_read_text(spark, f"{base}/log/{version:012d}.json"))
    return Snapshot(version, tuple(entry["folders"]), entry["rows"])


def read_snapshot(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """Rows of a version, by default the last one published."""
    found = snapshot(spark, base, version)
    if found is None:
        raise FileNotFoundError(f"{base} has no version {'yet' if version is None else version}")
    return _read(spark, base, found.folders)


def _read(spark: SparkSession, base: str, folders: tuple[str, ...]) -> DataFrame:
    """Folders of one table as a frame; every folder is a root of its own for partition columns."""
    parts = [spark.read.parquet(f"{base}/{folder}") for folder in folders]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _enter(spark: SparkSession, base: str, entry: Snapshot) -> None:
    """Rename an entry into place; fails where there is one already."""
    fs = _hadoop(spark)
    aside = fs.Path(f"{base}/log/.{uuid.uuid4().hex}")
    stream = _files(spark, base).create(aside, False)
    try:
        stream.write(json.dumps({"folders": entry.folders, "rows": entry.rows}).encode())
    finally:
        stream.close()
    context = fs.FileContext.getFileContext(aside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # Without the option to overwrite.
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(aside, fs.Path(f"{base}/log/{entry.version:012d}.json"), options)
    except Exception as error:
        remove_path(spark, aside.toString())
        if "FileAlreadyExists" in str(error):
            raise Conflict(f"{base} has a version {entry.version} already") from error
        raise


def publish(
    df: DataFrame, base: str, append: bool = False, seen: int | None = None,
    check: Callable[[DataFrame], bool] | None = None, partition_by: list[str] | None = None,
) -> Snapshot:
    """Write ``df`` aside, count it, and make it the table's next version.

    ``append`` adds to the folders of the version before; otherwise the new rows replace them.
    ``seen`` is the version that ``df`` was derived from (0 for none); where the table has moved on
    since, nothing is published. ``check`` sees the rows as they were written. Rows are counted while
    they are written and again when read back.
    """
    spark = df.sparkSession
    before = snapshot(spark, base)
    at = before.version if before else 0
    if seen is not None and seen != at:
        raise Conflict(f"{base} is at version {at}, not {seen}")
    folder = f"data/{uuid.uuid4().hex}"
    counter = Observation()
    try:
        writer = df.observe(counter, F.count(F.lit(1)).alias("n")).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{base}/{folder}")
        sent, written = counter.get["n"], spark.read.schema(df.schema).parquet(f"{base}/{folder}")
        found = written.count()
        if found != sent:
            raise Mismatch(f"{found} rows found of {sent} sent to {base}")
        if check is not None and not check(written):
            raise Mismatch(f"the rows sent to {base} were refused by their check")
        kept = before.folders if before and append else ()
        rows = sent + (before.rows if before and append else 0)
        # A folder without rows adds nothing, unless it is the whole table.
        folders = (*kept, folder) if sent or not kept else kept
        entry = Snapshot(at + 1, folders, rows)
        _enter(spark, base, entry)
    except BaseException:
        remove_path(spark, f"{base}/{folder}")
        raise
    if folder not in entry.folders:
        remove_path(spark, f"{base}/{folder}")
    return entry


def expire(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions, and the folders that none of these holds.

    Folders that a write under way has not entered yet go as well, so call it between loads.
    """
    known = versions(spark, base)
    old, kept = known[: -max(keep, 1)], known[-max(keep, 1) :]
    held = {folder for v in kept for folder in snapshot(spark, base, v).folders}
    for version in old:
        remove_path(spark, f"{base}/log/{version:012d}.json")
    data = _hadoop(spark).Path(f"{base}/data")
    removed = 0
    for status in _files(spark, base).listStatus(data) if known else ():
        folder = f"data/{status.getPath().getName()}"
        if folder not in held:
            remove_path(spark, f"{base}/{folder}")
            removed += 1
    return removed
