"""Session settings and the shared folder that jobs stage data in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join by hash, without sorting the large side, when every build partition stays this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not optimise methods above 8000 bytes; split wide projections below that.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "ledgerflow", master: str | None = None, **settings: str
) -> SparkSession:
    """Session with adaptive execution on and UTC time; ``settings`` win over the defaults.

    Setting names are passed with ``__`` for ``.``, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may go without the setting; it gets a fresh folder on this machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerflow-")


#: Paths that the job at hand has drawn; a list per job, and one for what runs outside of any.
_outside: list[str] = []
_paths: ContextVar[list[str]] = ContextVar("paths", default=_outside)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet; it belongs to the job at hand."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _paths.get().append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps then see one fixed set of rows, also when an executor is lost and tasks rerun.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside belongs to one job and is removed at its end; write results before.

    Jobs may run side by side or inside each other: each removes its own paths only.
    """
    own: list[str] = []
    token = _paths.set(own)
    try:
        yield
    finally:
        _paths.reset(token)
        for path in own:
            remove_path(spark, path)


def release_staged(spark: SparkSession) -> int:
    """Delete what was staged outside of any job; call it once the results are written."""
    count = len(_outside)
    while _outside:
        remove_path(spark, _outside.pop())
    return count
