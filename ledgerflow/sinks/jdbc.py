"""Database writes over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerflow.sources.jdbc import Database


#: Tasks that write at the same time, unless a call says otherwise.
CONNECTIONS = 32


def write_options(
    database: Database,
    table: str,
    truncate: bool = False,
    batch_size: int = 10_000,
    connections: int = CONNECTIONS,
) -> dict[str, str]:
    """Options of a JDBC write; ``truncate`` empties the table instead of replacing it."""
    options = {"url": database.url, "dbtable": table, "batchsize": str(batch_size)}
    options["numPartitions"] = str(connections)
    options.update(database.properties)
    if truncate:
        options["truncate"] = "true"
    return options


def spread(df: DataFrame, connections: int) -> DataFrame:
    """As many partitions as connections, by an exchange.

    Without it the writer would coalesce, and the whole stage before the write would run in as few
    tasks as there are connections.
    """
    return df.repartition(connections)


def append_jdbc(
    df: DataFrame, database: Database, table: str, connections: int = CONNECTIONS
) -> None:
    _write(df, "append", write_options(database, table, connections=connections))


def write_jdbc(
    df: DataFrame,
    database: Database,
    table: str,
    replace: bool = True,
    connections: int = CONNECTIONS,
) -> None:
    """Replace the table, or add to it."""
    mode = "overwrite" if replace else "append"
    _write(df, mode, write_options(database, table, connections=connections))


def truncate_and_load(
    df: DataFrame, database: Database, table: str, connections: int = CONNECTIONS
) -> None:
    """Empty the table, keeping its definition, then load."""
    _write(df, "overwrite", write_options(database, table, truncate=True, connections=connections))


def _write(df: DataFrame, mode: str, options: dict[str, str]) -> None:
    rows = spread(df, int(options["numPartitions"]))
    rows.write.format("jdbc").options(**options).mode(mode).save()
