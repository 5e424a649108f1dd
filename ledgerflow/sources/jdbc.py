"""Database tables and queries over JDBC."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.templates import LoadSettings

# URL form and driver class by kind of database.
URL_FORMS = {
    "oracle": "jdbc:oracle:thin:@//{host}:{port}/{database}",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
}
DRIVERS = {"oracle": "oracle.jdbc.OracleDriver", "postgresql": "org.postgresql.Driver"}


@dataclass(frozen=True)
class Database:
    """Where a database is; the password is left out of the printed form."""

    kind: str
    host: str
    port: int
    database: str
    user: str
    password: str = ""

    def __repr__(self) -> str:
        return f"Database({self.kind}, {self.host}:{self.port}/{self.database})"

    @property
    def url(self) -> str:
        return URL_FORMS[self.kind].format(
            host=self.host, port=self.port, database=self.database
        )

    @property
    def properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "driver": DRIVERS[self.kind]}


def read_options(
    database: Database,
    table: str | None = None,
    query: str | None = None,
    split_column: str | None = None,
    bounds: tuple | None = None,
    splits: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read; with ``split_column`` the table is read in parallel ranges.

    Rows outside ``bounds`` still come, in the first and last range.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": database.url, "fetchsize": str(fetch_size), **database.properties}
    if split_column is None:
        options["dbtable" if table else "query"] = table or query
        return options
    if bounds is None or splits is None:
        raise ValueError("a parallel read needs bounds and a number of splits")
    # Parallel reads take a table only, so a query becomes a derived table.
    options["dbtable"] = table or f"({query}) source_rows"
    options["partitionColumn"] = split_column
    options["lowerBound"], options["upperBound"] = str(bounds[0]), str(bounds[1])
    options["numPartitions"] = str(splits)
    return options


def read_jdbc(spark: SparkSession, database: Database, **how) -> DataFrame:
    """A table or query as a frame. A failing query raises, it never gives an empty frame."""
    return spark.read.format("jdbc").options(**read_options(database, **how)).load()


def split_bounds(spark: SparkSession, database: Database, table: str, column: str) -> tuple:
    """Lowest and highest value of a column, computed by the database, for a parallel read."""
    query = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
    return tuple(read_jdbc(spark, database, query=query).head())


# A column's hash, from 0 up to the number of parts, by kind of database.
HASH_FORMS = {
    "oracle": "ORA_HASH({column}, {last})",
    "postgresql": "MOD(ABS(CAST(HASHTEXT(CAST({column} AS TEXT)) AS BIGINT)), {parts})",
}


def hash_predicates(database: Database, column: str, splits: int) -> list[str]:
    """One predicate per part, by the database's hash of a column of any type.

    Every row meets one of them, rows without a value the first. The parts are even where values are
    many, and each reads the whole table's index or rows in the database, so ranges are the better
    choice where a column has an index.
    """
    if splits < 2:
        raise ValueError("a parallel read needs two splits or more")
    part = HASH_FORMS[database.kind].format(column=column, last=splits - 1, parts=splits)
    found = [f"{column} IS NOT NULL AND {part} = {k}" for k in range(splits)]
    return [f"{column} IS NULL OR ({found[0]})", *found[1:]]


def quantile_query(table: str, column: str, splits: int) -> str:
    """The lowest value of each of ``splits`` parts of equal size, computed by the database."""
    return (
        f"SELECT MIN(value) AS low FROM (SELECT {column} AS value, NTILE({splits}) OVER "
        f"(ORDER BY {column}) AS tile FROM {table} WHERE {column} IS NOT NULL) ranked "
        f"GROUP BY tile ORDER BY low"
    )


def _literal(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str, dt.date)):
        raise TypeError(f"no literal for {type(value).__name__}")
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("no literal for a value that is not finite")
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + value.replace("'", "''") + "'"


def range_predicates(column: str, lows: list) -> list[str]:
    """One predicate per range between neighbouring values of ``lows``, which are sorted as the
    database sorts them. Every row meets one of them: what lies below the first low, and rows without
    a value, the first. A value that is a low more than once, a very common one, begins one range."""
    bounds = list(dict.fromkeys(_literal(low) for low in lows))[1:]
    if not bounds:
        return []
    found = [f"{column} IS NULL OR {column} < {bounds[0]}"]
    found += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [*found, f"{column} >= {bounds[-1]}"]


def read_split(
    spark: SparkSession, database: Database, table: str, predicates: list[str],
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table in one task per predicate; without any, in one task."""
    properties = {**database.properties, "fetchsize": str(fetch_size)}
    if not predicates:
        return spark.read.jdbc(database.url, table, properties=properties)
    return spark.read.jdbc(database.url, table, predicates=predicates, properties=properties)


def read_by_quantiles(
    spark: SparkSession, database: Database, table: str, column: str, splits: int
) -> DataFrame:
    """A table in ranges of equal size of a column of any ordered type; the bounds are ``splits``
    values at most."""
    lows = read_jdbc(spark, database, query=quantile_query(table, column, splits)).collect()
    return read_split(spark, database, table, range_predicates(column, [row[0] for row in lows]))


def target_keys(target: DataFrame, load: LoadSettings) -> DataFrame | None:
    """Key columns the target already holds, or None unless the load is incremental.

    Projection and predicate are pushed into the target's reader.
    """
    if not load.incremental:
        return None
    rows = target.filter(load.where) if load.where else target
    return rows.select(*load.key_columns)
