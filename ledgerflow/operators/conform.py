"""Bring a frame into the shape of a warehouse table, driven by its column catalog."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerflow.functions import convert, dates
from ledgerflow.templates import resolve_names

NUMERIC, DATETIME, TEXT = "numeric", "datetime", "text"


@dataclass(frozen=True)
class CatalogColumn:
    """One row of the warehouse catalog."""

    column_name: str
    data_type: str
    precision: int | None = None
    scale: int | None = None
    max_length: int | None = None


def catalog_from_frame(
    catalog: DataFrame, df: DataFrame, table: str | None = None
) -> list[CatalogColumn]:
    """Read the catalog rows of ``df``'s own columns; bounded by the width of ``df``.

    A catalog of several tables has a ``TABLE_NAME``, and ``table`` says which one is meant.
    """
    if table is not None:
        catalog = catalog.filter(F.upper("TABLE_NAME") == table.upper())
    rows = (
        catalog.filter(F.col("COLUMN_NAME").isin(df.columns))
        .select("COLUMN_NAME", "DATA_TYPE", "PRECISION", "SCALE", "MAX_LENGTH")
        .limit(len(df.columns) + 1)
        .collect()
    )
    return [
        CatalogColumn(name, kind, *(None if v is None else int(v) for v in numbers))
        for name, kind, *numbers in rows
    ]


def _category(kind: T.DataType) -> str:
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return NUMERIC
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return DATETIME
    return TEXT


def _date_from_number(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(kind, T.IntegralType):
        return dates.timestamp_from_integer(c)
    return dates.timestamp_from_serial(c)


# Digits that a 64-bit number always holds.
LONG_DIGITS = 18

# Types the warehouse names that fall back to a plain cast.
PLAIN_CASTS = {"NUMBER": "double", "VARCHAR2": "string", "DATE": "timestamp_ntz", "BOOLEAN": "boolean"}


def _fallback(c: Column, kind: T.DataType, target: str, category: str) -> Column:
    plain = PLAIN_CASTS.get(target)
    if category == DATETIME and target in ("NUMBER", "BOOLEAN"):
        return F.lit(None).cast(plain)
    return c.try_cast(plain) if plain else c


def convert_column(c: Column, kind: T.DataType, to: CatalogColumn) -> Column:
    """The expression that turns a column of type ``kind`` into the catalog type."""
    category = _category(kind)
    if to.data_type == "VARCHAR2":
        if category == DATETIME:
            return convert.timestamp_to_text(c, to.max_length)
        if category == NUMERIC:
            return convert.number_to_text(c, kind, to.max_length)
        return convert.text_to_text(c.cast("string"), to.max_length)
    if to.data_type == "NUMBER" and category != DATETIME:
        if to.scale is None:
            raise ValueError("a NUMBER needs a scale")
        wide = to.precision is not None and to.precision > LONG_DIGITS
        if category == TEXT:
            return convert.text_to_number(c, to.scale, wide=wide)
        if isinstance(kind, T.DecimalType) and (wide or to.scale > 0):
            return convert.cut_decimal(c, to.scale)
        if isinstance(kind, T.BooleanType):
            c = c.cast("int")
        return convert.truncate_number(c, to.scale, exact=isinstance(kind, T.DecimalType), wide=wide)
    if to.data_type == "DATE" and category != DATETIME:
        if category == NUMERIC:
            return _date_from_number(c, kind)
        return dates.timestamp_from_text(c)
    return _fallback(c, kind, to.data_type, category)


def _names_once(names: list[str], where: str) -> None:
    again = sorted(name for name, times in Counter(names).items() if times > 1)
    if again:
        raise ValueError(f"{where} has more than one {', '.join(again)}")


def conform(
    df: DataFrame, catalog: DataFrame | list[CatalogColumn], table: str | None = None
) -> DataFrame:
    """Convert every cataloged column in one projection; others pass through.

    Catalog entries without an input column are skipped; ``table`` picks the rows of one table from
    a catalog of many, and a column that is named twice stops the job. The type of the input column
    decides the rule, so one NULL in a column never changes how the rest is read. Decimal columns
    are cut as decimals, to the cent.
    """
    _names_once(df.columns, "the input")
    if isinstance(catalog, DataFrame):
        catalog = catalog_from_frame(catalog, df, table)
    _names_once([entry.column_name for entry in catalog], "the catalog")
    rules = {entry.column_name: entry for entry in catalog}
    out = []
    for field in df.schema.fields:
        rule = rules.get(field.name)
        column = F.col(f"`{field.name}`")
        if rule is not None:
            try:
                column = convert_column(column, field.dataType, rule)
            except ValueError as error:
                raise ValueError(f"cannot convert column {field.name} to {rule}: {error}") from error
        out.append(column.alias(field.name))
    return df.select(*out)


def rename_by_position(
    df: DataFrame, header: list[str] | None = None, mapping: dict[str, str] | None = None
) -> DataFrame:
    """The n-th column takes the n-th final name of the header, or of the frame's own without one;
    columns beyond the header keep their name in upper case."""
    width = len(df.columns)
    names = resolve_names(header or df.columns, mapping or {}, loose=True)[:width]
    return df.toDF(*names, *map(str.upper, df.columns[len(names) :]))
