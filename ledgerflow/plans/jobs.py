"""Ready jobs: golden record, safe publication, loads, report import, lake ingest, report pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.functions.codec import key_hash
from ledgerflow.functions.masking import mask_by_key
from ledgerflow.operators.aggregates import load_audit, union_sources
from ledgerflow.operators.clean import cast_columns, where_present
from ledgerflow.operators.conform import CatalogColumn, conform
from ledgerflow.operators.joins import book_differences, key_book, new_rows, rows_of_keys
from ledgerflow.operators.masking import safe_projection, tokenise
from ledgerflow.operators.reports import settlement_summary
from ledgerflow.operators.settlement import read_reports, to_report_table
from ledgerflow.operators.windows import latest_per_key
from ledgerflow.session import stage
from ledgerflow.sinks.export import export_datasets
from ledgerflow.sinks.files import write_csv, write_lake, write_parquet
from ledgerflow.sinks.snapshots import publish, read_snapshot
from ledgerflow.sources.delimited import import_delimited
from ledgerflow.sources.files import path_exists, read_csv, read_parquet
from ledgerflow.sources.jdbc import target_keys
from ledgerflow.streaming.ingest import append_stream, raw_text, read_messages, run_to_end
from ledgerflow.templates import ExportTemplate, ImportTemplate


def golden_record(
    sources: list[DataFrame],
    identity: list[str],
    keep: list[str],
    required: list[str],
    newest_first: list[Column],
    tie_break: list[Column],
    renames: dict[str, str] | None = None,
    created: bool = False,
    null_marker: str | None = None,
) -> DataFrame:
    """Stack the sources, key rows by a hash of their identity, keep the newest row per key.

    Rows whose identity is missing altogether share one key; a ``null_marker`` stands for a missing
    part, so that a row without a phone and one without an e-mail stay apart. Rows without the required columns go at the end, so a newer incomplete row still hides an
    older complete one. ``created`` adds the time of this run.
    """
    bronze = union_sources(*sources)
    silver = latest_per_key(
        bronze.withColumn("unique_key", key_hash(*identity, null_marker=null_marker)), ["unique_key"], newest_first, tie_break
    )
    golden = where_present(silver.select("unique_key", *keep), *required)
    golden = golden.withColumnsRenamed(renames or {})
    return golden.withColumn("created_at", F.current_timestamp()) if created else golden


def publish_safe(
    df: DataFrame,
    tokens: dict[str, str],
    mask: dict[str, str],
    keep: list[str],
    key: str,
    salt: str,
    identifying: list[str],
) -> DataFrame:
    """Tokenise identities, mask numbers (``{column: masked column}``), let only safe columns out."""
    masked = tokenise(df, tokens).withColumns(
        {into: mask_by_key(name, key, salt) for name, into in mask.items()}
    )
    return safe_projection(masked, [*tokens.values(), *keep, *mask.values()], identifying)


def incremental_load(
    spark: SparkSession,
    paths: str | list[str],
    template: ImportTemplate,
    catalog: DataFrame | list[CatalogColumn],
    target: DataFrame | None = None,
) -> DataFrame:
    """Import files by template, convert to the warehouse types, leave out known keys.

    Nothing is written; append the result to ``target`` afterwards.
    """
    rows = conform(import_delimited(spark, paths, template), catalog)
    if target is None:
        return rows
    keys = target_keys(target, template.load)
    return rows if keys is None else new_rows(rows, keys, list(template.load.key_columns))


def copy_through_staging(
    source: DataFrame, staging_path: str, columns: list[str], write: Callable[[DataFrame], None]
) -> DataFrame:
    """Copy a database table to staging files, then write the chosen columns to the warehouse.

    Reader and writer are parameters, e.g. ``read_jdbc`` and ``append_jdbc``. Gives the staged rows.
    """
    write_parquet(source, staging_path)
    staged = read_parquet(source.sparkSession, staging_path).selectExpr(*columns)
    write(staged)
    return staged


def checked_load(
    spark: SparkSession,
    input_path: str,
    read: Callable[[str], DataFrame],
    write: Callable[[DataFrame], None],
    read_back: Callable[[], DataFrame],
    table: str,
) -> DataFrame:
    """Load with checks: the input must be there, the target is emptied and filled, then counted."""
    if not path_exists(spark, input_path):
        raise FileNotFoundError(input_path)
    write(read(input_path))
    return load_audit(read_back(), table)


def safe_load(
    spark: SparkSession,
    input_path: str,
    read: Callable[[str], DataFrame],
    base: str,
    table: str,
    check: Callable[[DataFrame], bool] | None = None,
) -> DataFrame:
    """Load with checks, the other way round: write aside and count first, switch over last.

    Gives the audit row of what readers see from now on. Where the input is absent, the write fails,
    or the rows are not those that were sent or do not pass ``check``, it raises, and readers go on
    with the version before.
    """
    if not path_exists(spark, input_path):
        raise FileNotFoundError(input_path)
    done = publish(read(input_path), base, check=check)
    return load_audit(read_snapshot(spark, base, done.version), table, done.rows)


def import_reports(
    spark: SparkSession,
    path: str | list[str],
    write: Callable[[DataFrame], None] | None = None,
    name_column: str | None = None,
) -> DataFrame:
    """Parse settlement reports into the report table; ``write`` appends or truncates first."""
    table = to_report_table(read_reports(spark, path, name_column))
    if write is not None:
        write(table)
    return table


def bronze_batch(spark: SparkSession, csv_path: str, lake_path: str, fmt: str | None = None) -> None:
    write_lake(read_csv(spark, csv_path, infer=True), lake_path, fmt)


def bronze_stream(
    spark: SparkSession,
    lake_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    source: str = "kafka",
    path: str | None = None,
    **options: str,
) -> None:
    """Everything available now, as raw text, into the lake."""
    stream = raw_text(read_messages(spark, source, path, **options))
    run_to_end(append_stream(stream, lake_path, checkpoint, fmt, available_now=True))


def derive_csv(
    spark: SparkSession, in_path: str, out_path: str, key: str, value: str
) -> DataFrame:
    """Text CSV in, value as a number and doubled, CSV out; gives what was written."""
    rows = cast_columns(read_csv(spark, in_path).select(key, value), {value: "double"})
    derived = rows.withColumn("value_double", F.col(value) * 2)
    write_csv(derived, out_path)
    return derived


def report_pack(
    imported: DataFrame,
    synced: DataFrame,
    keys: list[str],
    group_by: list[str],
    amount: str,
    fee: Column,
    base: str,
    template: ExportTemplate,
) -> DataFrame:
    """Settlement, duplicate and reconciliation sheets in one export; gives the manifest.

    Each side is read once and staged, so a database or a text import behind it is not asked again.
    One aggregate per key, staged as well, feeds the duplicate and both difference sheets; rows of
    keys that one side alone has are joined back.
    """
    imported, synced = stage(imported, "imported"), stage(synced, "synced")
    book = stage(key_book(imported, synced, keys, amount, amount), "key-book")
    duplicates = book.filter(F.col("_ln") > 1).select(*keys, F.col("_ln").alias("CN"))
    sheets = {
        "SUMMARY": settlement_summary(imported, group_by, F.col(amount), fee),
        "DUPLICATE": duplicates,
        "IMP_VS_SYNC": rows_of_keys(imported, book.filter("_rn = 0"), keys),
        "SYNC_VS_IMP": rows_of_keys(synced, book.filter("_ln = 0"), keys),
    }
    for sheet, kind in (("AMOUNT_DIFF", "TRANSACTION"), ("REFUND_DIFF", "REFUND")):
        differing = book_differences(book, keys, kind)
        sheets[sheet] = differing.filter(F.col("status").isin("AMOUNT_DIFF", "UNREADABLE"))
    return export_datasets(list(sheets.values()), list(sheets), base, template)
