"""Template-driven export of several datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ledgerflow.session import remove_path
from ledgerflow.sinks.files import write_csv, write_json
from ledgerflow.templates import ExportTemplate

MANIFEST = (
    "dataset string, path string, sheet_name string, title string, row_count bigint, "
    "written boolean"
)


def dataset_paths(base: str, names: list[str]) -> list[str]:
    """``{base}_{name}`` for the first dataset, ``{base}_{i}_{name}`` from the second on."""
    return [f"{base}{f'_{i}' if i else ''}_{name}" for i, name in enumerate(names)]


def _write(df: DataFrame, path: str, template: ExportTemplate, has_header: bool) -> None:
    extension = template.extension.lower()
    if extension == "json":
        write_json(df, path)
    elif extension == "csv":
        write_csv(df, path, header=has_header, sep=template.separator, emptyValue="")
    else:
        write_csv(df, path, header=False, sep=template.separator, emptyValue="")


def export_datasets(
    datasets: list[DataFrame],
    names: list[str],
    base: str,
    template: ExportTemplate,
    map_columns: bool = True,
) -> DataFrame:
    """Write each dataset to a folder of its own; gives one manifest row per dataset.

    The template's extension picks the format: ``csv`` with a header if the sheet has one, ``json``
    as JSON lines, anything else as text without header. A dataset is computed once; rows are
    counted while they are written, and the folder of an empty one is taken away again.
    """
    if len(datasets) != len(names):
        raise ValueError(f"{len(datasets)} datasets for {len(names)} names")
    if not datasets:
        raise ValueError("nothing to export")
    spark = datasets[0].sparkSession
    rows = []
    for df, name, path in zip(datasets, names, dataset_paths(base, names)):
        sheet = template.sheet(name)
        if map_columns and sheet.column_mapping:
            df = df.withColumnsRenamed(sheet.column_mapping)
        counter = Observation()
        _write(df.observe(counter, F.count(F.lit(1)).alias("n")), path, template, sheet.has_header)
        written = counter.get["n"]
        if not written:
            remove_path(spark, path)
        rows.append((name, path, sheet.sheet_name or name, sheet.title, written, written > 0))
    return spark.createDataFrame(rows, MANIFEST)
