"""Import and export templates: plain settings that drive the operators at plan time."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

log = logging.getLogger(__name__)

# Texts that switch a template flag on.
IMPORT_FLAG_TEXTS = ("true", "1", "yes")
EXPORT_FLAG_TEXTS = ("true", "1", "yes", "y")

FULL, INCREMENTAL = "Full", "Incremental"
DEFAULT_TEMPLATE = "DEFAULT"


def read_flag(value: Any, texts: tuple[str, ...]) -> bool:
    return value.lower() in texts if isinstance(value, str) else bool(value)


def resolve_names(header: Sequence[str], mapping: dict[str, str], loose: bool = False) -> list[str]:
    """Final column names of a whole header, in upper case.

    A name that the map holds gives its target. ``loose`` compares names trimmed and in any case and
    takes a map of any length; otherwise names must be equal, and a map that is not as long as the
    header is left out altogether, and told.
    """
    if mapping and not loose and len(mapping) != len(header):
        strangers = ", ".join(sorted(set(header).difference(mapping)))
        log.warning("map of %d names left out for a header of %d: %s", len(mapping), len(header), strangers)
        mapping = {}

    def form(name: str) -> str:
        return name.strip().upper() if loose else name

    final = dict(zip(map(form, mapping), mapping.values()))
    return [form(str(final.get(form(name), name))).upper() for name in header]


@dataclass(frozen=True)
class LoadSettings:
    """How imported rows reach their target."""

    load_type: str = FULL
    target_table: str | None = None
    key_columns: tuple[str, ...] = ()
    where: str | None = None

    @property
    def incremental(self) -> bool:
        return self.load_type == INCREMENTAL and bool(self.key_columns)


@dataclass(frozen=True)
class ImportTemplate:
    """Window, header and target of a delimited import.

    ``sheet_rules`` reads the file the way a spreadsheet export is read: blank rows end or leave
    the data, the start column counts even without an end column, and the header is fitted to the
    width of the data. ``missing_texts=False`` keeps texts such as ``NA`` or ``None`` as they are;
    only empty cells are missing then.
    """

    table_name: str
    header: tuple[str, ...] = ()
    column_mapping: dict[str, str] = field(default_factory=dict)
    separator: str = "|"
    encoding: str | None = None
    start_row: int = 2
    end_row: int = 0
    start_col: int = 1
    end_col: int = 0
    sheet_rules: bool = False
    read_to_empty_row: bool = False
    truncate_first: bool = False
    missing_texts: bool = True
    load: LoadSettings = LoadSettings()

    @classmethod
    def from_dict(cls, settings: dict[str, Any]) -> ImportTemplate:
        values = dict(settings)
        for name in ("sheet_rules", "read_to_empty_row", "truncate_first", "missing_texts"):
            if name in values:
                values[name] = read_flag(values[name], IMPORT_FLAG_TEXTS)
        if "load" in values and isinstance(values["load"], dict):
            load = dict(values["load"])
            load["key_columns"] = tuple(load.get("key_columns") or ())
            values["load"] = LoadSettings(**load)
        values["header"] = tuple(values.get("header") or ())
        values["column_mapping"] = dict(values.get("column_mapping") or {})
        for name in ("end_row", "end_col"):
            values[name] = values.get(name) or 0
        return cls(**values)

    @property
    def skip_rows(self) -> int:
        return max(self.start_row - 1, 0)

    @property
    def max_rows(self) -> int | None:
        """Data rows to read, or None for all."""
        return self.end_row - self.start_row + 1 if self.end_row > 0 else None

    @property
    def first_col(self) -> int:
        return max(self.start_col - 1, 0)


@dataclass(frozen=True)
class SheetTemplate:
    has_header: bool = True
    title: str = ""
    sheet_name: str | None = None
    column_mapping: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ExportTemplate:
    extension: str = "csv"
    separator: str = "|"
    sheets: dict[str, SheetTemplate] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, settings: dict[str, Any]) -> ExportTemplate:
        values = dict(settings)
        sheets = {}
        for key, sheet in (values.get("sheets") or {}).items():
            sheet = dict(sheet)
            if "has_header" in sheet:
                sheet["has_header"] = read_flag(sheet["has_header"], EXPORT_FLAG_TEXTS)
            sheet["column_mapping"] = dict(sheet.get("column_mapping") or {})
            sheets[key] = SheetTemplate(**sheet)
        values["sheets"] = sheets
        return cls(**values)

    def sheet(self, key: str) -> SheetTemplate:
        return self.sheets.get(key, SheetTemplate())


def pick_template(templates: dict[str, ExportTemplate], key: str | None) -> ExportTemplate:
    """The named template, or the default one."""
    return templates.get(key or DEFAULT_TEMPLATE) or templates[DEFAULT_TEMPLATE]
