"""Template-driven import of delimited text, over any number of files at once."""

from __future__ import annotations

import codecs
import csv
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.session import stage
from ledgerflow.sources.lines import (
    BLOCK,
    FILE,
    LINE,
    VALUE,
    carry_over_blocks,
    read_lines,
    scan_blocks,
)
from ledgerflow.templates import ImportTemplate, resolve_names

LATIN = "ISO-8859-1"
UTF8_NAMES = ("UTF-8", "UTF8", "UTF_8", "ASCII", "US-ASCII", "UTF-8-SIG")
LATIN_NAMES = ("ISO-8859-1", "ISO8859-1", "LATIN-1", "LATIN1")

# Cell texts that stand for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

FILLED = "_filled"


@dataclass(frozen=True)
class CodePage:
    """A single-byte encoding, as it differs from Latin-1: the letters ``read`` there are ``meant``
    otherwise, and those in ``without`` stand for bytes that it has no letter for."""

    read: str
    meant: str
    without: str

    def decode(self, latin: Column) -> Column:
        return F.translate(latin, self.read, self.meant) if self.read else latin


@lru_cache(maxsize=32)
def code_page(encoding: str) -> CodePage:
    """From the codec's own table; encodings of several bytes a letter, or with another ASCII half,
    are refused."""
    try:
        codec = codecs.lookup(encoding)
        letters = [codec.decode(bytes([k]), "ignore")[0] for k in range(256)]
        # No byte begins a letter of two.
        single = all(
            codec.decode(bytes([a, b]), "ignore")[0] == letters[a] + letters[b]
            for a in range(128, 256) for b in range(256)
        )
    except (LookupError, UnicodeError, ValueError, TypeError):
        letters, single = [], False
    if not single or letters[:128] != [chr(k) for k in range(128)]:
        raise ValueError(f"encoding {encoding} is not supported; convert the files to UTF-8")
    moved = [k for k in range(128, 256) if letters[k] and letters[k] != chr(k)]
    return CodePage(
        "".join(map(chr, moved)), "".join(letters[k] for k in moved),
        "".join(chr(k) for k in range(128, 256) if not letters[k]),
    )


def known_encoding(encoding: str | None) -> str | None:
    """The encoding to decode with, None for UTF-8 or none; unknown ones are refused at plan time."""
    if not encoding or encoding.upper() in UTF8_NAMES:
        return None
    if encoding.upper() in LATIN_NAMES:
        return LATIN
    code_page(encoding)
    return codecs.lookup(encoding).name


def decode_lines(rows: DataFrame, lines: DataFrame, encoding: str | None) -> DataFrame:
    """Decode per file: the configured encoding if it has a letter for every byte of the file, else
    UTF-8 when the whole file is that, else Latin-1.

    Latin-1 takes any byte, so no further encoding is ever reached, and a code page with a letter for
    every byte needs no look at the file. ``lines`` holds the whole files that ``rows`` come from;
    they are checked in one pass, and the few files that go another way are staged, so that the join
    back is planned by their real size.
    """
    named = known_encoding(encoding)
    latin = F.decode(F.col(VALUE).cast("binary"), LATIN)
    page = None if named is None else CodePage("", "", "") if named == LATIN else code_page(named)
    if page is not None and not page.without:
        return rows.withColumn(VALUE, page.decode(latin))
    utf8 = F.bool_and(F.is_valid_utf8(VALUE)).alias("_utf8")
    if page is None:
        fits, first = F.col("_utf8"), F.col(VALUE)
        verdict = lines.groupBy(FILE).agg(utf8)
    else:
        fits, first = F.col("_page"), page.decode(latin)
        whole = F.bool_and(~latin.rlike(f"[{page.without}]")).alias("_page")
        verdict = lines.groupBy(FILE).agg(utf8, whole)
    other = verdict.filter(~fits).select(FILE, F.col("_utf8").alias("_as_utf8"))
    joined = rows.join(stage(other, "encodings"), FILE, "left")
    decoded = F.when(F.col("_as_utf8"), F.col(VALUE)).when(~F.col("_as_utf8"), latin).otherwise(first)
    return joined.withColumn(VALUE, decoded).drop("_as_utf8")


def _is_filled(template: ImportTemplate) -> Column:
    """Whether a line holds anything; under sheet rules a row of empty cells is empty as well."""
    blanks = " " if template.separator == "\t" else " \t"
    filled = F.btrim(F.col(VALUE), F.lit(blanks + "\r")) != ""
    if not template.sheet_rules:
        return filled
    cells = F.replace(F.col(VALUE), F.lit(template.separator), F.lit(""))
    return filled & (F.replace(cells, F.lit('"'), F.lit("")) != "")


def window_rows(lines: DataFrame, template: ImportTemplate) -> DataFrame:
    """Lines of the template's row window, with their numbers where those were needed.

    A start row alone is settled inside the first block of each file. An end row, or reading up to
    the first empty row, needs numbers along the whole file and stages the lines once.
    """
    marked = lines.withColumn(FILLED, _is_filled(template))
    stop_at_empty = template.sheet_rules and template.read_to_empty_row
    if template.max_rows is None and not stop_at_empty:
        if template.skip_rows == 0:
            return marked.filter(FILLED).drop(FILLED)
        scanned = scan_blocks(marked)
        heading = (F.col(BLOCK) == 0) & (F.col(LINE) <= template.skip_rows)
        return scanned.filter(~heading & F.col(FILLED)).drop(FILLED)

    scanned = scan_blocks(marked, counts={"_nth": FILLED})
    numbered = carry_over_blocks(scanned, [LINE, "_nth"])
    body = numbered.filter(F.col(LINE) > template.skip_rows)
    if template.max_rows is not None and template.sheet_rules:
        body = body.filter(F.col(LINE) <= template.end_row)
    elif template.max_rows is not None:
        # Blank lines do not count as rows, so the heading's own filled lines are taken off.
        heading = (
            numbered.filter(F.col(LINE) <= template.skip_rows)
            .groupBy(FILE)
            .agg(F.max("_nth").alias("_above"))
        )
        above = F.coalesce(F.col("_above"), F.lit(0))
        body = body.join(stage(heading, "headings"), FILE, "left").filter(
            F.col("_nth") - above <= template.max_rows
        )
    if stop_at_empty:
        end = body.filter(~F.col(FILLED)).groupBy(FILE).agg(F.min(LINE).alias("_end"))
        body = body.join(stage(end, "ends"), FILE, "left").filter(
            F.col("_end").isNull() | (F.col(LINE) < F.col("_end"))
        )
    return body.filter(FILLED).select(*lines.columns, LINE)


#: Columns of the width table of headerless files.
WIDTH, GOES_ON = "_width", "_goes_on"


def first_rows(rows: DataFrame, template: ImportTemplate) -> DataFrame:
    """Per file the cells that its first row says to take, and whether rows may go on beyond them.

    As many as the first row holds; under sheet rules its first empty cell ends the data. One narrow
    pass gives the first row of each block, and the first block of a file decides, so what is brought
    together is one row per block. Rows without numbers must still be in the order of the files.
    """
    separator, skip, sheet = template.separator, template.first_col, template.sheet_rules

    # Everything the tasks run is nested here, so executors need no copy of this package.
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block, value, line = (batch.column(k) for k in range(4))
            codes = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            place = block.to_numpy(zero_copy_only=False)
            fresh = np.ones(batch.num_rows, bool)
            fresh[1:] = (codes[1:] != codes[:-1]) | (place[1:] != place[:-1])
            fresh[0] = (file[0].as_py(), int(place[0])) != here
            here = (file[-1].as_py(), int(place[-1]))
            found = []
            for k in np.flatnonzero(fresh).tolist():
                # Bytes that are no UTF-8 are no separator either.
                text = bytes(value[k].as_py()).decode("utf-8", "replace")
                if len(separator) > 1:
                    cells = text.split(separator)[skip:]
                else:
                    cells = next(csv.reader([text], delimiter=separator))[skip:]
                ends = sheet and "" in cells
                width = cells.index("") if ends else len(cells)
                found.append((file[k].as_py(), int(place[k]), line[k].as_py(), width, ends))
            if found:
                columns = [pa.array(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, names=[FILE, BLOCK, LINE, WIDTH, GOES_ON])

    line = F.col(LINE) if LINE in rows.columns else F.lit(0).cast("long").alias(LINE)
    blocks = rows.select(FILE, BLOCK, F.col(VALUE).cast("binary").alias(VALUE), line).mapInArrow(
        scan, f"{FILE} string, {BLOCK} long, {LINE} long, {WIDTH} long, {GOES_ON} boolean"
    )
    first = F.min(F.struct(BLOCK, LINE, WIDTH, GOES_ON)).alias("first")
    return blocks.groupBy(FILE).agg(first).select(FILE, f"first.{WIDTH}", f"first.{GOES_ON}")


def open_quote(separator: str) -> Column:
    """Whether a line ends inside a quoted cell, so that the cell goes on in the next line.

    An odd number of quotes is needed for that, which spares nearly all lines the pattern; a quote
    within an unquoted cell is a letter like any other.
    """
    sep = re.escape(separator)
    closed = f'"(?:[^"]++|"")*+"(?!")(?:(?!{sep}).)*+'
    plain = f'(?!")(?:(?!{sep}).)*+'
    pattern = f'(?s)^(?:(?:{closed}|{plain}){sep})*+"(?:[^"]++|"")*+$'
    quotes = F.length(VALUE) - F.length(F.replace(F.col(VALUE), F.lit('"'), F.lit("")))
    return F.col(VALUE).contains('"') & (quotes % 2 == 1) & F.col(VALUE).rlike(pattern)


def import_delimited(
    spark: SparkSession,
    paths: str | list[str],
    template: ImportTemplate,
    strict: bool | None = None,
    file_column: str | None = None,
    detect_encoding: bool = True,
) -> DataFrame:
    """Read text files into upper-cased, mapped text columns.

    Row and column windows, header fit and per-file encoding follow the template. The columns end at
    the end column, else with the header names; without both, each file's own first row says how many
    cells it has, and the widest file how many columns come out. ``strict`` (the default without
    sheet rules) stops the job at a row with more cells than there are columns; otherwise the surplus
    is cut, if a header, or an empty cell of the file's first row, says where. ``detect_encoding=False``
    takes UTF-8 on trust and so saves the pass that checks it. Missing cells are NULL. Values stay
    text, so leading zeros survive. A line break inside quotes stops the job. A missing path raises.
    """
    strict = not template.sheet_rules if strict is None else strict
    lines = read_lines(spark, paths)
    rows = window_rows(lines, template)
    per_file = template.end_col <= 0 and not template.header
    if per_file:
        widths = stage(first_rows(rows, template), "widths")
        width = widths.agg(F.max(WIDTH)).first()[0] or 0
        # Staged, so the optimizer knows their size and broadcasts them where that is small enough.
        rows = rows.join(widths, FILE, "left")
    else:
        width = template.end_col - template.first_col if template.end_col > 0 else len(template.header)
    if detect_encoding or known_encoding(template.encoding):
        rows = decode_lines(rows, lines, template.encoding)

    end = template.first_col + width
    names = resolve_names(template.header, template.column_mapping)
    if not names:
        names = [f"C{i}" for i in range(template.first_col + 1, end + 1)]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"Duplicate column detected: {repeated}")
    if strict and len(names) != width:
        raise ValueError(f"{len(names)} header names for {width} columns")

    cells = [f"c{i}" for i in range(end)]
    schema = ", ".join(f"{c} string" for c in [*cells, "surplus"])
    options = {"sep": template.separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    parsed = rows.select("*", F.from_csv(VALUE, schema, options).alias("row"))

    # Headerless data that goes on beyond its own file's width is never cut in silence, whatever the
    # rules.
    too_wide = F.col("row.surplus").isNotNull()
    allowed = F.lit(end)
    if per_file:
        allowed = F.col(WIDTH) + template.first_col
        beyond = [F.col(f"row.c{k}").isNotNull() & (allowed <= k) for k in range(template.first_col, end)]
        too_wide = ~F.col(GOES_ON) & functools.reduce(lambda a, b: a | b, beyond, too_wide)
    where = F.concat(F.lit("in "), F.col(FILE), F.lit(": "), F.col(VALUE))
    breaks = F.concat(F.lit("a line break inside quotes "), where)
    fault = F.when(open_quote(template.separator), F.raise_error(breaks).cast("string"))
    if per_file or (strict and template.end_col <= 0):
        message = F.concat(F.lit("more than "), allowed.cast("string"), F.lit(" cells "), where)
        fault = fault.when(too_wide, F.raise_error(message).cast("string"))
    # The checks ride on every cell, so they run whichever columns are read, and the line is parsed
    # only once.
    parsed = parsed.withColumn("_fault", fault)
    missing = MISSING_TEXTS if template.missing_texts else ("",)

    def cell(i: int) -> Column:
        value = F.col(f"row.c{i}")
        kept = ~value.isin(*missing)
        if per_file:
            kept = kept & (allowed > i)
        # The fault is NULL, or stops the job.
        return F.when(F.col("_fault").isNotNull(), F.col("_fault")).when(kept, value)

    # Header names beyond the data come out as NULL columns; cells beyond the header are cut.
    out = [
        cell(i).alias(name) if i < end else F.lit(None).cast("string").alias(name)
        for i, name in enumerate(names, start=template.first_col)
    ]
    if file_column:
        out.append(F.col(FILE).alias(file_column))
    return parsed.select(*out)


def source_files(spark: SparkSession, paths: str | list[str], file_column: str) -> DataFrame:
    """Every file below the paths, named as an import names it; the content is not read."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col("_metadata.file_path").alias(file_column))


def import_summary(
    imported: DataFrame, file_column: str, files: DataFrame | None = None
) -> DataFrame:
    """Rows, columns and column types per file.

    With ``files`` (see ``source_files``) a file without data rows has its line, too, with 0 rows.
    """
    data = [field for field in imported.schema.fields if field.name != file_column]
    types = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in data)
    counted = imported.groupBy(file_column).agg(F.count(F.lit(1)).alias("row_count"))
    if files is not None:
        counted = files.select(file_column).distinct().join(counted, file_column, "left")
    return counted.select(
        file_column, F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.lit(len(data)).alias("column_count"), F.lit(types).alias("column_types"),
    )


SLOT = re.compile(r"^FIELD_\d+_(\d+)$", re.IGNORECASE)


def fit_staging_slots(df: DataFrame) -> DataFrame:
    """Cut the columns of a generic staging table (``Field_02_15``) to the width in their name."""
    widths = {c: int(m.group(1)) for c in df.columns if (m := SLOT.match(c))}
    return df.withColumns({c: F.substring(c, 1, w) for c, w in widths.items()})
