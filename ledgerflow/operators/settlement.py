"""Card-settlement text reports to a table.

A report is a text file of pages. ``TCR 0`` opens a record, the lines up to the next ``TCR 0``
belong to it, and each holds a label and a value, two or more blanks apart. Dates of the page
heading hold for the records below it. Files are read in blocks (see ``sources.lines``), so one
very large report is shared out over many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerflow.functions.dates import date_from_page_header, timestamp_from_text
from ledgerflow.functions.text import clean_line, file_date, normalise_label
from ledgerflow.session import stage
from ledgerflow.sources.lines import BLOCK, FILE, VALUE, read_lines

# The columns of the report table, in order.
REPORT_HEADER = (
    "Record Date",
    "CPD",
    "System Date",
    "Destination Identifier",
    "Source Identifier",
    "Record Identifier",
    "Originator Recipient indi",
    "Tran Code of financial tr",
    "TCQ of financial tran",
    "Central Processing Date",
    "Transaction ID",
    "Account Number",
    "Account Number Extension",
    "Acquirer Reference Number",
    "Card Acceptor ID",
    "Terminal ID",
    "Source Amount",
    "Source Currency Code",
    "Settlement Flag",
    "Settlement Service ID",
    "Settlement Currency",
    "Leaf Level SRE-ID",
    "Funds Transfer SRE-ID",
    "Settlement amount - Inter",
    "Settlement amount Sign",
    "Usage Code",
    "Reclassification Indicato",
    "Requested Payment Service",
    "Product Id",
    "Account Funding Source",
    "Interchange Fee Amount",
    "Interchange Fee Sign",
    "Merchant Verification Val",
    "Fee Program Indicator",
    "Fee Descriptor",
    "Conversion Date",
    "Settlement Date",
    "BII Unique File ID",
    "PFX Applied Indicator",
    "Rate Table ID",
    "Additional Token Response",
    "Agreement ID",
    "Enabler Verification Val",
    "VMID",
    "Merchant Name",
    "Issuer Charge",
    "Merchant Category Code",
    "Purchase Date",
    "Reimbursement Attribute",
    "IAF Charge IND Type",
    "Applied Special Service",
)
# Signed, zero-padded number columns.
AMOUNT_COLUMNS = ("Source Amount", "Settlement amount - Inter", "Interchange Fee Amount")

RECORD_START = r"^TCR\s+0\b"
SYSTEM_DATE = r"SYSTEM DATE\s+(\d{2}/\d{2}/\d{2})"
PROCESSING_DATE = r"\bCPD\s+(\d{2}/\d{2}/\d{2})"
GAP = r"\s{2,}"


def _plain(label: str) -> str:
    return re.sub(r"[\s\-]+", " ", label.lower()).strip()


#: Letters of a header that was cut to fit its column.
CUT_AT = max(map(len, REPORT_HEADER))
#: Letters that the cut last word of a label must have at least.
CUT_WORD = 3


def label_prefixes() -> dict[str, str]:
    """Every accepted beginning of a label with the shortest header it could mean.

    A beginning is one or more whole words of the header, or whole words and at least ``CUT_WORD``
    letters of the next. Single letters and cut first words stand for nothing.
    """
    found: dict[str, str] = {}
    for header in sorted(REPORT_HEADER, key=len):
        plain = _plain(header)
        for end in range(1, len(plain) + 1):
            head, _, last = plain[:end].rpartition(" ")
            whole = end == len(plain) or plain[end] == " "
            if last and (whole or (head and len(last) >= CUT_WORD)):
                found.setdefault(plain[:end], header)
    for header in REPORT_HEADER:
        found[_plain(header)] = header
    return found


def _lookup_text(label: str) -> Column:
    """A label as it is looked up: one that goes on where a cut header ends is cut as well."""
    return F.rtrim(F.substring(normalise_label(label), 1, CUT_AT))


def _known_labels(df: DataFrame, into: str) -> DataFrame:
    return df.sparkSession.createDataFrame(list(label_prefixes().items()), f"_plain string, {into} string")


def map_labels(df: DataFrame, label: str, into: str = "header") -> DataFrame:
    """Header of each label: the exact one, else the shortest that begins with it; others go.

    The lookup holds the beginnings of 51 fixed names, so it is always small enough to broadcast.
    """
    lookup = F.broadcast(_known_labels(df, into))
    return df.join(lookup, _lookup_text(label) == F.col("_plain")).drop("_plain")


def unmapped_labels(df: DataFrame, label: str) -> DataFrame:
    """Labels that no header begins with, and how often they occur."""
    lookup = F.broadcast(_known_labels(df, "_header"))
    left = df.join(lookup, _lookup_text(label) == F.col("_plain"), "left_anti")
    return left.groupBy(label).agg(F.count(F.lit(1)).alias("lines"))


#: What a row of ``scan_records`` is: a record that ends in its block, lines that go on with the last
#: record of an earlier block, a record still open at the end of its block, and a block's own facts.
WHOLE, HEAD, OPEN, FACTS = range(4)
KIND, NAME, SYSTEM, CPD, VALUES = "kind", "name", "page_system", "page_cpd", "values"
SCANNED = (
    f"{FILE} string, {BLOCK} long, {KIND} int, {NAME} string, {SYSTEM} string, {CPD} string, "
    f"{VALUES} array<string>"
)


def split_lines(lines: DataFrame, name: Column) -> DataFrame:
    """Lines with what a report needs of them: record starts, page dates, looked-up label and value.

    Lines that are none of these stay, since a block without any record is a block, too.
    """
    text = F.col("text")

    def dated(word: str, pattern: str) -> Column:
        return F.when(text.contains(word), F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")))

    pair = F.split(text, GAP, 2)
    starts = text.startswith("TCR") & text.rlike(RECORD_START)
    parts = lines.select(FILE, BLOCK, name.alias(NAME), F.trim(clean_line(VALUE)).alias("text")).select(
        FILE, BLOCK, NAME, starts.alias("starts"), dated("SYSTEM DATE", SYSTEM_DATE).alias(SYSTEM),
        dated("CPD", PROCESSING_DATE).alias(CPD), F.when(~starts, pair).alias("pair"),
    )
    paired = F.size("pair") == 2
    return parts.select(
        FILE, BLOCK, NAME, "starts", SYSTEM, CPD,
        F.when(paired, _lookup_text(F.get("pair", F.lit(0)))).alias("label"),
        F.when(paired, F.trim(F.get("pair", F.lit(1)))).alias("value"),
    )


def scan_records(lines: DataFrame) -> DataFrame:
    """Records of each block of lines, in one narrow pass, see SCANNED.

    ``lines`` come from ``split_lines``, in the order of the file. A record's first value per header
    is kept by the header's place. Page dates are those in force where a record starts, as far as the
    block tells. Per block there are at most one HEAD and one OPEN row, and a FACTS row with the last
    page dates, which says whether a record starts in the block (one value) or not (none).
    """
    labels = label_prefixes()
    places = {h: k for k, h in enumerate(REPORT_HEADER)}
    width = len(REPORT_HEADER)

    # Everything the tasks run is nested here, so executors need no copy of this package.
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beginnings = pa.array(list(labels))
        place_of = np.array([places[h] for h in labels.values()] + [-1])
        schema = pa.schema(
            [(FILE, pa.string()), (BLOCK, pa.int64()), (KIND, pa.int32()), (NAME, pa.string()),
             (SYSTEM, pa.string()), (CPD, pa.string()), (VALUES, pa.list_(pa.string()))]
        )
        rows: list[tuple] = []
        # The unit of lines at hand: file, block, kind, name, page dates, values by header.
        unit: list | None = None
        dates: list[str | None] = [None, None]
        any_start = False

        def close(block_ends: bool) -> None:
            nonlocal unit, dates, any_start
            if unit is not None and (unit[2] != HEAD or any(v is not None for v in unit[6])):
                if unit[2] == OPEN and not block_ends:
                    unit[2] = WHOLE
                rows.append(tuple(unit))
            if block_ends and unit is not None:
                rows.append((*unit[:2], FACTS, unit[3], *dates, ["starts"] if any_start else []))
                dates, any_start = [None, None], False
            unit = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            file, block = batch.column(FILE), batch.column(BLOCK).to_numpy(zero_copy_only=False)
            codes = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            starts = batch.column("starts").to_numpy(zero_copy_only=False).astype(bool)
            new_block = np.zeros(size, bool)
            new_block[1:] = (codes[1:] != codes[:-1]) | (block[1:] != block[:-1])
            new_block[0] = unit is None or (file[0].as_py(), int(block[0])) != tuple(unit[:2])
            # Only lines that open a unit, hold a value or a date are looked at one by one.
            found = pc.index_in(batch.column("label"), beginnings)
            place = place_of[pc.fill_null(found, len(beginnings)).to_numpy(zero_copy_only=False)]
            dated = np.zeros(size, bool)
            for column in (SYSTEM, CPD):
                dated |= batch.column(column).is_valid().to_numpy(zero_copy_only=False)
            chosen = np.flatnonzero(new_block | starts | dated | (place >= 0))
            some = batch.take(pa.array(chosen))
            values, system, cpd = (some.column(c).to_pylist() for c in ("value", SYSTEM, CPD))
            for k, at in enumerate(chosen.tolist()):
                if new_block[at]:
                    close(True)
                    unit = [file[at].as_py(), int(block[at]), HEAD, batch.column(NAME)[at].as_py(),
                            None, None, [None] * width]
                if dated[at]:
                    dates = [system[k] or dates[0], cpd[k] or dates[1]]
                if starts[at]:
                    kept = unit[:2], unit[3]
                    close(False)
                    any_start = True
                    unit = [*kept[0], OPEN, kept[1], *dates, [None] * width]
                elif place[at] >= 0 and unit[6][place[at]] is None:
                    unit[6][place[at]] = values[k]
            if len(rows) >= 2000:
                yield flush()
        close(True)
        if rows:
            yield flush()

    return lines.mapInArrow(scan, SCANNED)


def stitch_records(scanned: DataFrame) -> DataFrame:
    """Whole records (``name``, page dates, ``values``) of scanned blocks.

    A record within one block is whole already. What an open record left in later blocks comes back
    to it in one exchange, combined by header before it moves, so neither a record over very many
    blocks nor a file of very many records meets in one task. One small row per block carries page
    dates and the block of the last record start on to the blocks below.
    """
    facts = scanned.where(F.col(KIND) == FACTS)
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)

    def last(value: Column) -> Column:
        return F.last(value, ignorenulls=True).over(before)

    carried = facts.select(
        FILE, BLOCK,
        last(F.when(F.size(VALUES) > 0, F.col(BLOCK))).alias("_opener"),
        last(F.col(SYSTEM)).alias("_system"), last(F.col(CPD)).alias("_cpd"),
    )
    # Staged, so the optimizer knows their size and broadcasts them where that is small enough.
    joined = scanned.where(F.col(KIND) < FACTS).join(stage(carried, "blocks"), [FILE, BLOCK], "left")
    joined = joined.withColumns(
        {SYSTEM: F.coalesce(SYSTEM, "_system"), CPD: F.coalesce(CPD, "_cpd")}
    )
    whole = joined.where(F.col(KIND) == WHOLE).select(NAME, SYSTEM, CPD, VALUES)
    is_open = F.col(KIND) == OPEN
    parts = joined.where(F.col(KIND).isin(HEAD, OPEN)).withColumn(
        "_opener", F.when(is_open, F.col(BLOCK)).otherwise(F.col("_opener"))
    )

    def first(k: int) -> Column:
        value = F.get(F.col(VALUES), F.lit(k))
        return F.min_by(value, F.when(value.isNotNull(), F.col(BLOCK)))

    merged = parts.where(F.col("_opener").isNotNull()).groupBy(FILE, "_opener").agg(
        *[F.max(F.when(is_open, F.col(c))).alias(c) for c in (NAME, SYSTEM, CPD)],
        F.array(*[first(k) for k in range(len(REPORT_HEADER))]).alias(VALUES),
    )
    return whole.unionByName(merged.select(NAME, SYSTEM, CPD, VALUES))


def parse_reports(lines: DataFrame, name: Column) -> DataFrame:
    """One row per record with the 51 report columns.

    The first value of a label wins. Lines above the first record of a file belong to none. A record
    is put together where its block is read; only records across block borders are exchanged.
    Identifiers stay text; the amounts are whole decimals, Purchase Date is a timestamp, Record Date
    comes from the report's name.
    """
    records = stitch_records(stage(scan_records(split_lines(lines, name)), "records"))

    def column(header: str) -> Column:
        value = F.get(F.col(VALUES), F.lit(REPORT_HEADER.index(header)))
        if header == "Record Date":
            value = file_date(NAME)
        elif header in AMOUNT_COLUMNS:
            value = value.try_cast("decimal(38,0)")
        elif header == "Purchase Date":
            value = timestamp_from_text(value)
        elif header == "System Date":
            value = F.coalesce(value, _page_date(F.col(SYSTEM)))
        elif header == "CPD":
            value = F.coalesce(value, _page_date(F.col(CPD)))
        return value.alias(header)

    return records.select(*[column(h) for h in REPORT_HEADER])


def _page_date(text: Column) -> Column:
    """``yyyyMMdd`` of a page date; month first, year first where that is no date."""
    turned = F.regexp_replace(text, r"^(\d{2})/(\d{2})/(\d{2})$", "$2/$3/$1")
    return F.date_format(
        F.coalesce(date_from_page_header(text), date_from_page_header(turned)), "yyyyMMdd"
    )


def table_column(header: str) -> str:
    """Table name of a report column: upper-case, anything else to one underscore."""
    return re.sub(r"[^A-Z0-9]+", "_", header.upper()).strip("_")


def to_report_table(records: DataFrame) -> DataFrame:
    return records.toDF(*[table_column(c) for c in records.columns])


def read_reports(
    spark: SparkSession, path: str | list[str], name_column: str | None = None
) -> DataFrame:
    """Parse all reports under a path.

    A report is named by its file, or by a folder column (``report=20250131_X.TXT/part-...``), the
    form in which Spark writes one.
    """
    lines = read_lines(spark, path)
    own_name = F.element_at(F.split(FILE, "/"), -1)
    return parse_reports(lines, F.col(name_column) if name_column else own_name)
