"""Text clean-up expressions: accents, report lines, file paths."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column, functions as F

# Letters without a canonical decomposition that still lose their stroke.
STROKE_LETTERS = {"Đ": "D", "đ": "d"}

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[dict[str, str], dict[str, str], str]:
    """From the Unicode data: one-letter bases, several-letter bases, combining marks."""
    single: dict[str, str] = dict(STROKE_LETTERS)
    several: dict[str, str] = {}
    marks: list[str] = []
    for code in [*range(0x80, 0x2FA20), *range(0xE0100, 0xE01F0)]:
        letter = chr(code)
        if unicodedata.category(letter) == "Mn":
            marks.append(letter)
            continue
        if HANGUL_FIRST <= code <= HANGUL_LAST or not unicodedata.decomposition(letter):
            continue
        base = "".join(
            x for x in unicodedata.normalize("NFD", letter) if unicodedata.category(x) != "Mn"
        )
        if len(base) == 1 and base != letter:
            single[letter] = base
        elif len(base) > 1:
            several[letter] = base
    return single, several, "".join(marks)


def _runs(letters: list[str], gap: int) -> list[list[str]]:
    """Sorted letters in runs whose neighbours lie less than ``gap`` apart; Hangul is a run."""
    runs: list[list[str]] = []
    for letter in letters:
        far = not runs or ord(letter) - ord(runs[-1][-1]) >= gap
        if far and letter != chr(HANGUL_LAST):
            runs.append([letter])
        else:
            runs[-1].append(letter)
    return runs


def _hangul_letters(c: Column) -> Column:
    """Split each Hangul syllable into its letters with the Unicode syllable formula."""

    def utf16(code: Column) -> Column:
        return F.lpad(F.hex(code), 4, "0")

    def split_one(ch: Column) -> Column:
        index = F.conv(F.hex(F.encode(ch, "UTF-16BE")), 16, 10).cast("int") - F.lit(HANGUL_FIRST)
        lead = F.floor(index / 588) + F.lit(0x1100)
        vowel = F.floor(F.pmod(index, F.lit(588)) / 28) + F.lit(0x1161)
        tail = F.pmod(index, F.lit(28))
        letters = F.concat(
            utf16(lead),
            utf16(vowel),
            F.when(tail > 0, utf16(tail + F.lit(0x11A7))).otherwise(F.lit("")),
        )
        return F.when(
            ch.between(chr(HANGUL_FIRST), chr(HANGUL_LAST)),
            F.decode(F.unhex(letters), "UTF-16BE"),
        ).otherwise(ch)

    return F.array_join(F.transform(F.split(c, ""), split_one), "")


def strip_accents(c: Column | str) -> Column:
    """Drop combining marks after canonical decomposition, and turn Đ/đ into D/d.

    Plain ASCII text, found by its byte length, passes untouched. All other letters go through one
    ``translate``, which swaps accented letters and deletes the marks; only text with letters that
    spread into several takes the longer way first.
    """
    c = as_column(c)
    single, several, marks = _accent_tables()

    def swap(text: Column) -> Column:
        return F.translate(text, "".join(single) + marks, "".join(single.values()))

    # The letters that decompose into several, and the Hangul syllables. Few ranges around them are
    # looked for first, since a class of single letters is slow and most text has none of either.
    letters = sorted([*several, chr(HANGUL_FIRST), chr(HANGUL_LAST)])
    near = [f"{run[0]}-{run[-1]}" for run in _runs(letters, 0x1000)]
    spreading = f"[{''.join(several)}{chr(HANGUL_FIRST)}-{chr(HANGUL_LAST)}]"
    spread = reduce(lambda e, kv: F.replace(e, F.lit(kv[0]), F.lit(kv[1])), several.items(), c)
    return (
        F.when(F.octet_length(c) == F.char_length(c), c)
        .when(c.rlike(f"[{''.join(near)}]") & c.rlike(spreading), swap(_hangul_letters(spread)))
        .otherwise(swap(c))
    )


def clean_line(c: Column | str) -> Column:
    """Drop control characters and DEL; tab and line feed stay."""
    return F.regexp_replace(as_column(c), r"[\x00-\x08\x0B-\x1F\x7F]", "")


def normalise_label(c: Column | str) -> Column:
    """Lower-case, dashes and runs of blanks to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(as_column(c)), r"[\s\-]+", " "))


def file_date(c: Column | str) -> Column:
    """Leading eight digits of a file name, else NULL."""
    digits = F.regexp_extract(as_column(c), r"^(\d{8})", 1)
    return F.when(digits != "", digits)


def path_kind(c: Column | str) -> Column:
    """``Full path``, ``Contains folder`` or ``Filename only``."""
    c = as_column(c)
    parts = F.filter(F.split(c, "/"), lambda p: ~p.isin("", "."))
    return (
        F.when(c.startswith("/"), "Full path")
        .when(F.size(parts) > 1, "Contains folder")
        .when(c.isNotNull(), "Filename only")
    )
