"""Number, flag and text conversion with warehouse rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerflow.functions.text import as_column, strip_accents

# Texts read as a flag.
YES_TEXTS = ("1", "yes", "true")
NO_TEXTS = ("0", "no", "false")

# ``\z`` is the very end; ``$`` would let a line feed pass.
DIGITS_ONLY = r"^[0-9]+(\.[0-9]+)?\z"
SIGNED_DIGITS = r"^[+-]?[0-9]+(\.[0-9]+)?\z"

#: From here on a double has no fraction.
WHOLE_DOUBLE = 2.0**53


def must_cast(c: Column, kind: str) -> Column:
    """Cast that stops the job, naming the value, where a value does not fit; NULL stays NULL."""
    out = c.try_cast(kind)
    message = F.concat(F.lit(f"does not fit {kind}: "), c.cast("string"))
    return F.when(c.isNotNull() & out.isNull(), F.raise_error(message).cast(kind)).otherwise(out)


def cut_decimal(c: Column, scale: int) -> Column:
    """Cut a decimal column to ``scale`` places, towards zero; NULL gives 0."""
    zero = F.lit(0).cast(f"decimal(38,{scale})")
    cut = F.when(c < 0, -F.floor(-c, scale)).otherwise(F.floor(c, scale))
    return F.coalesce(must_cast(cut, f"decimal(38,{scale})"), zero)


def truncate_number(
    c: Column | str, scale: int, exact: bool = False, wide: bool = False
) -> Column:
    """Cut to ``scale`` decimals, never round; NULL and NaN give 0.

    With a scale the arithmetic is done in doubles on purpose, so 1.15 becomes 1.14, as in the
    warehouse loads this mirrors. ``exact`` works in decimals instead. Scale 0 gives a whole number
    of 64 bits, or of 38 digits if ``wide``; a number that does not fit stops the job.
    """
    c = as_column(c)
    if scale <= 0:
        kind = "decimal(38,0)" if wide else "bigint"
        zero = F.lit(0).cast(kind)
        blank = c.isNull() | F.isnan(c.cast("double"))
        return F.when(blank, zero).otherwise(must_cast(cut_decimal(c, 0) if exact else c, kind))
    factor = 10**scale
    if exact:
        return cut_decimal(must_cast(c, "decimal(38,18)"), scale)
    number = c.cast("double")
    filled = F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)
    scaled = filled * F.lit(float(factor))
    whole = F.when(F.abs(scaled) < WHOLE_DOUBLE, scaled).try_cast("bigint") / F.lit(float(factor))
    # What is whole after scaling has nothing to cut.
    return F.when(F.abs(scaled) < WHOLE_DOUBLE, whole).otherwise(filled)


def text_to_number(
    c: Column | str, scale: int, signed: bool = False, wide: bool = False
) -> Column:
    """Plain digits with an optional fraction, then cut to ``scale``; anything else gives 0.

    Signs, blanks, exponents, ``.5`` and ``5.`` all count as unreadable unless ``signed`` allows
    a leading sign. At scale 0 the number has 64 bits, or 38 digits if ``wide``; digits that do not
    fit stop the job.
    """
    c = as_column(c)
    readable = c.rlike(SIGNED_DIGITS if signed else DIGITS_ONLY)
    if scale <= 0:
        kind = "decimal(38,0)" if wide else "bigint"
        whole = F.substring_index(F.when(readable, c), ".", 1)
        return F.coalesce(must_cast(whole, kind), F.lit(0).cast(kind))
    return truncate_number(F.when(readable, c.try_cast("double")), scale)


def number_to_text(
    c: Column | str, data_type: T.DataType, max_length: int | None = None
) -> Column:
    """Whole values without ``.0``, others in their shortest form; NULL gives ``''``."""
    c = as_column(c)
    if isinstance(data_type, T.BooleanType):
        text = F.initcap(c.cast("string"))
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = _double_text(c.cast("double"))
    else:
        text = c.cast("string")
    text = F.coalesce(text, F.lit(""))
    return F.substring(text, 1, max_length) if max_length else text


def _double_text(c: Column) -> Column:
    size = F.abs(c)
    whole = F.when(size < 2.0**63, c.try_cast("bigint").cast("string")).otherwise(
        F.format_string("%.0f", c)
    )
    plain = F.regexp_replace(
        c.cast("string").try_cast("decimal(38,21)").cast("string"), "0+$", ""
    )
    tiny = F.regexp_replace(F.lower(c.cast("string")), r"\.0e", "e")
    tiny = F.regexp_replace(tiny, r"e-([0-9])$", "e-0$1")
    return (
        F.when(F.isnan(c), F.lit(""))
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when(c == F.rint(c), whole)
        # Between these bounds the cast writes no exponent.
        .when(size.between(1e-3, 9999999.0), c.cast("string"))
        .when(size < 1e-4, tiny)
        .otherwise(plain)
    )


def text_to_text(c: Column | str, max_length: int | None = None) -> Column:
    """Accents off, then cut to length. Case is left alone."""
    text = strip_accents(c)
    return F.substring(text, 1, max_length) if max_length else text


def timestamp_to_text(c: Column | str, max_length: int | None = None) -> Column:
    text = F.date_format(as_column(c), "yyyyMMddHHmmss")
    return F.substring(text, 1, max_length) if max_length else text


def flag_to_number(c: Column | str) -> Column:
    """``1/yes/true`` to 1, ``0/no/false`` and NULL to 0; other whole numbers stay, the rest NULL."""
    text = F.lower(as_column(c).cast("string"))
    return (
        F.when(text.isNull() | text.isin(*NO_TEXTS), F.lit(0).cast("bigint"))
        .when(text.isin(*YES_TEXTS), F.lit(1).cast("bigint"))
        .when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("bigint"))
    )


def flag_to_text(c: Column | str) -> Column:
    """``True`` or ``False``."""
    return F.initcap(as_column(c).cast("string"))


def clamp(
    c: Column | str, data_type: T.DataType, highest: float, lowest: float | None = None
) -> Column:
    """Hold a number inside ``[lowest, highest]``; text that is no number stays as it is."""
    c = as_column(c)
    is_text = isinstance(data_type, T.StringType)
    number = c.try_cast("double") if is_text else c

    def edge(value: float) -> Column:
        return F.lit(str(value)) if is_text else F.lit(value)

    out = F.when(number > highest, edge(highest))
    if lowest is not None:
        out = out.when(number < lowest, edge(lowest))
    return out.otherwise(c)


def decimal_to_text(c: Column | str) -> Column:
    return as_column(c).cast("string")
