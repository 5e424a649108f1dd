"""Hashes, keyed tokens, encryption and column codecs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerflow.functions.dates import timestamp_from_log
from ledgerflow.functions.text import as_column, path_kind

HMAC_BLOCK = 64
IV_BYTES = 16

# Texts that mean yes.
TRUE_TEXTS = ("true", "1", "t", "y", "yes")


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(as_column(c).cast("string"), 256)


def key_hash(*columns: Column | str, separator: str = "_", null_marker: str | None = None) -> Column:
    """SHA-256 over the joined columns.

    NULL parts are skipped, so (NULL, 'x') and ('x', NULL) share a key; ``null_marker`` keeps them
    apart.
    """
    parts = [as_column(c).cast("string") for c in columns]
    if null_marker is not None:
        parts = [F.coalesce(p, F.lit(null_marker)) for p in parts]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def hmac_pads(secret: bytes) -> tuple[bytes, bytes]:
    """Inner and outer pad of HMAC-SHA256 for one secret."""
    import hashlib

    key = hashlib.sha256(secret).digest() if len(secret) > HMAC_BLOCK else secret
    key = key.ljust(HMAC_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256_hex(c: Column | str, secret: bytes) -> Column:
    """Keyed token: the same value and secret give the same token."""
    inner_pad, outer_pad = hmac_pads(secret)
    value = F.encode(as_column(c).cast("string"), "UTF-8")
    inner = F.unhex(F.sha2(F.concat(F.lit(inner_pad), value), 256))
    return F.sha2(F.concat(F.lit(outer_pad), inner), 256)


def aes_encrypt_text(
    c: Column | str, key: Column | bytes, iv: Column | bytes, keep_iv: bool = False
) -> Column:
    """AES-CBC with PKCS padding, text in and base64 out.

    The vector is stored apart from the cipher text unless ``keep_iv`` puts it in front.
    """
    sealed = F.aes_encrypt(
        F.encode(as_column(c), "UTF-8"), _bytes(key), F.lit("CBC"), F.lit("PKCS"), _bytes(iv)
    )
    return _one_line_base64(sealed if keep_iv else F.substring(sealed, IV_BYTES + 1, 2**31 - 1))


def aes_decrypt_text(
    c: Column | str,
    key: Column | bytes,
    iv: Column | bytes | None = None,
    bad_rows_to_null: bool = False,
) -> Column:
    """Back from base64; give ``iv`` when it was stored apart."""
    sealed = F.unbase64(as_column(c))
    if iv is not None:
        sealed = F.concat(_bytes(iv), sealed)
    decrypt = F.try_aes_decrypt if bad_rows_to_null else F.aes_decrypt
    return F.decode(decrypt(sealed, _bytes(key), F.lit("CBC"), F.lit("PKCS")), "UTF-8")


def _one_line_base64(c: Column) -> Column:
    """Some session settings break base64 into lines; take the breaks out again."""
    return F.translate(F.base64(c), "\r\n", "")


def _bytes(value: Column | bytes) -> Column:
    return F.lit(value) if isinstance(value, (bytes, bytearray)) else value


def utf8_lenient(c: Column) -> Column:
    """Bytes to text, leaving out what is not valid UTF-8."""
    text = c.cast("string")
    repaired = F.regexp_replace(F.make_valid_utf8(text), "�", "")
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def ascii_lenient(c: Column) -> Column:
    """Bytes to text, leaving out everything beyond ASCII."""
    return F.regexp_replace(F.make_valid_utf8(c.cast("string")), r"[^\x00-\x7F]", "")


def _to_bytes(c: Column, source: str) -> Column:
    if source == "text":
        return F.encode(c, "UTF-8")
    if source == "base64":
        return F.unbase64(c)
    if source == "hex":
        return F.unhex(c)
    if source == "bytes":
        return c
    if source == "integer":
        digits = F.lower(F.hex(c.cast("bigint")))
        return F.unhex(digits)
    raise ValueError(f"unknown form: {source}")


def recode(c: Column | str, source: str, target: str) -> Column:
    """Between ``text``, ``base64``, ``hex``, ``bytes`` and ``integer``; hex is lower-case."""
    c = as_column(c)
    if target == "integer":
        digits = c if source == "hex" else F.hex(_to_bytes(c, source))
        return F.conv(digits, 16, 10).try_cast("bigint")
    raw = _to_bytes(c, source)
    if target == "bytes":
        return raw
    if target == "base64":
        return _one_line_base64(raw)
    if target == "hex":
        return F.lower(F.hex(raw))
    if target == "text":
        return utf8_lenient(raw)
    if target == "ascii":
        return ascii_lenient(raw)
    raise ValueError(f"unknown form: {target}")


def recode_columns(df: DataFrame, columns: list[str], source: str, target: str) -> DataFrame:
    return df.withColumns({name: recode(name, source, target) for name in columns})


NUMBER_TEXT = (
    r"(?i)^\s*[+-]?(([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)"
    r"(e[+-]?[0-9](_?[0-9])*)?|inf(inity)?|nan)\s*$"
)


def is_number_text(c: Column | str) -> Column:
    return F.coalesce(as_column(c).rlike(NUMBER_TEXT), F.lit(False))


def number_or_zero(c: Column | str) -> Column:
    c = as_column(c)
    value = F.replace(F.trim(c), F.lit("_"), F.lit("")).try_cast("double")
    return F.when(is_number_text(c), F.coalesce(value, F.lit(0.0))).otherwise(F.lit(0.0))


def yes_text(c: Column | str) -> Column:
    return F.lower(as_column(c)).isin(*TRUE_TEXTS)


COERCIONS = {
    "is_number": is_number_text,
    "number": number_or_zero,
    "timestamp": timestamp_from_log,
    "flag": yes_text,
}


def coerce_columns(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Apply one rule of ``COERCIONS`` per named column."""
    unknown = sorted(set(spec.values()) - set(COERCIONS))
    if unknown:
        raise ValueError(f"unknown coercions: {unknown}")
    return df.withColumns({name: COERCIONS[rule](name) for name, rule in spec.items()})


def classify_paths(df: DataFrame, column: str, into: str = "path_kind") -> DataFrame:
    return df.withColumn(into, path_kind(column))
