from __future__ import annotations

import base64
import hashlib
import hmac

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import codec, masking, text
from ledgerflow.operators import joins, masking as protect


def run(spark, items, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.o for r in rows.select("i", expr.alias("o")).orderBy("i").collect()]


#: Text and the same without accents.
PLAIN = {
    "Nguyễn Văn Đức": "Nguyen Van Duc", "crème brûlée": "creme brulee", "": "", "plain": "plain",
    "đường phố Huế, ừ": "duong pho Hue, u", "Ångström ÅÄÖ": "Angstrom AAO", "e\u0301a\u0323": "ea",
    "a" * 5000 + "é": "a" * 5000 + "e", "Ǆ ß ø ł": "Ǆ ß ø ł", "ﬁ": "ﬁ", "가": "\u1100\u1161",
    "각 é": "\u1100\u1161\u11a8 e", "й Ё": "и Е",
}


def test_accents(spark):
    assert run(spark, list(PLAIN), text.strip_accents("v")) == list(PLAIN.values())


def test_accents_of_latin_letters_equal_duckdb(spark):
    """Every Latin letter up to Vietnamese; DuckDB leaves the stroke of Đ on."""
    letters = [chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if chr(c) not in "Đđ"]
    frame = pd.DataFrame({"i": range(len(letters)), "v": letters})
    duck = duckdb.connect()
    duck.register("frame", frame)
    wanted = [r[0] for r in duck.sql("SELECT strip_accents(v) FROM frame ORDER BY i").fetchall()]
    assert run(spark, letters, text.strip_accents("v")) == wanted


def test_report_line_cleaners(spark):
    assert run(spark, ["Hello\x00World", "A\x7fB", "a\tb"], text.clean_line("v")) == ["HelloWorld", "AB", "a\tb"]
    labels = run(spark, ["Transaction   ID", "Account-Number"], text.normalise_label("v"))
    assert labels == ["transaction id", "account number"]
    names = ["20251103_REPORT.TXT", "abc.txt", "REPORT_20251103.TXT", None]
    assert run(spark, names, text.file_date("v")) == ["20251103", None, None, None]


def test_path_kinds(spark):
    items = ["/home/a/f.txt", "documents/f.txt", "f.txt", "./f", "a/", "../a", None]
    assert run(spark, items, text.path_kind("v")) == [
        "Full path", "Contains folder", "Filename only", "Filename only", "Filename only",
        "Contains folder", None,
    ]


def test_hmac_equals_the_standard_library(spark):
    for secret in (b"short", b"x" * 64, b"longer than one block " * 5):
        found = run(spark, ["value", "đồng", ""], codec.hmac_sha256_hex("v", secret))
        wanted = [hmac.new(secret, v.encode(), hashlib.sha256).hexdigest() for v in ("value", "đồng", "")]
        assert found == wanted


def test_aes_layouts(spark):
    key, iv = b"k" * 32, b"v" * 16
    items = ["short", "a text that is longer than one block, đồng " * 9, None]
    sealed = codec.aes_encrypt_text("v", key, iv)
    assert run(spark, items, codec.aes_decrypt_text(sealed, key, iv)) == items
    joined = codec.aes_encrypt_text("v", key, iv, keep_iv=True)
    assert run(spark, items, codec.aes_decrypt_text(joined, key)) == items
    raw = base64.b64decode(run(spark, items, sealed)[0])
    assert len(raw) == 16 and base64.b64decode(run(spark, items, joined)[0]) == iv + raw
    assert "\n" not in run(spark, items, sealed)[1]
    broken = codec.aes_decrypt_text(F.lit("AAAA"), key, iv, bad_rows_to_null=True)
    assert run(spark, ["x"], broken) == [None]


def test_recode(spark):
    item = "héllo"
    assert run(spark, [item], codec.recode("v", "text", "hex")) == [item.encode().hex()]
    assert run(spark, [item], codec.recode("v", "text", "base64")) == [base64.b64encode(item.encode()).decode()]
    assert run(spark, ["ff"], codec.recode("v", "hex", "integer")) == [255]
    assert run(spark, [255], codec.recode("v", "integer", "hex"), "bigint") == ["ff"]
    assert run(spark, ["61ff62"], codec.recode("v", "hex", "text")) == ["ab"]
    assert run(spark, ["61c3a962"], codec.recode("v", "hex", "ascii")) == ["ab"]
    with pytest.raises(ValueError):
        codec.recode("v", "text", "morse")


def test_coerce(spark):
    items = ["1", "1e3", " 5 ", "1d", "x", "1_000", "inf", None]
    assert run(spark, items, codec.is_number_text("v")) == [True, True, True, False, False, True, True, False]
    assert run(spark, items[:6], codec.number_or_zero("v")) == [1, 1000, 5, 0, 0, 1000]
    assert run(spark, ["Y", "true", "no"], codec.yes_text("v")) == [True, True, False]
    with pytest.raises(ValueError):
        codec.coerce_columns(spark.sql("SELECT '1' AS a"), {"a": "colour"})


def test_composite_key_and_null_marker(spark):
    rows = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    plain = {r[0] for r in rows.select(codec.key_hash("a", "b")).collect()}
    marked = {r[0] for r in rows.select(codec.key_hash("a", "b", null_marker="~")).collect()}
    assert len(plain) == 1 and len(marked) == 2


def test_masks(spark):
    rows = spark.range(500).select("id", (F.col("id") + 1).cast("double").alias("v"))
    for masked in (masking.mask_random("v", seed=1), masking.mask_by_key("v", "id", "salt")):
        ratios = [r[0] for r in rows.select(masked / F.col("v")).collect()]
        assert all(0.9 - 1e-9 <= r < 1.1 for r in ratios) and len(set(ratios)) > 100
    again = rows.select(masking.mask_by_key("v", "id", "salt")).collect()
    assert again == rows.select(masking.mask_by_key("v", "id", "salt")).collect()
    assert run(spark, [None], masking.mask_by_key("v", "i", "s"), "double") == [None]


def test_safe_projection_refuses_identities(spark):
    rows = spark.sql("SELECT 1 AS id, 'n' AS name, 'c' AS city")
    assert protect.safe_projection(rows, ["city"], ["id", "name"]).columns == ["city"]
    with pytest.raises(ValueError, match="NAME"):
        protect.safe_projection(rows, ["city", "NAME"], ["id", "name"])


def test_vault_round_trip(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    vault = protect.build_vault(rows, "v", codec.hmac_sha256_hex("v", b"k"))
    assert vault.count() == 2
    asked = vault.select("token").unionByName(spark.sql("SELECT 'nobody' AS token"))
    found = {r.value: r.found for r in joins.detokenise(asked, vault).collect()}
    assert found == {"a": True, "b": True, None: False}
