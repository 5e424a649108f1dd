"""Hashes, tokens, encryption, codecs and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions import codec, masking
from ledgerflow.operators import joins, masking as protect
from ledgerflow.plans.jobs import publish_safe
from ledgerflow.queries.registry import query
from ledgerflow.session import scratch_path
from ledgerflow.sinks.snapshots import read_snapshot
from ledgerflow.sources.files import read_table as table

# Sample secrets for the queries below; jobs take theirs as a parameter.
SECRET, AES_KEY, AES_IV = b"sample-secret", b"0123456789abcdef0123456789abcdef", b"sample-vector-16"
INNER, OUTER = (pad.hex() for pad in codec.hmac_pads(SECRET))


def hmac_sql(value: str) -> str:
    return f"sha256(unhex('{OUTER}') || unhex(sha256(unhex('{INNER}') || encode({value}))))"


@query("""SELECT sha256(cast(c_custkey AS VARCHAR)) AS customer_token, sha256(c_name) AS name_token,
       c_mktsegment FROM customer""")
def sha_token(spark, sf):
    rows = protect.tokenise(
        table(spark, sf, "customer"), {"c_custkey": "customer_token", "c_name": "name_token"}
    )
    return rows.select("customer_token", "name_token", "c_mktsegment")


@query("""SELECT o_orderkey,
       sha256(concat_ws('_', nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'))) AS plain_key,
       sha256(concat_ws('_', coalesce(nullif(o_orderstatus, 'P'), '~'),
                        coalesce(nullif(o_orderpriority, '5-LOW'), '~'))) AS marked_key
FROM orders""")
def composite_key(spark, sf):
    parts = [F.nullif("o_orderstatus", F.lit("P")), F.nullif("o_orderpriority", F.lit("5-LOW"))]
    return table(spark, sf, "orders").select(
        "o_orderkey",
        codec.key_hash(*parts).alias("plain_key"),
        codec.key_hash(*parts, null_marker="~").alias("marked_key"),
    )


@query(f"SELECT c_custkey, {hmac_sql('c_name')} AS token FROM customer")
def hmac_token(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", codec.hmac_sha256_hex("c_name", SECRET).alias("token")
    )


@query(f"SELECT DISTINCT {hmac_sql('o_orderpriority')} AS token, o_orderpriority AS value FROM orders")
def token_vault(spark, sf):
    return protect.build_vault(
        table(spark, sf, "orders"), "o_orderpriority",
        codec.hmac_sha256_hex("o_orderpriority", SECRET),
    )


@query(f"SELECT DISTINCT {hmac_sql('c_name')} AS token, c_name AS value FROM customer")
def vault_growth(spark, sf):
    """Customer names in two batches that overlap; the vault holds each once."""
    base = scratch_path(spark, "vault")
    names = table(spark, sf, "customer")
    third = F.pmod(F.xxhash64("c_name"), F.lit(3))
    token = codec.hmac_sha256_hex("c_name", SECRET)
    for batch in (names.filter(third < 2), names.filter(third > 0), names):
        protect.grow_vault(batch, "c_name", token, base)
    return read_snapshot(spark, base)


@query(f"""SELECT o_orderkey, {hmac_sql('o_orderpriority')} AS token,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS value,
       o_orderpriority <> '5-LOW' AS found FROM orders""")
def detokenise(spark, sf):
    orders = table(spark, sf, "orders")
    token = codec.hmac_sha256_hex("o_orderpriority", SECRET)
    known = orders.filter(F.col("o_orderpriority") != "5-LOW")
    vault = protect.build_vault(known, "o_orderpriority", token)
    return joins.detokenise(orders.select("o_orderkey", token.alias("token")), vault)


@query("SELECT c_custkey, c_name AS decrypted, TRUE AS hidden FROM customer")
def aes_round_trip(spark, sf):
    sealed = table(spark, sf, "customer").select(
        "c_custkey", "c_name", codec.aes_encrypt_text("c_name", AES_KEY, AES_IV).alias("sealed")
    )
    return sealed.select(
        "c_custkey",
        codec.aes_decrypt_text("sealed", AES_KEY, AES_IV).alias("decrypted"),
        (~F.contains(codec.recode("sealed", "base64", "ascii"), F.col("c_name"))).alias("hidden"),
    )


@query("""SELECT c_custkey, base64(encode(c_name)) AS as_base64, lower(hex(encode(c_name))) AS as_hex,
       c_name AS back, c_custkey AS as_integer FROM customer""")
def recode_columns(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_name").alias("as_base64"),
        F.col("c_name").alias("as_hex"),
        codec.recode("c_name", "text", "base64").alias("back"),
        F.hex("c_custkey").alias("as_integer"),
    )
    rows = codec.recode_columns(rows, ["as_base64"], "text", "base64")
    rows = codec.recode_columns(rows, ["as_hex"], "text", "hex")
    rows = codec.recode_columns(rows, ["back"], "base64", "text")
    return codec.recode_columns(rows, ["as_integer"], "hex", "integer")


@query("""SELECT event_id, event_type = 'click' AS is_number,
       CASE WHEN event_type = 'click' THEN value ELSE 0 END AS number,
       date_trunc('second', ts) AS stamp, event_type = 'view' AS flag FROM events""")
def coerce_columns(spark, sf):
    kind = F.col("event_type")
    raw = F.when(kind == "click", F.col("value").cast("string")).otherwise(kind)
    rows = table(spark, sf, "events").select(
        "event_id",
        raw.alias("is_number"),
        raw.alias("number"),
        F.date_format("ts", "dd/MM/yy HH.mm.ss").alias("stamp"),
        F.when(kind == "view", "Yes").otherwise("off").alias("flag"),
    )
    return codec.coerce_columns(
        rows,
        {"is_number": "is_number", "number": "number", "stamp": "timestamp", "flag": "flag"},
    )


@query("""SELECT page_id, 'Contains folder' AS url_kind, 'Full path' AS path_kind,
       'Filename only' AS name_kind FROM pages""")
def classify_paths(spark, sf):
    rows = table(spark, sf, "pages").select(
        "page_id",
        "url",
        F.regexp_replace("url", "^[a-z]+:/", "").alias("path"),
        F.regexp_replace("url", "[^a-z0-9]", "").alias("name"),
    )
    rows = codec.classify_paths(rows, "url", "url_kind")
    rows = codec.classify_paths(rows, "path", "path_kind")
    return codec.classify_paths(rows, "name", "name_kind").drop("url", "path", "name")


def factor_sql(key: str, salt: str) -> str:
    return (
        f"(0.9::DOUBLE + 0.2::DOUBLE * (('0x' || substr(sha256(concat_ws(':', cast({key} AS VARCHAR), "
        f"'{salt}')), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE))"
    )


@query(f"SELECT c_custkey, round(c_acctbal * {factor_sql('c_custkey', 'q1')}, 4) AS masked FROM customer")
def mask_hash(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.round(masking.mask_by_key("c_acctbal", "c_custkey", "q1"), 4).alias("masked"),
    )


@query("""SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN TRUE END AS in_range
FROM customer""")
def mask_random(spark, sf):
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.abs("c_acctbal") + 1)
    rows = table(spark, sf, "customer").select("c_custkey", balance.alias("balance"))
    masked = rows.withColumn("masked", masking.mask_random("balance", seed=42))
    ratio = F.col("masked") / F.col("balance")
    return masked.select("c_custkey", ((ratio >= 0.9 - 1e-9) & (ratio < 1.1)).alias("in_range"))


@query(f"""SELECT sha256(cast(c_custkey AS VARCHAR)) AS customer_token,
       sha256(c_name) AS account_token, c_mktsegment,
       round(c_acctbal * {factor_sql('c_custkey', 'safe')}, 4) AS masked_balance FROM customer""")
def safe_dataset(spark, sf):
    safe = publish_safe(
        table(spark, sf, "customer"),
        tokens={"c_custkey": "customer_token", "c_name": "account_token"},
        mask={"c_acctbal": "masked_balance"},
        keep=["c_mktsegment"],
        key="c_custkey",
        salt="safe",
        identifying=["c_custkey", "c_name", "c_acctbal"],
    )
    return safe.withColumn("masked_balance", F.round("masked_balance", 4))
