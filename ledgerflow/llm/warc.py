"""A content-addressed WARC archive: payloads once, record headers apart, joined to read.

``write_archive`` writes two tables into a folder:

* ``payloads``: SHA-256 digest and Zstandard-compressed bytes, one row per distinct payload. That
  equal digests mean equal payloads is verified by length and a second digest (SHA-1) of every row.
* ``records``: the exact WARC header of each record and the digest of its payload.

``read_archive`` joins both and gives back every record whole.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.llm.common import per_batch, ship, text_of
from ledgerflow.session import stage

#: Records carry this time; pages have none of their own, and reruns must agree.
DATE = "2020-01-01T00:00:00Z"
URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BODY = pa.schema([("digest", pa.binary()), ("body", pa.binary())])
FACTS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.binary()), ("sha1", pa.string()),
     ("bytes", pa.int64())]
)
FACTS_SQL = "page_id long, url string, digest binary, sha1 string, bytes long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _facts(batch: pa.RecordBatch) -> pa.RecordBatch:
    payloads = [text.encode("utf-8") for text in batch.column(2).to_pylist()]
    columns = [
        batch.column(0), batch.column(1), [hashlib.sha256(p).digest() for p in payloads],
        [base32_sha1(p) for p in payloads], [len(p) for p in payloads],
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) if isinstance(c, list) else c.cast(f.type)
         for c, f in zip(columns, FACTS)], schema=FACTS,
    )


def _bodies(batch: pa.RecordBatch) -> pa.RecordBatch:
    packer = zstandard.ZstdCompressor(level=3)
    distinct = {}
    for text in batch.column(0).to_pylist():
        payload = text.encode("utf-8")
        digest = hashlib.sha256(payload).digest()
        if digest not in distinct:
            distinct[digest] = packer.compress(payload)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(distinct), pa.binary()), pa.array(list(distinct.values()), pa.binary())],
        schema=BODY,
    )


def _header(smallest: int) -> Column:
    """The header of a record, from ``page_id``, ``url``, ``sha1``, ``bytes`` and ``response``."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    name = F.concat(F.lit(f"<{URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    first = F.concat(F.lit(f"<{URN}"), F.col("response").cast("string"), F.lit(">"))
    revisit = (F.col("bytes") >= smallest) & ~F.col("page_id").eqNullSafe(F.col("response"))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    common = [
        line("WARC-Record-ID", name), line("WARC-Target-URI", target), line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
    ]
    plain = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.lit("WARC-Type: response"), *common,
        line("Content-Length", F.col("bytes").cast("string")),
    )
    again = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.lit("WARC-Type: revisit"), *common,
        line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", first),
        F.lit("Content-Length: 0"),
    )
    return F.concat(F.when(revisit, again).otherwise(plain), F.lit("\r\n\r\n"))


def write_archive(pages: DataFrame, folder: str, smallest_revisit: int = 0) -> None:
    """Archive ``page_id``, ``url`` and ``html`` of ``pages`` in ``folder``.

    Of the records with one payload of at least ``smallest_revisit`` bytes, that with the largest
    page_id is the response and the others revisit it. Null html is an empty payload, a null url an
    empty one. Rows that share that largest page_id are responses, all of them; a null page_id is
    the smallest, and where a payload has no other, its records are responses.
    """
    ship(pages.sparkSession)
    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"), text_of("url").alias("url"),
        text_of("html").alias("html"),
    )
    facts = stage(chosen.mapInArrow(per_batch(_facts), FACTS_SQL), "warc-facts")
    groups = facts.groupBy("digest").agg(
        F.max("page_id").alias("response"),
        F.min(F.struct("bytes", "sha1")).alias("low"), F.max(F.struct("bytes", "sha1")).alias("high"),
    )
    same = F.col("low") == F.col("high")
    clash = F.raise_error(F.lit("two payloads share a SHA-256 digest")).cast("long")
    groups = groups.select("digest", F.when(same, F.col("response")).otherwise(clash).alias("response"))
    # Staged, so that the join lays both sides out itself and adaptive execution can split a payload
    # that a third of all pages share.
    groups = stage(groups, "warc-groups")
    records = facts.join(groups, "digest").select("digest", _header(smallest_revisit).alias("header"))
    records.write.option("compression", "zstd").parquet(f"{folder}/records")

    bodies = chosen.select("html").mapInArrow(per_batch(_bodies), "digest binary, body binary")
    once = bodies.groupBy("digest").agg(F.first("body").alias("body"))
    once.write.option("compression", "none").parquet(f"{folder}/payloads")


RECORDS = pa.schema([("header", pa.string()), ("payload", pa.binary())])


def _restore(batch: pa.RecordBatch) -> pa.RecordBatch:
    unpacker = zstandard.ZstdDecompressor()
    payloads = []
    for digest, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        payload = unpacker.decompress(body)
        if hashlib.sha256(payload).digest() != digest:
            raise ValueError(f"payload {digest.hex()} is damaged")
        payloads.append(payload)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(payloads, pa.binary())], schema=RECORDS
    )


def _join(spark: SparkSession, folder: str) -> DataFrame:
    records = spark.read.schema("digest binary, header string").parquet(f"{folder}/records")
    payloads = spark.read.schema("digest binary, body binary").parquet(f"{folder}/payloads")
    return records.join(payloads, "digest", "left").select("header", "digest", "body")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: its ``header`` and its whole ``payload``, also that of a revisit.

    A record whose payload is missing or damaged stops the read.
    """
    ship(spark)
    return _join(spark, folder).mapInArrow(per_batch(_restore), "header string, payload binary")


def warc_bytes() -> Column:
    """A record as it stands in a WARC file; a revisit has no payload there."""
    revisit = F.col("header").startswith("WARC/1.1\r\nWARC-Type: revisit")
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.col("header").cast("binary"), body, F.lit(b"\r\n\r\n"))


DIGESTED = pa.schema(
    [("header", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    restored = _restore(batch).column(1).to_pylist()
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array([len(p) for p in restored], pa.int64()),
         pa.array([base32_sha1(p) for p in restored], pa.string())], schema=DIGESTED,
    )


def archive_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per record what its header says, and length and digest of the payload as restored."""
    ship(spark)
    digested = _join(spark, folder).mapInArrow(
        per_batch(_digest), "header string, payload_bytes long, payload_digest string"
    )
    said = lambda pattern: F.regexp_extract("header", pattern, 1)
    whole = lambda name: F.expr(
        f"try_cast(regexp_extract(header, '(?m)^{name}: <{URN}(-?[0-9]+)>', 1) as bigint)"
    )
    return digested.select(
        whole("WARC-Record-ID").alias("page_id"), "payload_bytes", "payload_digest",
        said(r"(?m)^WARC-Type: (\w+)").alias("record_type"), whole("WARC-Refers-To").alias("refers_to"),
    )


ORACLE = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), largest AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS response FROM digests
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, CAST((5 * i) // 4 + 1 AS INT), 2) AS INT)
      >> CAST(3 - (5 * i) % 4 AS INT)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM largest
"""
