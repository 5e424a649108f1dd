"""Sources mixed to target weights by hash-threshold histograms, in DataFrame operations only.

Each source gets a target number of words. Every document is taken as often in full as the target
allows; of the rest of the target, the documents below a threshold of a 60-bit hash are taken once
more. The threshold is found without sorting documents: words are summed by source and the hash's
first 12 bits, the bucket in which the budget ends is found by a running sum over at most 4096
buckets, and only the rows of that bucket are summed again by the next 12 bits, until the whole
hash is fixed.

Null texts have no words. Null sources are a source of their own, the last in order. Rows with equal
doc_id and text share a hash and are taken or left together. Columns beside ``doc_id``, ``text`` and
``source`` pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.llm.common import WORD, text_of
from ledgerflow.session import stage

WEIGHTS = (1, 2, 3)
#: No document is taken more often than this.
MOST = 3
HASH_BITS = 60
LEVEL_BITS = 12
#: A table of this many sources (under 2 MB) is broadcast; a longer one is joined by shuffling.
BROADCAST_SOURCES = 20_000


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def document_hash() -> Column:
    """60 bits that depend on doc_id and text alone."""
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_of()))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_key() -> Column:
    """The source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def _prefix(level: int) -> Column:
    """The bits of the hash down to and with ``level``."""
    return F.shiftright("h", HASH_BITS - LEVEL_BITS * (level + 1))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``key``, ``source``, ``source_size`` and ``target`` of each source.

    The sum of all sizes is shared by weight; a source takes ``MOST`` times its size at most and
    what it leaves is shared by weight among the others. Sources by their cap per weight, lowest
    first: the first whose cap is not below its share of what is left fixes the share of all after
    it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), place + 1))
    weighed = weighed.withColumn("cap", F.lit(MOST) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shared = weighed.withColumn(
        "share", left.cast("double") / F.sum("w").over(onward)
    ).withColumn("turn", F.row_number().over(by_cap))
    open_turn = F.when(F.col("share") * F.col("w") <= F.col("cap"), F.col("turn"))
    final = F.min_by("share", open_turn).over(everything)
    target = F.least(F.col("cap").cast("double"), final * F.col("w"))
    return shared.select("key", "source", "source_size", target.alias("target"))


def thresholds(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source its target, full copies (``whole``) and the hash below which documents are taken
    once more (``limit``, itself included if ``closed``)."""
    sized = docs.select(
        source_key().alias("key"), F.col("source").cast("string").alias("source"),
        document_hash().alias("h"), word_count().alias("size"),
    )
    sized = stage(sized, "mix-sizes")
    sizes = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    full = F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(0)
    budget = (
        source_targets(sizes, weights)
        .withColumn("goal", goal)
        .withColumn("whole", full.cast("long"))
        .withColumn("rest", F.col("goal") - F.col("whole") * F.col("source_size"))
    )
    budget = stage(budget, "mix-budgets")
    few = budget.count() <= BROADCAST_SOURCES
    small = F.broadcast if few else (lambda table: table)

    rows = sized.where(F.col("size") > 0).join(small(budget.select("key", "rest")), "key")
    levels = HASH_BITS // LEVEL_BITS
    by_bucket = Window.partitionBy("key").orderBy("bucket")
    for level in range(levels):
        sums = rows.groupBy("key", "rest", _prefix(level).alias("bucket")).agg(
            F.sum("size").alias("words")
        )
        before = F.sum("words").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1))
        sums = sums.withColumn("before", F.coalesce(before, F.lit(0)))
        edge = sums.where("before < rest and rest <= before + words")
        edge = stage(edge.select("key", "bucket", "words", "before", "rest"), "mix-edge")
        if level + 1 < levels:
            inner = edge.select("key", "bucket", (F.col("rest") - F.col("before")).alias("left"))
            rows = (
                rows.withColumn("bucket", _prefix(level))
                .join(small(inner), ["key", "bucket"])
                .select("key", "h", "size", F.col("left").alias("rest"))
            )
            if level == 0:
                rows = stage(rows, "mix-bucket")
    closed = F.col("before") * 2 + F.col("words") < F.col("rest") * 2
    edge = edge.select("key", F.col("bucket").alias("limit"), closed.alias("closed"))
    return budget.join(edge, "key", "left").select(
        "key", "source_size", "target", "whole",
        F.coalesce("limit", F.lit(-1)).alias("limit"),
        F.coalesce("closed", F.lit(False)).alias("closed"),
    )


def _with_copies(docs: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """The row as ``doc``, beside its size, its source's figures and how often it is taken."""
    limits = stage(thresholds(docs, weights), "mix-limits")
    if limits.count() <= BROADCAST_SOURCES:
        limits = F.broadcast(limits)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        source_key().alias("key"), document_hash().alias("h"), word_count().alias("size"),
    )
    once_more = (F.col("h") < F.col("limit")) | (F.col("closed") & (F.col("h") == F.col("limit")))
    return rows.join(limits, "key").withColumn("copies", F.col("whole") + once_more.cast("long"))


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """What the mix takes of every document, in words."""
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return _with_copies(docs, weights).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", taken,
        F.col("doc.source").alias("source"), "copies",
    )


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``; a row taken twice is there twice."""
    taken = _with_copies(docs, weights).where("copies > 0 and size > 0")
    return taken.select(
        "doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).select("doc.*")


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))),
      1, 15) AS BIGINT) AS h
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM docs GROUP BY source
), shares AS (
  SELECT *, row_number() OVER byCap AS turn,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER
      (byCap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / sum(w) OVER (byCap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM sources WINDOW byCap AS (ORDER BY 3 * source_size / w, source NULLS LAST)
), targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE),
    (SELECT min_by(share, turn) FROM shares WHERE share * w <= 3 * source_size) * w) AS target
  FROM shares
), budgets AS (
  SELECT *, CASE WHEN source_size > 0
      THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole,
    CAST(floor(target + 0.5) AS BIGINT) - CASE WHEN source_size > 0
      THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END * source_size AS rest
  FROM targets
), hashes AS (
  SELECT source, h, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
  FROM docs WHERE size > 0 GROUP BY source, h
)
SELECT d.doc_id, d.size, b.source_size, b.target,
  CAST(d.size * (b.whole + CASE WHEN 2 * x.upto - x.words < 2 * b.rest THEN 1 ELSE 0 END) AS BIGINT)
    AS taken, d.source,
  CAST(b.whole + CASE WHEN 2 * x.upto - x.words < 2 * b.rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN hashes x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
"""
