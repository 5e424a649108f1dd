"""Ranked lexical search of a stated set of items over all documents, half term by term, half
document by document.

Documents are indexed in segments: postings by term of some thousand documents in order of doc_id.
Only terms of the items are indexed; items go in blocks whose terms fit a bounded dictionary. In each
segment an item's short lists are summed term by term into accumulators. These then act as one more
iterator, with a bound of its own, beside the long lists: documents are taken window by window in
order, a window is skipped where the bounds of all iterators together miss the kth score, and within
a window the lists are added from the largest bound down, dropping documents that can no longer
reach it. The kth largest accumulators of all segments give each item a kth score to begin with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.llm.common import batch_parts, ship, text_of
from ledgerflow.session import stage

K = 10
#: Documents and, about, postings of a segment.
SEGMENT_DOCS, SEGMENT_POSTINGS = 4096, 262_144
#: Documents of a window, and windows that are scored between two looks at the kth score.
WINDOW, STEP = 64, 16
#: Accumulators take an item's shortest lists as long as these have this share of a segment's documents.
SHORT_SHARE = 0.25
#: Terms of items, repeats between items counted, that one pass over the documents looks for.
TERM_BLOCK = 200_000
#: Letters A-Z in lower case; ASCII but letters and digits parts terms.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

POSTINGS = (
    "doc_ids array<long>, n array<long>, terms array<int>, ends array<int>, docs array<int>, tf array<int>"
)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and ``term``, each pair once; rows of one item_id are one item."""
    schema = pa.schema([("item_id", pa.int64()), ("term", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch_parts(batch, 1):
                rows = [
                    (key, term)
                    for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                    for term in set(terms_of(text))
                ]
                columns = list(zip(*rows)) or [(), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    chosen = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    return chosen.mapInArrow(run, "item_id long, term binary").distinct()


class Builder:
    """Gathers documents and closes them into segments."""

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        self.get = vocabulary.get
        self.clear()

    def clear(self) -> None:
        self.keys: list[int | None] = []
        self.n: list[int] = []
        self.parts: list[np.ndarray] = []
        self.postings = 0

    def add(self, keys: list[int | None], texts: list[str]) -> None:
        split = [terms_of(text) for text in texts]
        count = np.array([len(s) for s in split], np.int64)
        found = np.fromiter(map(self.get, chain.from_iterable(split), repeat(-1)), np.int64, int(count.sum()))
        # Documents without any term are no documents here.
        real = np.flatnonzero(count)
        place = np.zeros(len(keys), np.int64)
        place[real] = len(self.keys) + np.arange(len(real))
        doc = np.repeat(place, count)
        key, tf = np.unique((found << 32 | doc)[found >= 0], return_counts=True)
        self.parts.append(np.stack([key >> 32, key & 0xFFFFFFFF, tf]))
        self.postings += len(key)
        self.keys += [keys[k] for k in real.tolist()]
        self.n += count[real].tolist()

    @property
    def full(self) -> bool:
        return len(self.keys) >= SEGMENT_DOCS or self.postings >= SEGMENT_POSTINGS

    def close(self, schema: pa.Schema) -> pa.RecordBatch:
        """The segment as one row, its documents in order of doc_id, null last."""
        order = sorted(range(len(self.keys)), key=lambda k: (self.keys[k] is None, self.keys[k] or 0))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        term, doc, tf = np.concatenate(self.parts, axis=1)
        doc = place[doc]
        by = np.lexsort((doc, term))
        used, starts = np.unique(term[by], return_index=True)
        row = (
            [self.keys[k] for k in order], [self.n[k] for k in order], used,
            np.append(starts[1:], len(by)) if len(by) else starts, doc[by], tf[by],
        )
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([value], f.type) for value, f in zip(row, schema)], schema=schema
        )


def build_segments(docs: DataFrame, vocabulary) -> DataFrame:
    """One row per segment, see POSTINGS: doc_ids and lengths by document, and by term the end of its
    list, with the documents' places and frequencies. ``vocabulary`` is a broadcast list of terms."""
    lists = pa.list_(pa.int32())
    schema = pa.schema(
        [("doc_ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("terms", lists),
         ("ends", lists), ("docs", lists), ("tf", lists)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = Builder({term: k for k, term in enumerate(vocabulary.value)})
        for batch in batches:
            for part in batch_parts(batch, 1):
                for at in range(0, part.num_rows, SEGMENT_DOCS // 4):
                    some = part.slice(at, SEGMENT_DOCS // 4)
                    builder.add(some.column(0).to_pylist(), some.column(1).to_pylist())
                    if builder.full:
                        yield builder.close(schema)
        if builder.keys:
            yield builder.close(schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return chosen.mapInArrow(run, POSTINGS)


class Segment:
    """Impacts of a segment's postings, with the largest of each list in each window of documents."""

    def __init__(self, row: dict, weights: np.ndarray, docs_in_all: int, terms_in_all: int) -> None:
        self.doc_ids, n = row["doc_ids"], row["n"]
        self.terms = {t: k for k, t in enumerate(row["terms"].tolist())}
        self.docs, tf = row["docs"].astype(np.int64), row["tf"].astype(np.int64)
        self.starts = np.append(0, row["ends"]).astype(np.int64)
        # In Python integers where the product could leave the long range.
        wide = 90 * int(n.max()) * docs_in_all >= 1 << 63
        length = n.astype(object) if wide else n
        m = (100 - 90 + (90 * length * docs_in_all) // terms_in_all).astype(np.int64)
        weight = np.repeat(weights[row["terms"]], np.diff(self.starts))
        self.impacts = weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs]))
        self.windows = -(-len(n) // WINDOW)
        self.views: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def lists(self, terms: np.ndarray) -> list[int]:
        """Places of an item's lists in this segment, shortest first."""
        found = [self.terms[t] for t in terms.tolist() if t in self.terms]
        return sorted(found, key=lambda k: self.starts[k + 1] - self.starts[k])

    def view(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window begins in a list, and the list's largest impact in each window."""
        if k not in self.views:
            begin, end = self.starts[k], self.starts[k + 1]
            borders = np.arange(self.windows + 1) * WINDOW
            at = begin + np.searchsorted(self.docs[begin:end], borders)
            top = np.zeros(self.windows, np.int64)
            filled = np.flatnonzero(np.diff(at))
            top[filled] = np.maximum.reduceat(self.impacts[begin:end], at[filled] - begin)
            self.views[k] = at, top
        return self.views[k]

    def accumulate(self, lists: list[int]) -> tuple[np.ndarray, list[int]]:
        """Sums of the shortest lists by document, and the long lists left."""
        sizes = [int(self.starts[k + 1] - self.starts[k]) for k in lists]
        room = SHORT_SHARE * len(self.doc_ids)
        short = int(np.searchsorted(np.cumsum(sizes), room, side="right"))
        sums = np.zeros(len(self.doc_ids), np.int64)
        for k in lists[:short]:
            part = slice(self.starts[k], self.starts[k + 1])
            # A list holds a document once.
            sums[self.docs[part]] += self.impacts[part]
        return sums, lists[short:]

    def best(self, terms: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents with a score of ``least`` or more, which is 1 at
        least; of equal scores the first in order."""
        sums, long = self.accumulate(self.lists(terms))
        padded = np.zeros(self.windows * WINDOW, np.int64)
        padded[: len(sums)] = sums
        views = [self.view(one) for one in long]
        bound = padded.reshape(-1, WINDOW).max(1)
        for _, top in views:
            bound = bound + top
        tops = [int(top.max()) for _, top in views]
        order = sorted(range(len(long)), key=lambda j: -tops[j])
        left = np.append(np.cumsum([tops[j] for j in order][::-1])[::-1], 0).astype(np.int64)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting = np.flatnonzero(bound >= least)
        while len(waiting):
            now, waiting = waiting[:STEP], waiting[STEP:]
            begin, end = int(now[0]) * WINDOW, min(int(now[-1] + 1) * WINDOW, len(sums))
            part = sums[begin:end].copy()
            alive = np.repeat(np.isin(np.arange(now[0], now[-1] + 1), now), WINDOW)[: end - begin]
            for turn, j in enumerate(order):
                alive &= part + left[turn] >= least
                if not alive.any():
                    break
                at = views[j][0]
                some = slice(at[now[0]], at[now[-1] + 1])
                docs = self.docs[some] - begin
                wanted = alive[docs]
                part[docs[wanted]] += self.impacts[some][wanted]
            hit = np.flatnonzero(alive & (part >= least))
            if len(hit):
                places = np.concatenate([places, hit + begin])
                scores = np.concatenate([scores, part[hit]])
                keep = np.lexsort((places, -scores))[:k]
                places, scores = places[keep], scores[keep]
                if len(scores) == k:
                    least = max(least, int(scores[-1]))
                    waiting = waiting[bound[waiting] >= least]
        return places, scores


def segments_of(
    batches: Iterator[pa.RecordBatch], weights: np.ndarray, docs: int, terms: int
) -> Iterator[Segment]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = {}
            for name in batch.schema.names:
                values = batch.column(name).slice(at, 1).flatten()
                row[name] = values.to_pylist() if name == "doc_ids" else values.to_numpy(zero_copy_only=False)
            yield Segment(row, weights, docs, terms)


def top_rows(rows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """Rows with their ``rank`` among the first k of their keys."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def search_block(docs: DataFrame, pairs: list[tuple[int | None, bytes]], k: int) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the items of one block."""
    spark = docs.sparkSession
    vocabulary = sorted({term for _, term in pairs})
    number = {term: t for t, term in enumerate(vocabulary)}
    by_item: dict[int | None, list[int]] = {}
    for item, term in pairs:
        by_item.setdefault(item, []).append(number[term])
    items = [(item, np.array(sorted(terms), np.int64)) for item, terms in by_item.items()]
    segments = stage(build_segments(docs, spark.sparkContext.broadcast(vocabulary)), "search-segments")
    n = segments.agg(
        F.sum(F.size("doc_ids").cast("long")),
        F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)),
    ).first()
    docs_in_all, terms_in_all = n[0] or 0, n[1] or 0
    # A list's length is its end less the end before.
    lists = segments.select(F.posexplode("terms").alias("at", "term"), "ends")
    length = F.col("ends")[F.col("at")] - F.when(F.col("at") > 0, F.col("ends")[F.col("at") - 1]).otherwise(0)
    frequencies = lists.select("term", length.cast("long").alias("df")).groupBy("term").agg(F.sum("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in frequencies.collect():
        weights[term] = math.floor(1000 * math.log((2 * docs_in_all + 2) / (2 * df + 1)))
    known = spark.sparkContext.broadcast((items, weights))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = known.value
        for segment in segments_of(batches, weights, docs_in_all, terms_in_all):
            at, sums = [], []
            for place, (_, terms) in enumerate(items):
                found, _ = segment.accumulate(segment.lists(terms))
                found = found[found > 0]
                if len(found) > k:
                    found = np.partition(found, len(found) - k)[len(found) - k :]
                at.append(np.full(len(found), place, np.int32))
                sums.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(at)), pa.array(np.concatenate(sums))], names=["item", "sum"]
            )

    sums = segments.mapInArrow(bounds, "item int, sum long")
    kth = top_rows(sums, ["item"], [F.desc("sum")], k).where(F.col("rank") == k).select("item", "sum")
    least = np.ones(len(items), np.int64)
    for item, total in kth.collect():
        least[item] = total

    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = known.value
        # What an item's kth score is in one segment holds in the next of the same task.
        so_far = least.copy()
        for segment in segments_of(batches, weights, docs_in_all, terms_in_all):
            rows: list[tuple] = []
            for place, (item, terms) in enumerate(items):
                at, found = segment.best(terms, int(so_far[place]), k)
                if len(found) == k:
                    so_far[place] = max(so_far[place], found[-1])
                rows += [(item, segment.doc_ids[a], s) for a, s in zip(at.tolist(), found.tolist())]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    found = segments.mapInArrow(scores, "item_id long, doc_id long, score long")
    best = top_rows(found, ["item_id"], [F.desc("score"), F.asc_nulls_last("doc_id")], k)
    return best.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, term_block: int = TERM_BLOCK) -> DataFrame:
    """The k documents of the highest scores above 0 for each item: ``item_id``, ``rank``, ``doc_id``,
    ``score``.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and ``text``; other columns are
    left out. Null, empty and blank texts have no terms: such documents do not count, such items have
    no rows. Rows of one item_id are one item with the terms of all. Repeated documents are ranked each
    on its own, with ranks of their own; equal scores go by doc_id, null last. A null item_id is an
    item. Empty tables give no rows. Items are searched in blocks of about ``term_block`` terms.
    """
    spark = docs.sparkSession
    ship(spark)
    pairs = stage(item_terms(items), "search-items")
    blocks = -(-pairs.count() // term_block)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        chosen = pairs if blocks == 1 else pairs.where(block == b)
        rows = [(r["item_id"], bytes(r["term"])) for r in chosen.collect()]
        if rows:
            found = search_block(docs, rows, k)
            out = found if blocks == 1 else out.union(found)
    return out


#: Terms as DuckDB and RE2 read them.
TERM_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE = rf"""
WITH folded AS (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '{TERM_CLASS}') AS terms
  FROM documents),
sized AS (SELECT doc, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM folded WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
wanted AS (
  SELECT DISTINCT item_id, unnest(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '{TERM_CLASS}')) AS term
  FROM benchmark),
tf AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM sized)
  WHERE term IN (SELECT term FROM wanted) GROUP BY doc, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, totals GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id, doc,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // words))))) AS BIGINT)
           AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN sized USING (doc), totals
  GROUP BY item_id, doc_id, doc),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
