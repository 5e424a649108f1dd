"""Toxicity by logistic regression over hashed word n-grams and skip-grams, trained by FTRL-proximal.

Per-coordinate learning rates let rare features learn fast; the L1 term keeps all but the telling
ones at exactly zero, so the model is a short list of weights that is broadcast to score all texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerflow.llm.common import batch_parts, frugal, ship, text_of
from ledgerflow.session import stage

FEATURE_BITS = 20
#: Labelled rows that the classifier is fitted on, of each class: those of the smallest hash.
MAX_PER_CLASS = 5_000
EPOCHS = 8
#: Features of fewer training documents tell one document, not toxicity, and are left out.
MIN_DOCS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 16.0, 0.0
TOXIC_AT = 0.7
#: Texts of about this size are taken apart together; a text's features take many times its size.
PART_BYTES = 250_000

_TOKEN = re.compile(r"[^\W_]+")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: A feature is a word, two neighbours, or two words with one or two between them.
_GAPS = (0, 1, 2, 3)
#: The first letters of a word are features, too: inflected forms share them.
_STEMS = (4, 6, 8)


def _number(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _SPREAD
    return (mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def word_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hashed feature of every word, stem, neighbour pair and skip pair."""
    hashes: list[int] = []
    stems: list[list[int]] = [[] for _ in _STEMS]
    sizes = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = _TOKEN.findall(text.lower()) if text else []
        hashes.extend([zlib.crc32(word.encode("utf-8", "surrogatepass")) for word in words])
        for size, found in zip(_STEMS, stems):
            found.extend([zlib.crc32(word[:size].encode("utf-8", "surrogatepass")) for word in words])
        sizes[k] = len(words)
    h = np.array(hashes, np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    owners, features = [], []
    for size, found in zip(_STEMS, stems):
        owners.append(owner)
        features.append(_number((np.array(found, np.uint64) + np.uint64(size << 34)) * _SPREAD))
    for gap in _GAPS:
        if gap == 0:
            mixed, who = h * _SPREAD, owner
        elif len(h) > gap:
            inside = owner[:-gap] == owner[gap:]
            mixed = ((h[:-gap] * _SPREAD) ^ (h[gap:] + np.uint64(gap << 40)))[inside] * _SPREAD
            who = owner[:-gap][inside]
        else:
            continue
        owners.append(who)
        features.append(_number(mixed))
    return np.concatenate(owners), np.concatenate(features)


def train_ftrl(
    rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes over rows of distinct feature numbers."""
    size = 1 << FEATURE_BITS
    seen = np.bincount(np.concatenate(rows), minlength=size) if rows else np.zeros(size)
    rows = [row[seen[row] >= MIN_DOCS] for row in rows]
    # Both classes pull alike, however rare one is.
    share = np.mean(labels) if len(labels) else 0.5
    pull = {0: 1.0, 1: (1 - share) / share if 0 < share < 1 else 1.0}
    z, n, bias, bias_n = np.zeros(size), np.zeros(size), 0.0, 0.0

    def weights(at) -> np.ndarray:
        lean = z[at]
        free = np.sign(lean) * np.maximum(np.abs(lean) - L1, 0.0)
        return -free / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at = rows[k]
            w = weights(at)
            error = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[k]
            error *= pull[int(labels[k])]
            squared = error * error
            before = np.sqrt(n[at])
            z[at] += error - (np.sqrt(n[at] + squared) - before) / ALPHA * w
            n[at] += squared
            bias_n += squared
            bias -= error * ALPHA / (BETA + np.sqrt(bias_n))
    return weights(slice(None)), bias


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray
    weights: np.ndarray
    bias: float


def _crc(column: str) -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def held_out(column: str = "doc_id") -> Column:
    """Documents that the model must not learn from; a null doc_id counts as empty text."""
    return _crc(column) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled documents of each class.

    ``labels`` has doc_id and toxic; of a doc_id's repeated labels the largest counts, rows with a
    null in either column are left out. Without labelled rows every score is 0.5.
    """
    ship(docs.sparkSession)
    known = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where("doc_id is not null and toxic is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"),
        F.xxhash64(F.col("doc_id").cast("long")).alias("turn"),
    )
    picks = [known.where(F.col("toxic") == c).orderBy("turn").limit(per_class) for c in (0, 1)]
    # At most twice ``per_class`` rows of twenty bytes.
    chosen = F.broadcast(stage(picks[0].unionByName(picks[1]), "toxic-sample"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sample = texts.join(chosen, "doc_id").select("text", "toxic", "turn")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in batch_parts(batch, 0, PART_BYTES)):
            owners, features = word_features(part.column(0).to_pylist())
            keys = np.unique(owners.astype(np.int64) << FEATURE_BITS | features)
            ends = np.searchsorted(keys, np.arange(1, part.num_rows) << FEATURE_BITS)
            split = np.split(keys & ((1 << FEATURE_BITS) - 1), ends)
            rows = [one.astype("<i4").tobytes() for one in split]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), part.column(1), part.column(2)],
                names=["features", "toxic", "turn"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        seen.sort(key=lambda row: (row[2], row[1], row[0]))
        rows = [np.frombuffer(row[0], "<i4") for row in seen]
        weights, bias = train_ftrl(rows, np.array([row[1] for row in seen], float))
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(weights[at], bias))],
            names=["feature", "weight"],
        )

    featured = stage(
        sample.mapInArrow(frugal(featurise), "features binary, toxic int, turn long"), "toxic-features"
    )
    # The bounded sample meets in one task; the weights are few.
    fitted = featured.coalesce(1).mapInArrow(frugal(fit), "feature long, weight double").collect()
    features = np.array([row.feature for row in fitted if row.feature >= 0], np.int64)
    weights = np.array([row.weight for row in fitted if row.feature >= 0], float)
    return ToxicityModel(features, weights, next((r.weight for r in fitted if r.feature < 0), 0.0))


def with_score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc``, the whole input row, and ``score`` from 0 to 1 by its text.

    A row goes to Python and back once, its text inside; texts are taken out of it part by part.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")
    # Names may clash; inside the struct columns go by their place.
    rows = docs.select(F.struct(*[
        (F.col(f"`{c}`").cast("string") if k == place else F.col(f"`{c}`")).alias(c)
        for k, c in enumerate(docs.columns)
    ]).alias("doc"))
    shape = T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        dense = np.zeros(1 << FEATURE_BITS, np.float32)
        dense[known.features] = known.weights
        for batch in batches:
            texts = batch.column(0).field(place)
            only = pa.RecordBatch.from_arrays([texts], names=["text"])
            at = 0
            for part in batch_parts(only, 0, PART_BYTES):
                owners, features = word_features([t or "" for t in part.column(0).to_pylist()])
                telling = np.flatnonzero(dense[features])
                # A feature counts once a text.
                pairs = np.unique(owners[telling].astype(np.int64) << FEATURE_BITS | features[telling])
                weight = dense[pairs & ((1 << FEATURE_BITS) - 1)]
                total = np.bincount(pairs >> FEATURE_BITS, weight, part.num_rows)
                lean = np.clip(total + known.bias, -35, 35)
                # Part by part, so that neither side holds a second whole batch.
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, part.num_rows), pa.array(1.0 / (1.0 + np.exp(-lean)))],
                    names=["doc", "score"],
                )
                at += part.num_rows

    return rows.mapInArrow(frugal(score), shape)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        F.col("doc.doc_id").alias("doc_id"), held_out("doc.doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below TOXIC_AT."""
    return with_score(docs, train(docs, labels)).where(F.col("score") < TOXIC_AT).select("doc.*")
