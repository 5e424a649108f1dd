"""Near-duplicate texts: Jaccard similarity of word shingles, joined with Bayesian pruning.

1. Texts with equal shingle sets are one class; the rest works on classes.
2. Classes whose MinHash values agree in a band meet in a bucket. Bands are short, so that a pair
   at the threshold misses all of them with probability below 1e-7.
3. In a bucket, pairs compare their MinHash values a few at a time. With a uniform prior the
   similarity's posterior is a Beta law; a pair goes when the posterior probability of reaching the
   threshold falls below TOLERANCE.
4. What is left connects classes to clusters. The texts of a cluster are fetched once and all its
   pairs are verified exactly, by intersections of their shingle sets.

No step emits pairs: buckets and clusters are compared in blocks and give counts and forest edges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.llm.common import frugal, ship, text_of, words_of
from ledgerflow.llm.components import connected_components
from ledgerflow.llm.pairs import allowed_pairs, cut_buckets, deal, groups, local_roots
from ledgerflow.session import stage

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
#: MinHash values of a band.
ROWS = 4
#: MinHash values compared between two looks at the posterior.
LOOK = 16
TOLERANCE = 1e-6
#: Texts of a cluster that one task compares with as many others.
TEXT_BLOCK = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit digests of the distinct runs of ``size`` words; a shorter text is one run."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashed = np.array([digest(word) for word in words], np.uint64)
    size = min(size, len(hashed))
    runs = np.zeros(len(hashed) - size + 1, np.uint64) + np.uint64(size)
    for k in range(size):
        runs = runs * _MIX + hashed[k : len(hashed) - size + 1 + k]
    return np.unique(_mixed(runs))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    factors = draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, 16 bits each, of sets that are not empty."""
    factors, shifts = _coefficients()
    out = np.empty((len(sets), HASHES), np.uint16)
    sizes = [len(one) for one in sets]
    first = 0
    while first < len(sets):
        last, held = first, 0
        while last < len(sets) and (last == first or held + sizes[last] <= 2048):
            held += sizes[last]
            last += 1
        values = np.concatenate(sets[first:last])
        starts = np.cumsum([0, *sizes[first : last - 1]])
        best = None
        for at in range(0, len(values), 4096):  # one long text is taken in parts
            part = values[at : at + 4096, None] * factors + shifts
            if last == first + 1:
                low = part.min(axis=0, keepdims=True)
                best = low if best is None else np.minimum(best, low)
            else:
                best = np.minimum.reduceat(part, starts, axis=0)
        out[first:last] = (best * _MIX) >> np.uint64(48)
        first = last
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit bucket number per row and band."""
    bands = signatures.astype(np.uint64).reshape(len(signatures), -1, ROWS)
    keys = np.zeros(bands.shape[:2], np.uint64) + np.arange(1, bands.shape[1] + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * _MIX + bands[:, :, k])
    return keys.view(np.int64)


def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After so many compared values, the agreements below which a pair is dropped.

    With a uniform prior and m of n values equal, the similarity is Beta(m+1, n-m+1), and reaches t
    with the probability that a binomial of n+1 draws at t has at most m successes.
    """
    out = {}
    for n in range(LOOK, HASHES + 1, LOOK):
        reach, m = 0.0, -1
        while reach < tolerance:
            m += 1
            reach += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def surviving_pairs(signatures: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the allowed pairs that no look at their MinHash values drops."""
    left, right = np.nonzero(pairs)
    agreed = np.zeros(len(left), np.int32)
    for n, least in least_agreements().items():
        if not len(left):
            break
        part = signatures[:, n - LOOK : n]
        agreed += (part[left] == part[right]).sum(axis=1, dtype=np.int32)
        alive = agreed >= least
        left, right, agreed = left[alive], right[alive], agreed[alive]
    return left, right


def similar_pairs(sets: list[np.ndarray], pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the allowed pairs whose exact Jaccard similarity reaches the threshold."""
    sizes = np.array([len(one) for one in sets])
    member = np.repeat(np.arange(len(sets)), sizes)
    _, number, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[number] > 1  # what one text alone has is in no intersection
    member, number = member[shared], number[shared]
    order = np.argsort(number, kind="stable")
    member, number = member[order], number[order]
    number = np.cumsum(np.append(0, number[1:] != number[:-1])) if len(number) else number
    common = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        low, high = np.searchsorted(number, (begin, begin + 4096))
        grid = np.zeros((len(sets), min(4096, int(number[-1]) + 1 - begin)), np.float32)
        grid[member[low:high], number[low:high] - begin] = 1.0
        common += grid @ grid.T
    union = np.maximum(sizes[:, None] + sizes[None, :] - common, 1.0)
    return np.nonzero(pairs & (common.astype(np.float64) / union >= THRESHOLD))


def shingle_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


SIGNED = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("signature", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for at in range(0, len(texts), 512):
            sets = [shingle_set(text) for text in texts[at : at + 512]]
            full = [k for k, one in enumerate(sets) if len(one)]
            keys, signatures = [None] * len(sets), [None] * len(sets)
            for k, row in zip(full, min_hashes([sets[k] for k in full]) if full else ()):
                keys[k] = shingle_key(sets[k])
                signatures[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(sets)), pa.array(keys, pa.binary()),
                 pa.array(signatures, pa.binary())], schema=SIGNED,
            )


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_signatures(batch.column(1)))
            ids = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1)), pa.array(ids)], names=["bucket", "id"]
            )


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends: list[np.ndarray] = []
    roots: list[np.ndarray] = []
    for group in groups(batches):
        # In order of the ids, so that one cluster has the same roots in all its buckets.
        order = np.argsort(group["id"].to_numpy(), kind="stable")
        ids, own = group["id"].to_numpy()[order], group["own"].to_numpy()[order]
        pairs = allowed_pairs(own, group["one"][0].as_py(), group["two"][0].as_py())
        left, right = surviving_pairs(_signatures(group["signature"])[order], pairs)
        if len(left):
            root = local_roots(len(ids), left, right)
            told = root != np.arange(len(ids))
            ends.append(ids[told])
            roots.append(ids[root[told]])
        if len(ends) >= 5000:
            yield _edges(ends, roots)
            ends, roots = [], []
    if ends:
        yield _edges(ends, roots)


def _edges(ends: list[np.ndarray], roots: list[np.ndarray]) -> pa.RecordBatch:
    both = np.unique(np.stack([np.concatenate(ends), np.concatenate(roots)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


FOUND = "id long, links long, root long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches):
        ids, own = group["id"].to_numpy(), group["own"].to_numpy()
        copies, keys = group["copies"].to_numpy(), group["key"].to_pylist()
        sets = [shingle_set(text) for text in group["text"].to_pylist()]
        # Where a doc_id is repeated, only the row that the class was made from counts.
        right_text = [shingle_key(s) for s in sets]
        first = {one: k for k, one in reversed(list(enumerate(ids.tolist()))) if right_text[k] == keys[k]}
        chosen = np.array([first[one] for one in sorted(first)], np.int64)
        if len(chosen) < 2:
            continue
        ids, own, copies = ids[chosen], own[chosen], copies[chosen]
        pairs = allowed_pairs(own, group["one"][0].as_py(), group["two"][0].as_py())
        left, right = similar_pairs([sets[k] for k in chosen], pairs)
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        root = ids[local_roots(len(ids), left, right)]
        told = links > 0
        if told.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[told]), pa.array(links[told]), pa.array(root[told])],
                names=["id", "links", "root"],
            )


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id``, ``n_links``, ``text_class`` and ``kept`` of every document.

    Two documents are linked if the sets of their five-word shingles (words unchanged, between
    blanks) have a Jaccard similarity of THRESHOLD or more; a text of one to four words is one
    shingle. ``class_id`` is the smallest doc_id that links reach, ``n_links`` counts the other
    documents linked directly, ``text_class`` is the smallest doc_id with the same shingles.
    Documents without words and rows without a doc_id link with nothing; their class is their own.
    Rows that share doc_id and shingles count as two documents of one class.
    """
    return _report(docs).select("doc_id", "class_id", "n_links", "text_class", "kept")


def _report(docs: DataFrame) -> DataFrame:
    """``similar_documents`` with each row's ``key`` (digest of its shingles) and ``component``."""
    ship(docs.sparkSession)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    signed = stage(
        chosen.mapInArrow(frugal(_sign), "doc_id long, key binary, signature binary"), "join-signed"
    )
    classes = signed.where("key is not null and doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        F.first("signature").alias("signature"),
    )
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "join-classes")
    named = classes.select("id", "signature").mapInArrow(frugal(_bands), "bucket long, id long")
    shared = named.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    kept = stage(named.join(shared.select("bucket"), "bucket"), "join-buckets")
    cut = cut_buckets(kept).join(classes.select("id", "signature"), "id")
    cut = cut.select("bucket", "one", "two", "own", "id", "signature")
    near = stage(deal(cut).mapInArrow(frugal(_prune), "a long, b long").distinct(), "join-near")

    clusters = connected_components(near).withColumnRenamed("component", "bucket")
    members = cut_buckets(clusters.select("bucket", "id"), TEXT_BLOCK).join(
        classes.select("id", "copies", "key", "first_id"), "id"
    )
    texts = members.join(chosen.where("doc_id is not null"), F.col("first_id") == F.col("doc_id"))
    texts = texts.select("bucket", "one", "two", "own", "id", "copies", "key", "text")
    found = stage(deal(texts).mapInArrow(frugal(_verify), FOUND), "join-links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    label = connected_components(edges.distinct())
    whole = classes.select("id", "key", "first_id", "copies").join(label, "id", "left")
    whole = whole.join(links, "id", "left").withColumn("component", F.coalesce("component", "id"))
    smallest = whole.groupBy("component").agg(F.min("first_id").alias("class_id"))
    facts = whole.join(smallest, "component").select(
        "key", "component", "class_id", F.col("first_id").alias("text_class"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    usable = F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")
    result = signed.select("doc_id", usable).join(stage(facts, "join-facts"), "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("text_class", "doc_id").alias("text_class"), "key", "component",
    )
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def _keys(texts: pa.Array) -> pa.Array:
    sets = (shingle_set(text) for text in texts.to_pylist())
    return pa.array([shingle_key(one) if len(one) else None for one in sets], pa.binary())


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each class of similar ones.

    Rows that share a doc_id are decided each by its own text. Where several of them are in the class
    that their doc_id leads, the row of the smallest shingle digest stays, and of equal digests the
    row whose columns come first as JSON. Rows without a doc_id or without words stay.
    """
    report = stage(_report(docs).select("doc_id", "key", "component", "kept"), "join-report")
    ids = report.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_or("kept").alias("kept")
    )
    # Texts meet the shorter list, of ids that stay or of those that go, so that a short one can be
    # sent to where the texts are.
    ids = ids.withColumn("stays", (F.col("rows") == 1) & F.col("kept"))
    ids = stage(ids.withColumn("several", (F.col("rows") > 1) & F.col("kept")).drop("rows", "kept"), "join-ids")
    some = ids.agg(F.count_if("stays"), F.count_if(~F.col("stays")), F.count_if("several")).first()
    listed = stage(ids.where("stays" if some[0] < some[1] else "not stays").select("doc_id"), "join-listed")
    named = docs.where(F.col("doc_id").isNotNull())
    how = "left_semi" if some[0] < some[1] else "left_anti"
    rest = named.join(listed, "doc_id", how).select(*named.columns)
    if some[2]:
        several = ids.where("several").select("doc_id")
        rest = rest.unionByName(_one_of_repeated(named, report, several))
    return rest.unionByName(docs.where(F.col("doc_id").isNull()))


def _one_of_repeated(named: DataFrame, report: DataFrame, several: DataFrame) -> DataFrame:
    """What stays of the rows whose doc_id is among ``several``."""
    leaders = report.where("kept and key is not null").join(several, "doc_id", "left_semi")
    leaders = leaders.groupBy("component").agg(F.min("doc_id").alias("id"), F.min("key").alias("key"))
    rows = named.join(several, "doc_id", "left_semi").select(F.struct(*named.columns).alias("doc"))
    rows = rows.withColumn("key", F.arrow_udf(_keys, "binary")(text_of("doc.text")))
    rows = rows.withColumn("id", F.col("doc.doc_id").cast("long"))
    order = Window.partitionBy("id", "key").orderBy(F.to_json("doc"))
    first = rows.join(leaders.select("id", "key"), ["id", "key"], "left_semi")
    first = first.withColumn("place", F.row_number().over(order)).where("place = 1")
    return first.select("doc.*").unionByName(rows.where("key is null").select("doc.*"))
