"""Repeated passages by recompression.

Recompression shrinks a word sequence in rounds: a run of one symbol becomes a symbol, then, by a bit
of each symbol's digest that makes it a left or a right one, each left symbol followed by a right one
becomes a symbol. A symbol's name is a digest of what it stands for, so every task gives equal runs
and pairs equal names without asking others, and whether two neighbours merge depends on them alone.
Equal word sequences therefore get equal symbols, except near their ends, where a symbol may take in
a neighbour; those end symbols are dropped round by round, and what remains inside a window is the
same wherever the window occurs.

1. Every window of ``WINDOW`` words is represented by its inner symbols of the highest level that has
   any: the ``GROUP`` neighbouring symbols of the smallest digest, or all if there are fewer. Windows
   that overlap mostly share their representative, so there are about 0.3 a word.
2. Representatives of each document are dealt out by name; those of two documents or more go back to
   their documents.
3. Only windows with such a representative are named themselves, by digests of all their words, and
   dealt out by that name. A document's windows that a smaller doc_id has, too, are removed.

Names travel in sorted blocks with compressed doc_ids, a few bytes a name, beside compressed texts.
A window counts as equal by 96 bits: its own name and half of its representative's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerflow.llm.common import batch_parts, frugal, ship, text_of, words_of

WINDOW = 13
#: Rounds: one of runs, the others of pairs.
LEVELS = 3
GROUP = 3
#: Bytes of text that one part is planned for; there are as many parts as shuffle partitions at least.
PART_BYTES = 32 << 20
#: Characters of text that are parsed at once, and names that are held before they are dealt out.
CHUNK, HELD = 2_000_000, 1_000_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def digest(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _B
    return values ^ (values >> np.uint64(29))


def word_symbols(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One symbol per word, and the text it is of."""
    name = xxhash.xxh3_64_intdigest
    symbols = np.array([name(word) for words in texts for word in words], np.uint64)
    return symbols, np.repeat(np.arange(len(texts)), [len(words) for words in texts])


def window_starts(owner: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places at which a window of one text begins."""
    if len(owner) < window:
        return np.zeros(0, np.int64)
    return np.flatnonzero(owner[: len(owner) - window + 1] == owner[window - 1 :])


def window_names(symbols: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A digest of all words of each window, in order."""
    names = np.full(len(starts), window, np.uint64)
    for k in range(window):
        names = names * _A + symbols[starts + k]
    return digest(names)


def representatives(
    symbols: np.ndarray, owner: np.ndarray, starts: np.ndarray, window: int = WINDOW
) -> np.ndarray:
    """The name of each window's inner symbols, from the highest level that has any."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digest(symbols * _A))])
    names = digest(sums[starts + window] - sums[starts])
    if not len(starts):
        return names
    # Runs. The run at either end of a window may reach beyond it.
    change = np.ones(len(symbols), bool)
    change[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    place = np.cumsum(change) - 1
    first = np.flatnonzero(change)
    length = np.diff(np.append(first, len(symbols))).astype(np.uint64)
    level, of = symbols[first], owner[first]
    level = np.where(length > 1, digest(level * _A + length), level)
    left, right = place[starts] + 1, place[starts + window - 1]
    live = np.arange(len(starts))
    for turn in range(1, LEVELS + 1):
        inside = left < right
        live, left, right = live[inside], left[inside], right[inside]
        if not len(live):
            break
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digest(level * _A + np.uint64(turn)))])
        name = digest(sums[np.minimum(left + GROUP, right)] - sums[left] + np.uint64(turn))
        for shift in range(1, int((right - left).max()) - GROUP + 1):
            more = np.flatnonzero(left + shift + GROUP <= right)
            at = left[more] + shift
            name[more] = np.minimum(name[more], digest(sums[at + GROUP] - sums[at] + np.uint64(turn)))
        names[live] = name
        if turn == LEVELS:
            break
        # Pairs. A right symbol at the left end may be taken by what is before it, and a left one
        # at the right end by what comes after.
        is_left = (digest(level * _A + np.uint64(1000 + turn)) >> np.uint64(63)).astype(bool)
        joined = np.zeros(len(level), bool)
        joined[:-1] = is_left[:-1] & ~is_left[1:] & (of[:-1] == of[1:])
        left, right = left + ~is_left[left], right - is_left[right - 1]
        inside = left < right
        live, left, right = live[inside], left[inside], right[inside]
        taken = np.zeros(len(level), bool)
        taken[1:] = joined[:-1]
        place = np.cumsum(~taken) - 1
        kept = np.flatnonzero(~taken)
        pairs = kept[joined[kept]]
        merged = level.copy()
        merged[pairs] = digest(level[pairs] * _A + digest(level[pairs + 1]) + np.uint64(turn))
        level, of = merged[kept], of[kept]
        left, right = place[left], place[right - 1] + 1
    return names


class Names:
    """Names and the doc_ids they are of, gathered and dealt out in blocks by bucket."""

    SCHEMA = "bucket int, kind int, doc long, body binary"
    ARROW = pa.schema(
        [("bucket", pa.int32()), ("kind", pa.int32()), ("doc", pa.int64()), ("body", pa.binary())]
    )

    def __init__(self, buckets: int, by_doc: bool) -> None:
        self.buckets, self.by_doc = buckets, by_doc
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, names: np.ndarray, docs: np.ndarray, checks: np.ndarray | None = None) -> None:
        if checks is None:
            checks = np.zeros(0, np.uint32)
        self.held.append((names, docs.astype(np.int64), checks))
        self.count += len(names)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        names, docs, checks = (np.concatenate(parts) for parts in zip(*self.held))
        self.held, self.count = [], 0
        bucket = doc_bucket(docs, self.buckets) if self.by_doc else name_bucket(names, self.buckets)
        order = np.lexsort((docs, bucket))
        names, docs, bucket = names[order], docs[order], bucket[order]
        checks = checks[order] if len(checks) else checks
        packer = zstandard.ZstdCompressor(level=1)
        used, starts = np.unique(bucket, return_index=True)
        bodies = []
        for begin, end in zip(starts, [*starts[1:], len(names)]):
            step = np.diff(docs[begin:end], prepend=0).astype("<i8").tobytes()
            head = np.array([end - begin, len(checks) > 0], "<u4").tobytes()
            raw = names[begin:end].astype("<u8").tobytes() + checks[begin:end].astype("<u4").tobytes()
            bodies.append(head + raw + packer.compress(step))
        for at in range(0, len(bodies), 256):
            part = bodies[at : at + 256]
            columns = [used[at : at + 256].astype(np.int32), np.zeros(len(part), np.int32)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.nulls(len(part), pa.int64()), pa.array(part, pa.binary())],
                schema=self.ARROW,
            )


def read_block(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, doc_ids and checks of a block."""
    count, checked = np.frombuffer(body, "<u4", 2).tolist()
    names = np.frombuffer(body, "<u8", count, 8)
    at = 8 + 8 * count
    checks = np.frombuffer(body, "<u4", count * checked, at)
    step = zstandard.ZstdDecompressor().decompress(body[at + checks.nbytes :])
    return names, np.cumsum(np.frombuffer(step, "<i8")), checks


def name_bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    return ((names >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)


def doc_bucket(docs: np.ndarray, buckets: int) -> np.ndarray:
    mixed = digest(docs.astype(np.int64).view(np.uint64) * _A)
    return (mixed % np.uint64(buckets)).astype(np.int32)


def _name_parts(buckets: int):
    """Representatives of every document, each once, dealt out by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Names(buckets, by_doc=False)
        for part in (part for batch in batches for part in batch_parts(batch, 1, CHUNK)):
            part = part.filter(part.column(0).is_valid())
            ids = part.column(0).to_numpy()
            symbols, owner = word_symbols([words_of(t) for t in part.column(1).to_pylist()])
            starts = window_starts(owner)
            if not len(starts):
                continue
            names, of = representatives(symbols, owner, starts), owner[starts]
            order = np.lexsort((names, of))
            names, of = names[order], of[order]
            fresh = np.ones(len(names), bool)
            fresh[1:] = (names[1:] != names[:-1]) | (of[1:] != of[:-1])
            out.add(names[fresh], ids[of[fresh]])
            if out.count >= HELD:
                yield from out.blocks()
        yield from out.blocks()

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """All names of one bucket after the other."""
    bucket, held = None, []
    for batch in batches:
        for number, body in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if number != bucket and held:
                yield tuple(np.concatenate(parts) for parts in zip(*held))
                held = []
            bucket = number
            held.append(read_block(body))
    if held:
        yield tuple(np.concatenate(parts) for parts in zip(*held))


def _shared(buckets: int, later_only: bool):
    """Names that two documents have go back to them; with ``later_only`` not to the smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Names(buckets, by_doc=True)
        for names, docs, checks in _buckets(batches):
            keys = (docs, checks, names) if len(checks) else (docs, names)
            order = np.lexsort(keys)
            names, docs = names[order], docs[order]
            new = np.ones(len(names), bool)
            new[1:] = names[1:] != names[:-1]
            if len(checks):
                checks = checks[order]
                new[1:] |= checks[1:] != checks[:-1]
            group = np.cumsum(new) - 1
            smallest = docs[new]
            largest = docs[np.append(np.flatnonzero(new)[1:], len(docs)) - 1]
            told = docs > smallest[group] if later_only else (largest > smallest)[group]
            if told.any():
                out.add(names[told], docs[told])
                if out.count >= HELD:
                    yield from out.blocks()
        yield from out.blocks()

    return run


class Returned:
    """The names that came back to the documents of the bucket at hand."""

    def __init__(self) -> None:
        self.bucket: int | None = None
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.names = self.docs = None

    def take(self, bucket: int, body: bytes) -> None:
        if bucket != self.bucket:
            self.bucket, self.held = bucket, []
        names, docs, _ = read_block(body)
        self.held.append((names, docs))
        self.names = None

    def of(self, bucket: int, doc: int | None) -> np.ndarray:
        if doc is None or bucket != self.bucket:
            return np.zeros(0, np.uint64)
        if self.names is None:
            names, docs = (np.concatenate(parts) for parts in zip(*self.held))
            order = np.argsort(docs, kind="stable")
            self.names, self.docs = names[order], docs[order]
        low, high = np.searchsorted(self.docs, (doc, doc + 1))
        return self.names[low:high]


def _name_windows(buckets: int):
    """Windows of the documents' shared representatives, dealt out by their own names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, back = Names(buckets, by_doc=False), Returned()
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            known: list[tuple[int, np.ndarray, list[bytes]]] = []
            size = 0
            for number, kind, doc, body in zip(*(c.to_pylist() for c in batch.columns[:4])):
                if kind == 0:
                    back.take(number, body)
                    continue
                wanted = back.of(number, doc)
                if len(wanted):
                    raw = unpack(body)
                    known.append((doc, wanted, raw.split()))
                    size += len(raw)
                if size >= CHUNK:
                    _add_windows(out, known)
                    known, size = [], 0
                if out.count >= HELD:
                    yield from out.blocks()
            _add_windows(out, known)
        yield from out.blocks()

    return run


def _add_windows(out: Names, known: list[tuple[int, np.ndarray, list[bytes]]]) -> None:
    if not known:
        return
    symbols, owner = word_symbols([words for _, _, words in known])
    starts = window_starts(owner)
    names, of = representatives(symbols, owner, starts), owner[starts]
    # Document and name in one number; a chance agreement only names a window too many.
    salt = np.arange(len(known), dtype=np.uint64) * _B
    wanted = np.concatenate([digest(one + salt[k : k + 1]) for k, (_, one, _) in enumerate(known)])
    chosen = np.flatnonzero(np.isin(digest(names + salt[of]), wanted))
    ids = np.array([doc for doc, _, _ in known], np.int64)
    checks = (names[chosen] >> np.uint64(32)).astype(np.uint32)
    out.add(window_names(symbols, starts[chosen]), ids[of[chosen]], checks)


def covered(words: list[bytes], removed: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words a window with one of the names ``removed`` covers."""
    symbols, owner = word_symbols([words])
    starts = window_starts(owner)
    hit = starts[np.isin(window_names(symbols, starts), removed)]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + window, -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document, with the covered words removed."""
    back = Returned()
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in (part for whole in batches for part in batch_parts(whole, 3, CHUNK)):
        rows, count, gone, digests, texts = [], [], [], [], []
        columns = (batch.column(k).to_pylist() for k in range(4))
        for k, (number, kind, doc, body) in enumerate(zip(*columns)):
            if kind == 0:
                back.take(number, body)
                continue
            raw = unpack(body)
            words = raw.split()
            removed = back.of(number, doc)
            kept, text = words, raw
            if len(removed):
                inside = covered(words, removed)
                kept = [word for word, out in zip(words, inside) if not out]
                text = b" ".join(kept) if len(kept) < len(words) else raw
            rows.append(k)
            count.append(len(words))
            gone.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            texts.append(text.decode("utf-8", "surrogatepass"))
        if rows:
            rest = batch.column(4).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [rest, pa.array(count, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=["doc", "n_words", "n_removed", "kept_sha256", "text"],
            )


def _as_rows(buckets: int):
    """Documents as rows of the same shape as blocks of names, beside their other columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for part in (part for batch in batches for part in batch_parts(batch, 1, CHUNK)):
            ids = part.column(0)
            bucket = doc_bucket(ids.fill_null(0).to_numpy(), buckets)
            texts = part.column(1).cast(pa.binary()).to_pylist()
            kind = np.ones(part.num_rows, np.int32)
            bodies = pa.array([packer.compress(text) for text in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(kind), ids, bodies, part.column(2)],
                names=["bucket", "kind", "doc", "body", "rest"],
            )

    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc`` (the input row), ``n_words``, ``n_removed``, ``kept_sha256`` and ``text`` without the
    words that a window of ``WINDOW`` words covers which also starts in a smaller doc_id.

    Words are what stands between blanks, unchanged; kept words are joined by one space where
    something was removed, other texts stay as they are. A null text has no words, and a row without
    a doc_id neither loses words nor makes others lose any. Rows that share a doc_id lose nothing to
    each other.
    """
    spark = docs.sparkSession
    ship(spark)
    total = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    buckets = 2 * parts
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")
    chosen = docs.select(doc_id, text_of().alias("text"))
    kind = T.StructType.fromDDL(Names.SCHEMA)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")

    def with_documents(names: DataFrame, rest: Column) -> DataFrame:
        whole = docs.select(doc_id, text_of().alias("text"), rest)
        shape = T.StructType([*kind.fields, T.StructField("rest", whole.schema["rest"].dataType)])
        rows = whole.mapInArrow(frugal(_as_rows(buckets)), shape)
        empty = F.lit(None).cast(shape["rest"].dataType).alias("rest")
        return dealt(names.select("*", empty).unionByName(rows))

    parts_named = chosen.mapInArrow(frugal(_name_parts(buckets)), Names.SCHEMA)
    shared = dealt(parts_named).mapInArrow(frugal(_shared(buckets, later_only=False)), Names.SCHEMA)
    texts = with_documents(shared, F.lit(0).alias("rest"))
    windows = texts.mapInArrow(frugal(_name_windows(buckets)), Names.SCHEMA)
    repeated = dealt(windows).mapInArrow(frugal(_shared(buckets, later_only=True)), Names.SCHEMA)
    out = T.StructType(
        [
            T.StructField("doc", docs.select(others).schema["rest"].dataType),
            T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
            T.StructField("kept_sha256", T.StringType()), T.StructField("text", T.StringType()),
        ]
    )
    return with_documents(repeated, others).mapInArrow(frugal(_cut), out)


def repeats_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every document."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"), "n_words", "n_removed", "kept_sha256"
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, their texts without repeated passages; a column
    ``n_chars`` follows the text."""
    cut = remove_repeats(docs)
    columns = {c: F.col("doc").getField(c) for c in docs.columns if c != "text"}
    if "n_chars" in columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_removed") > 0, changed).otherwise(columns["n_chars"])
    return cut.select(*[columns.get(c, F.col("text")).alias(c) for c in docs.columns])


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, w[i : i + 12] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
), firsts AS (
  SELECT g, min(doc_id) AS first_id FROM windows GROUP BY g
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM windows JOIN firsts USING (g) WHERE doc_id > first_id
), removed AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n_words, len(coalesce(ps, [])) AS n_removed,
    list_filter(w, lambda x, k: ps IS NULL OR NOT list_contains(ps, k)) AS k
  FROM words LEFT JOIN removed USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""
