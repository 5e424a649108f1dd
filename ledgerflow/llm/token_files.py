"""Token ids in binary files: patched frame-of-reference blocks with an index.

A file holds whole documents in order. Their ids are cut into blocks of ``BLOCK`` ids. A block
stores its smallest id; what each id exceeds it by is packed at one width, chosen as the bits that
``SHARE`` of the block's ids need; ids that need more are patched from a list of exceptions.

File layout, little-endian::

    "PFB1" | block count u32 | id count u64 | document count u32
    per block: offset u64, minimum u32, width u8, exceptions u16   (the index)
    per document: id u64 (two's complement), null flag u8, first id's place u64
    blocks: packed bits, then exceptions as (place u16, excess u32)
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.llm.common import batch_parts, frugal, ship, text_of
from ledgerflow.llm.token_ids import MAX_UNITS, unit_encoder
from ledgerflow.session import scratch_path, stage

MAGIC = b"PFB1"
BLOCK = 1024
#: Share of a block's ids that its width must hold; the others are exceptions.
SHARE = 0.9
#: A file is closed once it holds this many ids; a reader holds one file in memory.
FILE_IDS = 1_000_000
#: Texts of about this size are encoded together, so that a unit is looked up once in all of them.
PART_BYTES = 4_000_000
HEAD = struct.Struct("<4sIQI")
INDEX = np.dtype([("at", "<u8"), ("low", "<u4"), ("width", "u1"), ("patched", "<u2")])
DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("first", "<u8")])
PATCH = np.dtype([("place", "<u2"), ("excess", "<u4")])


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned values to rows of bytes, ``width`` bits each, lowest bit first."""
    if width == 0:
        return np.zeros((len(values), 0), np.uint8)
    size = 8 * ((width + 7) // 8)
    raw = values.astype("<u4").view(np.uint8).reshape(*values.shape, 4)[..., : size // 8]
    bits = np.unpackbits(np.ascontiguousarray(raw), axis=-1, bitorder="little")[..., :width]
    return np.packbits(bits.reshape(len(values), -1), axis=-1, bitorder="little")


def unpack_bits(packed: np.ndarray, width: int, count: int) -> np.ndarray:
    """Rows of ``count`` values of ``width`` bits; eight of them take ``width`` whole bytes."""
    rows = len(packed)
    if width == 0:
        return np.zeros((rows, count), np.uint32)
    eights = -(-count // 8)
    raw = np.zeros((rows, eights * width), np.uint8)
    raw[:, : packed.shape[1]] = packed
    raw = np.ascontiguousarray(raw.reshape(-1, width).T)
    out = np.empty((rows * eights, 8), np.uint32)
    for k in range(8):
        at, shift = divmod(k * width, 8)
        size = (shift + width + 7) // 8
        kind = np.uint32 if size <= 4 else np.uint64
        value = raw[at].astype(kind)
        for byte in range(1, size):
            value |= raw[at + byte].astype(kind) << kind(8 * byte)
        out[:, k] = (value >> kind(shift)) & kind((1 << width) - 1)
    return out.reshape(rows, -1)[:, :count]


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Index and blocks of an id sequence. The last block is filled up with its own last id."""
    count = -(-len(ids) // BLOCK)
    index = np.zeros(count, INDEX)
    if not count:
        return index, b""
    whole = np.full(count * BLOCK, ids[-1], np.uint32)
    whole[: len(ids)] = ids
    whole = whole.reshape(count, BLOCK)
    low = whole.min(axis=1)
    excess = whole - low[:, None]
    needed = np.frexp(excess.astype(np.float64))[1].astype(np.uint8)  # bits of each excess
    place = min(BLOCK - 1, int(np.ceil(SHARE * BLOCK)) - 1)
    width = np.partition(needed, place, axis=1)[:, place]
    over = needed > width[:, None]
    index["low"], index["width"], index["patched"] = low, width, over.sum(axis=1)
    bodies: list[bytes] = [b""] * count
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        kept = np.where(over[rows], 0, excess[rows])
        for row, packed in zip(rows, pack_bits(kept, int(w))):
            places = np.flatnonzero(over[row])
            patches = np.empty(len(places), PATCH)
            patches["place"], patches["excess"] = places, excess[row, places]
            bodies[row] = packed.tobytes() + patches.tobytes()
    sizes = np.array([len(body) for body in bodies], np.uint64)
    index["at"] = np.cumsum(sizes) - sizes
    return index, b"".join(bodies)


def decode_blocks(index: np.ndarray, body: bytes, ids: int) -> np.ndarray:
    whole = np.empty((len(index), BLOCK), np.uint32)
    raw = np.frombuffer(body, np.uint8)
    for w in np.unique(index["width"]):
        rows = np.flatnonzero(index["width"] == w)
        size = (int(w) * BLOCK + 7) // 8
        starts = index["at"][rows].astype(np.int64)
        packed = raw[starts[:, None] + np.arange(size)]
        whole[rows] = unpack_bits(packed, int(w), BLOCK)
        for row, start in zip(rows, starts):
            patched = int(index["patched"][row])
            if patched:
                patches = np.frombuffer(body, PATCH, patched, int(start) + size)
                whole[row, patches["place"]] = patches["excess"]
    whole += index["low"][:, None]
    return whole.reshape(-1)[:ids]


def encode_file(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    index, body = encode_blocks(ids)
    table = np.zeros(len(docs), DOCUMENT)
    table["id"] = [0 if d is None else d for d in doc_ids]
    table["null"] = [d is None for d in doc_ids]
    sizes = np.array([len(d) for d in docs], np.uint64)
    table["first"] = np.cumsum(sizes) - sizes
    head = HEAD.pack(MAGIC, len(index), len(ids), len(docs))
    return head + index.tobytes() + table.tobytes() + body


def decode_file(raw: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    magic, blocks, ids, docs = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size
    index = np.frombuffer(raw, INDEX, blocks, at)
    at += index.nbytes
    table = np.frombuffer(raw, DOCUMENT, docs, at)
    at += table.nbytes
    values = decode_blocks(index, raw[at:], ids)
    names = [None if n else int(d) for d, n in zip(table["id"], table["null"])]
    return names, np.split(values, table["first"][1:].astype(np.int64)) if docs else []


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


WRITTEN = "path string, first_doc long, part long, file int, ids long, docs long"
WRITTEN_ARROW = pa.schema(
    [("path", pa.string()), ("first_doc", pa.int64()), ("part", pa.int64()), ("file", pa.int32()),
     ("ids", pa.int64()), ("docs", pa.int64())]
)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, keeps_space: bool, end_id: int,
    files: int | None = None, max_units: int = MAX_UNITS,
) -> DataFrame:
    """Write ``doc_id`` and ``text`` as token files into ``folder``, in ascending doc_id order.

    ``max_units`` bounds the units whose ids a Python worker remembers, about 200 bytes each.

    Returns one row per file: its path, its part and place in the part (their order is that of the
    ids), ids and documents. Null texts are empty, null doc_ids come first, rows that share a
    doc_id are ordered by text. Each attempt of a task writes files of its own name, and only those
    that the returned rows list count, so a task that is run again leaves the result as it is.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = unit_encoder(tokenizer, keeps_space, max_units)
        system, root = _open(folder)
        end = np.uint32(end_id)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        names: list[int | None] = []
        held: list[np.ndarray] = []
        ids = number = 0

        def close() -> pa.RecordBatch:
            nonlocal names, held, ids, number
            path = posixpath.join(root, f"part-{part:06d}-{number:05d}-{attempt}.pfb")
            with system.open_output_stream(path) as out:
                out.write(encode_file(names, held))
            full = posixpath.join(folder, posixpath.basename(path))
            row = [full], [names[0]], [part], [number], [ids], [len(held)]
            names, held, ids, number = [], [], 0, number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(row, WRITTEN_ARROW)], schema=WRITTEN_ARROW
            )

        system.create_dir(root, recursive=True)
        def encoded(texts: pa.Array) -> Iterator[np.ndarray]:
            if keeps_space:
                yield from (np.frombuffer(raw, "<u4") for raw in encoder.encode(texts.to_pylist()))
                return
            found, sizes = encoder.encode_column(texts)
            yield from np.split(found, np.cumsum(sizes)[:-1])

        for part_rows in (some for batch in batches for some in batch_parts(batch, 1, PART_BYTES)):
            keys = part_rows.column(0).to_pylist()
            for key, found in zip(keys, encoded(part_rows.column(1))):
                names.append(key)
                held.append(np.append(found, end))
                ids += len(held[-1])
                if ids >= FILE_IDS:
                    yield close()
        if held:
            yield close()

    ship(docs.sparkSession)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    keys = ["doc_id"]
    ranged = chosen.repartitionByRange(files, *keys) if files else chosen.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    return stage(ordered.mapInArrow(frugal(write, encodes=True), WRITTEN), "token-files")



def read_token_files(written: DataFrame, keep_ids: bool = True) -> DataFrame:
    """Documents of the listed files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids`` (little-endian unsigned 32-bit)."""
    ship(written.sparkSession)
    # One row per file, so the window is as small as the list of files of one part's order.
    order = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    based = written.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
         ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * keep_ids
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, place = _open(path)
                with system.open_input_stream(place) as source:
                    names, docs = decode_file(source.read())
                sizes = np.array([len(d) for d in docs], np.int64)
                raw = [d.astype("<u4").tobytes() for d in docs]
                columns = [names, base + np.cumsum(sizes) - sizes, sizes, [zlib.crc32(r) for r in raw]]
                columns += [raw] * keep_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    shown = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    # One file a task, as far as that goes; a given number is not coalesced again.
    spread = based.select("path", "base").repartition(max(1, min(written.count(), 10_000)))
    return spread.mapInArrow(frugal(read), shown)


def token_file_folder(docs: DataFrame) -> str:
    """A new folder in the place that all executors share."""
    return scratch_path(docs.sparkSession, "tokens")
