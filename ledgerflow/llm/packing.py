"""Documents packed into sequences of a fixed number of tokens, by multiway differencing.

Whole windows are cut off the front of each document; what is left, at most a window less one token,
stays whole where it can. Rests are gathered into groups of bounded size inside the task that
tokenises them, and each group is packed by Karmarkar-Karp differencing: every rest starts as a
partial partition of its own, and the two partial partitions of the largest imbalance are merged with
opposing order, largest load against smallest, until one is left. Its loads are near equal. Where one
exceeds the window, the group is packed again into one window more, as far as the padding allows;
then what exceeds is cut off the largest rest of each window that is too full, and packed with the
others, documents of many windows being cut before others.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.common import batch_parts, frugal, ship, text_of
from ledgerflow.llm.token_ids import unit_encoder

WINDOW = 1024
#: Windows of a group; its rests are held in memory and differenced together.
GROUP_WINDOWS = 64
#: Windows that a group may take beyond those its tokens would fill, as a share, before rests are cut.
SPARE = 0.03
#: Rounds of cuts before the group takes a window more all the same.
CUT_ROUNDS = 16


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Places of ``sizes`` in ``ways`` parts of near-equal sums."""
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = []
    for k, size in enumerate(sizes):
        # A partial partition: its parts that are not empty, largest first.
        heap.append((-size, k, [(size, [k])]))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        free = ways - len(one)
        if len(two) > free:
            # The smallest parts of both meet, the largest of the one with the smallest of the other.
            meeting = len(two) - free
            ours, theirs = one[len(one) - meeting :], two[len(two) - meeting :]
            merged = one[: len(one) - meeting] + two[: len(two) - meeting]
            merged += [(a[0] + b[0], a[1] + b[1]) for a, b in zip(ours, reversed(theirs))]
        else:
            merged = one + two
        merged.sort(key=lambda part: -part[0])
        least = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (least - merged[0][0], turn, merged))
        turn += 1
    return [members for _, members in heap[0][2]] if heap else []


def pack_group(
    sizes: list[int], window: int, spare: float = SPARE, cut_first: list[bool] | None = None
) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (place in ``sizes``, start, length), each item in as few pieces as it can.

    No item is longer than a window. The number of windows rises while one is too full, up to
    ``spare`` beyond the least, and again when cuts do not help.
    """
    total = sum(sizes)
    pieces = [(k, 0, size) for k, size in enumerate(sizes)]
    ways = max(1, -(-total // window))
    most, rounds = max(ways, int(total / window * (1 + spare))), 0

    def gladly(k: int) -> tuple[bool, int]:
        return bool(cut_first and cut_first[pieces[k][0]]), pieces[k][2]

    while True:
        lengths = [piece[2] for piece in pieces]
        parts = differencing(lengths, ways)
        full = [(part, load - window) for part in parts if (load := sum(lengths[k] for k in part)) > window]
        if not full:
            return [[pieces[k] for k in part] for part in parts]
        if ways < most or rounds == CUT_ROUNDS:
            ways, rounds = ways + 1, 0
            continue
        for part, excess in full:
            k = max(part, key=gladly)
            item, start, length = pieces[k]
            kept = max(length - excess, length // 2, 1)
            if kept < length:
                pieces[k] = item, start, kept
                pieces.append((item, start + kept, length - kept))
        rounds += 1


PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)
PIECE = pa.schema([(part.split()[0], pa.int64()) for part in PACKED.split(", ")])


def pack(
    docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, window: int = WINDOW,
    group_windows: int = GROUP_WINDOWS, spare: float = SPARE, with_ids: bool = False,
) -> DataFrame:
    """One row per piece of ``docs`` (``doc_id``, ``text``), see PACKED.

    Null and empty texts are the end id alone, null doc_ids stay null, repeated rows are packed each
    on its own. Groups never leave their task, so there is no shuffle, and a task that runs again
    over the same input split gives the same rows. ``with_ids`` adds the ids themselves.
    """
    ship(docs.sparkSession)
    schema = PIECE.append(pa.field("ids", pa.binary())) if with_ids else PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = unit_encoder(tokenizer, keeps_space)
        end = np.uint32(end_id).tobytes()
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        held: list[tuple] = []
        load = 0

        def close() -> None:
            nonlocal held, load, sequence
            long = [total >= window for *_, total in held]
            for pieces in pack_group([len(raw) // 4 for _, _, raw, _ in held], window, spare, long):
                offset = 0
                for k, begin, length in pieces:
                    key, start, raw, total = held[k]
                    raw = raw[4 * begin : 4 * (begin + length)]
                    rows.append(
                        (key, start + begin, length, zlib.crc32(raw), total, sequence, offset)
                        + (raw,) * with_ids
                    )
                    offset += length
                sequence += 1
            held, load = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal rows
            columns = list(zip(*rows))
            rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

        for part in (part for batch in batches for part in batch_parts(batch, 1)):
            keys = part.column(0).to_pylist()
            for key, raw in zip(keys, encoder.encode(part.column(1).to_pylist())):
                raw += end
                total = len(raw) // 4
                start = 0
                while total - start >= window:
                    piece = raw[4 * start : 4 * (start + window)]
                    rows.append(
                        (key, start, window, zlib.crc32(piece), total, sequence, 0)
                        + (piece,) * with_ids
                    )
                    sequence += 1
                    start += window
                if start < total:
                    held.append((key, start, raw[4 * start :], total))
                    load += total - start
                if load >= group_windows * window:
                    close()
            if len(rows) >= 20_000:
                yield flush()
        if held:
            close()
        if rows:
            yield flush()

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return chosen.mapInArrow(frugal(run, encodes=True), PACKED + ", ids binary" * with_ids)
