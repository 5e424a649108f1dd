"""Byte-pair encoding and decoding by merge rounds over many words at once.

Texts are cut into units at spaces and line feeds that no token can cross, and units into words as the
tokenizer's file says. The words that are new to a part of the corpus lie in one flat numpy array of
symbols, bytes at first. A round finds the rank of every neighbouring pair by binary search in the
sorted keys of all merges, the lowest rank of each word, and merges that pair wherever the word holds
it; only pairs beside a merge are looked up again, and a word without a known pair leaves. Ids of a
bounded number of units are remembered, so a text is put together by one gather. Decoding gathers the
bytes of all ids from one table.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.common import batch_parts, frugal, ship, text_of
from ledgerflow.llm.token_ids import LATIN_END, LONG_UNIT, byte_letters

#: Units remembered by one Python worker, and the ids that all units held may have together.
MAX_UNITS, MAX_IDS = 300_000, 8_000_000
#: Rounds over a longer word would cost its length squared; it is merged in order of rank from a heap.
LONG_WORD = 400
#: No pair of this rank exists.
NO_RANK = np.int32(2**31 - 1)
#: How the byte-level pre-tokenizer parts words (fixed value of that format).
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class MergeTable:
    """Merges of a byte-level tokenizer file, as sorted pair keys, and the bytes of each id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        plain = {
            "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
            "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False,
        }
        split = spec["pre_tokenizer"] or {}
        if (
            any(model.get(name) or value for name, value in plain.items())
            or spec["normalizer"]
            or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space")
            or not split.get("use_regex", True)
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.count = 1 + max([*vocab.values(), *self.special.values()])
        self.byte_ids = np.array([vocab.get(letters[b], -1) for b in range(256)], np.int64)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.count + right
        # Of a pair that is listed twice, the last entry counts, as in the library.
        order = np.argsort(keys, kind="stable")
        last = np.append(keys[order][1:] != keys[order][:-1], True) if len(keys) else np.zeros(0, bool)
        self.ranks = order[last].astype(np.int32)
        self.keys = keys[self.ranks]
        # Where every merge comes after those that make its two parts, no merge makes a pair of a
        # lower rank, and a round may take all places of a word's lowest pair.
        made = np.full(self.count, -1, np.int64)
        np.maximum.at(made, self.merged, np.arange(len(pairs)))
        self.ordered = bool(np.all(np.maximum(made[left], made[right]) < np.arange(len(pairs))))
        self.byte_of = {letter: b for b, letter in letters.items()}
        spelt = [b""] * self.count
        for token, key in vocab.items():
            if all(c in self.byte_of for c in token):
                spelt[key] = bytes(self.byte_of[c] for c in token)
            else:
                spelt[key] = token.encode("utf-8")
        for token, key in self.special.items():
            spelt[key] = token.encode("utf-8")
        self.known = np.zeros(self.count, bool)
        self.known[[*vocab.values(), *self.special.values()]] = True
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.spelt_ends = np.cumsum([len(s) for s in spelt], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where no merge takes it."""
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        key = left * self.count + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]


def merge_rounds(
    table: MergeTable, symbols: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each has. No word is empty."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(lengths) - 1] = True

    def look_up(at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at these places."""
        return np.where(last[at], NO_RANK, table.rank(symbols[at], symbols[np.minimum(at + 1, len(symbols) - 1)]))

    rank = look_up(np.arange(len(symbols)))
    done_symbols, done_words = [], []
    while len(symbols):
        starts = np.flatnonzero(np.append(True, last[:-1]))
        lowest = np.minimum.reduceat(rank, starts)
        open_word = np.repeat(lowest != NO_RANK, np.diff(np.append(starts, len(symbols))))
        if not open_word.all():
            done_symbols.append(symbols[~open_word])
            done_words.append(word[~open_word])
            symbols, word, last, rank = (a[open_word] for a in (symbols, word, last, rank))
            lowest = lowest[lowest != NO_RANK]
            if not len(symbols):
                break
            starts = np.flatnonzero(np.append(True, last[:-1]))
        sizes = np.diff(np.append(starts, len(symbols)))
        hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
        if table.ordered:
            # Of overlapping places (the same symbol again and again) every second one from the left.
            fresh = np.append(True, np.diff(hit) != 1)
            run = np.flatnonzero(fresh)
            hit = hit[(np.arange(len(hit)) - run[np.cumsum(fresh) - 1]) % 2 == 0]
        else:
            hit = hit[np.append(True, word[hit][1:] != word[hit][:-1])]
        symbols[hit] = table.merged[rank[hit]]
        last[hit] = last[hit + 1]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        place = (np.cumsum(keep) - 1)[hit]
        symbols, word, last, rank = (a[keep] for a in (symbols, word, last, rank))
        touched = np.concatenate([place, place[place > 0] - 1])
        rank[touched] = look_up(touched)
    if not done_words:
        return symbols, np.zeros(len(lengths), np.int64)
    flat, owner = np.concatenate(done_symbols), np.concatenate(done_words)
    return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))


def merge_long(table: MergeTable, symbols: np.ndarray) -> list[int]:
    """Ids of one long word, its pairs merged in order of rank, then from the left."""
    ids: list[int | None] = symbols.tolist()
    after = list(range(1, len(ids) + 1))
    before = list(range(-1, len(ids) - 1))
    pair_rank: dict[tuple[int, int], int] = {}

    def rank_of(a: int, b: int) -> int:
        if (a, b) not in pair_rank:
            pair_rank[a, b] = int(table.rank(np.array([a]), np.array([b]))[0])
        return pair_rank[a, b]

    first = table.rank(symbols[:-1], symbols[1:])
    heap = [(int(first[k]), k, ids[k], ids[k + 1]) for k in np.flatnonzero(first != NO_RANK).tolist()]
    heapq.heapify(heap)
    while heap:
        rank, k, a, b = heapq.heappop(heap)
        right = after[k]
        if ids[k] != a or right >= len(ids) or ids[right] != b:
            continue
        ids[k], ids[right] = int(table.merged[rank]), None
        after[k] = after[right]
        if after[k] < len(ids):
            before[after[k]] = k
        for one in (before[k], k):
            if one >= 0 and after[one] < len(ids):
                found = rank_of(ids[one], ids[after[one]])
                if found != NO_RANK:
                    heapq.heappush(heap, (found, one, ids[one], ids[after[one]]))
    return [k for k in ids if k is not None]


class Slots(dict):
    """The number of each unit; new ones are numbered and noted."""

    def __init__(self, number: Callable[[str], int], prefix: str) -> None:
        super().__init__()
        self.number, self.prefix = number, prefix

    def __missing__(self, unit: str) -> int:
        slot = self.number(self.prefix + unit)
        if len(unit) <= LONG_UNIT:
            self[unit] = slot
        return slot


class MergeCodec:
    """Encodes and decodes as the tokenizer library does with the same file."""

    def __init__(self, path: str, max_units: int = MAX_UNITS, max_ids: int = MAX_IDS) -> None:
        import regex
        from tokenizers import Tokenizer

        self.table = MergeTable(path)
        self.max_units, self.max_ids = max_units, max_ids
        self.parts = regex.compile(PARTS).findall
        # Letters of young Unicode versions are parted as the library itself parts them.
        self.library_parts = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = sorted(self.table.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.restart()

    def restart(self) -> None:
        """Forget all units but those of special tokens."""
        self.fresh: list[str] = []
        self.slots = 0
        self.first, self.after = Slots(self._number, ""), Slots(self._number, " ")
        self.lengths = np.zeros(1024, np.int64)
        self.starts = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.held = 0
        self.special_slots = {}
        for token, key in self.table.special.items():
            self.special_slots[token] = self.slots
            self._append(np.array([key]), np.array([1]))
            self.slots += 1

    def _number(self, unit: str) -> int:
        self.fresh.append(unit)
        self.slots += 1
        return self.slots - 1

    def _append(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Ids of the units that come next by number."""
        first = self.slots - len(self.fresh)
        while first + len(lengths) > len(self.lengths):
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while self.held + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.held : self.held + len(ids)] = ids
        self.lengths[first : first + len(lengths)] = lengths
        self.starts[first : first + len(lengths)] = self.held + np.cumsum(lengths) - lengths
        self.held += len(ids)

    def _words(self, unit: str) -> list[bytes]:
        """The words of a unit, as bytes."""
        if max(unit) < LATIN_END:
            return [part.encode("utf-8") for part in self.parts(unit)]
        byte_of = self.table.byte_of
        return [bytes(byte_of[c] for c in part) for part, _ in self.library_parts(unit)]

    def _learn(self) -> None:
        """Merge rounds over the words of all new units."""
        if not self.fresh:
            return
        numbers: dict[bytes, int] = {}
        of_unit = [[numbers.setdefault(w, len(numbers)) for w in self._words(u)] for u in self.fresh]
        words = list(numbers)
        sizes = np.array([len(w) for w in words], np.int64)
        flat = self.table.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        if (flat < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        long = np.flatnonzero(sizes > LONG_WORD)
        short = np.repeat(sizes <= LONG_WORD, sizes)
        ids, counts = merge_rounds(self.table, flat[short], sizes[sizes <= LONG_WORD])
        if len(long):
            merged = [np.array(merge_long(self.table, flat[e - n : e]), np.int64)
                      for e, n in zip(np.cumsum(sizes)[long], sizes[long])]
            lengths = np.zeros(len(words), np.int64)
            lengths[sizes <= LONG_WORD], lengths[long] = counts, [len(m) for m in merged]
            both = np.concatenate([ids, *merged])
            starts = np.zeros(len(words), np.int64)
            starts[sizes <= LONG_WORD] = np.cumsum(counts) - counts
            starts[long] = len(ids) + np.cumsum(lengths[long]) - lengths[long]
            ids, counts = gather(both, starts, lengths), lengths
        of_word = np.fromiter((w for some in of_unit for w in some), np.int64)
        unit_words = np.array([len(some) for some in of_unit])
        starts = np.cumsum(counts) - counts
        unit_ids = np.add.reduceat(counts[of_word], np.cumsum(unit_words) - unit_words)
        self._append(gather(ids, starts[of_word], counts[of_word]), unit_ids)
        self.fresh.clear()

    def _plain(self, text: str, out: list[int]) -> None:
        """Numbers of the units of a text without special tokens."""
        lines = text.split("\n")
        current = lines[0]
        for line in [*lines[1:], None]:
            if line is not None and not (
                current and line and not current[-1].isspace() and not line[0].isspace()
            ):
                current = f"{current}\n{line}"
                continue
            units = current.split(" ")
            if "" in units or len(current.split()) != len(units):
                if current:
                    out.append(self.first[current])
            else:
                out.append(self.first[units[0]])
                out.extend(map(self.after.__getitem__, units[1:]))
            if line is not None:
                out.append(self.first["\n"])
                current = line

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        numbers: list[int] = []
        ends = []
        for text in texts:
            if self.special is None or not self.special.search(text):
                self._plain(text, numbers)
            else:
                at = 0
                for match in self.special.finditer(text):
                    self._plain(text[at : match.start()], numbers)
                    numbers.append(self.special_slots[match.group()])
                    at = match.end()
                self._plain(text[at:], numbers)
            ends.append(len(numbers))
        self._learn()
        slots = np.array(numbers, np.int64)
        lengths = self.lengths[slots]
        flat = gather(self.ids, self.starts[slots], lengths)
        upto = np.append(0, np.cumsum(lengths))[np.append(0, ends).astype(np.int64)]
        if len(self.first) + len(self.after) > self.max_units or self.held > self.max_ids:
            self.restart()
        return flat, np.diff(upto)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """Texts of runs of ids; what is no UTF-8 becomes U+FFFD, ids of no token become nothing."""
        return decode(self.table, ids, lengths)


def decode(table: MergeTable, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
    ids = np.asarray(ids, np.int64)
    known = (ids >= 0) & (ids < table.count)
    ids = np.where(known, ids, 0)
    ends = table.spelt_ends[ids]
    sizes = np.where(known & table.known[ids], ends - np.append(0, table.spelt_ends)[ids], 0)
    raw = gather(table.spelt, ends - sizes, sizes).tobytes()
    upto = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(lengths)).astype(np.int64)].tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(upto, upto[1:])]


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


@lru_cache(maxsize=2)
def merge_codec(path: str) -> MergeCodec:
    return MergeCodec(path)


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. A null text is empty and has
    no ids, a null doc_id stays null, repeated rows give a row each, an empty table gives none. A
    special token's string in a text is that token, as the library has it by default. Rows stay in
    their task: there is no shuffle, and a task that runs again gives the same rows.
    """
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = merge_codec(tokenizer)
        for batch in batches:
            for part in batch_parts(batch, 1):
                flat, lengths = codec.encode(part.column(1).to_pylist())
                raw, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(lengths)).tolist()
                ids = [raw[a:b] for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], schema=schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return chosen.mapInArrow(frugal(run), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``text`` in place of ``ids`` in every row of ``encoded``; other columns stay as they are.

    Bytes that are no UTF-8 become U+FFFD, as in the library; null ids are none, and a null text.
    """
    ship(encoded.sparkSession)
    others = [c for c in encoded.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(tokenizer)
        last = len(others)
        for batch in batches:
            for part in batch_parts(batch, last, 4_000_000):
                column = part.column(last).to_pylist()
                ids = np.frombuffer(b"".join(raw or b"" for raw in column), "<u4")
                lengths = np.array([len(raw or b"") // 4 for raw in column], np.int64)
                texts = [None if raw is None else text
                         for raw, text in zip(column, decode(table, ids, lengths))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], pa.array(texts, pa.string())], names=[*others, "text"]
                )

    rows = encoded.select(*others, F.col("ids").cast("binary").alias("ids"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(frugal(run), f"{shape}, text string" if others else "text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, and digests of the ids and of the text decoded from them."""
    encoded = encode_documents(docs, tokenizer).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), "ids",
    )
    return decode_documents(encoded, tokenizer).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256")
    )
