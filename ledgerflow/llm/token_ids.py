"""Ids of whole texts by a public tokenizer of the ``tokenizers`` library.

Encoding a text in one call is slow when most words are new to the library's small cache. Texts are
therefore cut at spaces and line feeds that no token can cross, the library encodes each distinct
unit once, and a bounded dictionary remembers its ids. A unit of plain letters goes straight to the
library's model, ASCII marks after them are learnt apart, any other unit goes through its whole
pipeline. Where white space only separates words, Arrow finds a column's distinct units, so Python meets
each of them once. Parts of a text that are not plainly safe to
cut (repeated white space, tabs and the like) are encoded uncut.
"""

from __future__ import annotations

import string
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units remembered by one Python worker, about 200 bytes each.
MAX_UNITS = 400_000
#: Longer units are not remembered.
LONG_UNIT = 64
#: Marks that the tokenizers' patterns always part from letters before them; an apostrophe may begin a
#: contraction.
MARKS = string.punctuation.replace("'", "")
#: Letters below this are of the same class and composition in every Unicode version.
LATIN_END = "ɐ"
LATIN = "".join(letter for letter in map(chr, range(ord(LATIN_END))) if letter.isalpha())


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies spell bytes: printable Latin-1 stands for
    itself, the other bytes take the letters from U+0100 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Units(dict):
    """Ids by unit, learnt when first asked for. When ``most`` units are held, all but those asked for
    since half of them were new are forgotten, so frequent units are not learnt again."""

    def __init__(self, learn: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.learn, self.half = learn, max(most // 2, 1)
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.learn(unit)
            if len(unit) > LONG_UNIT:
                return ids
        self[unit] = ids
        return ids

    def turn(self) -> None:
        """Forget what was not asked for lately; call it when no lookup is under way."""
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()


class UnitEncoder:
    """``keeps_space``: a space belongs to the word after it (byte-level vocabularies); otherwise
    white space only separates words and case is folded."""

    def __init__(self, path: str, keeps_space: bool, max_units: int = MAX_UNITS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keeps_space = keeps_space
        # A special token's string in a text is that token, as the library has it by default; only
        # these tokens, and what stands beside them, are not cut at blanks alone.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(" " in t or "\n" in t for t in self.special):
            raise ValueError(f"tokens that hold white space are not supported: {path}")
        # Letters, and marks after them, hold no special token that begins otherwise.
        self.spells = not any(t[:1].isalpha() for t in self.special)
        self.letters = byte_letters()
        self.marks = Units(self._library, max_units // 8)
        self.newline = self._library("\n") if keeps_space else b""
        self.first = Units(self._learn_first, max_units // 8 if keeps_space else max_units)
        self.after = Units(self._learn_after, max_units)

    def _library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _spelt(self, spelt: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(spelt)]).tobytes()

    def _plain(self, word: str) -> bool:
        return self.spells and word.isalpha() and (word.isascii() or max(word) < LATIN_END)

    def _learn_after(self, unit: str) -> bytes:
        """Ids of a unit with the space before it; a word is learnt once, whatever marks follow."""
        if self._plain(unit):
            return self._spelt("Ġ" + (unit if unit.isascii() else self._letters(unit)))
        word = unit.rstrip(MARKS)
        if word != unit and self._plain(word):
            return self.after[word] + self.marks[unit[len(word) :]]
        return self._library(f" {unit}")

    def _learn_first(self, unit: str) -> bytes:
        """Ids of a unit with nothing before it."""
        word = unit if self.keeps_space else unit.lower()
        if self._plain(word):
            if word != unit:
                return self.first[word]
            return self._spelt(word if word.isascii() else self._letters(word))
        word = unit.rstrip(MARKS)
        if word != unit and self._plain(word):
            return self.first[word] + self.marks[unit[len(word) :]]
        return self._library(unit)

    def _letters(self, word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(self.letters)

    def _segments(self, text: str) -> list[str]:
        """Parts of a text between line feeds that have no white space beside them."""
        lines = text.split("\n")
        if len(lines) == 1:
            return lines
        out, current = [], lines[0]
        for line in lines[1:]:
            if current and line and not current[-1].isspace() and not line[0].isspace():
                out.append(current)
                current = line
            else:
                current = f"{current}\n{line}"
        out.append(current)
        return out

    def _segment(self, segment: str) -> bytes:
        units = segment.split(" ")
        if "" in units or len(segment.split()) != len(units):
            return self._library(segment)
        return self.first[units[0]] + b"".join(map(self.after.__getitem__, units[1:]))

    def _folded(self, texts: pa.Array) -> pa.Array:
        """The texts, A-Z lowered where the library would compose no letter anew after that."""
        beyond = pc.match_substring_regex(texts, f"[^\\x{{0}}-\\x{{{ord(LATIN_END) - 1:X}}}]")
        low = pc.if_else(beyond, texts, pc.ascii_lower(texts))
        for token in self.special:  # found as they are written
            found, written = (pc.count_substring(t, token) for t in (low, texts))
            low = pc.if_else(pc.equal(found, written), low, texts)
        return low

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and how many each text has; white space must only separate words."""
        self.first.turn()
        self.marks.turn()
        folded = pc.replace_substring(self._folded(texts), "\n", " ")
        split = pc.split_pattern(folded, " ")
        units = split.flatten().dictionary_encode()
        whole, place = units.dictionary, units.indices.to_numpy()
        stems = pc.utf8_rtrim(whole, MARKS)
        plain = pc.and_(pc.equal(pc.utf8_ltrim(stems, LATIN), ""), pc.not_equal(stems, ""))
        if not self.spells:
            plain = pc.and_(plain, False)
        stems = pc.if_else(plain, stems, whole).dictionary_encode()
        tails = pc.if_else(plain, pc.utf8_ltrim(whole, LATIN), "").dictionary_encode()
        known = [*map(self.first.__getitem__, _strings(stems.dictionary))]
        first_tail = len(known)
        known += map(self.marks.__getitem__, _strings(tails.dictionary))
        pieces = np.column_stack([stems.indices.to_numpy(), tails.indices.to_numpy() + first_tail])
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = _gather(np.frombuffer(b"".join(known), "<u4"), sizes, pieces.reshape(-1))
        sizes = sizes[pieces].sum(axis=1)
        ids = _gather(ids, sizes, place)
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        upto = np.append(0, np.cumsum(sizes[place]))[ends]
        return ids, np.diff(upto, prepend=0)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if not self.keeps_space:
            ids, sizes = self.encode_column(pa.array(texts, pa.string()))
            return [part.tobytes() for part in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []
        for units in (self.first, self.after, self.marks):
            units.turn()
        return [self.newline.join(map(self._segment, self._segments(t))) if t else b"" for t in texts]


def _strings(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def _gather(ids: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Runs of ``ids``, which lie there one after another with ``sizes``, in the order of ``places``."""
    count = sizes[places]
    shift = (np.cumsum(sizes) - sizes)[places] - (np.cumsum(count) - count)
    return ids[np.repeat(shift, count) + np.arange(count.sum())]


@lru_cache(maxsize=2)
def unit_encoder(path: str, keeps_space: bool, max_units: int = MAX_UNITS) -> UnitEncoder:
    return UnitEncoder(path, keeps_space, max_units)


def forget_units() -> None:
    """Let go of what this worker's encoders remember."""
    unit_encoder.cache_clear()
