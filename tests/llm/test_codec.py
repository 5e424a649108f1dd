"""Merge rounds against the tokenizer library, id by id."""

from __future__ import annotations

import hashlib
import json
import sys
from functools import lru_cache
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))
from documents import frame, odd_documents  # noqa: E402

from ledgerflow.llm import merge_codec  # noqa: E402
from ledgerflow.llm.queries import vocabulary  # noqa: E402

PATH = vocabulary("byte_bpe_50k.json")
ODD_TEXTS = [
    "", " ", "\n", "\n\n x", "a\nb", "a \n b", "tab\there", "it's WE'RE don't.", "x  y   z ", "\x1c a\x1f",
    "naïve café. Straße, ẞ İstanbul", "漢字 かな 한국어", "é ́x", "U.S.A. 3.14 1,000!", "😀 ok?", "\r\na\r",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>\n", "<|endoftext", "aaaaaaaaaaa" * 9,
    "ab" * 1500, "x" * 5000, "the" * 700 + " " + "é" * 900, "a b　c d",
]


@lru_cache(maxsize=1)
def the_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture
def library():
    return the_library()


def ids_of(codec, texts):
    flat, lengths = codec.encode(texts)
    ends = np.cumsum(lengths)
    return [flat[b - n : b].tolist() for b, n in zip(ends, lengths)]


@pytest.mark.parametrize("ordered", [True, False])
def test_ids_and_texts_are_the_librarys(library, ordered, monkeypatch):
    codec = merge_codec.MergeCodec(PATH, max_units=5)
    assert codec.table.ordered
    codec.table.ordered = ordered
    texts = ODD_TEXTS + [" ".join(ODD_TEXTS), "".join(ODD_TEXTS)]
    wanted = [library.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(3):
        assert ids_of(codec, texts) == wanted
        assert [found for text in texts for found in ids_of(codec, [text])] == wanted
    flat, lengths = codec.encode(texts)
    assert codec.decode(flat, lengths) == texts
    # Without the heap, rounds alone give the same ids.
    monkeypatch.setattr(merge_codec, "LONG_WORD", 10**9)
    codec.restart()
    assert ids_of(codec, texts) == wanted


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\tabtheinzÉß.,!'1漢́<|>")), max_size=30), max_size=4))
def test_any_texts_have_the_librarys_ids(texts):
    codec, library = merge_codec.merge_codec(PATH), the_library()
    assert ids_of(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_any_ids_are_decoded_as_by_the_library(library):
    """Also runs of ids that are no whole characters."""
    draw = np.random.default_rng(3)
    table = merge_codec.merge_table(PATH)
    runs = [draw.integers(0, table.count, draw.integers(0, 9)).tolist() for _ in range(600)]
    runs += [draw.integers(90, 256, 5).tolist() for _ in range(600)]
    found = merge_codec.decode(table, np.concatenate(runs), np.array([len(r) for r in runs]))
    assert found == [library.decode(run, skip_special_tokens=False) for run in runs]


def test_tables_in_any_order_of_merges(tmp_path):
    """A merge listed before those that make its parts: one merge a round, as the library does."""
    from tokenizers import Tokenizer

    merges = [["ab", "c"], ["b", "c"], ["a", "b"], ["c", "ab"], ["bc", "bc"], ["a", "a"], ["aa", "a"]]
    letters = [chr(c) for c in range(97, 123)] + ["Ġ"]
    tokens = letters + [a + b for a, b in merges]
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"] |= {"vocab": {t: k for k, t in enumerate(tokens)}, "merges": merges}
    spec["added_tokens"] = []
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    library, codec = Tokenizer.from_file(str(path)), merge_codec.MergeCodec(str(path))
    assert not codec.table.ordered
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice(list("aabbc "), 25)) for _ in range(300)]
    assert ids_of(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        merge_codec.MergeTable(vocabulary("word_bpe_49k.json"))


def test_round_trip_of_awkward_documents(spark, library):
    rows = odd_documents()
    found = merge_codec.round_trip(frame(spark, rows), PATH).collect()
    expected = []
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digests = [np.array(ids, "<u4").tobytes(), back.encode("utf-8")]
        expected.append((key, len(ids), *(hashlib.sha256(d).hexdigest() for d in digests)))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert merge_codec.round_trip(frame(spark, []), PATH).count() == 0


def test_other_columns_pass_the_decoder(spark):
    docs = frame(spark, odd_documents()[:20])
    encoded = merge_codec.encode_documents(docs, PATH).withColumnRenamed("doc_id", "label")
    rows = merge_codec.decode_documents(encoded, PATH).collect()
    assert sorted((r.label, r.text) for r in rows) == sorted((r.doc_id, r.text or "") for r in docs.collect())
