"""Packing, token files and the WARC archive: exact round trips over awkward rows."""

from __future__ import annotations

import base64
import hashlib
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))
from documents import frame, odd_documents  # noqa: E402

from ledgerflow.llm import common, packing, token_files, token_ids, warc  # noqa: E402
from ledgerflow.llm.queries import vocabulary  # noqa: E402
from ledgerflow.session import scratch_path  # noqa: E402

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


def library_ids(name, text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [
    "", " ", "\n", "\n\n x", "a\nb", "a \n b", "tab\there", "it's WE'RE don't.", "x  y   z ", "\x1c a\x1f",
    "naïve café. Straße, ẞ İstanbul", "漢字 かな 한국어", "é ́x", "U.S.A. 3.14 1,000!", "😀 ok?",
    "Σίσυφος ΟΔΟΣ.", "<|endoftext|> <|startoftext|>", "a b c", "!?.,;:", ". , x", "\r\na\r",
]


@pytest.mark.parametrize("name, keeps_space", [(BYTES, True), (WORDS, False)])
def test_cutting_texts_changes_no_id(name, keeps_space):
    encoder = token_ids.UnitEncoder(vocabulary(name), keeps_space, max_units=3)
    for text in ODD_TEXTS + [" ".join(ODD_TEXTS)]:
        found = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert found == library_ids(name, text), text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\tabzAÉß.,!'1漢́ ")), max_size=30))
def test_cutting_any_text_changes_no_id(text):
    for name, keeps_space in ((BYTES, True), (WORDS, False)):
        encoder = token_ids.unit_encoder(vocabulary(name), keeps_space)
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library_ids(name, text)


@pytest.mark.parametrize("name, keeps_space", [(BYTES, True), (WORDS, False)])
def test_marks_after_words_and_special_tokens_change_no_id(name, keeps_space):
    encoder = token_ids.UnitEncoder(vocabulary(name), keeps_space)
    stems = ["heat", "HEAT", "Été", "J\u030cx", "it's", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>", "3", ""]
    tails = ["", ".", "***", "%%%\"", "'", "'s.", "_x", "\u0338", "=\u0338", "<|", ".\u0301"]
    texts = [f"x {stem}{tail} y\n{stem}{tail}" for stem in stems for tail in tails]
    library = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, raw, expected in zip(texts, encoder.encode(texts), library, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == expected.ids, text


def test_a_word_is_learnt_once_whatever_its_marks_and_case():
    encoder = token_ids.UnitEncoder(vocabulary(WORDS), False)
    encoder.encode(["heat Heat, heat*** HEAT%%%", "", "(heat"])
    assert sorted(encoder.first) == ["", "(heat", "heat"]


def test_workers_remember_units_only_for_operators_that_encode():
    for encodes, left in ((True, 1), (False, 0)):
        token_ids.forget_units()
        token_ids.unit_encoder(vocabulary(BYTES), True)
        assert list(common.frugal(lambda batches: batches, encodes)(iter([]))) == []
        assert token_ids.unit_encoder.cache_info().currsize == left


@pytest.mark.parametrize("count", [1, 7, 8, 1024])
def test_bits_of_any_width_come_back(count):
    for width in range(33):
        top = (1 << width) - 1
        rows = np.random.default_rng(width).integers(0, top, (2, count), np.uint64, endpoint=True)
        rows[0, 0] = top
        packed = token_files.pack_bits(rows.astype(np.uint32), width)
        assert (token_files.unpack_bits(packed, width, count) == rows).all()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_covers_every_token_once(spark):
    rows = odd_documents()
    pieces = packing.pack(frame(spark, rows), vocabulary(BYTES), True, 0, with_ids=True).collect()
    expected = sorted((r[0], crc([*library_ids(BYTES, r[1]), 0])) for r in rows if r[0] is not None)
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert crc(np.frombuffer(p.ids, "<u4")) == p.ids_crc32 and len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append(p)
        by_doc[p.doc_id, p.doc_tokens].append(p)
    for some in sequences.values():
        upto = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == upto
            upto += p.length
        assert 0 < upto <= 1024
    found = []
    for (key, total), some in by_doc.items():
        starts = defaultdict(list)
        for p in some:
            starts[p.start].append(p)
        copies = len(starts[0])
        for k in range(copies if key is not None else 0):
            raw, at = b"", 0
            while at < total:
                raw += starts[at][k].ids
                at += starts[at][k].length
            assert at == total
            found.append((key, zlib.crc32(raw)))
    assert sorted(found) == expected
    assert sum(p.length for p in pieces) == sum(len(library_ids(BYTES, r[1])) + 1 for r in rows)


def test_packing_leaves_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = packing.pack(docs.coalesce(1), vocabulary(BYTES), True, 0)
    loads = [r["sum(length)"] for r in pieces.groupBy("sequence_id").sum("length").collect()]
    assert sum(1024 - n for n in loads) < 0.03 * 1024 * len(loads)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.floats(0, 0.2))
def test_differencing_places_every_token_within_the_windows(sizes, spare):
    windows = packing.pack_group(sizes, 100, spare, [size > 50 for size in sizes])
    found = sorted(piece for pieces in windows for piece in pieces)
    wanted = [(k, at) for k, size in enumerate(sizes) for at in range(size)]
    assert [(k, at) for k, start, length in found for at in range(start, start + length)] == wanted
    assert all(0 < sum(piece[2] for piece in pieces) <= 100 for pieces in windows if pieces)


def test_short_documents_stay_nearly_whole(spark):
    """Whole rests are the items; cuts hold padding down, and documents of many windows take them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    pieces = packing.pack(docs, vocabulary(BYTES), True, 0).toPandas()
    loads = pieces.groupby("sequence_id")["length"].sum()
    assert 1 - loads.sum() / (1024 * len(loads)) < 0.015
    short = pieces[pieces.doc_tokens < 1024]
    assert len(short) / len(short.drop_duplicates("doc_id")) < 1.2


def test_differencing_balances():
    assert sorted(sum([8, 7, 6, 5, 4][k] for k in p) for p in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    assert packing.differencing([], 3) == []


def test_packing_nothing(spark):
    assert packing.pack(frame(spark, []), vocabulary(BYTES), True, 0).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), max_size=4))
def test_token_files_give_back_what_they_hold(docs):
    arrays = [np.array(d, np.uint32) for d in docs]
    keys = [None if k == 1 else -(10**12) * k for k in range(len(docs))]
    names, found = token_files.decode_file(token_files.encode_file(keys, arrays))
    assert names == keys and [f.tolist() for f in found] == docs


def test_outliers_are_exceptions_not_wider_blocks():
    ids = np.full(token_files.BLOCK, 7, np.uint32)
    ids[::100] = 40_000
    index, body = token_files.encode_blocks(ids)
    assert index["width"][0] == 0 and index["patched"][0] == len(ids[::100])
    assert (token_files.decode_blocks(index, body, len(ids)) == ids).all()


def test_token_files_in_document_order(spark, monkeypatch):
    rows = odd_documents()
    docs = frame(spark, rows)
    written = token_files.write_token_files(
        docs, scratch_path(spark, "tokens"), vocabulary(WORDS), False, 1, files=3
    )
    found = token_files.read_token_files(written).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for r in ordered:
        ids = [*library_ids(WORDS, r[1]), 1]
        expected.append((r[0], start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted((tuple(f)[:4] for f in found), key=lambda f: f[1]) == expected
    assert all(crc(np.frombuffer(f.ids, "<u4")) == f.ids_crc32 for f in found)


def test_no_token_files_of_nothing(spark):
    written = token_files.write_token_files(
        frame(spark, []), scratch_path(spark, "tokens"), vocabulary(WORDS), False, 1
    )
    assert token_files.read_token_files(written).count() == 0


PAGES = "page_id long, url string, html string, digest string, response string"


def odd_pages():
    rows = [(k, f"http://a/{k}", f"<p>{k % 7}</p>") for k in range(40)]
    rows += [
        (50, None, None), (51, "u", ""), (52, "x\r\nWARC-Type: revisit", "<p>0</p>"), (53, "ü", "ü" * 70_000),
        (None, "n", "<p>1</p>"), (None, "n", "only here"), (60, "a", "twice"), (60, "a", "twice"), (1, "b", "twice"),
    ]
    return rows


def test_archive_gives_back_every_record(spark):
    rows = odd_pages()
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    folder = scratch_path(spark, "warc")
    warc.write_archive(pages, folder)
    report = warc.archive_report(spark, folder).collect()
    largest = {}
    for key, _, html in rows:
        payload = (html or "").encode()
        if key is not None:
            largest[payload] = max(largest.get(payload, key), key)
    expected = []
    for key, _, html in rows:
        payload = (html or "").encode()
        first = largest.get(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = key != first
        expected.append(
            (key, len(payload), digest, "revisit" if again else "response", first if again else None)
        )
    assert sorted((tuple(r) for r in report), key=repr) == sorted(expected, key=repr)
    whole = warc.read_archive(spark, folder).collect()
    assert sorted(bytes(r.payload) for r in whole) == sorted((r[2] or "").encode() for r in rows)
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == len({r[2] or "" for r in rows})
    for r in warc.read_archive(spark, folder).select(warc.warc_bytes()).collect():
        head, body = bytes(r[0]).split(b"\r\n\r\n", 1)
        length = int(head.rsplit(b"Content-Length: ", 1)[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[length:] == b"\r\n\r\n"


def test_short_payloads_may_stay_responses(spark):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "a", "xx")], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    warc.write_archive(pages, folder, smallest_revisit=3)
    assert {r.record_type for r in warc.archive_report(spark, folder).collect()} == {"response"}


def test_archive_of_nothing_and_of_damaged_payloads(spark):
    folder = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame([], PAGES), folder)
    assert warc.archive_report(spark, folder).count() == 0
    with pytest.raises(ValueError, match="damaged"):
        import pyarrow as pa
        import zstandard

        body = zstandard.ZstdCompressor().compress(b"other")
        warc._restore(pa.RecordBatch.from_arrays([["h"], [b"\0" * 32], [body]], names=["a", "b", "c"]))
