"""Ranked search against a plain loop over all documents and terms."""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from documents import frame, odd_documents  # noqa: E402

from ledgerflow.llm import ranked_search as rs  # noqa: E402

CLASS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return CLASS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """Every item against every document."""
    split = [(key, Counter(plain_terms(text))) for key, text in docs]
    split = [(key, tf) for key, tf in split if tf]
    count, total = len(split), sum(sum(tf.values()) for _, tf in split)
    df = Counter(term for _, tf in split for term in tf)
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        rows = []
        for key, tf in split:
            m = 10 + (90 * sum(tf.values()) * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in terms & tf.keys()
            )
            if score > 0:
                rows.append((-score, key is None, key))
        out += [(item, n + 1, r[2], -r[0]) for n, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:k])]
    return sorted(out, key=str)


def items_of(docs):
    texts = [text for _, text in docs if text and len(text) < 3000]
    items = [(k, text[:200]) for k, text in enumerate(texts[::7])]
    items += [(500, None), (501, ""), (502, "!!! ..."), (503, "w1 W1 w2"), (None, "w3 changed2"),
              (504, "absent"), (505, "w1"), (505, "w2 w3"), (503, "w1 W1 w2"), (506, "ÜNÏ çødé 漢字")]
    return items


def test_terms_are_the_maximal_matches():
    every = "".join(chr(c) for c in range(0x3000) if not 0xD800 <= c <= 0xDFFF)
    for text in (every, "x".join(every), "A-b_C d9É\x7fz", "", None):
        assert [t.decode("utf-8") for t in rs.terms_of(text)] == plain_terms(text)


def test_awkward_documents_and_items(spark):
    docs = [(r[0], r[1]) for r in odd_documents()]
    items = items_of(docs)
    expected = brute(docs, items)
    shape = "item_id long, text string, term string, score string"
    table = spark.createDataFrame([(*i, "t", "s") for i in items], shape)
    many = frame(spark, odd_documents()).repartition(3)
    for block in (200_000, 25):
        found = rs.ranked_search(many, table, term_block=block)
        assert sorted(map(tuple, found.collect()), key=str) == expected
    none = spark.createDataFrame([], shape)
    assert rs.ranked_search(many, none).count() == 0
    assert rs.ranked_search(frame(spark, []), table).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_segments_windows_and_bounds(seed, monkeypatch):
    """Small windows and few accumulators, ties everywhere; skipping loses no document."""
    draw = np.random.default_rng(seed)
    monkeypatch.setattr(rs, "WINDOW", 4)
    monkeypatch.setattr(rs, "STEP", 3)
    monkeypatch.setattr(rs, "SHORT_SHARE", [0.0, 0.1, 0.5, 9.0][seed])
    vocabulary = [f"t{k}" for k in range(30)]
    share = 1 / np.arange(1, 31)
    docs = []
    for key in draw.permutation(400).tolist():
        size = int(draw.integers(0, 25))
        docs.append((key, " ".join(draw.choice(vocabulary, size, p=share / share.sum()))))
    items = [(k, " ".join(draw.choice(vocabulary, 6))) for k in range(25)]
    expected = brute(docs, items, 5)
    number = {t.encode(): k for k, t in enumerate(vocabulary)}
    lists = pa.list_(pa.int32())
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("terms", lists),
                        ("ends", lists), ("docs", lists), ("tf", lists)])
    real = [d for d in docs if d[1]]
    df = Counter(t for _, text in real for t in set(text.split()))
    weights = np.array([math.floor(1000 * math.log((2 * len(real) + 2) / (2 * df[t] + 1))) for t in vocabulary])
    builder = rs.Builder(number)
    builder.add([k for k, _ in docs[:150]], [t for _, t in docs[:150]])
    builder.add([k for k, _ in docs[150:]], [t for _, t in docs[150:]])
    [segment] = rs.segments_of([builder.close(schema)], weights, len(real), sum(len(t.split()) for _, t in real))
    found, skipped = [], 0
    for item, text in items:
        terms = np.array(sorted({number[t.encode()] for t in text.split()}))
        sums, _ = segment.accumulate(segment.lists(terms))
        least = max(1, int(np.sort(sums)[-5]))
        places, scores = segment.best(terms, least, 5)
        found += [(item, n + 1, segment.doc_ids[p], s) for n, (p, s) in enumerate(zip(places.tolist(), scores.tolist()))]
        # No document reaches a score just above the best one.
        skipped += not len(segment.best(terms, int(scores[0]) + 1, 5)[0])
    assert sorted(found, key=str) == expected and skipped == len(items)
