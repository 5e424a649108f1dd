"""Text operators against brute force, over documents with every awkward case."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
from documents import CLASHING, SHAPE, frame, odd_documents, words  # noqa: E402

from ledgerflow.llm import bayes_join, log_bilinear, mixing, recompression, toxicity  # noqa: E402


def split(text):
    return text.encode().split() if text else []


# --- n-gram Jaccard join


def shingles(text):
    w = split(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_similar(rows):
    sets = [shingles(r[1]) for r in rows]
    good = [k for k, r in enumerate(rows) if sets[k] and r[0] is not None]
    linked = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                linked[a].add(b)
                linked[b].add(a)
    out = []
    for k, row in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            fresh = linked[todo.pop()] - reach
            reach |= fresh
            todo += fresh
        least = row[0] if row[0] is None else min(rows[j][0] for j in reach)
        out.append((row[0], least, len(linked[k])))
    return sorted(out, key=repr)


def test_similar_documents_agree_with_brute_force(spark):
    rows = odd_documents()
    found = bayes_join.similar_documents(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in found), key=repr) == brute_similar(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.class_id) for r in found)


def test_similar_documents_of_nothing(spark):
    assert bayes_join.similar_documents(frame(spark, [])).count() == 0
    assert bayes_join.one_of_each(frame(spark, [])).columns == SHAPE.names + CLASHING


def test_one_of_each_keeps_the_rest_as_it_is(spark):
    rows = odd_documents()
    kept = bayes_join.one_of_each(frame(spark, rows))
    assert kept.columns == SHAPE.names + CLASHING
    brute = {d for d, least, _ in brute_similar(rows) if d is not None and d == least}
    found = [r.doc_id for r in kept.collect()]
    assert Counter(d for d in found if d is not None) == Counter(brute)
    assert found.count(None) == sum(r[0] is None for r in rows)


def test_one_of_each_decides_rows_of_one_doc_id_by_their_texts(spark):
    one, two, copy, near = (words(k, 60, 900) for k in (1, 2, 3, 4))
    changed = f"{near} end"
    rows = [(3, copy), (5, copy), (5, one), (7, one + " other"), (7, two), (9, near), (9, changed)]
    rows += [(9, changed), (11, ""), (11, words(6, 60, 900)), (12, copy), (12, near)]
    rows = [(k, text, "en", f"s{n}", 0) for n, (k, text) in enumerate(rows)]
    found = []
    for some in (rows, rows[::-1]):
        kept = bayes_join.one_of_each(frame(spark, some).repartition(3)).collect()
        found.append(sorted((r.doc_id, r.text, r.source) for r in kept))
    assert found[0] == found[1]
    texts = Counter((key, text) for key, text, _ in found[0])
    nine = [one for one in texts if one[0] == 9]
    assert len(nine) == 1 and nine[0][1] in (near, changed)
    assert texts == Counter([(3, copy), (5, one), (7, two), (11, ""), (11, rows[9][1]), *nine])


def test_a_large_group_of_near_copies_is_compared_in_blocks(spark):
    """700 different texts that are all similar: more than a block of texts."""
    base = words(1, 120, 5000).split()
    rows = [(k, " ".join([*base, f"end{k}"]), None, None, 0) for k in range(700)]
    found = bayes_join.similar_documents(frame(spark, rows, extra=False)).collect()
    assert {(r.n_links, r.class_id) for r in found} == {(699, 0)}


def test_pruning_keeps_pairs_at_the_threshold():
    least = bayes_join.least_agreements()
    assert list(least) == list(range(16, 129, 16)) and all(m < n for n, m in least.items())
    # At similarity 0.8, the chance of falling below any look's bound.
    lost = sum(
        sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m)) for n, m in least.items()
    )
    assert lost < 1e-4


def test_min_hashes_estimate_the_similarity():
    draw = np.random.default_rng(0)
    pool = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
    one, two = np.unique(pool[:2000]), np.unique(pool[400:2400])
    a, b = bayes_join.min_hashes([one, two])
    assert abs((a == b).mean() - 1600 / 2400) < 0.15
    assert (bayes_join.min_hashes([two])[0] == b).all()


# --- toxicity


def toxic_rows():
    rows, labels = [], []
    for k in range(900):
        bad = k % 5 == 0
        text = words(k, 30 + k % 200, 900) + (f" you vile{'aeiou'[k % 25 // 5]} wretch" if bad else "")
        rows.append((k, text, "en", "s", 0))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_learns_and_leaves_clean_documents_alone(spark):
    rows, labels = toxic_rows()
    marked = spark.createDataFrame(labels + [(None, 1), (3, None), (0, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score_documents(frame(spark, rows), marked).collect()}
    held = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 3 == 1]
    assert {k for k in found if found[k].held_out} == set(held)
    truth = dict(labels)
    right = [found[k].predicted == truth[k] for k in held]
    assert sum(right) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found.values())


def test_ftrl_is_that_of_plain_loops():
    """Per-coordinate rates and the L1 gap, one feature at a time in dictionaries."""
    draw = np.random.default_rng(7)
    rows = [np.unique(draw.integers(0, 60, draw.integers(1, 25))).astype(np.int32) for _ in range(150)]
    labels = (np.array([3 in row or 8 in row for row in rows]) ^ (draw.random(150) < 0.1)).astype(float)
    weights, bias = toxicity.train_ftrl(rows, labels, epochs=3)
    seen = Counter(int(f) for row in rows for f in row)
    kept = [[int(f) for f in row if seen[int(f)] >= toxicity.MIN_DOCS] for row in rows]
    share = labels.mean()
    z, n, b, b_n = Counter(), Counter(), 0.0, 0.0

    def weight(f):
        gap = max(abs(z[f]) - toxicity.L1, 0.0) * (1 if z[f] > 0 else -1)
        return -gap / ((toxicity.BETA + n[f] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for epoch in range(3):
        for k in np.random.default_rng(epoch).permutation(150):
            old = {f: weight(f) for f in kept[k]}
            error = 1 / (1 + np.exp(-(sum(old.values()) + b))) - labels[k]
            error *= (1 - share) / share if labels[k] else 1.0
            for f, w in old.items():
                z[f] += error - ((n[f] + error**2) ** 0.5 - n[f] ** 0.5) / toxicity.ALPHA * w
                n[f] += error**2
            b_n += error**2
            b -= error * toxicity.ALPHA / (toxicity.BETA + b_n**0.5)
    assert bias == pytest.approx(b) and np.count_nonzero(weights) > 2
    assert [weights[f] for f in range(60)] == pytest.approx([weight(f) if f in z else 0.0 for f in range(60)])
    assert not weights[60:].any()


def test_toxicity_takes_awkward_documents_and_keeps_all_columns(spark):
    rows, labels = toxic_rows()
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    odd = rows + [(k if k is None else k + 5000, *r) for k, *r in odd_documents()]
    clean = toxicity.without_toxic(frame(spark, odd), marked)
    assert clean.columns == SHAPE.names + CLASHING
    gone = {r[0] for r in odd} - {r.doc_id for r in clean.select("doc_id").collect()}
    assert gone <= {k for k, bad in labels if bad} and len(gone) > 0.9 * 180


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scores = toxicity.score_documents(frame(spark, odd_documents()), none)
    assert {r.score for r in scores.collect()} == {0.5}
    assert toxicity.score_documents(frame(spark, []), none).count() == 0


# --- language model


def test_base_scores_and_counts_agree_with_brute_force(spark):
    rows = odd_documents()
    found = log_bilinear.score_documents(frame(spark, rows)).collect()

    def tokens(text):
        return [*(text or "").encode().lower().split(), b""]

    def out(key):
        return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2

    counts = Counter(t for r in rows if not out(r[0]) for t in tokens(r[1]))
    total = sum(counts.values())
    expected = []
    for r in rows:
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens(r[1]))
        known = sum(counts[t] > 0 for t in tokens(r[1]))
        expected.append((r[0], out(r[0]), len(tokens(r[1])), known, total, round(base, 6)))
    got = [
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_frequent_words_stay_within_their_bound(spark, monkeypatch):
    counts = spark.createDataFrame([(k, 1 + k % 50) for k in range(1000)], "word long, count long")
    for most in (0, 19, 20, 500, 1000, 5000):
        found = [r["count"] for r in log_bilinear.frequent_words(counts, most).collect()]
        left = [1 + k % 50 for k in range(1000)]
        assert len(found) <= most and sorted(found) == sorted(left)[1000 - len(found) :]
    # Few broadcast counts change no score.
    docs = frame(spark, odd_documents())
    whole = {repr(r.doc_id): r for r in log_bilinear.score_documents(docs).collect() if r.doc_id != 5}
    monkeypatch.setattr(log_bilinear, "HEAD", 30)
    for r in log_bilinear.score_documents(docs).collect():
        if r.doc_id is not None and r.doc_id != 5:
            other = whole[repr(r.doc_id)]
            assert r.n_known == other.n_known and abs(r.base_score - other.base_score) < 1e-6
            assert abs(r.score - other.score) < 1e-6


def test_the_model_learns_and_its_probabilities_add_up_to_one(spark):
    """Words follow each other in a fixed order, which an unordered model cannot know."""
    rows = []
    for k in range(400):
        rows.append((k, " ".join(f"v{(k * 7 + j) % 30}" for j in range(60)), None, None, 0))
    found = log_bilinear.score_documents(frame(spark, rows, extra=False)).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 0.7 * sum(r.base_score for r in held)
    share = np.array([0.2, 0.5, 0.3])
    draw = np.random.default_rng(0)
    model = log_bilinear.Model(
        np.array([3, 9], np.uint64), np.array([2, 1]), draw.normal(size=(4, 24)).astype(np.float32),
        draw.normal(size=(2, 24, 24)).astype(np.float32), np.log(share).astype(np.float32), share,
    )
    table = log_bilinear.log_normalisers(frame(spark, [], extra=False), model)
    v, t = model.vectors.astype(float), model.turns.astype(float)
    for one in range(4):
        for two in range(4):
            scores = (v[one] @ t[0] + v[two] @ t[1]) @ v[:3].T + model.bias
            assert abs(np.exp(scores - table[one, two]).sum() - 1) < 1e-6


def test_the_vocabulary_grows_with_the_corpus(spark):
    """Words beyond the first thousand have vectors, and all probabilities add up to one."""
    sizes = []
    for count in (200, 3000):
        counts = spark.createDataFrame([(7 * k, 9 + k % 50) for k in range(count)], "word long, count long")
        model = log_bilinear.first_model(counts, sum(9 + k % 50 for k in range(count)))
        sizes.append(len(model.words))
        found = model.encode(model.words)
        assert len(set(found.tolist())) == count and found.min() == 1
        draw = np.random.default_rng(3)
        model.vectors[:] = draw.normal(size=model.vectors.shape)
        model.bias[:] = draw.normal(size=len(model.bias))
        words = np.arange(model.first_class)
        predictor = log_bilinear.Predictor(model, np.float64)
        for one, two in ((0, len(model.vectors) - 1), (count, count - 1), (5, 5)):
            logs = predictor.log_probabilities(np.full(len(words), one), np.full(len(words), two), words)
            assert abs(np.exp(logs).sum() - 1) < 1e-9
    assert sizes == [200, 3000]


def test_words_within_a_class_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(log_bilinear, "SINGLES", 8)
    counts = spark.createDataFrame([(k, 1000) for k in range(60)], "word long, count long")
    trainer = log_bilinear.Trainer(log_bilinear.first_model(counts, 60_000), 0)
    ids = np.arange(4002) % 60 + 1
    one, two, word = ids[1:-1], ids[:-2], ids[2:]
    for _ in range(150):
        trainer.step(one, two, word)
    model = trainer.model
    model.vectors[:], model.bias[:], model.turns[:] = trainer.rows[:, :-1], trainer.rows[:-1, -1], trainer.turns
    logs = log_bilinear.Predictor(model).log_probabilities(one[:60], two[:60], word[:60])
    assert np.exp(logs).mean() > 0.3


def test_probabilities_are_those_of_plain_loops():
    """Every word after every context: its class, then the word within it, one exponential at a time."""
    draw = np.random.default_rng(2)
    size, count = log_bilinear.SIZE, 9
    bounds = np.array([4, 6, 9])
    share = np.full(count + 2, 1 / (count + 2))
    model = log_bilinear.Model(
        np.arange(1, count, dtype=np.uint64), np.arange(1, count), draw.normal(0, 1, (count + 3, size)).astype(np.float32),
        draw.normal(0, 0.4, (2, size, size)).astype(np.float32), draw.normal(0, 1, count + 2).astype(np.float32),
        share, bounds,
    )
    one, two, word = (draw.integers(0, n, 400) for n in (count + 3, count + 3, count))
    found = log_bilinear.Predictor(model, np.float64).log_probabilities(one, two, word)
    v, turns, bias = model.vectors.astype(float), model.turns.astype(float), model.bias.astype(float)
    for k in range(400):
        query = v[one[k]] @ turns[0] + v[two[k]] @ turns[1]
        odds = {row: math.exp(sum(a * b for a, b in zip(query, v[row])) + bias[row]) for row in range(count + 2)}
        top = [0, 1, 2, 3, count, count + 1]
        kind = next((c for c in range(2) if bounds[c] <= word[k] < bounds[c + 1]), None)
        chance = odds[word[k] if kind is None else count + kind] / sum(odds[row] for row in top)
        if kind is not None:
            chance *= odds[word[k]] / sum(odds[row] for row in range(bounds[kind], bounds[kind + 1]))
        assert found[k] == pytest.approx(math.log(chance), abs=1e-9)


def test_words_of_a_part_are_hashed_once_each(monkeypatch):
    texts = ["", " ", "a\x0bB\x0cc\td\re\nf  a ", "\u00c9 x\u00a0y\u2003 \x1cz\x85", "\x1f\x00 a A", *["to be or not to be"] * 50]
    hashed, plain = [], log_bilinear.xxhash.xxh3_64_digest

    class Counted:
        @staticmethod
        def xxh3_64_digest(word):
            hashed.append(word)
            return plain(word)

    monkeypatch.setattr(log_bilinear, "xxhash", Counted)
    for kind in (pa.string(), pa.large_string()):
        hashed.clear()
        names, tokens, sizes = log_bilinear.read_words(pa.array(texts, kind).slice(0))
        words = [[*t.encode().lower().split(), b""] for t in texts]
        assert sizes.tolist() == [len(w) for w in words]
        expected = [int.from_bytes(plain(w), "big") for text in words for w in text]
        assert names[tokens].tolist() == expected
        assert len(hashed) <= len(set(expected)) + 1
    assert [len(x) for x in log_bilinear.read_words(pa.array([], pa.string()))] == [1, 0, 0]


def test_draws_within_a_class_are_those_of_a_binary_search():
    draw = np.random.default_rng(4)
    share = draw.random(400) ** 3
    bounds = np.array([10, 11, 60, 200, 400])
    draws = log_bilinear.ClassDraws(share, bounds)
    kinds, part = draw.integers(0, 4, 20_000), draw.random(20_000)
    part[:4], kinds[:4] = (0.0, 0.0, 1 - 2**-53, 1 - 2**-53), (0, 3, 0, 3)
    upto = np.cumsum(share)
    low, high = bounds[kinds], bounds[kinds + 1]
    spot = upto[low - 1] + part * (upto[high - 1] - upto[low - 1])
    expected = np.clip(np.searchsorted(upto, spot), low, high - 1)
    assert (draws.take(kinds, part) == expected).all()


def test_a_step_is_that_of_plain_loops():
    """Noise-contrastive gradients word by word, summed by row, and Adagrad on each number."""
    draw = np.random.default_rng(8)
    size, words, bounds = log_bilinear.SIZE, 9, np.array([4, 6, 9])
    share = draw.random(words + 2) + 0.1
    share[[0, 1, 2, 3, 9, 10]] /= share[[0, 1, 2, 3, 9, 10]].sum()
    share[4:6] /= share[4:6].sum()
    share[6:9] /= share[6:9].sum()
    model = log_bilinear.Model(
        np.arange(1, words, dtype=np.uint64), np.arange(1, words), draw.normal(0, 0.5, (words + 3, size)).astype(np.float32),
        draw.normal(0, 0.4, (2, size, size)).astype(np.float32), draw.normal(0, 1, words + 2).astype(np.float32),
        share, bounds,
    )
    start = words + 2
    runs = draw.integers(0, words, (4, 6))
    runs[1, :3] = runs[3, 2:4] = start  # where texts begin
    trainer = log_bilinear.Trainer(model, 1)
    inner_noise = {}
    pick = trainer.inner_draws.take

    def noted(kinds, part):
        found = pick(kinds, part)
        for k, w in zip(kinds.tolist(), found.tolist()):
            inner_noise.setdefault(k, []).append(w)
        return found

    trainer.inner_draws.take = noted
    rows, turns = trainer.rows.astype(float), trainer.turns.astype(float)
    again = np.random.default_rng(1)
    trainer.step_runs(runs)
    tops = [0, 1, 2, 3, 9, 10]
    drawn = np.searchsorted(np.cumsum(share[tops]), again.random(log_bilinear.NOISE))
    noise = [tops[min(k, 5)] for k in drawn]
    changes, turned = np.zeros_like(rows), np.zeros_like(turns)
    blocks, tokens = {}, []
    for run in runs.tolist():
        tokens += [(run[k - 1], run[k - 2], run[k]) for k in range(2, 6) if run[k] != start]
    for one, two, word in tokens:
        query = np.append(rows[one, :-1] @ turns[0] + rows[two, :-1] @ turns[1], 1.0)
        back = np.zeros(size + 1)
        kind = next((k for k in range(2) if bounds[k] <= word < bounds[k + 1]), None)
        cases = [(word if kind is None else words + kind, noise, log_bilinear.NOISE)]
        if kind is not None:
            # Not more than a block's words of each class are in this batch, so they share their noise.
            blocks[kind] = blocks.get(kind, 0) + 1
            cases.append((word, inner_noise[kind], log_bilinear.INNER_NOISE))
        for target, others, count in cases:
            for row, real in [(target, 1.0), *((o, 0.0) for o in others)]:
                odds = query @ rows[row] - math.log(count * share[row])
                error = real - 1 / (1 + math.exp(-odds))
                back += error * rows[row]
                changes[row] += error * query
        for at, k in ((one, 0), (two, 1)):
            changes[at, :-1] += turns[k] @ back[:-1]
            turned[k] += np.outer(rows[at, :-1], back[:-1])
    assert blocks and max(blocks.values()) <= log_bilinear.BLOCK
    changes, turned = changes / len(tokens), turned / len(tokens)
    rows += log_bilinear.RATE * changes / np.sqrt(log_bilinear.FIRST_SQUARE + changes**2)
    turns += log_bilinear.RATE * turned / np.sqrt(1e-4 + turned**2)
    assert trainer.tokens == len(tokens)
    assert np.abs(trainer.rows - rows).max() < 1e-4 and np.abs(trainer.turns - turns).max() < 1e-4


def test_every_token_is_learnt_once():
    counts = {}
    model = log_bilinear.Model(
        np.arange(1, 9, dtype=np.uint64), np.arange(1, 9), np.zeros((10, 24), np.float32),
        np.zeros((2, 24, 24), np.float32), np.zeros(9, np.float32), np.full(9, 1 / 9),
    )
    for sizes in ([1], [1, 1, 1], [40, 1, 7, 300], [9000, 3], [16] * 20):
        texts = [np.arange(n) % 9 for n in sizes]
        trainer, met = log_bilinear.Trainer(model, 0), []
        trainer.step_runs = lambda runs, met=met: met.extend(
            (r[k - 2], r[k - 1], r[k]) for r in runs.tolist() for k in range(2, len(r)) if r[k] != 9
        )
        trainer.learn(texts)
        padded = [[9, 9, *t.tolist()] for t in texts]
        counts = Counter((t[k - 2], t[k - 1], t[k]) for t in padded for k in range(2, len(t)))
        assert Counter(met) == counts


def test_few_texts_are_learnt_in_smaller_batches(spark):
    rows = []
    for k in range(400):
        rows.append((k, " ".join(f"v{(k * 7 + j) % 30}" for j in range(60)), None, None, 0))
    found = log_bilinear.score_documents(frame(spark, rows, extra=False)).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


def test_tables_of_frequent_words_change_no_probability(monkeypatch):
    draw = np.random.default_rng(6)
    words, bounds = 90, np.array([20, 50, 90])
    rows = words + 2 + 1
    for scale in (0.3, 30.0):  # the latter is beyond what single precision can multiply
        model = log_bilinear.Model(
            np.arange(1, words, dtype=np.uint64), np.arange(1, words), draw.normal(0, 0.6, (rows, 24)).astype(np.float32),
            draw.normal(0, scale, (2, 24, 24)).astype(np.float32), draw.normal(0, 1, words + 2).astype(np.float32),
            np.full(words + 2, 0.1), bounds,
        )
        one, two = draw.integers(0, rows, (2, 3000))
        one[one >= words], two[two >= words] = rows - 1, rows - 1
        word = draw.integers(0, words, 3000)
        exact = log_bilinear.Predictor(model, np.float64)
        exact.slot[:] = -1
        exact = exact.log_probabilities(one, two, word)
        for table in (0, 22 * 30, 4_000_000):
            monkeypatch.setattr(log_bilinear, "TABLE", table)
            found = log_bilinear.Predictor(model).log_probabilities(one, two, word)
            assert np.isfinite(found).all()
            assert np.abs(found - exact).max() < 1e-4 * max(1.0, np.abs(exact).max())
    assert len(log_bilinear.Predictor(model).log_probabilities(*np.zeros((3, 0), np.int64))) == 0


def test_scoring_nothing(spark):
    assert log_bilinear.score_documents(frame(spark, [])).count() == 0
    one = log_bilinear.score_documents(frame(spark, [(1, None, None, None, 0)])).collect()
    assert len(one) == 1 and one[0].n_tokens == 1


# --- mixing


def brute_targets(sizes):
    """Share by weight, cap, and share what is left among the others until no one is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[n % 3] for n, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3.0 * sizes[s] for s in full)
        open_ -= full
    return target


def test_mixing_meets_its_targets(spark):
    rows = odd_documents()
    found = mixing.mix_report(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(split(r[1]))
    targets, taken, largest = brute_targets(sizes), defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for source, goal in targets.items():
        # Repeated rows are taken together, so a source may miss by two of its largest documents.
        assert abs(taken[source] - goal) <= 2 * largest[source] + 1
    again = mixing.mix_report(frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_mixed_documents_are_there_as_often_as_reported(spark):
    rows = odd_documents()
    report = mixing.mix_report(frame(spark, rows)).collect()
    mixed = mixing.mix_documents(frame(spark, rows))
    assert mixed.columns == SHAPE.names + CLASHING
    expected = Counter()
    for r in report:
        expected[r.doc_id] += r.copies if r.size else 0
    assert Counter(r.doc_id for r in mixed.collect()) == +expected


def test_mixing_runs_without_python_and_on_nothing(spark):
    assert mixing.mix_report(frame(spark, [])).count() == 0
    plan = mixing.mix_documents(frame(spark, odd_documents()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- repeated passages


def brute_repeats(rows, window=13):
    first = {}
    for key, text, *_ in rows:
        w = split(text)
        for i in range(len(w) - window + 1 if key is not None else 0):
            g = tuple(w[i : i + window])
            first[g] = min(first.get(g, key), key)
    out = []
    for key, text, *_ in rows:
        w = split(text)
        gone = set()
        for i in range(len(w) - window + 1 if key is not None else 0):
            if first[tuple(w[i : i + window])] < key:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_repeats_agree_with_brute_force(spark, seed):
    rows = odd_documents(seed)
    # Few words, so that runs, periods and chance repeats abound.
    rows += [(500 + k, words(k, 400, 1 + k % 3), None, None, 0) for k in range(12)]
    rows += [(600 + k, words(k // 4, 90 + k, 30), None, None, 0) for k in range(40)]
    found = recompression.repeats_report(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_repeats(rows)


def test_texts_without_repeats_keep_their_columns(spark):
    rows = odd_documents()
    cut = recompression.without_repeats(frame(spark, rows))
    assert cut.columns == SHAPE.names + CLASHING
    whole = {r[0]: r[1] for r in rows}
    for r in cut.collect():
        if len(split(r.text)) == len(split(whole[r.doc_id])):
            assert r.text == (whole[r.doc_id] or "")
        else:
            assert r.n_chars == len(r.text)


def test_repeats_of_nothing(spark):
    assert recompression.repeats_report(frame(spark, [])).count() == 0


def test_equal_windows_have_equal_representatives_wherever_they_stand():
    draw = np.random.default_rng(5)
    for vocabulary in (1, 2, 5, 50):
        core = draw.integers(1, vocabulary + 1, 13).astype(np.uint64)
        names = set()
        for _ in range(200):
            left, right = draw.integers(0, 30, 2)
            around = draw.integers(1, vocabulary + 1, left + right).astype(np.uint64)
            whole = recompression.digest(np.concatenate([around[:left], core, around[left:]]))
            owner = np.zeros(len(whole), np.int64)
            starts = np.array([left])
            names.add(int(recompression.representatives(whole, owner, starts)[0]))
        assert len(names) == 1
