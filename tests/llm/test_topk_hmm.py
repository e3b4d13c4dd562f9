"""Top-k search and language-model scoring against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from llm_rows import docs, prose
from pyspark.sql import functions as F

from shopflow.llm import hmm, topk


def best(rows, k=5):
    """Every row is a query or a candidate, also those that repeat an id."""
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for query in {i for i, _ in fine if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for j, q in fine if j == query for i, v in fine if i != query)
        out += [(query, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_search(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(230)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]  # ties
    rows += [(400, None), (450, [1.0, None] * 4), (500, [float("nan")] * 8), (550, [float("inf")] * 8),
             (None, rows[0][1]), (600, [3.0]), (650, []), (50, rows[50][1]), (50, rows[51][1]), (77, rows[50][1]), (77, rows[9][1]), (700, [1e6] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, v int")
    for per_block in (topk.ROWS_PER_BLOCK, 40):
        monkeypatch.setattr(topk, "ROWS_PER_BLOCK", per_block)
        monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
        got = sorted(tuple(r) for r in topk.search(frame, F.col("id") % 50 == 0).collect())
        assert got == best(rows)


def test_far_blocks_are_not_met(spark, monkeypatch):
    """Clustered rows: queries are sent to few blocks; without statistics they go to all."""
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 60)
    monkeypatch.setattr(topk, "LEAST_ROWS_PER_BLOCK", 60)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6)) * 40
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=6)]) for i in range(1200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent, send = [], topk._sent

    def counted(queries, blocks, first):
        made = send(queries, blocks, first)
        sent.append((made.count(), len(blocks.block)))
        return made

    monkeypatch.setattr(topk, "_sent", counted)
    want = best(rows)
    assert sorted(tuple(r) for r in topk.search(frame, F.col("id") % 50 == 0).collect()) == want
    (first, blocks), (rest, _) = sent
    assert first == 24 and blocks > 15 and rest < 24 * blocks / 2
    monkeypatch.setattr(topk, "STATISTICS_BYTES", 0)
    assert sorted(tuple(r) for r in topk.search(frame, F.col("id") % 50 == 0).collect()) == want
    assert len(sent) == 2


def test_search_of_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (50, [2.0]), (3, [-1.0])], "vec_id long, embedding array<float>")
    assert topk.search(frame, F.col("id") % 50 == 0).count() == 4
    assert topk.search(frame.limit(0), F.col("id") % 50 == 0).count() == 0


def test_rows_beyond_the_bound_are_not_evaluated():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 8)) * 1000
    rows = np.floor(centres[np.arange(4000) % 20] + rng.normal(size=(4000, 8)) * 10).astype(np.int64)
    pivots = rows[:16].astype(float)
    d = np.sqrt(((rows[:, None].astype(float) - pivots)**2).sum(2))
    ids = np.arange(4000)
    evaluated = 0

    class Counting(np.ndarray):
        def __matmul__(self, other):
            nonlocal evaluated
            evaluated += len(self)
            return np.asarray(self) @ np.asarray(other)

    query, found, score = topk.best_of_block(ids[:4], rows[:4], d[:4], ids, rows.view(Counting), d, 5)
    for q in range(4):
        want = sorted((-int(rows[q] @ rows[i]), i) for i in ids if i != q)[:5]
        assert [(-s, i) for s, i in zip(score[query == q], found[query == q])] == want
    assert evaluated < 4 * 4000


def model(seed, states=3, classes=5):
    rng = np.random.default_rng(seed)
    rows = lambda *shape: (x := rng.uniform(0.1, 1, shape)) / x.sum(-1, keepdims=True)
    return hmm.Model(rows(states), rows(states, states), rows(states, classes))


def path_sums(m, sequence):
    """Probability and expected counts by adding up all paths."""
    k = len(m.start)
    total, steps, emit = 0.0, np.zeros((k, k)), np.zeros_like(m.emit)
    for path in itertools.product(range(k), repeat=len(sequence)):
        p = m.start[path[0]] * m.emit[path[0], sequence[0]]
        for a, b, c in zip(path, path[1:], sequence[1:]):
            p *= m.step[a, b] * m.emit[b, c]
        total += p
        for a, b in zip(path, path[1:]):
            steps[a, b] += p
        for s, c in zip(path, sequence):
            emit[s, c] += p
    return total, steps / total, emit / total


@pytest.mark.parametrize("segment", [128, 6, 3, 2, 1])
def test_forward_and_expected_counts_equal_sums_over_paths(monkeypatch, segment):
    """Also when texts go over the ends of pieces."""
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    monkeypatch.setattr(hmm, "PIECES", 2)
    m = model(1)
    sequences = [np.array(s, np.uint16) for s in ([0, 1, 2, 3, 4, 0, 2], [2], [4, 4, 1], [1, 1, 3, 0], [3, 3, 3, 3, 3, 3])]
    want = [path_sums(m, s) for s in sequences]
    assert np.allclose(hmm.forward(m, sequences), [math.log10(w[0]) for w in want])
    pieces, starts = hmm._pieces(sequences, 5)
    sums = hmm.expected_counts(m, pieces, starts, *hmm.messages(m, pieces, starts))
    assert np.allclose(sums[3:12].reshape(3, 3), sum(w[1] for w in want))
    assert np.allclose(sums[12:].reshape(3, 5), sum(w[2] for w in want))
    assert sums[:3].sum() == pytest.approx(5)


def test_a_long_text_is_trained_on_as_a_whole(monkeypatch):
    rng = np.random.default_rng(4)
    long = rng.integers(0, 5, 3000).astype(np.uint16)

    def sums(segment):
        monkeypatch.setattr(hmm, "SEGMENT", segment)
        pieces, starts = hmm._pieces([long, long[:7]], 5)
        return hmm.expected_counts(model(3), pieces, starts, *hmm.messages(model(3), pieces, starts))

    assert np.allclose(sums(128), sums(4000))


def test_forward_of_long_text_does_not_vanish():
    assert np.isfinite(hmm.forward(model(2), [np.zeros(50_000, np.uint16), np.zeros(0, np.uint16)])).all()


def test_scores(spark):
    rng = random.Random(6)
    rows = [(i, prose(i, rng.randint(3, 80), 60 if i % 2 else 5000)) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "never seen words"), (1, rows[1][1]), (103, "W1\tw2 w1\x0bw3"), (104, prose(9, 20_000))]
    learned = F.col("doc_id") % 5 != 0
    got = hmm.score(docs(spark, rows), learned, rounds=2).collect()
    assert len(got) == len(rows)
    tokens = lambda t: [*(t or "").lower().replace("\t", " ").replace("\x0b", " ").split(), None]
    counts = {}
    for i, t in rows:
        if i is not None and i % 5:
            for w in tokens(t):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    texts = {i: t for i, t in rows}
    for r in got:
        w = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.train_tokens) == (len(w), n)
        assert r.n_known == sum(x in counts for x in w)
        assert r.base_score == pytest.approx(sum(math.log10((counts.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        assert r.held_out == (r.doc_id is None or r.doc_id % 5 == 0)
        assert r.score < 0


def plain_score(train, text, words_of, m, own, buckets, bucket_of):
    """log10 probability of one text, word by word, from its definition."""
    counts = {}
    for t in train:
        for w in words_of(t):
            counts[w] = counts.get(w, 0) + 1
    tokens = sum(counts.values()) + len(train)
    large = sorted((w for w in counts if counts[w] * own >= tokens), key=hash_of)
    shared = [sum(counts[w] for w in counts if w not in large and bucket_of(w) == b)
              + hmm.SMOOTH * (sum(w not in large and bucket_of(w) == b for w in counts) + 1) for b in range(buckets)]
    classes = [buckets + large.index(w) if w in large else bucket_of(w) for w in words_of(text)] + [buckets + len(large)]
    share = sum(math.log10((counts.get(w, 0) + hmm.SMOOTH) / shared[bucket_of(w)]) for w in words_of(text) if w not in large)
    a, total = m.start, 0.0
    for n, c in enumerate(classes):
        a = (a if n == 0 else a @ m.step) * m.emit[:, c]
        total, a = total + math.log10(a.sum()), a / a.sum()
    return total + share


def hash_of(word):
    import pyarrow as pa

    from shopflow.llm import arrow

    return int(arrow.words(*next(arrow.text_blocks(pa.array([word])))[1:])[0][0])


def test_a_whole_score_equals_its_definition(spark, monkeypatch):
    monkeypatch.setattr(hmm, "OWN", 12)
    monkeypatch.setattr(hmm, "HEAVY", 40)  # so that some counts are joined
    trained = []
    train = hmm.train

    def kept(*args, **options):
        trained.append(train(*args, **options))
        return trained[0]

    monkeypatch.setattr(hmm, "train", kept)
    texts = [prose(i, 12, 25) for i in range(14)] + ["", "unknown w1 words", "w0"]
    got = {r.doc_id: r.score for r in hmm.score(docs(spark, list(enumerate(texts))), F.col("doc_id") < 11, rounds=2).collect()}
    for i, text in enumerate(texts):
        want = plain_score(texts[:11], text, str.split, trained[0], 12, 64, lambda w: hash_of(w) >> 58)
        assert got[i] == pytest.approx(want)


def test_all_words_of_a_vocabulary_share_probability_one(spark, monkeypatch):
    """Over all known words and the unknown ones of each shared class, one step sums to one."""
    monkeypatch.setattr(hmm, "OWN", 8)
    monkeypatch.setattr(hmm, "BUCKET_BITS", 2)
    frame = docs(spark, [(i, prose(i, 30, 40)) for i in range(20)])
    counts = hmm._count_words(frame.select("text")).cache()
    vocabulary = hmm._vocabulary(counts, 20)
    words = np.array([r.word for r in counts.collect()], np.int64).view(np.uint64)
    cls, _, log_share, _ = vocabulary.look_up(words)
    mass = np.bincount(cls, 10**log_share, vocabulary.classes)
    mass[:vocabulary.buckets] += hmm.SMOOTH / vocabulary.shared
    mass[vocabulary.end] = 1
    assert np.allclose(mass, 1)


def test_no_training_rows(spark):
    got = hmm.score(docs(spark, [(1, "a b")]), F.lit(False)).first()
    assert (got.n_known, got.train_tokens, got.n_tokens) == (0, 0, 3) and got.base_score == 0
    assert hmm.score(docs(spark, []), F.lit(True)).count() == 0
