import random
import re
import zlib
from collections import Counter

import pytest
from llm_rows import docs, prose

from shopflow.llm import spelling


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = brute_counts(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), None if form[w] is None else n[form[w]]) for w in n}


def spelled(seed, words, texts):
    """Texts of words and of their misspellings."""
    rng = random.Random(seed)
    letters = "abcdeé"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(words)]

    def miss(w):
        k = rng.randrange(len(w))
        return rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])

    return [" ".join(w if rng.random() < 0.7 else miss(w) for w in (stems[int(rng.random() ** 2 * words)] for _ in range(120)))
            for _ in range(texts)]


def result(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_variants_equal_all_pairs(spark):
    rows = list(enumerate(spelled(1, 60, 40)))
    want = brute(rows)
    assert result(spelling.variants(docs(spark, rows))) == want
    assert any(w[1] for w in want) and any(w[2] != w[1] and w[1] for w in want) and max(w[4] for w in want) > 3


def test_damage_and_odd_signs(spark):
    rows = [(k, "Commerce commerces ×÷Ééÿā don't cafés éte pro-pose") for k in range(3000)]
    want = brute(rows)
    assert {w[0] for w in want} > {"commerce", "commerces"} and any(len(w[0]) == 7 for w in want)
    assert result(spelling.variants(docs(spark, rows))) == want


def test_long_words_and_equal_letters(spark, monkeypatch):
    """Long words, runs of one letter, and prefixes of each other; in small blocks."""
    monkeypatch.setattr(spelling, "LETTERS", 300)
    monkeypatch.setattr(spelling, "TEXT_PART", 50)
    monkeypatch.setattr(spelling, "HELD", 3)
    rng = random.Random(4)
    long = "".join(rng.choice("abü") for _ in range(500))
    words = ["a" * k for k in (5, 6, 7, 9, 10, 64, 65, 66)] + [long, long[:200] + long[201:], long[:499] + "z", "b" + long[1:]]
    words += [long + "q", long[:70], long[:71], "abcde", "bcdea", "abcdef", "xabcde", "abXde"]
    rows = [(None, " ".join(words * 3)), (None, " ".join(words[3:] * 2)), (None, " ".join(words[10:])), (None, None), (None, "")]
    assert result(spelling.variants(docs(spark, rows))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "no such words ever")], [(1, "alone alone alone")]])
def test_little_or_nothing(spark, rows):
    assert result(spelling.variants(docs(spark, rows))) == brute(rows)


def test_chance_hash_hits_do_no_harm(spark, monkeypatch):
    """With hashes of few values, states go astray, yet no pair is lost or invented."""
    rows = list(enumerate(spelled(6, 12, 8)))
    plain = spelling.Letters.hash
    monkeypatch.setattr(spelling.Letters, "hash", lambda self, a, b: plain(self, a, b) % spelling._U64(997))
    words = spark.createDataFrame(list(brute_counts(rows).items()), "word string, n long")
    got = {(r.word, r.other) for r in spelling.near_pairs(words).collect()}
    n = brute_counts(rows)
    assert got == {(a, b) for a in n for b in n if one_edit(a, b)}
    assert prose(1, 3)
