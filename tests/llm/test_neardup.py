"""Near-duplicates and components against brute force."""

import random

import numpy as np
import pytest
from llm_rows import docs, prose

from shopflow.llm import neardup
from shopflow.llm.components import components


def brute(rows, size, percent=80):
    sets = {}
    for i, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        grams = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(grams)
    parent = {i: i for i in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(parent)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in parent}, sets


def corpus():
    rng = random.Random(11)
    rows = []
    for base in range(12):
        text = prose(base, 90, 4000).split()
        for copy in range(rng.randint(1, 6)):
            own = list(text)
            for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
                own[rng.randrange(len(own))] = f"edit{rng.random()}"
            rows.append((len(rows) * 3 + 1, " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(spark, size):
    rows = corpus()
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE "), (505, "two words"), (506, "two\twords"),
             (None, rows[0][1]), (rows[1][0], rows[1][1]), (507, "É a"), (508, "é a"), (509, prose(77, 30_000, 900))]
    want, sets = brute(rows, size)
    got = neardup.groups(docs(spark, rows), size=size).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
        assert r.kept == (r.doc_id is not None and want[r.doc_id] == r.doc_id)
    kept = neardup.survivors(docs(spark, rows), size=size)
    assert kept.columns == docs(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))


def test_large_nodes(spark):
    """Nodes of more than ``small`` classes: copies of one text, and of two that share a half."""
    rng = random.Random(2)
    a, b = prose(1, 120, 4000).split(), prose(2, 60, 4000).split()
    b += a[:60]
    rows = []
    for i in range(120):
        own = list((a, b)[i % 3 == 0])
        own[rng.randrange(120)] = f"edit{i}"
        rows.append((i, " ".join(own)))
    want, _ = brute(rows, 2)
    got = neardup.groups(docs(spark, rows), size=2, small=4).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_recall_at_the_deepest_level():
    """Of pairs of similarity 0.8 that are parted in all trees before LEVELS are done."""
    rng = np.random.default_rng(8)
    pairs = 40_000
    a = rng.integers(0, 2**32, (pairs, neardup.COORDINATES), np.uint32)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 2**32, a.shape, np.uint32))
    levels, trees = neardup.LEVELS, neardup.TREES
    together = (neardup._paths(a, levels, trees)[:, :, -1] == neardup._paths(b, levels, trees)[:, :, -1]).any(1)
    agreeing = (a == b).sum(1) >= neardup.AGREEING
    assert together.mean() >= 0.999 and (together & agreeing).mean() >= 0.999


def test_a_pair_is_compared_in_one_tree_of_those_it_ends_together_in(spark):
    rng = np.random.default_rng(1)
    minwise = rng.integers(0, 2**32, (6, neardup.COORDINATES), np.uint32)
    minwise[1:4] = minwise[0]
    minwise[3, ::5] += 1
    classes = spark.createDataFrame([(i, i, bytearray(x.tobytes())) for i, x in enumerate(minwise)],
                                    "rep long, label long, minwise binary")
    rows = neardup._nodes(classes, 2, 8).selectExpr("node", "-1 AS part", "tree", "rep", "label")
    made = neardup._with_short(rows, classes, 8, 4)
    pairs = {tuple(r) for r in neardup._compare(made).collect()}
    assert {(1, 0), (2, 0), (2, 1)} <= pairs <= {(1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2)}
    later = made.where("tree > 0")
    assert neardup._compare(later.where("rep IN (0, 1)")).count() == 0


def test_lower_similarities_are_refused(spark):
    with pytest.raises(ValueError, match="80"):
        neardup.groups(docs(spark, [(1, "a b")]), percent=70)


def test_blocks_compare_all_of_a_node(spark):
    rows = spark.createDataFrame([(7, 0, i, i) for i in range(40)], "node long, tree int, rep long, label long")
    cut = [(r.node, r.part, r.rep, r.label) for r in neardup._blocks(rows, 4).collect()]
    met = {(min(x[2], y[2]), max(x[2], y[2])) for x in cut for y in cut
           if x[0] == y[0] and x[3] != y[3] and (x[1] < 0 or x[1] != y[1])}
    assert met == {(i, j) for j in range(40) for i in range(j)}


def test_near_classes_meet_every_member(spark, monkeypatch):
    """Only one member of a large component is similar enough to the class near it."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:50] + [f"e{i}"] + base[51:])) for i in range(30)]
    member = base[:20] + ["far"] * 3 + base[23:]
    rows += [(50, " ".join(member)), (60, " ".join(member[:80] + ["off"] * 4 + member[84:])),
             (61, " ".join(base[:40] + ["no"] * 30 + base[70:]))]
    labelled = spark.createDataFrame(
        [(i, 0 if i <= 50 else i) for i, _ in rows], "rep long, label long")
    near = spark.createDataFrame([(60, 0), (61, 0)], "rep long, core long")
    got = neardup._confirm_near(near, labelled, docs(spark, rows), 2, 80, "doc_id", "text").collect()
    _, sets = brute(rows, 2)
    linked = {b for b, s in sets.items() if b <= 50 and 100 * len(s[0] & sets[60][0]) >= 80 * len(s[0] | sets[60][0])}
    assert linked and {r.a for r in got} == {60} and {r.b for r in got} <= linked


def test_repeated_id_with_other_text(spark):
    rows = [(9, "a b c d e f g"), (9, "p q r s t u v"), (3, "p q r s t u v"), (12, "a b c d e f g")]
    got = neardup.groups(docs(spark, rows), size=2).collect()
    assert {r.component_id for r in got} == {3}


def test_empty_table(spark):
    assert neardup.groups(docs(spark, [])).count() == 0
    assert neardup.survivors(docs(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101 + i) for i in range(50)] + [(7, 7)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for x in {v for link in links for v in link}:
        assert got.get(x, x) == find(x)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
