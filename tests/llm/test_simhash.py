import random

import numpy as np
import pytest
import xxhash
from llm_rows import docs, prose
from pyspark.sql import functions as F

from shopflow.llm import components, simhash


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(values):
    """value -> least value reachable by steps of three bits or fewer."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def same_parts(got, want):
    """Both maps part their keys alike."""
    assert got.keys() == want.keys()
    assert len(set(zip(got.values(), want.values()))) == len(set(got.values())) == len(set(want.values()))


def near_families(seed, centres, members, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(members):
            v = centre
            for k in rng.sample(range(64), rng.randint(0, flips)):
                v ^= 1 << k
            out.add(v)
    return sorted(out)


def test_fingerprints_equal_the_definition(spark):
    texts = ["", None, "one", "Two Words", "a b c", "É è  É\tx\ny", " \t ", prose(1, 200), "w " * 40, "A b C d e f G",
             "nbsp one two three four five"]
    got = {r.doc_id: r.fp for r in simhash.fingerprints(docs(spark, list(enumerate(texts)))).collect()}
    assert [got[k] & (1 << 64) - 1 for k in range(len(texts))] == [brute_fingerprint(t) for t in texts]
    hashes = [xxhash.xxh64_intdigest(t, 42) for t in ("a b c",)]
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert hashes[0] == spark_hash & (1 << 64) - 1


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = prose(3, 500)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES", 7)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_vector_distance_is_a_lower_bound():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 1 << 63, 5000, np.uint64) * np.uint64(2) + rng.integers(0, 2, 5000, np.uint64) for _ in "ab")
    counts = [sum(np.bitwise_count((x >> np.uint64(2 * k)) & np.uint64(3)).astype(int)
                  * np.eye(32, dtype=int)[k][:, None] for k in range(32)) for x in (a, b)]
    manhattan = np.abs(counts[0] - counts[1]).sum(0)
    assert (np.bitwise_count(simhash._unary(a) ^ simhash._unary(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("cell, few", [(2048, 8), (6, 8), (5, 2)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, cell, few):
    """Dense families, chains and lone values; with small cells, blocks of cells meet."""
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "FEW", few)
    values = near_families(7, 12, 40, 5) + near_families(8, 200, 1, 0) + [0, 1, 3, 0xFF]
    values = sorted(set(values))
    rng = random.Random(9)
    for _ in range(60):  # pairs at exactly three and four bits
        v = rng.getrandbits(64)
        for flips in (3, 4):
            w = v
            for k in rng.sample(range(64), flips):
                w ^= 1 << k
            values += [v, w]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    classes = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.near_links(classes).collect()]
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in found:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    same_parts({v: find(v) for v in values}, brute_components(values))


def test_groups_of_documents(spark):
    base = prose(11, 400)
    words = base.split()
    rows = [(3, base), (9, base.upper().lower()), (None, base), (2, " ".join(words[:399])), (20, prose(12, 300)),
            (30, ""), (31, None), (32, " \n"), (5, "x" * 100_000), (6, "one two"), (6, "one two")]
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.groups(docs(spark, rows)).collect()}
    assert simhash.groups(docs(spark, rows)).count() == len(rows)
    values = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(values)
    for (doc_id, text), value in zip(rows, values):
        reach = [d for (d, _), v in zip(rows, values) if roots[v] == roots[value] and d is not None]
        assert got[doc_id, f"{value:016x}"] == min(reach)
    assert got[31, "0" * 16] == 30
    assert simhash.groups(docs(spark, [])).count() == 0


def test_nothing_that_grows_with_the_documents_is_broadcast(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i % 7}") for i in range(50)], "doc_id long, text string")
    classes = docs.select(F.xxhash64("doc_id").alias("fp"))
    links = classes.select(F.col("fp").alias("a"), F.lit(3).cast("long").alias("b"))
    for made in (simhash.near_links(classes), components._star(links, True), components._star(links, False),
                 simhash.groups(docs)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
