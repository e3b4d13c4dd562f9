"""Decontamination against a brute-force alignment."""

import random
import re

from llm_rows import docs, prose

from shopflow.llm import contamination as c


def words(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(
        x.lower() if "A" <= x <= "Z" else x for x in text or "")) if w]


def brute(text, item):
    """Most agreeing words of a run, over all alignments."""
    a, b, best = words(text), words(item), 0
    for shift in range(-len(b), len(a)):
        score = agree = 0
        for j in range(len(b)):
            if 0 <= shift + j < len(a):
                same = a[shift + j] == b[j]
                score += 1 if same else -4
                agree += same
                if score <= 0:
                    score = agree = 0
                best = max(best, agree)
    return best


def test_against_brute_force(spark):
    rng = random.Random(5)
    items = [(i, prose(100 + i, n, 3000)) for i, n in enumerate([8, 9, 12, 16, 25, 40, 70, 150])]
    items += [(20, "too short"), (21, None), (22, ""), (None, prose(9, 30)), (0, items[0][1])]
    rows = []
    for i in range(60):
        body, item = prose(i, 80, 3000).split(), words(items[i % 8][1])
        part = item[: rng.choice([len(item), len(item), 12, 13, 20])]
        for _ in range(rng.choice([0, 0, 1, 2])):
            part[rng.randrange(len(part))] = "other"
        at = rng.randrange(len(body))
        rows.append((i, " ".join(body[:at]) + ", " + " ".join(part).upper() + ".\n" + " ".join(body[at:])))
    rows += [(100, None), (101, ""), (None, items[5][1]), (0, rows[0][1]), (103, "x"), (104, prose(1, 40_000) + items[6][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in c.flagged(docs(spark, rows), benchmark).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[0]) == 2
    missed = 0
    for doc_id, text in rows:
        if len(text or "") > 100_000:
            assert got[doc_id][0]["items"] == "6"
            continue
        want = {i for i, item in items if i is not None and len(words(item)) >= c.SPAN
                and brute(text, item) >= min(13, -(-len(words(item)) * 8 // 10))}
        found = set(map(int, filter(None, got[doc_id][0]["items"].split(","))))
        assert found <= want
        assert got[doc_id][0].contaminated == bool(found) and got[doc_id][0].n_items == len(found)
        missed += len(want - found)
    assert missed <= 2  # short items with a word replaced where no mask ignores it
    clean = c.clean(docs(spark, rows), benchmark)
    assert clean.columns == docs(spark, rows).columns
    assert clean.count() == sum(not x.contaminated for x in sum(got.values(), []))


def test_a_substitution_within_every_eight_words(spark):
    item = [f"t{i}" for i in range(40)]
    leaked = [w if i % 8 != 3 else "changed" for i, w in enumerate(item)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(1, "so " + " ".join(leaked) + " on"), (2, " ".join(item[:12])), (3, " ".join(reversed(item)))]
    got = {r.doc_id: r.contaminated for r in c.flagged(docs(spark, rows), benchmark).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_short_items_are_found_as_whole_runs(spark, monkeypatch):
    items = [(1, "Quick brown fox"), (2, "brown"), (3, "one two three four five six seven"), (4, "a b a b"), (5, "..."),
             (6, prose(3, 30, 5000))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "the quick, BROWN fox!"), (2, "quick fox brown"), (3, "one two three four five six and seven"),
            (4, "x one two three four five six seven"), (5, "b a b a b a"), (6, "a a b b a"), (7, None), (8, ""), (9, "..."),
            (10, items[5][1]), (None, "brown"), (1, "the quick, BROWN fox!")]
    for limit in (c.BROADCAST_BYTES, -1):
        monkeypatch.setattr(c, "BROADCAST_BYTES", limit)
        got = [(r.doc_id, r["items"], r.words) for r in c.flagged(docs(spark, rows), benchmark).collect()]
        assert sorted(got, key=str) == sorted([
            (1, "1,2", 3), (2, "2", 1), (3, "", 0), (4, "3", 7), (5, "4", 4), (6, "", 0), (7, "", 0), (8, "", 0), (9, "", 0),
            (10, "6", 30), (None, "2", 1), (1, "1,2", 3)], key=str)


def test_an_item_is_aligned_alike_whatever_the_others(spark):
    """A long item does not change how a short one is found."""
    short, long = prose(4, 30, 5000), " ".join(f"t{i}" for i in range(400))
    rows = [(1, "a " + short), (2, "so " + long), (3, " ".join(short.split()[:15])), (4, prose(5, 90))]

    def found(items):
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        return {r.doc_id: (r["items"], r.words) for r in c.flagged(docs(spark, rows), benchmark).collect()}

    alone, both = found([(1, short)]), found([(1, short), (2, long)])
    assert both[2] == ("2", 400) and {k: v for k, v in both.items() if k != 2} == {k: v for k, v in alone.items() if k != 2}


def test_shuffled_seeds_give_the_same(spark, monkeypatch):
    item = prose(3, 30, 5000)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, "a " + item), (2, prose(8, 50))]
    monkeypatch.setattr(c, "BROADCAST_BYTES", -1)
    assert [r.contaminated for r in c.flagged(docs(spark, rows), benchmark).orderBy("doc_id").collect()] == [True, False]


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert c.flagged(docs(spark, []), benchmark).count() == 0
    assert c.clean(docs(spark, [(1, "a")]), benchmark).count() == 1


def test_an_upper_cased_passage_with_other_letters(spark):
    items = [
        (1, "la función de la educación está en la región según la comisión económica y su población"),
        (2, "où l'été a été préféré à l'hiver, les élèves français étaient très gênés par la forêt brûlée"),
        (3, "die Straße war groß und weiß und hieß seit jeher Große Gaßstraße bis zum Fluß draußen"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, "Before it. " + text.upper() + " and after") for i, text in items]
    rows += [(i + 10, text) for i, text in items]
    got = {r.doc_id: r["items"] for r in c.flagged(docs(spark, rows), benchmark).collect()}
    assert got == {1: "1", 2: "2", 3: "3", 11: "1", 12: "2", 13: "3"}


def test_words_of_a_leak_longer_than_the_radius(spark):
    item = [f"t{i}" for i in range(400)]
    gap = item[:40] + [f"u{i}" for i in range(8)] + item[48:]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, prose(4, 30, 5000))], "item_id long, text string")
    rows = [(1, "so " + " ".join(item) + " on"), (2, " ".join(item[90:390])), (3, " ".join(gap)),
            (4, "a " + prose(4, 30, 5000)), (5, " ".join(item)), (6, " ".join(item)), (7, None), (8, prose(5, 90))]
    got = {r.doc_id: r.words for r in c.flagged(docs(spark, rows), benchmark).collect()}
    assert got == {1: 400, 2: 300, 3: 392, 4: 30, 5: 400, 6: 400, 7: 0, 8: 0}
