"""Benchmark decontamination by spaced-seed hashing.

Texts become words (folded to one case, cut at ASCII signs and white space) and words become
64-bit hashes. A mask picks some of SPAN neighbouring words and ignores the others, so a
seed survives a substitution at an ignored position; the masks ignore different positions.
Seeds of benchmark items and of texts are joined by hash. Around every hit the text is
aligned with the item, word by word without gaps, and the overlap with the best run is
kept: a run grows while at least MATCH_SHARE of its words agree. RADIUS words to either side
reach both ends of an item that is not longer; with longer items the text and the item are
aligned from end to end, once for every shift at which a seed hit. Which of the two it is
depends on the item alone. Items of fewer than SPAN words have no seed: texts are searched
for runs of exactly their words.
"""

import json

from pyspark.sql import DataFrame, functions as F

from shopflow.sources import stage

# The masks; 0 ignores a word. Each inner position is ignored by one of them.
MASKS = ["11101101", "10110111", "11011011"]
SPAN = 8
RADIUS = 64  # words carried along with a hit, to either side; longer items are met otherwise
LEAST_WORDS = 13  # agreeing words of a run that make a leak, fewer only for short items
MATCH_SHARE = 0.8
BROADCAST_BYTES = 64 << 20  # of seeds; more are joined by shuffling
BITMAP_BITS = 1 << 22  # at most, of the filter in front of the join

SIGNS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def _hashes(text):
    """The words of a text column as an array of hashes.

    Upper case first: it writes out the letters that have no capital ('ß' as 'SS'). Without
    the blank in between Spark would simplify the two to ``lower`` alone.
    """
    words = F.split(F.lower(F.concat(F.upper(text), F.lit(" "))), SIGNS, -1)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(mask, tokens, at):
    """The hash of the words that mask number ``mask`` picks from position ``at`` on."""
    picked = [F.get(tokens, at + o) for o, bit in enumerate(MASKS[mask]) if bit == "1"]
    return F.xxhash64(F.lit(mask), *picked)


def _starts(tokens):
    """Positions at which SPAN words begin."""
    n = F.size(tokens)
    return F.when(n >= SPAN, F.sequence(F.lit(0), n - SPAN)).otherwise(
        F.expr("array()").cast("array<int>"))


class _Bitmap:
    """A literal set of hashes: never misses one, lets a small share of others pass."""

    def __init__(self, hashes: DataFrame, column: str, per_hash: int):
        n = max(hashes.count(), 1)
        self.bits = min(BITMAP_BITS, max(64, 1 << (n * per_hash - 1).bit_length()))
        spot = F.pmod(F.col(column), F.lit(self.bits))
        words = [0] * (self.bits // 64)
        for r in (hashes.groupBy(F.shiftright(spot, 6).cast("int").alias("at"))
                  .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))")).alias("word"))
                  .collect()):
            words[r["at"]] = r.word
        self.literal = F.from_json(F.lit(json.dumps(words)), "array<bigint>")

    def may_hold(self, value):
        spot = F.pmod(value, F.lit(self.bits))
        word = F.get(self.literal, F.shiftright(spot, 6).cast("int"))
        return F.getbit(word, F.pmod(value, F.lit(64)).cast("int")) == 1


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored (item, tokens) of the items with a word."""
    items = benchmark.select(F.col(id_col).alias("item"), _hashes(
        F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("tokens"))
    known = items.where((F.size("tokens") > 0) & F.col("item").isNotNull()).distinct()
    return stage.table(known, "benchmark-items")


def _seeds(items: DataFrame) -> DataFrame:
    """Stored (seed, item, at) of every item of SPAN words or more, position and mask."""
    def seeds_of(m):
        return F.transform(_starts(F.col("tokens")), lambda i: F.struct(
            _seed(m, F.col("tokens"), i).alias("seed"), i.alias("at")))

    every = F.concat(*[seeds_of(m) for m in range(len(MASKS))])
    seeds = items.select("item", F.explode(every).alias("s")).select("s.seed", "item", "s.at")
    return stage.table(seeds, "benchmark-seeds")


def _agreeing(eq):
    """Most agreeing words of a run in which at least MATCH_SHARE of the words agree.

    Scores +1 for a word that agrees and minus share / (1 - share) for another; a run goes
    on while its score is above 0.
    """
    loss = MATCH_SHARE / (1 - MATCH_SHARE)
    zero = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("words"), F.lit(0).alias("best"))

    def step(acc, same):
        score = acc["score"] + F.when(same, F.lit(1.0)).otherwise(F.lit(-loss))
        words = acc["words"] + F.when(same, F.lit(1)).otherwise(F.lit(0))
        on = score > 1e-9
        return F.struct(
            F.when(on, score).otherwise(F.lit(0.0)).alias("score"),
            F.when(on, words).otherwise(F.lit(0)).alias("words"),
            F.greatest(acc["best"], F.when(on, words).otherwise(F.lit(0))).alias("best"))

    return F.aggregate(eq, zero, step, lambda acc: acc["best"])


def text_key(text_col: str = "text"):
    """128 bits that stand for a text; whether it leaks depends on nothing else."""
    text = F.col(text_col).cast("string")
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _around(docs, text_col, texts, seeds, items):
    """``key``, ``item``, ``n`` and ``eq``: a row per hit, RADIUS words to either side."""
    # explode_outer: a filter on the arrays would be pushed below them and compute them anew
    # for every word; the join drops the texts without a hit.
    hit = texts.select("key", "tokens", "hits").select(
        "key", F.explode_outer(F.transform("hits", lambda h: F.struct(
            h["seed"].alias("seed"),
            F.least(h["at"], F.lit(RADIUS)).alias("left"),
            F.slice("tokens", h["at"] - F.least(h["at"], F.lit(RADIUS)) + 1,
                    F.least(h["at"], F.lit(RADIUS)) + SPAN + RADIUS).alias("around")))).alias("h"),
    ).select("key", "h.*")
    met = hit.join(seeds, "seed").join(items, "item")
    left = F.least("left", "at")
    size = left + F.least(F.size("around") - F.col("left"), F.size("tokens") - F.col("at"))
    return met.select(
        "key", "item", F.size("tokens").alias("n"),
        F.zip_with(
            F.slice("around", F.col("left") - left + 1, size),
            F.slice("tokens", F.col("at") - left + 1, size), lambda a, b: a == b).alias("eq"))


def _end_to_end(docs, text_col, texts, seeds, items):
    """The same, a row per shift between a text and an item, over all their words."""
    hit = texts.select("key", F.explode_outer("hits").alias("h")).select(
        "key", "h.seed", F.col("h.at").alias("there"))
    shifts = stage.table(
        hit.join(seeds, "seed").join(items.select("item"), "item", "left_semi").select("key", "item", (F.col("there") - F.col("at")).alias("shift"))
        .distinct(), "benchmark-shifts")
    of_text = shifts.groupBy(F.col("key").alias("known")).agg(
        F.collect_list(F.struct("item", "shift")).alias("met"))
    raw = docs.select(text_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    met = (
        raw.join(of_text, F.col("key") == F.col("known"))
        .select("key", "met", _hashes(F.col("text")).alias("words"))
        .select("key", "words", F.explode("met").alias("m")).select("key", "words", "m.*")
        .join(items, "item")
    )
    there, at = F.greatest("shift", F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    size = F.least(F.size("words") - there, F.size("tokens") - at)
    return met.select(
        "key", "item", F.size("tokens").alias("n"),
        F.zip_with(F.slice("words", there + 1, size), F.slice("tokens", at + 1, size),
                   lambda a, b: a == b).alias("eq"))


def _short_leaks(texts, items, sizes):
    """(key, item, words) of items of ``sizes`` words that a text holds as a whole run."""
    filed = items.select(F.xxhash64(F.lit(-1), F.size("tokens"), "tokens").alias("run"), "item", "tokens")
    filed = stage.table(filed, "benchmark-runs")
    if filed.count() * SPAN * 16 <= BROADCAST_BYTES:
        filed = F.broadcast(filed)

    def runs(n):
        ends = F.size("tokens") - n
        starts = F.when(ends >= 0, F.sequence(F.lit(0), ends)).otherwise(F.expr("array()").cast("array<int>"))

        def possible(i):
            cond = F.get("known", i)
            for o in range(1, n):
                cond = cond & F.get("known", i + o)
            return cond

        return F.transform(F.filter(starts, possible), lambda i: F.slice("tokens", i + 1, n))

    held = F.array_distinct(F.concat(*[runs(n) for n in sizes]))
    found = texts.select("key", F.explode(held).alias("words")).select(
        "key", "words", F.xxhash64(F.lit(-1), F.size("words"), "words").alias("run"))
    met = found.join(filed, "run").where(F.col("words") == F.col("tokens"))
    return met.select("key", "item", F.size("tokens").cast("long").alias("words")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``key`` (see ``text_key``), ``item`` and ``words`` (agreeing ones) of every leak.

    A text leaks an item when a run (see the module) has LEAST_WORDS agreeing words, or
    MATCH_SHARE of the item's words where that is fewer; of an item of fewer than SPAN words
    it holds all words in a row. Items without a word are not looked for. One row per
    different text and item, so copies of a text share their rows; null texts and null item
    ids take no part.
    """
    every = _items(benchmark, item_col, item_text_col)
    sizes = sorted(r.n for r in every.select(F.size("tokens").alias("n")).where(F.col("n") < SPAN).distinct().collect())
    items = every.where(F.size("tokens") >= SPAN)
    seeds = _seeds(items)
    seed_bytes = seeds.count() * 40
    vocabulary = _Bitmap(every.select(F.explode("tokens").alias("word")).distinct(), "word", 32)
    filed = _Bitmap(seeds.select("seed").distinct(), "seed", 64)

    texts = docs.where(F.col(text_col).isNotNull()).select(
        text_key(text_col).alias("key"), _hashes(F.col(text_col).cast("string")).alias("tokens"))
    texts = texts.withColumn("known", F.transform("tokens", vocabulary.may_hold))

    def hits(m):
        offsets = [o for o, bit in enumerate(MASKS[m]) if bit == "1"]

        def possible(i):
            cond = F.get("known", i + offsets[0])
            for o in offsets[1:]:
                cond = cond & F.get("known", i + o)
            return cond

        found = F.transform(F.filter(_starts(F.col("tokens")), possible), lambda i: F.struct(
            i.alias("at"), _seed(m, F.col("tokens"), i).alias("seed")))
        return F.filter(found, lambda h: filed.may_hold(h["seed"]))

    texts = texts.withColumn("hits", F.concat(*[hits(m) for m in range(len(MASKS))]))
    small = seed_bytes <= BROADCAST_BYTES

    def sent(df):
        return F.broadcast(df) if small else df

    longest = items.agg(F.coalesce(F.max(F.size("tokens")), F.lit(0)).alias("n")).first().n
    near, far = items.where(F.size("tokens") <= RADIUS), items.where(F.size("tokens") > RADIUS)
    aligned = _around(docs, text_col, texts, sent(seeds), sent(near))
    if longest > RADIUS:
        aligned = aligned.unionByName(_end_to_end(docs, text_col, texts, sent(seeds), sent(far)))
    scored = aligned.select("key", "item", "n", _agreeing(F.col("eq")).alias("words"))
    enough = F.least(F.lit(LEAST_WORDS), F.ceil(F.col("n") * MATCH_SHARE))
    found = (
        scored.where(F.col("words") >= enough)
        .groupBy("key", "item").agg(F.max("words").cast("long").alias("words"))
    )
    if sizes:
        found = found.unionByName(_short_leaks(texts, every.where(F.size("tokens") < SPAN), sizes))
    return found


def flagged(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
            text_col: str = "text", **columns) -> DataFrame:
    """``id_col``, ``contaminated``, ``n_items``, ``items`` (text, ascending) and ``words``.

    A row per row of ``docs``, repeated rows, null ids and null or empty texts (never
    contaminated) included. Found leaks are stored, so their size is known for the join.
    """
    found = stage.table(
        leaks(docs, benchmark, text_col, **columns).groupBy("key").agg(
            F.sort_array(F.collect_list("item")).alias("found"), F.max("words").alias("words")),
        "leaks").withColumnRenamed("key", "known")
    keyed = docs.select(F.col(id_col), text_key(text_col).alias("key"))
    return keyed.join(found, F.col("key") == F.col("known"), "left").select(
        id_col, F.col("found").isNotNull().alias("contaminated"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.transform("found", lambda x: x.cast("string")), ","), F.lit("")).alias("items"),
        F.coalesce("words", F.lit(0)).cast("long").alias("words"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **columns) -> DataFrame:
    """``docs`` without contaminated rows; all columns stay."""
    found = stage.table(
        leaks(docs, benchmark, text_col, **columns).select("key").distinct(), "leaks"
    ).select(F.col("key").alias("_leak"))
    rows = docs.select(F.struct("*").alias("_row"), text_key(text_col).alias("_key"))
    return rows.join(found, F.col("_key") == F.col("_leak"), "left_anti").select("_row.*")
