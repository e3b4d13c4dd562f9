"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

A text's features are hashed into a table of fixed size: words, pairs of neighbouring
words, and the same over word shapes (case, digits, signs), with a mark on words that
repeat the one before. Values are 1 + log(count), scaled to length one. Follow-the-
regularised-leader keeps most weights at exactly zero. A score is a sparse dot product.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopflow.llm import arrow
from shopflow.sources import stage

BITS = 18
SAMPLE_ROWS = 24_000  # labelled rows learned from, at most
SAMPLE_CHARS = 48 << 20  # and characters of their texts, at most
SHARDS = 4
LEAST_SHARD = 500  # rows; fewer are not worth a shard of their own
EPOCHS, MOST_EPOCHS = 3, 40
UPDATES = 20_000  # a small sample is passed over until about so many rows were seen
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 1.0

_U64 = np.uint64

# Bytes by shape: lower-case and beyond ASCII, upper-case, digit, sign, white space.
_SHAPE = np.full(256, 4, np.uint8)
_SHAPE[[0x20, *range(0x09, 0x0E)]] = 0
_SHAPE[97:123] = 1
_SHAPE[128:] = 1
_SHAPE[65:91] = 2
_SHAPE[48:58] = 3
_SHAPE_WORD = 5  # shapes of up to five bytes at a word's end tell signs and case apart


def features(offsets, data, bits=BITS):
    """(feature numbers, values, first of each row) of texts as bytes."""
    hashes, first = arrow.words(offsets, data)
    rows = len(offsets) - 1
    shapes = _word_shapes(offsets, data, len(hashes))
    parts, owners = [], []
    row = np.repeat(np.arange(rows), np.diff(first))
    next_same = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        next_same[:-1] = row[1:] == row[:-1]
    pair = np.flatnonzero(next_same)

    def add(salt, values, at):
        parts.append(arrow.mix(values + _U64(salt)) >> _U64(64 - bits))
        owners.append(row[at])

    everywhere = np.arange(len(hashes))
    add(0x11, hashes, everywhere)
    add(0x22, shapes, everywhere)
    if len(pair):
        p, q = hashes[pair], hashes[pair + 1]
        add(0x33, p * _U64(0x9E3779B97F4A7C15) + q, pair)
        repeated = (p == q).astype(np.uint64)
        add(0x44, shapes[pair] * _U64(1 << 20) + shapes[pair + 1] * _U64(2) + repeated, pair)
        add(0x55, repeated, pair)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(rows + 1, np.int64)
    key = (np.concatenate(owners).astype(np.uint64) << _U64(bits)) | np.concatenate(parts)
    key, count = np.unique(key, return_counts=True)
    owner = (key >> _U64(bits)).astype(np.int64)
    value = 1.0 + np.log(count)
    norm = np.sqrt(np.bincount(owner, value * value, rows))
    value /= norm[owner]
    number = (key & _U64((1 << bits) - 1)).astype(np.int64)
    return number, value, np.searchsorted(owner, np.arange(rows + 1))


def _word_shapes(offsets, data, n):
    """A number per word: shapes of its first byte and of its last few, and its length class."""
    if not n:
        return np.zeros(0, np.uint64)
    shape = _SHAPE[data].astype(np.uint64)
    inside = shape > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    stops = np.flatnonzero(ends)
    out = shape[starts]
    for back in range(_SHAPE_WORD):
        at = np.maximum(stops - back, starts)
        out = out * _U64(5) + shape[at]
    # The last byte itself where it is a sign: a full stop is not a hash mark.
    last = data[stops].astype(np.uint64)
    out = out * _U64(256) + np.where(shape[stops] == 4, last, _U64(0))
    return arrow.mix(out) >> _U64(44)


def train_ftrl(number, value, first, label, epochs=EPOCHS, bits=BITS):
    """Weights of one pass sequence over the rows given, by FTRL-proximal; the last is the bias.

    ``number``, ``value`` and ``first`` as from ``features``.
    """
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    bias = 1 << bits

    def weights(at):
        zz = z[at]
        sign = np.sign(zz)
        w = (sign * L1 - zz) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zz) <= L1, 0.0, w)

    order = np.arange(len(label))
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for r in order:
            at = np.append(number[first[r]:first[r + 1]], bias)
            x = np.append(value[first[r]:first[r + 1]], 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label[r]) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(bias + 1))


def _sample(docs: DataFrame, labels: DataFrame, rows: int, chars: int) -> DataFrame:
    """Stored (id, label, text) of at most ``rows`` rows and ``chars`` characters.

    Labels are picked by the least hash of the id, so only their texts are read for long,
    and only picked texts move. Picked labels are few enough to be broadcast.
    """
    total = labels.count()
    share = min(1.0, rows * 1.2 / max(total, 1))
    least = (
        labels.withColumn("hash", F.xxhash64("id"))
        .where((F.col("hash").cast("double") / 2.0**64 + 0.5) <= share)
        .orderBy("hash", "id", "label").limit(rows)
    )
    least = stage.table(least, "quality-labels")
    texts = docs.join(F.broadcast(least), "id")
    sizes = sorted((r["hash"], r.chars) for r in texts.groupBy("hash").agg(
        F.sum(F.length("text")).alias("chars")).collect())  # at most ``rows`` of them
    held, fitting = 0, []
    for value, size in sizes:
        if held + size <= chars:  # a text that does not fit costs itself only
            held += size
            fitting.append((value,))
    fitting = docs.sparkSession.createDataFrame(fitting, "hash long")
    return stage.table(texts.join(F.broadcast(fitting), "hash", "left_semi"), "quality-sample")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
        shards: int = SHARDS) -> np.ndarray:
    """Weights learned from a bounded sample of labelled rows (``rows``, ``chars``).

    The sample is dealt into ``shards`` by hash; each learns its own weights in a task and
    their mean is taken, so what reaches the driver is one vector of 2**BITS + 1 numbers.
    Labels that are not 0 or 1, or of no document, are left out; with none left all weights
    are 0 and every score is 0.5. A document labelled twice counts twice. The id only
    joins and picks rows; they are dealt and ordered by their texts. Rows are taken in the
    order of their hash as long as they fit, so a text that exceeds what is left of
    ``chars`` is not learned from, and only it is left out.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("label"))
    texts = docs.select(F.col(id_col).cast("string").alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = _sample(texts, known, rows, chars)
    picked = sample.count()
    shards = max(1, min(shards, picked // LEAST_SHARD))
    epochs = min(MOST_EPOCHS, max(EPOCHS, UPDATES * shards // max(picked, 1)))
    sample = sample.withColumn("place", F.xxhash64("text")).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(shards)).cast("int"))

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("label", "ascending"), ("text", "ascending")])
        numbers, values, firsts = [], [], [np.zeros(1, np.int64)]
        for _, offsets, data in arrow.text_blocks(group.column("text")):
            number, value, first = features(offsets, data)
            firsts.append(first[1:] + firsts[-1][-1])
            numbers.append(number.astype(np.int32))
            values.append(value.astype(np.float32))
        w = train_ftrl(np.concatenate(numbers), np.concatenate(values), np.concatenate(firsts),
                       group.column("label").to_numpy(), epochs)
        at = np.flatnonzero(w)
        del numbers, values, firsts, group
        arrow.release()
        return pa.table({"at": pa.array(at, pa.int32()), "w": pa.array(w[at], pa.float64())})

    learned = sample.groupBy("shard").applyInArrow(learn, "at int, w double")
    out = np.zeros((1 << BITS) + 1)
    for r in learned.groupBy("at").agg(F.sort_array(F.collect_list("w")).alias("ws")).collect():
        out[r["at"]] = sum(r.ws) / shards  # sorted: the same sum in every run
    return out


def _scores(texts, w):
    scores = np.zeros(len(texts))
    for row, offsets, data in arrow.text_blocks(texts):
        number, value, first = features(offsets, data)
        n = len(first) - 1
        owner = np.repeat(np.arange(n), np.diff(first))
        scores[row:row + n] = np.bincount(owner, w[number] * value, n) + w[-1]
    return 1 / (1 + np.exp(-np.clip(scores, -35, 35)))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` (0 to 1) of every row's whole text.

    A null or empty text has no features and gets the bias alone. Repeated rows and null
    ids give rows; other columns are ignored. The weights are broadcast: their size is
    fixed, whatever the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            scores = _scores(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    return frame.mapInArrow(arrow.tidy(run), f"id {kind}, score double").withColumnRenamed("id", id_col)


def accept(docs: DataFrame, weights: np.ndarray, cut: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``cut`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    text = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            scores = _scores(batch.column(text), shared.value)
            yield batch.filter(pa.array(scores >= cut))

    return docs.mapInArrow(arrow.tidy(run), docs.schema)
