"""Language-model scoring with a hidden Markov model over word classes.

Words are counted over all training texts. The most frequent ones are classes of their own,
the others share classes by hash; a shared class gives its word by smoothed share, so every
text, unknown words included, has a proper probability. Baum-Welch runs on all training
texts: tasks sum expected counts, Spark adds them up, and only the sums, whose size does
not depend on the corpus, reach the driver. Scoring runs the scaled forward recursion over
whole texts.

Counts of words beyond a share of the corpus are broadcast: at most HEAVY words can have a
share of 1/HEAVY. The others are joined by word, so nothing that grows with the corpus
passes through the driver or is broadcast.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopflow.llm import arrow
from shopflow.sources import stage

STATES = 6
OWN = 2_000  # words with 1/OWN of all training tokens or more are classes of their own
BUCKET_BITS = 6  # the others share 2**BUCKET_BITS classes
HEAVY = 1 << 20
ROUNDS = 4
SEGMENT = 128  # tokens of a row of the training matrix; longer texts take several rows
PIECES = 1024  # rows handled at once
SMOOTH = 0.1  # added to every word's count
SEED = 7

_U64 = np.uint64


def _count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over a column ``text``; a word is its 64-bit hash."""
    def run(batches):
        for batch in batches:
            held, size = [], 0
            for _, offsets, data in arrow.text_blocks(batch.column(0)):
                hashes, _ = arrow.words(offsets, data)
                held.append(hashes)
                size += len(hashes)
                if size > 4_000_000:
                    yield _counted(held)
                    held, size = [], 0
            if size:
                yield _counted(held)

    def _counted(held):
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])

    parts = texts.mapInArrow(arrow.tidy(run), "word long, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """What tasks need of the counts: bounded by HEAVY and the number of classes."""

    def __init__(self, word, n, tokens, types, ends, bucket_n, bucket_types):
        order = np.argsort(word)
        self.word, self.n = word[order], n[order]  # heavy words, sorted by hash
        self.tokens, self.types, self.ends = tokens, types, ends
        own = self.n * OWN >= tokens
        self.buckets = 1 << BUCKET_BITS
        self.classes = self.buckets + int(own.sum()) + 1
        self.end = self.classes - 1
        self.class_of = np.where(own, self.buckets + np.cumsum(own) - 1, -1)
        share = np.zeros(self.buckets)
        np.add.at(share, self._bucket(self.word[own]), self.n[own])
        number = np.bincount(self._bucket(self.word[own]), minlength=self.buckets)
        # Tokens and types of each shared class, with one type for all unknown words.
        self.shared = bucket_n - share + SMOOTH * (bucket_types - number + 1)
        self.class_n = np.concatenate([bucket_n - share, self.n[own], [ends]])
        self.log_total = np.log10(tokens + SMOOTH * (types + 1))

    def _bucket(self, words):
        return (words >> _U64(64 - BUCKET_BITS)).astype(np.int64)

    def look_up(self, words):
        """(class, log10 count, log10 share in the class, is heavy) of words by hash.

        Counts and shares of words that are not heavy are still to be joined: their count
        is given as 0, and their share lacks it.
        """
        at = np.minimum(np.searchsorted(self.word, words), max(len(self.word) - 1, 0))
        heavy = self.word[at] == words if len(self.word) else np.zeros(len(words), bool)
        bucket = self._bucket(words)
        cls, log_n = bucket.copy(), np.zeros(len(words))
        if heavy.any():
            found = self.class_of[at[heavy]]
            cls[heavy] = np.where(found >= 0, found, bucket[heavy])
            log_n[heavy] = np.log10(self.n[at[heavy]] + SMOOTH)
        own = cls >= self.buckets
        log_share = np.where(own, 0.0, log_n - np.log10(self.shared)[bucket])
        return cls, log_n, log_share, heavy


def _vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("t")).first()
    tokens, types = total.n + ends, total.t + (ends > 0)
    heavy = counts.where(F.col("n") * HEAVY >= tokens).toPandas()
    bucket = F.shiftrightunsigned("word", 64 - BUCKET_BITS).cast("int")
    n, t = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for r in counts.groupBy(bucket.alias("b")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("t")).collect():
        n[r.b], t[r.b] = r.n, r.t
    return Vocabulary(heavy["word"].to_numpy(np.int64).view(np.uint64),
                      heavy["n"].to_numpy(np.int64), tokens, types, ends, n, t)


def _encode(rows: DataFrame, shared) -> DataFrame:
    """Class sequences and sums of heavy words per text, and its other words with counts."""
    def run(batches):
        vocabulary = shared.value
        for batch in batches:
            for row, offsets, data in arrow.text_blocks(batch.column(3)):
                n = len(offsets) - 1
                hashes, first = arrow.words(offsets, data)
                owner = np.repeat(np.arange(n), np.diff(first))
                unique, back = np.unique(hashes, return_inverse=True)
                cls, log_n, log_share, heavy = (x[back] for x in vocabulary.look_up(unique))
                end_n = vocabulary.ends + SMOOTH
                sequence = np.full(len(hashes) + n, vocabulary.end, np.uint16)
                sequence[np.arange(len(hashes)) + owner] = cls
                bounds = first + np.arange(n + 1)
                rare = np.flatnonzero(~heavy)
                word, word_first = hashes[rare], np.searchsorted(owner[rare], np.arange(n + 1))
                order = np.lexsort((word, owner[rare]))
                word, own = word[order], owner[rare][order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (own[1:] != own[:-1])
                starts = np.flatnonzero(new)
                times = np.diff(np.append(starts, len(word)))
                word_first = np.searchsorted(own[starts], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(row, n) for c in range(3)],
                    pa.array([sequence[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(np.bincount(owner, heavy, n).astype(np.int64) + (vocabulary.ends > 0)),
                    pa.array(np.bincount(owner, log_n, n) + np.log10(end_n)),
                    pa.array(np.bincount(owner, log_share, n)),
                    pa.ListArray.from_arrays(pa.array(word_first), pa.array(word[starts].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(word_first), pa.array(times, pa.int32())),
                ], names=["key", "id", "held_out", "classes", "n_tokens", "known", "log_n",
                          "log_share", "words", "times"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(arrow.tidy(run), (
        f"key long, id {kind}, held_out boolean, classes binary, n_tokens long, known long, "
        "log_n double, log_share double, words array<long>, times array<int>"))


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start, step, emit):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, class_n, states=STATES, seed=SEED):
        """Sticky states whose emissions are class shares with noise, alike in every run."""
        rng = np.random.default_rng(seed)
        step = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
        emit = (class_n + 0.1) * rng.uniform(0.5, 1.5, (states, len(class_n)))
        even = np.full(states, 1 / states)
        return cls(even, step, emit / emit.sum(1, keepdims=True))

    def updated(self, sums):
        """The model that expected counts call for, with a little of the shares for zeros."""
        k, c = self.emit.shape
        start, step, emit = sums[:k], sums[k:k + k * k].reshape(k, k), sums[k + k * k:].reshape(k, c)
        shares = emit.sum(0) + 0.1
        emit = emit + 0.5 * shares / shares.sum()
        step, start = step + 0.01, start + 0.01
        return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def messages(model: Model, classes, starts):
    """What pieces of longer texts pass on to each other, exactly.

    ``entering`` is the distribution of the state before a piece (unused where a text
    starts), ``leaving`` the weight of the states after it, 1 at a text's end; both as
    (pieces, states). A piece is a matrix from the state at its first token to the one at
    its last; the matrices of a text are multiplied along from both ends.
    """
    pieces, length = classes.shape
    k, c = model.emit.shape
    entering, leaving = np.zeros((pieces, k)), np.ones((pieces, k))
    first = np.flatnonzero(starts)
    counts = np.diff(np.append(first, pieces))
    if not pieces or counts.max() == 1:
        return entering, leaving
    of = np.flatnonzero(np.repeat(counts > 1, counts))
    emit = np.vstack([model.emit.T, np.ones(k)])
    through = np.empty((pieces, k, k))
    for low in range(0, len(of), PIECES):
        some = of[low:low + PIECES]
        own = np.zeros((len(some), k, k))
        own[:, np.arange(k), np.arange(k)] = emit[classes[some, 0]]
        for t in range(1, length):
            now = classes[some, t]
            ahead = (own.reshape(-1, k) @ model.step).reshape(own.shape) * emit[now][:, None, :]
            own = np.where((now < c)[:, None, None], ahead, own)
            if t % 8 == 0:
                own /= own.sum((1, 2), keepdims=True)
        through[some] = own / own.sum((1, 2), keepdims=True)
    for j in range(1, int(counts.max())):
        at = first[counts > j] + j  # pieces that come j-th in their text, from 0
        before = np.broadcast_to(model.start, (len(at), k)) if j == 1 else entering[at - 1] @ model.step
        a = np.einsum("pk,pkl->pl", before, through[at - 1])
        entering[at] = a / a.sum(1, keepdims=True)
    for j in range(int(counts.max()) - 1, 0, -1):
        at = first[counts > j] + j
        b = np.einsum("pkl,pl->pk", through[at], leaving[at]) @ model.step.T
        leaving[at - 1] = b / b.sum(1, keepdims=True)
    return entering, leaving


def expected_counts(model: Model, classes, starts, entering, leaving) -> np.ndarray:
    """Expected starts, steps and emissions of pieces, as one vector.

    ``classes`` is (pieces, SEGMENT) with the number of classes as padding, which only ends
    texts; ``starts`` tells which pieces begin a text, and ``messages`` gives the others.
    Steps from one piece to the next are counted with the later one.
    """
    k, c = model.emit.shape
    emit = np.vstack([model.emit.T, np.ones(k)])
    pieces, length = classes.shape
    alpha, scale = np.empty((length, pieces, k)), np.empty((length, pieces))
    valid = classes < c
    a = np.where(starts[:, None], model.start, entering @ model.step)
    for t in range(length):
        if t:
            a = a @ model.step
        a = a * emit[classes[:, t]]
        scale[t] = np.where(valid[:, t], a.sum(1), 1.0)
        a = a / scale[t][:, None]
        alpha[t] = a
    steps, beta = np.zeros((k, k)), leaving / (alpha[-1] * leaving).sum(1, keepdims=True)
    for t in range(length - 1, 0, -1):
        ahead = emit[classes[:, t]] * beta / scale[t][:, None]
        steps += alpha[t - 1].T @ (ahead * valid[:, t, None])
        gamma = alpha[t] * beta
        alpha[t] = gamma / gamma.sum(1, keepdims=True)
        beta = ahead @ model.step.T
    inner = ~starts
    steps += entering[inner].T @ (emit[classes[inner, 0]] * beta[inner] / scale[0][inner, None])
    gamma = alpha[0] * beta
    alpha[0] = gamma / gamma.sum(1, keepdims=True)
    flat = classes.T.ravel()
    emits = [np.bincount(flat, alpha[:, :, s].ravel(), c + 1)[:c] for s in range(k)]
    start = alpha[0][starts].sum(0)
    return np.concatenate([start, (steps * model.step).ravel(), *emits])


def _pieces(sequences, classes):
    """Cut class sequences into rows of SEGMENT classes, padded."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    counts = -(-lengths // SEGMENT)
    out = np.full((counts.sum(), SEGMENT), classes, np.int64)
    begins = np.zeros(len(out), bool)
    at = 0
    for s, n in zip(sequences, counts):
        out[at:at + n].ravel()[:len(s)] = s
        begins[at] = True
        at += n
    return out, begins


def train(encoded: DataFrame, class_n, rounds: int = ROUNDS, states: int = STATES) -> Model:
    """Baum-Welch over ``classes`` of all rows; expected counts are summed by Spark."""
    model = Model.first(class_n, states)
    context = encoded.sparkSession.sparkContext
    size = states + states * states + states * len(class_n)
    for _ in range(rounds):
        shared = context.broadcast(model)

        def run(batches, shared=shared):
            model, total = shared.value, 0.0
            c = model.emit.shape[1]
            for batch in batches:
                held, pieces = [], 0
                for packed in batch.column(0).to_pylist():
                    held.append(np.frombuffer(packed, np.uint16))
                    pieces += -(-len(held[-1]) // SEGMENT)
                    if pieces >= PIECES:
                        total, held, pieces = total + _sum(model, held, c), [], 0
                if held:
                    total = total + _sum(model, held, c)
            if np.ndim(total):
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array(total[at])], names=["at", "n"])

        def _sum(model, held, c):
            pieces, starts = _pieces(held, c)
            entering, leaving = messages(model, pieces, starts)
            return sum(expected_counts(model, *(x[low:low + PIECES] for x in (pieces, starts, entering, leaving)))
                       for low in range(0, len(pieces), PIECES))

        sums = np.zeros(size)
        for r in (encoded.select("classes").mapInArrow(arrow.tidy(run), "at int, n double")
                  .groupBy("at").agg(F.sum("n").alias("n")).collect()):
            sums[r["at"]] = r.n
        model = model.updated(sums)
        shared.unpersist()
    return model


def forward(model: Model, sequences) -> np.ndarray:
    """log10 probability of every class sequence, by the scaled forward recursion."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate(sequences).astype(np.int64) if len(sequences) else np.zeros(0, np.int64)
    starts = (np.cumsum(lengths) - lengths)[order]
    ranked = lengths[order]
    out = np.zeros(len(sequences))
    emit = np.ascontiguousarray(model.emit.T)
    active = int((ranked > 0).sum())
    a = np.tile(model.start, (active, 1))
    t = 0
    while active:
        if t:
            a = a[:active] @ model.step
        a = a * emit[flat[starts[:active] + t]]
        scale = a.sum(1)
        a /= scale[:, None]
        out[order[:active]] += np.log10(scale)
        t += 1
        while active and ranked[active - 1] <= t:
            active -= 1
    return out


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """Counts and log10 probabilities of every row of ``docs``.

    ``training`` is a boolean column: rows where it is true are learned from, others
    (false or null) are held out. Returns ``id_col``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` (smoothed single words) and ``score``
    (the model). A null or empty text is its end token alone. Every row gives a row,
    repeated rows and null ids too; other columns are ignored. Without training rows all
    words are unknown and the model keeps its first guess.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), (~F.coalesce(training, F.lit(False))).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    learned = rows.where(~F.col("held_out"))
    counts = stage.table(_count_words(learned.select("text")), "word-counts")
    vocabulary = _vocabulary(counts, learned.count())
    shared = spark.sparkContext.broadcast(vocabulary)
    keyed = rows.select(F.monotonically_increasing_id().alias("key"), "id", "held_out", "text")
    encoded = stage.table(_encode(keyed, shared), "word-classes")
    model = train(encoded.where(~F.col("held_out")), vocabulary.class_n, rounds)

    words = encoded.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "key", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    light = counts.where(F.col("n") * HEAVY < vocabulary.tokens)
    rest = words.join(light, "word", "left").groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("rest"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rest_known"))

    final = spark.sparkContext.broadcast(model)
    kind = encoded.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sequences = [np.frombuffer(x, np.uint16) for x in batch.column(7).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in range(7)], pa.array(forward(final.value, sequences))],
                names=["key", "id", "held_out", "n_tokens", "known", "log_n", "log_share", "log_classes"])

    scored = encoded.select(
        "key", "id", "held_out", "n_tokens", "known", "log_n", "log_share", "classes",
    ).mapInArrow(arrow.tidy(run), (f"key long, id {kind}, held_out boolean, n_tokens long, known long, "
                       "log_n double, log_share double, log_classes double"))
    rest_sum = F.coalesce("rest", F.lit(0.0))
    return scored.join(rest, "key", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(int(vocabulary.tokens)).cast("long").alias("train_tokens"),
        (F.col("log_n") + rest_sum - F.col("n_tokens") * F.lit(float(vocabulary.log_total))).alias("base_score"),
        (F.col("log_classes") + F.col("log_share") + rest_sum).alias("score"),
    )
