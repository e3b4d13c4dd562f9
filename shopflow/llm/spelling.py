"""Spelling variants: words at one edit, found by a relational frontier over a trie.

All words lie in a trie whose nodes are prefixes, written as 64-bit hashes, and whose edges
are rows of a distributed table: (node, label) -> child, where a label is the hash of the
next few letters. A word is followed by an end sign, so the node behind it is the word's own.
A state of the frontier is (word, place in it, node, edits). Reading its own letters, a word
stands at its own prefixes without edits. At every place it makes its one edit: it leaves a
letter out, or takes a later letter of the alphabet instead, which is a join with edges that
skip one letter. From then on every level joins all states with the edge table on the node
and the next letters of the word. States whose word is read have reached a neighbour. An
inserted letter is one left out as seen from the other word, and an earlier letter a later
one, so found pairs are taken both ways.

Labels take four letters near the root and half the depth below, so words of n letters take
some log(n) levels, however long. Equal hashes of different prefixes can only add states;
pairs are compared letter by letter in the end.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopflow.llm import arrow
from shopflow.sources import stage

SHORTEST, FEWEST = 5, 3  # letters of a word, occurrences in all
DAMAGE = 97  # one run in this many loses a letter
HELD = 200_000  # words counted in a task before their counts go on
LETTERS = 1 << 16  # letters of words handled at once
TEXT_PART = 1 << 20  # letters of a text searched at once
LABEL = 4

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_U64 = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


def _parts(text):
    """Parts of a long text, cut where no run can go on."""
    low = 0
    while len(text) - low > TEXT_PART:
        found = _BREAK.search(text, low + TEXT_PART)
        if not found:
            break
        yield text[low:found.end()]
        low = found.end()
    yield text[low:]


def count_runs(doc_id, text: str, counts: Counter) -> None:
    """Add the words of a text to ``counts``, damaged where the id and the run say so."""
    begin = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
    own = Counter()
    for part in _parts(text.encode().lower().decode()):
        own.update(x for x in _RUN.findall(part) if len(x) >= SHORTEST)
    for run, n in own.items():
        if begin is not None:
            h = zlib.crc32(run.encode(), begin)
            if h % DAMAGE == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < SHORTEST:
                    continue
        counts[run] += n


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n``: words of SHORTEST letters or more that occur FEWEST times or more."""
    frame = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        def rows(counts):
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        counts = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    count_runs(doc_id, text, counts)
                    if len(counts) >= HELD:
                        yield rows(counts)
                        counts = Counter()
        if counts:
            yield rows(counts)

    return frame.mapInArrow(arrow.tidy(run), "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= FEWEST)


class Letters:
    """Words laid end to end, each with its end sign, and hashes of any stretch of them."""

    def __init__(self, words: list):
        self.code = np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le"), np.uint32).astype(_U64)
        size = len(self.code)
        self.at = np.arange(size)
        ends = np.flatnonzero(self.code == 0)
        starts = np.concatenate(([0], ends[:-1] + 1))
        self.starts, self.ends = starts, ends
        number = np.repeat(np.arange(len(words)), ends - starts + 1)
        self.start, self.end = starts[number], ends[number]  # of the word around each sign
        power = np.full(size + 1, _P, _U64)
        self.inverse = np.full(size + 1, _P_INVERSE, _U64)
        power[0] = self.inverse[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(size + 1, _U64)
        np.cumsum(arrow.mix(self.code + _U64(1)) * power[:size], out=self.sums[1:])

    def hash(self, low, high):
        return arrow.mix((self.sums[high] - self.sums[low]) * self.inverse[low]
                         + (high - low).astype(_U64) * _U64(0xD6E8FEB86659FD93))

    def stops(self, at, depth, end):
        """Where the label that a word reads from ``at`` ends, the node lying at ``depth``."""
        return np.minimum(at + np.maximum(LABEL, depth // 2), end + 1)

    def ids(self):
        """Each word's own node."""
        return self.hash(self.starts, self.ends + 1)


def _long(x):
    return pa.array(x.view(np.int64), pa.int64())


def _edges(letters):
    at, start, end = letters.at, letters.start, letters.end
    stop = letters.stops(at, at - start, end)
    label, child = letters.hash(at, stop), letters.hash(start, stop)
    node = letters.hash(start, at)
    inner = np.flatnonzero(at < end)
    none = np.zeros(len(at), np.int32)
    # Plain edges have letter 0; edges that skip a letter name it and read on behind it.
    return [_long(np.concatenate((node, node[inner]))),
            pa.array(np.concatenate((none, letters.code[inner].astype(np.int32))), pa.int32()),
            _long(np.concatenate((label, label[inner + 1]))),
            _long(np.concatenate((child, child[inner + 1])))]


def _walks(letters):
    at, start, end, code = letters.at, letters.start, letters.end, letters.code
    inner = np.flatnonzero(at < end)
    first = inner == start[inner]
    once = inner[first | (code[inner] != code[inner - 1])]  # of equal letters in a row one is left out
    taken = np.concatenate((code[inner].astype(np.int32), np.zeros(len(once), np.int32)))
    edit = np.concatenate((inner, once))
    shift = np.concatenate((np.ones(len(inner), np.int64), np.zeros(len(once), np.int64)))
    place, depth, stop = edit + 1, edit - start[edit] + shift, end[edit]
    labels, there = [], []
    now = place.copy()
    while (now <= stop).any():
        going = now <= stop
        ahead = np.where(going, letters.stops(now, depth, stop), now)
        labels.append(letters.hash(np.minimum(now, stop), np.maximum(ahead, np.minimum(now, stop))))
        there.append(going)
        depth, now = depth + (ahead - now), ahead
    there, labels = np.stack(there, 1), np.stack(labels, 1)
    offsets = np.concatenate(([0], np.cumsum(there.sum(1))))
    own = letters.hash(start, end + 1)[edit]
    return [_long(own), pa.array(edit - start[edit], pa.int32()), _long(letters.hash(start, at)[edit]),
            pa.array(taken, pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _long(labels[there]))]


def _mapped(words: DataFrame, columns_of, schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for word in [*batch.column(0).to_pylist(), None]:
                if held and (word is None or size + len(word) > LETTERS):
                    yield pa.RecordBatch.from_arrays(columns_of(Letters(held)), names=names)
                    held, size = [], 0
                if word is not None:
                    held.append(word)
                    size += len(word)

    return words.select("word").mapInArrow(arrow.tidy(run), schema)


def _edge_table(words):
    return _mapped(words, _edges, "node long, letter int, label long, child long").distinct()


def _starts(words):
    """States with their edit still to make: word, place, node, its letter (0: left out), labels."""
    return _mapped(words, _walks, "id long, place int, node long, letter int, rest array<long>")


def near_ids(words: DataFrame) -> DataFrame:
    """``id`` and ``node``: own nodes of words at one edit, each pair once, with chance extras."""
    edges = stage.table(_edge_table(words), "edges")
    skipping = edges.where("letter > 0").select(
        F.col("node").alias("from"), F.col("letter").alias("other"), "label", "child")
    plain = edges.where("letter = 0").select(F.col("node").alias("from"), "label", "child")
    starts = stage.table(_starts(words), "starts")

    def ahead(met):
        return met.select("id", F.col("child").alias("node"),
                          F.expr("slice(rest, 2, greatest(size(rest) - 1, 0))").alias("rest"))

    replaced = ahead(starts.where("letter > 0").join(
        skipping, (F.col("node") == F.col("from")) & (F.col("rest")[0] == F.col("label"))
        & (F.col("other") > F.col("letter"))))
    frontier = stage.table(replaced.union(starts.where("letter = 0").select("id", "node", "rest")), "frontier")
    reached = frontier.where("size(rest) = 0").select("id", "node")
    frontier = frontier.where("size(rest) > 0")
    while not frontier.isEmpty():
        frontier = stage.table(ahead(frontier.join(
            plain, (F.col("node") == F.col("from")) & (F.col("rest")[0] == F.col("label")))), "frontier")
        reached = reached.union(frontier.where("size(rest) = 0").select("id", "node"))
        frontier = frontier.where("size(rest) > 0")
    return reached


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``other``, ``other_n``: all pairs of words at one edit, both ways."""
    def columns(letters):
        names = "".join(map(chr, letters.code.tolist())).split("\0")[:-1]
        return [_long(letters.ids()), pa.array(names, pa.string())]

    ids = stage.table(_mapped(words, columns, "id long, word string").join(words, "word"), "ids")
    left, right = ids.toDF("word", "id", "n"), ids.toDF("other", "node", "other_n")
    found = near_ids(words).distinct().join(left, "id").join(right, "node").where(
        F.levenshtein("word", "other", 1) == 1)
    # Different words of the same hash can bring a pair in twice.
    once = found.select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other"),
                        F.when(F.col("word") < F.col("other"), F.col("n")).otherwise(F.col("other_n")).alias("n"),
                        F.when(F.col("word") < F.col("other"), F.col("other_n")).otherwise(F.col("n")).alias("other_n"))
    once = stage.table(once.distinct(), "near")
    return once.select("word", "n", "other", "other_n").union(once.select("other", "other_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words with a form: each round doubles the steps made."""
    now = stage.table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stage.table(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of ``docs``.

    ``form`` is the most frequent word at one edit (ties: the least) if it is at least twice as
    frequent, else null; ``root`` is where following forms ends; ``n_near`` counts the words at
    one edit. Runs are damaged by the rule of ``count_runs``, but not where the id is null. Null
    and empty texts have no words; repeated rows count each; an empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    words = stage.table(vocabulary(docs, id_col, text_col), "words")
    best = near_pairs(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    usual = -F.col("best.less") >= 2 * F.col("n")
    best = stage.table(best.select(
        "word", "n_near", F.when(usual, F.col("best.other")).alias("form"),
        F.when(usual, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(best.where("form is not null"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
