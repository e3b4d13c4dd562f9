"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are doubly linked lists of byte runs. Every adjacent pair that the vocabulary can
merge is queued under its rank: a bucket per rank holds list positions, and a two-level bitmap
of 256-bit words over the buckets finds the lowest rank with two find-first-set steps, however
many positions wait. Positions of a pre-token leave a bucket from left to right. Entries of
pairs that meanwhile changed are skipped when they surface.

One queue serves many pre-tokens: a bucket is taken out as a whole, and its leftmost position
of every pre-token is merged at once by array operations. The lowest rank of all is the lowest
rank of each pre-token that has it, so each is merged as if it were alone. A pre-token beyond
LONG_BYTES has a queue of its own and takes O(n log n), so texts without any break are no
problem.

Texts are cut into units at spaces. Equal units of a task are cut into pre-tokens once, and
equal pre-tokens of different units ("word," and "word.") are merged once. Both are forgotten
when a task ends, or when they take KEPT_BYTES; texts are put together from them by array
operations.
"""

import base64
import hashlib
import re
from array import array
from heapq import heappop, heappush
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from shopflow.llm import arrow

VOCABULARY_BYTES = 32 << 20  # a rank file beyond this is refused, not broadcast
KEPT_BYTES = 128 << 20  # about what a worker keeps of units and pre-tokens
BLOCK_CHARS = 1 << 19  # text encoded at once; one longer text makes a block of its own
GATHERED = 1 << 20  # items put together at once
MERGED_BYTES = 1 << 19  # bytes of pre-tokens that share a queue
LONG_BYTES = 64  # a longer pre-token is merged alone


_BIT = [1 << i for i in range(256)]


class Merger:
    """Merges one long pre-token at a time; the empty queue is kept between calls."""

    def __init__(self, ranks: dict):
        self.ranks = ranks
        # Rank of any two bytes, by their number.
        self.two = [ranks.get(bytes((a, b))) for a in range(256) for b in range(256)]
        self.low = [0] * ((max(ranks.values(), default=0) >> 8) + 1)  # a bit per rank
        self.top_bit = [1 << i for i in range(len(self.low))]
        self.buckets = {}  # rank -> its only position, or a heap of several

    def merge(self, data: bytes) -> list:
        """Ids of one pre-token. The queue is inlined: calls would double the time."""
        get, low, buckets, bit, top_bit = self.ranks.get, self.low, self.buckets, _BIT, self.top_bit
        whole = get(data)
        if whole is not None:
            return [whole]
        n, two = len(data), self.two
        top = live = 0  # a bit per word of low; pairs that can still merge
        # Rank under which the pair starting here is queued now.
        queued = [two[a << 8 | b] for a, b in zip(data, data[1:])]
        at = 0
        for rank in queued:
            if rank is not None:
                live += 1
                held = buckets.get(rank)
                if held is None:
                    buckets[rank] = at
                    a = rank >> 8
                    if not low[a]:
                        top |= top_bit[a]
                    low[a] |= bit[rank & 255]
                elif held.__class__ is int:
                    buckets[rank] = [held, at]
                else:
                    held.append(at)  # positions come in order, so the heap stays one
            at += 1
        queued += (None, None)
        following = list(range(1, n + 1))  # also the end of the run that starts here
        before = list(range(-1, n))
        while live:
            # Find first set, from the top level down.
            a = (top & -top).bit_length() - 1
            word = low[a]
            b = (word & -word).bit_length() - 1
            lowest = (a << 8) + b
            held = buckets[lowest]
            if held.__class__ is int:
                i = held
                held = None
            else:
                i = heappop(held)
            if not held:
                del buckets[lowest]
                word ^= bit[b]
                low[a] = word
                if not word:
                    top ^= top_bit[a]
            if queued[i] != lowest:
                continue  # stale: the pair changed after it was queued
            j = following[i]
            live -= 1 + (queued[j] is not None)
            queued[i] = queued[j] = None
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                right = get(data[i:following[k]])
            else:
                right = None
            h = before[i]
            left = None
            if h >= 0:
                left = get(data[h:k])
                if left == queued[h]:
                    left = None  # queued already, or not to be queued
                elif queued[h] is not None:
                    live -= 1
                    queued[h] = None
            while True:
                if right is not None:
                    queued[i] = right
                    live += 1
                    held = buckets.get(right)
                    if held is None:
                        buckets[right] = i
                        a = right >> 8
                        if not low[a]:
                            top |= top_bit[a]
                        low[a] |= bit[right & 255]
                    elif held.__class__ is int:
                        buckets[right] = [held, i] if held < i else [i, held]
                    else:
                        heappush(held, i)
                if left is None:
                    break
                right, i, left = left, h, None  # the pair on the left, in the same way
        for rank in buckets:  # what is left is stale
            low[rank >> 8] = 0
        buckets.clear()
        ids, i = [], 0
        while i < n:
            k = following[i]
            ids.append(self.ranks[data[i:k]])
            i = k
        return ids


class SharedMerger:
    """Merges many pre-tokens by one queue; the empty queue is kept between calls."""

    def __init__(self, ranks: dict):
        self.size = max(ranks.values(), default=-1) + 1
        # Numbers of runs: their rank; bytes that have none follow, and the mark between pre-tokens.
        self.mark, self.base = self.size + 256, self.size + 257
        byte = [ranks.get(bytes((b,)), self.size + b) for b in range(256)]
        self.byte = np.array(byte, np.int64)
        self.two = np.array([ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)], np.int64)
        keys, merged = array("q"), array("q")  # numbers of two runs -> rank of both together
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = byte[token[0]] if cut == 1 else ranks.get(token[:cut])
                if left is not None:
                    right = byte[token[-1]] if cut == len(token) - 1 else ranks.get(token[cut:])
                    if right is not None:
                        keys.append(left * self.base + right)
                        merged.append(rank)
        keys.append(np.iinfo(np.int64).max)  # so that every search ends at a key
        merged.append(-1)
        keys, merged = np.array(keys), np.array(merged)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], merged[order]
        self.low = [0] * ((self.size >> 8) + 1)  # a bit per rank
        self.top = 0  # a bit per word of low
        self.buckets = {}  # rank -> arrays of positions

    def _push(self, ranks, positions) -> None:
        """Queue positions under their ranks."""
        order = ranks.argsort()
        ranks, positions = ranks[order], positions[order]
        cuts = ((ranks[1:] != ranks[:-1]).nonzero()[0] + 1).tolist()
        starts = [0, *cuts]
        low, buckets = self.low, self.buckets
        for rank, start, stop in zip(ranks[starts].tolist(), starts, [*cuts, len(ranks)]):
            held = buckets.get(rank)
            if held is None:
                buckets[rank] = [positions[start:stop]]
                a = rank >> 8
                if not low[a]:
                    self.top |= 1 << a
                low[a] |= _BIT[rank & 255]
            else:
                held.append(positions[start:stop])

    def _pop(self):
        """(lowest rank, its positions in order, stale ones too)."""
        top = self.top
        # Find first set, from the top level down.
        a = (top & -top).bit_length() - 1
        word = self.low[a]
        b = (word & -word).bit_length() - 1
        word ^= _BIT[b]
        self.low[a] = word
        if not word:
            self.top = top ^ (1 << a)
        rank = (a << 8) + b
        held = self.buckets.pop(rank)
        at = held[0] if len(held) == 1 else np.concatenate(held)
        at.sort()
        return rank, at

    def merge(self, pieces: list):
        """(ids of all pre-tokens, how many each has)."""
        text = np.frombuffer(b"\0".join([b"", *pieces, b""]), np.uint8).astype(np.int64)
        marks = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        number = self.byte[text]  # of the run that starts here; -1 inside of runs
        number[marks] = self.mark
        owner = np.zeros(len(text), np.int64)
        owner[marks] = 1
        owner = np.cumsum(owner)
        following = np.arange(1, len(text) + 1)
        before = np.arange(-1, len(text) - 1)
        queued = np.full(len(text), -1)  # rank under which the pair starting here is queued now
        queued[:-1] = self.two[text[:-1] << 8 | text[1:]]
        queued[marks] = queued[marks[1:] - 1] = -1
        at = np.flatnonzero(queued >= 0)
        if len(at):
            self._push(queued[at], at)
        while self.top:
            rank, at = self._pop()
            at = at[queued[at] == rank]  # the others are stale: their pair changed
            if len(at) > 1:
                whose = owner[at]
                again = whose[1:] == whose[:-1]
                if again.any():  # only the leftmost of a pre-token: its merge may change the next
                    later = at[1:][again]
                    self._push(np.full(len(later), rank), later)
                    at = np.concatenate((at[:1], at[1:][~again]))
            n = len(at)
            if not n:
                continue
            second = following[at]
            third = following[second]
            following[at] = third
            before[third] = at
            number[at] = rank
            number[second] = queued[second] = -1
            at = np.concatenate((at, before[at]))
            pairs = np.concatenate((number[third] + rank * self.base, number[at[n:]] * self.base + rank))
            found = self.keys.searchsorted(pairs)
            ranks = np.where(self.keys[found] == pairs, self.merged[found], -1)
            fresh = ranks >= 0
            fresh[n:] &= ranks[n:] != queued[at[n:]]  # queued already
            queued[at] = ranks
            if fresh.any():
                self._push(ranks[fresh], at[fresh])
        number[marks] = -1
        live = number >= 0
        ids = number[live]
        if len(ids) and ids.max() >= self.size:
            raise KeyError("a byte that the vocabulary does not have")
        return ids, np.diff(np.cumsum(live)[marks])


def _gather(flat, starts, spans):
    """``flat[s:s + n]`` of all starts and spans, one after the other."""
    out, ends, low = np.empty(int(spans.sum()), flat.dtype), np.cumsum(spans), 0
    while low < len(spans):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + GATHERED, "right")))
        shift = starts[low:high] - (ends[low:high] - spans[low:high])
        out[before:ends[high - 1]] = flat[np.arange(before, ends[high - 1]) + np.repeat(shift, spans[low:high])]
        low = high
    return out


class Encoder:
    """Ids of texts, remembering those of units and pre-tokens.

    A unit is a space and what follows up to the next space. Pre-tokens never run on into
    a white-space run, so a text may be cut before any run; with a lone space the run's
    start is the space itself. Texts in which white space comes right before a space are
    matched as a whole instead, and their pre-tokens are units.
    """

    def __init__(self, ranks: dict, pattern: str):
        self.pattern = regex.compile(pattern)
        self.double = re.compile(r"\s ")
        self.ranks = ranks
        self.merge = Merger(ranks).merge
        self.merge_all = SharedMerger(ranks).merge
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.bytes_of = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.clear()

    def clear(self):
        # Numbers of units: behind a space, at a text's start, and whole pre-tokens.
        self.spaced, self.head, self.whole = {}, {}, {}
        self.parts, self.first_part = array("q"), array("q", [0])  # per unit: numbers of its pre-tokens
        self.pieces = {}  # number of a pre-token that is not a unit of its own
        self.ids, self.first = array("I"), array("q", [0])  # per pre-token
        self.waiting = []  # pre-tokens that have a number, and no ids yet
        self.weight = 0

    def _new(self, piece: str) -> int:
        self.waiting.append(piece)
        return len(self.first) + len(self.waiting) - 2

    def _piece(self, piece: str) -> int:
        """Number of a pre-token that is part of a unit."""
        number = self.pieces.get(piece)
        if number is None and piece[:1] == " ":
            unit = self.spaced.get(piece[1:])
            if unit is not None and self.first_part[unit + 1] - self.first_part[unit] == 1:
                return self.parts[self.first_part[unit]]
        if number is None:
            number = self.pieces[piece] = self._new(piece)
            self.weight += 180 + len(piece)
        return number

    def _add(self, known: dict, unit: str, pieces: list) -> None:
        if len(pieces) == 1:  # a unit of one pre-token stands for it
            number = self.pieces.get(pieces[0])
            self.parts.append(self._new(pieces[0]) if number is None else number)
        else:
            self.parts.extend(map(self._piece, pieces))
        known[unit] = len(self.first_part) - 1
        self.first_part.append(len(self.parts))
        self.weight += 190 + len(unit) + 8 * len(pieces)

    def _add_spaced(self, units: list) -> None:
        """Units behind a space, matched together: those that end in white space, or are empty, alone."""
        findall, joined = self.pattern.findall, []
        for unit in units:
            if not unit or unit[-1].isspace():
                self._add(self.spaced, unit, findall(" " + unit))
            else:
                joined.append(unit)
        if joined:
            found = findall(" " + " ".join(joined))
            starts = [k for k, piece in enumerate(found) if piece[:1] == " "]
            if len(starts) == len(joined):
                for unit, low, high in zip(joined, starts, [*starts[1:], len(found)]):
                    self._add(self.spaced, unit, found[low:high])
            else:  # the pattern leaves spaces out
                for unit in joined:
                    self._add(self.spaced, unit, findall(" " + unit))

    def _numbers(self, text: str) -> list:
        """Numbers of a text's units."""
        if self.double.search(text):
            units, known = self.pattern.findall(text), self.whole
            for unit in set(units).difference(known):
                self._add(known, unit, [unit])
            return list(map(known.__getitem__, units))
        head, *rest = text.split(" ")
        if head not in self.head:
            self._add(self.head, head, self.pattern.findall(head))
        known = self.spaced
        new = set(rest).difference(known)
        if new:
            self._add_spaced(list(new))
        return [self.head[head], *map(known.__getitem__, rest)]

    def _merge_waiting(self) -> None:
        """Ids of the pre-tokens that wait for them."""
        ranks, low = self.ranks, 0
        while low < len(self.waiting):
            size, spans, loose, shared = 0, [], [], []
            while low < len(self.waiting) and size < MERGED_BYTES:
                data = self.waiting[low].encode()
                low += 1
                rank = ranks.get(data)
                if rank is not None:
                    spans.append(1)
                    loose.append(rank)
                elif len(data) > LONG_BYTES:
                    ids = self.merge(data)
                    spans.append(len(ids))
                    loose.extend(ids)
                    size += len(data)
                else:
                    spans.append(-1)
                    shared.append(data)
                    size += len(data)
            spans = np.array(spans, np.int64)
            ids, counts = self.merge_all(shared)
            together = spans < 0
            spans[together] = counts
            start = np.empty_like(spans)
            start[together] = np.cumsum(counts) - counts
            start[~together] = len(ids) + np.cumsum(spans[~together]) - spans[~together]
            flat = np.concatenate((ids, np.array(loose, np.int64))).astype(np.uint32)
            end = len(self.ids)
            self.ids.frombytes(_gather(flat, start, spans).tobytes())
            self.first.frombytes((end + np.cumsum(spans)).tobytes())
            self.weight += 4 * int(spans.sum()) + 8 * len(spans)
        self.waiting = []

    def encode_blocks(self, texts: list):
        """Yield (first row, rows, ids of their texts, first of every text and the end)."""
        low = 0
        while low < len(texts):
            if self.weight > KEPT_BYTES:
                self.clear()
            numbers, cuts = array("q"), [0]
            for text in islice(texts, low, None):
                if text:
                    numbers.extend(self._numbers(text))
                cuts.append(len(numbers))
                if self.weight > KEPT_BYTES:
                    break
            self._merge_waiting()
            number = np.array(numbers, np.int64)
            parts, first_part = np.array(self.parts, np.int64), np.array(self.first_part, np.int64)
            flat, first = np.array(self.ids, np.uint32), np.array(self.first, np.int64)
            for row, block in _blocks(texts[low:low + len(cuts) - 1]):
                cut = np.array(cuts[row:row + len(block) + 1])
                units = number[cut[0]:cut[-1]]
                spans = first_part[units + 1] - first_part[units]
                part_cut = np.concatenate(([0], np.cumsum(spans)))[cut - cut[0]]
                pieces = _gather(parts, first_part[units], spans)
                spans = first[pieces + 1] - first[pieces]
                ids = _gather(flat, first[pieces], spans)
                yield low + row, len(block), ids, np.concatenate(([0], np.cumsum(spans)))[part_cut]
            low += len(cuts) - 1

    def encode_block(self, texts: list):
        """(ids of all texts, first of every text and the end)."""
        ids, first = [np.zeros(0, np.uint32)], [0]
        for _, _, part, cuts in self.encode_blocks(texts):
            ids.append(part)
            first.extend((first[-1] + cuts[1:]).tolist())
        return np.concatenate(ids), np.array(first)

    def decode_block(self, ids: np.ndarray, first: np.ndarray):
        """(bytes that ids stand for, first of every text and the end); KeyError for an unknown id."""
        if len(ids) and (ids.max() >= len(self.length) or not self.length[ids].all()):
            raise KeyError("an id that the vocabulary does not have")
        spans = self.length[ids]
        return _gather(self.bytes_of, self.start[ids], spans), np.concatenate(([0], np.cumsum(spans)))[first]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_block([text])[0].astype("<u4").tobytes()

    def decode(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        ids = np.frombuffer(packed, "<u4")
        return self.decode_block(ids, np.array([0, len(ids)]))[0].tobytes()


def read_ranks(path: str) -> bytes:
    """The rank file as it is; refused beyond VOCABULARY_BYTES."""
    data = Path(path).read_bytes()
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path}: {len(data)} bytes; at most {VOCABULARY_BYTES} are broadcast")
    return data


def parse_ranks(data: bytes) -> dict:
    """token bytes -> rank, of lines ``base64 rank``."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in data.splitlines() if line)}


_encoders = {}
arrow.keepers.append(_encoders.clear)


def _encoder(data: bytes, pattern: str) -> Encoder:
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(parse_ranks(data), pattern)
    return _encoders[key]


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", with_decoded: bool = False) -> DataFrame:
    """``id_col``, ``n_tokens`` and ``ids`` of every row, nothing else of ``docs``.

    ``vocabulary`` is the path of a rank file on the driver, whose content is broadcast
    (size checked). ``ids`` is binary: little-endian unsigned 32-bit integers.
    ``with_decoded`` adds ``decoded``: the bytes that the ids decode to.

    Every row gives a row, repeated rows too; a null id stays null; a null or empty text
    has no tokens and empty binaries; other columns, whatever their names, are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches):
        coder = _encoder(shared.value, pattern)
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for low, rows, ids, first in coder.encode_blocks(texts):
                    columns = [batch.column(0).slice(low, rows), pa.array(np.diff(first), pa.int64()),
                               _binary(ids.astype("<u4").view(np.uint8), first * 4)]
                    if with_decoded:
                        columns.append(_binary(*coder.decode_block(ids, first)))
                    names = ["id", "n_tokens", "ids", "decoded"][:len(columns)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            coder.clear()

    schema = f"id {kind}, n_tokens long, ids binary" + ", decoded binary" * with_decoded
    return frame.mapInArrow(arrow.tidy(run), schema).withColumnRenamed("id", id_col)


def _blocks(texts):
    """(first row, texts) of about BLOCK_CHARS."""
    low = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield low, texts[low:k]
            low, size = k, 0
        size += len(text)
    if low < len(texts):
        yield low, texts[low:]


def _binary(data, first):
    """An Arrow column of the bytes between neighbouring places."""
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(first, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``decoded`` (binary) of packed ids; null ids decode to empty bytes."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    frame = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches):
        coder = _encoder(shared.value, "")
        for batch in batches:
            texts = [coder.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["id", "decoded"])

    return frame.mapInArrow(arrow.tidy(run), f"id {kind}, decoded binary").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Token counts and SHA-256 digests of ids and of decoded bytes, per document."""
    coded = encode(docs, vocabulary, pattern, with_decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
