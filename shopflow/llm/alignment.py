"""Cross-tokenizer alignment by token-byte incidence matrices in compressed sparse rows.

Two tokenizers cut the same bytes, so every token is a row of bytes in a sparse 0/1 matrix:
A (tokens of the first by bytes) and B. The product A . B^T, formed row by row as Gustavson
does, has an entry wherever two tokens overlap. Byte offsets where both have a token's end
cut the tokens into groups; the product of the two token-group matrices links all tokens of
a group. Texts are laid end to end in a block, which makes the matrices block-diagonal, so
one product serves many texts.
"""

import hashlib
import os
import re
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopflow.llm import arrow
from shopflow.sources import stage

MODEL_BYTES = 32 << 20  # a tokenizer file beyond this is refused, not broadcast
BLOCK_CHARS = 1 << 19  # text handled at once; one longer text makes a block of its own
JOINED = 4096  # signs of pieces that are encoded as one text
ENTRIES = 1 << 20  # entries of a product formed at once
# Pairs in 1 of 2**18 links of the corpus or more are broadcast: at most 2**18 pairs.
FREQUENT = 1 << 18


class Csr(NamedTuple):
    """A sparse 0/1 matrix: row ``r`` has the columns ``index[first[r]:first[r + 1]]``."""

    first: np.ndarray
    index: np.ndarray


def transpose(m: Csr, columns: int) -> Csr:
    rows = np.repeat(np.arange(len(m.first) - 1), np.diff(m.first))
    first = np.zeros(columns + 1, np.int64)
    np.cumsum(np.bincount(m.index, minlength=columns), out=first[1:])
    return Csr(first, rows[np.argsort(m.index, kind="stable")])


def product(a: Csr, b: Csr):
    """Entries (row, column, value) of ``a . b``, in order of rows and columns.

    A row of the result is the sum of the rows of ``b`` that the row of ``a`` names. Rows are
    taken in runs of about ENTRIES summands (one row at least), each yielded by itself.
    """
    spans = np.diff(b.first)[a.index]
    summands = np.concatenate(([0], np.cumsum(spans)))[a.first]
    rows, low = len(a.first) - 1, 0
    while low < rows:
        high = int(np.searchsorted(summands, summands[low] + ENTRIES, "right")) - 1
        high = min(max(high, low + 1), rows)
        names = slice(a.first[low], a.first[high])
        named, span = a.index[names], spans[names]
        row = np.repeat(np.repeat(np.arange(low, high), np.diff(a.first[low:high + 1])), span)
        ends = np.cumsum(span)
        at = np.arange(len(row)) - np.repeat(ends - span, span) + np.repeat(b.first[named], span)
        column = b.index[at]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] > row[:-1]) | (column[1:] > column[:-1])
        if (fresh[1:] < ((row[1:] != row[:-1]) | (column[1:] != column[:-1]))).any():
            order = np.lexsort((column, row))
            row, column = row[order], column[order]
            fresh[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
        begins = np.flatnonzero(fresh)
        yield row[begins], column[begins], np.diff(np.append(begins, len(row)))
        low = high


class Block(NamedTuple):
    """Alignment of the texts of a block; token, link and group numbers run over the block."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    ends_a: np.ndarray  # byte after each token
    ends_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray  # overlap links: token of A, token of B
    link_b: np.ndarray
    first_a: np.ndarray  # a text's first token, and its end
    first_b: np.ndarray
    first_group: np.ndarray
    first_link: np.ndarray
    near_links: np.ndarray  # per text: pairs of tokens that share a group


def _first(numbers):
    """The first item of every text, and the end, for texts of ``numbers`` items each."""
    return np.concatenate(([0], np.cumsum(numbers, dtype=np.int64)))


def align(a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray,
          bytes_a: np.ndarray, bytes_b: np.ndarray) -> Block:
    """Align the ids of texts laid end to end; ``bytes_*`` has the byte length of every id.

    The tokens of a text have the same bytes on both sides.
    """
    ends_a, ends_b = np.cumsum(bytes_a[a]), np.cumsum(bytes_b[b])
    size = int(ends_a[-1]) if len(a) else 0
    columns = np.arange(size)
    matrix_a = Csr(np.concatenate(([0], ends_a)), columns)
    matrix_b = Csr(np.concatenate(([0], ends_b)), columns)
    parts = list(product(matrix_a, transpose(matrix_b, size)))
    link_a, link_b = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1))
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    text_ends = np.concatenate(([0], ends_a))[first_a]
    first_group = np.searchsorted(cuts, text_ends, "right")
    # A token's row of the group product has an entry for every token of its group.
    members_b = np.diff(transpose(Csr(np.arange(len(b) + 1), group_b), len(cuts)).first)
    near = np.concatenate(([0], np.cumsum(members_b[group_a])))[first_a]
    return Block(a, b, ends_a, ends_b, group_a, group_b, link_a, link_b, first_a, first_b,
                 first_group, np.searchsorted(link_a, first_a), np.diff(near))


def byte_alphabet() -> dict:
    """Sign -> byte of byte-level vocabularies: printable bytes stand for themselves, the
    others for the signs from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def cut(text: str) -> list:
    """Pieces of a long text, each but the first beginning with a lone space.

    Neither tokenizer has tokens that run on into a space between letters or digits, so
    pieces are encoded by themselves; a text without such spaces is one piece.
    """
    pieces, low = [], 0
    while len(text) - low > BLOCK_CHARS:
        found = _CUT.search(text, low + BLOCK_CHARS)
        if not found:
            break
        pieces.append(text[low:found.start()])
        low = found.start()
    return [*pieces, text[low:]]


class Pair:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, data_a: bytes, data_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(data_a.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=data_b)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.bytes_a[k] = bytes(map(alphabet.get, token)) if all(c in alphabet for c in token) else token.encode()
        self.bytes_b = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k)
                                else piece.replace("▁", " ").encode())
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.a_bytes, self.b_bytes = (
            (np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length)
            for tokens, length in ((self.bytes_a, self.len_a), (self.bytes_b, self.len_b)))
        # "id" with the sign that follows it: within a side, and at its end.
        self.shown = [s for k in range(len(self.bytes_a)) for s in (f"{k},", f"{k}|")]
        self.shown += [s for k in range(len(self.bytes_b)) for s in (f"{k},", f"{k};")]

    def encode(self, texts: list):
        """(ids of A, first of every text, ids of B, first of every text), texts end to end.

        A text whose tokens do not spell space + text has none.
        """
        pieces = [cut(t) if t else [] for t in texts] if any(len(t) > BLOCK_CHARS for t in texts) else [
            [t] if t else [] for t in texts]
        flat = [p if k else " " + p for own in pieces for k, p in enumerate(own)]
        sizes = np.fromiter((len(p.encode()) for p in flat), np.int64, len(flat))
        a, first_a = self._flat([e.ids for e in self.a.encode_batch_fast(flat, add_special_tokens=False)])
        b, first_b = self._flat(self.b.encode([p[1:] for p in flat], num_threads=1))
        whole = np.frombuffer("".join(flat).encode(), np.uint8)
        spelt = self._spelt(a, first_a, self.a_bytes, whole, sizes) & self._spelt(b, first_b, self.b_bytes, whole, sizes)
        at = _first([len(own) for own in pieces])  # a text's first piece
        if not spelt.all():
            good = np.logical_and.reduceat(np.append(spelt, True), at[:-1]) if len(texts) else spelt
            good = np.repeat(good, np.diff(at))
            a, first_a = _kept(a, first_a, good)
            b, first_b = _kept(b, first_b, good)
        return a, first_a[at], b, first_b[at]

    def encode_plain(self, pieces: list):
        """The same for pieces that neither begin nor end with a sign that could join a space.

        They are put together, spaces between them, to texts of about JOINED signs, since a
        call of its own for every piece would cost more than its tokens.
        """
        if not pieces:
            return self.encode(pieces)
        cuts = np.flatnonzero(np.diff(np.cumsum([len(p) for p in pieces]) // JOINED, prepend=-1)).tolist()
        texts = [" ".join(pieces[low:high]) for low, high in zip(cuts, [*cuts[1:], len(pieces)])]
        a, _ = self._flat([e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)])
        b, _ = self._flat(self.b.encode(texts, num_threads=1))
        sizes = np.fromiter((len(p.encode()) + 1 for p in pieces), np.int64, len(pieces))
        whole = np.frombuffer((" " + " ".join(pieces)).encode(), np.uint8)
        out = []
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            ends, wanted = np.cumsum(table[2][ids]), np.cumsum(sizes)
            last = np.minimum(np.searchsorted(ends, wanted), max(len(ends) - 1, 0))
            if not len(ends) or (ends[last] != wanted).any():
                return self.encode(pieces)
            first = np.concatenate(([0], last + 1))
            if not self._spelt(ids, first, table, whole, sizes).all():
                return self.encode(pieces)
            out += (ids, first)
        return tuple(out)

    @staticmethod
    def _flat(lists):
        first = _first(list(map(len, lists)))
        return np.fromiter(chain.from_iterable(lists), np.int64, int(first[-1])), first

    @staticmethod
    def _spelt(ids, first, table, whole, sizes):
        """Whether the bytes of each piece's tokens are those of the piece."""
        flat, start, length = table
        spans = length[ids]
        ends = np.concatenate(([0], np.cumsum(spans)))
        same = np.diff(ends[first]) == sizes
        if same.all():
            # Bytes of all tokens, one after the other: as the tokens are short, by place in the token.
            at = np.arange(ends[-1]) - np.repeat(ends[:-1] - start[ids], spans)
            wrong = np.flatnonzero(flat[at] != whole)
            same[np.searchsorted(_first(sizes), wrong, "right") - 1] = False
            return same
        offsets = _first(sizes)
        for k in np.flatnonzero(same):
            own = ids[first[k]:first[k + 1]]
            same[k] = b"".join(flat[start[i]:start[i] + length[i]].tobytes() for i in own) == whole[offsets[k]:offsets[k + 1]].tobytes()
        return same

    def groups(self, block: Block) -> list:
        """Per text: ids of A and B by group, ``a1,a2|b1;a3|b2,b3``."""
        a, b = len(block.ids_a), len(block.ids_b)
        numbers = int(block.first_group[-1])
        before_b = np.searchsorted(block.group_b, np.arange(numbers))
        until_a = np.searchsorted(block.group_a, np.arange(numbers), "right")
        last_a, last_b = np.ones(a, bool), np.ones(b, bool)
        last_a[:-1] = np.diff(block.group_a) > 0
        last_b[:-1] = np.diff(block.group_b) > 0
        codes = np.empty(a + b, np.int64)
        if a:
            codes[np.arange(a) + before_b[block.group_a]] = block.ids_a * 2 + last_a
            codes[np.arange(b) + until_a[block.group_b]] = (block.ids_b + len(self.bytes_a)) * 2 + last_b
        first = (block.first_a + block.first_b).tolist()
        shown = list(map(self.shown.__getitem__, codes.tolist()))
        return ["".join(shown[x:y])[:-1] for x, y in zip(first, first[1:])]


def _kept(ids, first, good):
    """The ids of good pieces; the others have none."""
    spans = np.diff(first)
    return ids[np.repeat(good, spans)], _first(np.where(good, spans, 0))


_pairs = {}


def _pair(data_a: bytes, data_b: bytes) -> Pair:
    key = hashlib.sha256(data_a).digest() + hashlib.sha256(data_b).digest()
    if key not in _pairs:
        _pairs.clear()
        _pairs[key] = Pair(data_a, data_b)
    return _pairs[key]


arrow.keepers.append(_pairs.clear)


def read_model(path: str) -> bytes:
    """A tokenizer's file as it is; refused beyond MODEL_BYTES."""
    data = Path(path).read_bytes()
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path}: {len(data)} bytes; at most {MODEL_BYTES} are broadcast")
    return data


def _lists(first, values, kind):
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


# Spaces at which a text is cut, and what a text must not hold to be cut at every space.
_LONE = re.compile(r"(?<=[^\s▁]) (?=\S)")
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000▁]")
_NEXT_TO_SPACE = ("  ", "\n ", " \n", "\t ", " \t", "\r ", " \r")


def pieces_of(text: str) -> list:
    """A text cut at lone spaces, which are left out; each piece follows a space.

    Neither tokenizer has a token that runs on into a space behind another sign, so both
    have a token's end at each cut: pieces are encoded and aligned by themselves.
    """
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or any(x in text for x in _NEXT_TO_SPACE) or _ODD.search(text):
        return _LONE.split(text)
    return text.split(" ")


class Units:
    """Alignments of distinct pieces, kept while a task goes on from block to block.

    ``number`` tells the place of a piece in the other fields: its groups as text, its
    numbers of tokens, groups and links, and its linked pairs of ids. A piece without
    tokens is one whose tokens do not spell it.
    """

    KEPT = 250_000  # pieces; beyond this the next block starts afresh
    COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")

    def __init__(self, pair):
        self.pair = pair
        self.clear()

    def clear(self):
        self.number, self.shown = {}, []
        self.counts = np.zeros((0, len(self.COUNTS)), np.int64)
        self.first, self.linked = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def numbers(self, texts: list) -> list:
        """Per text the numbers of its pieces; none where a piece is not spelt by its tokens."""
        if len(self.number) > self.KEPT:
            self.clear()
        pieces = [pieces_of(t) for t in texts]
        known = self.number
        fresh = set(chain.from_iterable(pieces)).difference(known)
        odd = [p for p in fresh if p != p.strip() or p[-1] == "▁"]
        for _, part in _blocks(list(fresh.difference(odd))):
            self._add(part, self.pair.encode_plain(part))
        for _, part in _blocks(odd):
            self._add(part, self.pair.encode(part))
        spelt = self.counts[:, 0] > 0
        out = [list(map(known.__getitem__, own)) for own in pieces]
        if not spelt.all():
            out = [own if spelt[own].all() else [] for own in out]
        return out

    def _add(self, fresh, encoded):
        block = align(*encoded, self.pair.len_a, self.pair.len_b)
        for piece in fresh:
            self.number[piece] = len(self.number)
        self.shown += self.pair.groups(block)
        firsts = (block.first_a, block.first_b, block.first_group, block.first_link)
        self.counts = np.concatenate((self.counts, np.stack([*map(np.diff, firsts), block.near_links], 1)))
        self.first = np.concatenate((self.first, self.first[-1] + block.first_link[1:]))
        linked = (block.ids_a[block.link_a] << 32) | block.ids_b[block.link_b]
        self.linked = np.concatenate((self.linked, linked))

    def pairs(self, numbers: list):
        """Per text, its distinct linked pairs of ids and how often each occurs."""
        sizes = np.array([len(own) for own in numbers], np.int64)
        text = np.repeat(np.arange(len(numbers)), sizes)
        unit = np.fromiter((k for own in numbers for k in own), np.int64, int(sizes.sum()))
        key, times = np.unique(text * len(self.shown) + unit, return_counts=True)
        text, unit = np.divmod(key, max(len(self.shown), 1))
        span = self.first[unit + 1] - self.first[unit]
        ends = np.cumsum(span)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - span, span) + np.repeat(self.first[unit], span)
        values, code = np.unique(self.linked[at], return_inverse=True)
        key = np.repeat(text, span) * len(values) + code
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.repeat(times, span)[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        text, code = np.divmod(key[begins], max(len(values), 1))
        first = np.searchsorted(text, np.arange(len(numbers) + 1))
        return first, values[code], np.add.reduceat(times, begins) if len(begins) else times


def _blocks(texts):
    """(first row, rows' texts) of about BLOCK_CHARS."""
    low = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield low, texts[low:k]
            low, size = k, 0
        size += len(text)
    if low < len(texts):
        yield low, texts[low:]


def _mapped(docs, tokenizer_a, model_b, id_col, text_col, schema, columns_of):
    """``columns_of(pair)`` gives a function from a block of texts to named columns."""
    shared = docs.sparkSession.sparkContext.broadcast((read_model(tokenizer_a), read_model(model_b)))
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches):
        columns = columns_of(_pair(*shared.value))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for low, part in _blocks(texts):
                made = {"id": batch.column(0).slice(low, len(part)), **columns(part)}
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return frame.mapInArrow(arrow.tidy(run), f"id {kind}, {schema}")


def alignments(docs: DataFrame, tokenizer_a: str, model_b: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Tokens, overlap links and groups of every row of ``docs``.

    ``a_ids`` and ``b_ids`` are the ids, ``a_ends`` and ``b_ends`` the byte after each token
    in space + text, ``a_groups`` and ``b_groups`` each token's group (so tokens with the same
    number share one), and ``links`` the overlap links as (number of the token in A, number in
    B), all counted from 0. The paths name a byte-level tokenizer file and a sentence-piece
    model on the driver; their content is broadcast (size checked).

    Every row gives a row, repeated rows too; ids may be null; a null or empty text, and one
    whose tokens do not spell space + text, has empty lists; other columns are ignored.
    """
    def columns_of(pair):
        return lambda texts: columns(align(*pair.encode(texts), pair.len_a, pair.len_b))

    def columns(block):
        def own(values, first, base):
            return _lists(first, values - np.repeat(base, np.diff(first)), pa.int32())

        starts = np.concatenate(([0], block.ends_a))[block.first_a[:-1]]
        groups = block.first_group[:-1]
        links = pa.StructArray.from_arrays(
            [pa.array(block.link_a - np.repeat(block.first_a[:-1], np.diff(block.first_link)), pa.int32()),
             pa.array(block.link_b - np.repeat(block.first_b[:-1], np.diff(block.first_link)), pa.int32())],
            names=["a", "b"])
        return {
            "a_ids": _lists(block.first_a, block.ids_a, pa.int32()),
            "b_ids": _lists(block.first_b, block.ids_b, pa.int32()),
            "a_ends": own(block.ends_a, block.first_a, starts),
            "b_ends": own(block.ends_b, block.first_b, starts),
            "a_groups": own(block.group_a, block.first_a, groups),
            "b_groups": own(block.group_b, block.first_b, groups),
            "links": pa.ListArray.from_arrays(pa.array(block.first_link, pa.int32()), links),
        }

    numbers = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_ends", "b_ends", "a_groups", "b_groups"))
    return _mapped(docs, tokenizer_a, model_b, id_col, text_col,
                   f"{numbers}, links array<struct<a: int, b: int>>", columns_of).withColumnRenamed("id", id_col)


def _digests(pair):
    units = Units(pair)

    def columns(texts):
        numbers = units.numbers(texts)
        shown = [";".join(map(units.shown.__getitem__, own)) for own in numbers]
        counts = np.array([units.counts[own].sum(0) for own in numbers], np.int64).reshape(len(numbers), -1)
        first, values, times = units.pairs(numbers)
        return {**{name: pa.array(counts[:, k], pa.int64()) for k, name in enumerate(units.COUNTS)},
                "groups_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in shown], pa.string()),
                "pairs": _lists(first, values, pa.int64()), "times": _lists(first, times, pa.int32())}

    return columns


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (A id * 2**32 + B id), ``n`` (rows that hold it linked), ``best`` (whether no
    pair of its A id is in more rows), from ``pairs`` of distinct numbers per row."""
    counts = stage.table(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return stage.table(counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "counts")


def summary(docs: DataFrame, tokenizer_a: str, model_b: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Counts, a digest of the groups and how usual its links are, for every row.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links`` (overlapping tokens), ``n_group_links``
    (tokens that share a group), ``groups_sha256`` (of the ids by group). A pair of ids counts
    the rows of ``docs`` that hold it linked: ``n_best`` links have the highest count of their
    A id (ties included), ``count_sum`` adds the counts of all links.

    Every row gives a row, repeated rows too, and counts by itself; ids may be null; a null or
    empty text, and one whose tokens do not spell space + text, has zeros and ''; an empty
    table gives no rows; other columns, whatever their names, are ignored.
    """
    numbers = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_group_links"))
    aligned = stage.table(
        _mapped(docs, tokenizer_a, model_b, id_col, text_col,
                f"{numbers}, groups_sha256 string, pairs array<long>, times array<int>", _digests)
        .withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(aligned)
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = F.col("n") * FREQUENT >= total
    frequent, rare = F.broadcast(counts.where(share)), counts.where(~share)
    linked = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))

    def sums(met):
        return met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                      F.sum(F.col("n") * F.col("times")).alias("count_sum"))

    both = sums(linked.join(frequent, "pair")).union(
        sums(linked.join(frequent, "pair", "left_anti").join(rare, "pair")))
    added = both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(added, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", whole).alias("n_best"), F.coalesce("count_sum", whole).alias("count_sum"),
        "groups_sha256", "n_group_links")
