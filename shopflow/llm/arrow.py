"""Helpers for Arrow batches inside tasks: text buffers, words and 64-bit word hashes.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. Both rules only
touch ASCII bytes, so working on UTF-8 bytes equals working on characters. Hashes depend
on nothing but the word, so they agree between tasks, runs and machines.
"""

import ctypes

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19  # text handled at once; one longer text makes a block of its own

_U64 = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x):
    """Scramble 64-bit values (a fixed bijection)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U64(_P))
_powers = {}

# What operators of one worker keep between tasks: functions that free it when the worker
# goes on to other work.
keepers = []


def release() -> None:
    """Give freed memory of this worker back to the system; idle workers keep the rest."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def tidy(run):
    """A function over batches that gives its memory back when a task is done."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def _power_table(n):
    """P**0 .. P**(n-1) and the same of the inverse, kept for the longest block so far."""
    if len(_powers.get("p", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("p", _P), ("q", _P_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["p"], _powers["q"]


def text_blocks(column):
    """Yield (first row, offsets, bytes) for runs of rows of about BLOCK_BYTES of text.

    ``offsets`` has one entry more than rows and counts from 0 in ``bytes``. A null text
    is an empty one. Frees what other operators kept in this worker.
    """
    for free in keepers:
        free()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, row + 1), n)
        part = offsets[row:end + 1]
        yield row, part - part[0], data[part[0]:part[-1]]
        row = end


def words(offsets, data):
    """(hash of each word, first word of each row): rows' words lie at first[r]:first[r + 1]."""
    first = np.zeros(len(offsets), np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), first
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]  # a word ends where its text ends
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    stops = np.flatnonzero(ends) + 1
    p, q = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * p[:len(data)], out=sums[1:])
    hashes = mix((sums[stops] - sums[starts]) * q[starts] + (stops - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes, first, size):
    """(hash of each run of ``size`` words, first run of each row), duplicates included.

    A row of fewer words has one run holding all of them; a row without words has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_first = np.concatenate(([0], np.cumsum(runs)))
    row = np.repeat(np.arange(len(counts)), runs)
    start = np.arange(out_first[-1]) - out_first[row] + first[row]
    stop = first[1:][row]
    value = np.full(len(start), 0x51ED270B, np.uint64)
    for k in range(size):
        at = start + k
        there = at < stop
        word = hashes[np.minimum(at, max(len(hashes) - 1, 0))] if len(hashes) else hashes
        value = np.where(there, mix(value * _U64(_P) + word), value)
    return value, out_first


def distinct(values, first):
    """Sorted distinct values of every row: (values, first)."""
    if not len(values):
        return values, first
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[keep], np.searchsorted(row[keep], np.arange(len(first)))
