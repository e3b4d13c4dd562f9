"""SimHash near-duplicates by a grid over segment bit counts.

A fingerprint of 64 bits is cut into 32 segments of two bits; the counts of ones make a
vector of 32 numbers from 0 to 2. Flipping a bit changes one count by one, so the Manhattan
distance of two vectors is never above the Hamming distance of the fingerprints. Vectors at
distance 3 or less are at distance 1 or less in one half of the segments: every fingerprint
lies in the grid cell of each of its halves and also visits the cells one step above, where
it meets all partners of that half. Met vectors are compared by Manhattan distance, those
that pass by Hamming distance.

Vectors are kept in unary: a count of 0, 1, 2 is written 00, 01, 11. The distance of two
vectors then is the number of differing bits, and a step up sets one bit.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shopflow.llm import arrow
from shopflow.llm.components import components
from shopflow.sources import stage

SIZE = 3  # words of a shingle
SEED = 42
DISTANCE = 3
SHINGLES = 1 << 15  # hashes handled at once
CELL = 2_048  # members of a cell compared in one task; larger cells are dealt out in blocks
FEW = 8  # groups up to this size are compared together

_LOW = 0x5555555555555555  # the lower bit of each segment


def fingerprint(text: str, size: int = SIZE) -> int:
    """64 bits; one is set if it is set in over half the hashes of the shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    starts, ends = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, len(starts), SHINGLES):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[low:low + SHINGLES], ends[low:low + SHINGLES])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``id_col`` and ``fp`` (the 64 bits as a long) of every row; no words: 0."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            values = [fingerprint(t, size) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())],
                names=["id", "fp"])

    return frame.mapInArrow(arrow.tidy(run), f"id {kind}, fp long").withColumnRenamed("id", id_col)


def _unary(x):
    """Bit counts of the segments of 64-bit numbers, in unary."""
    low, one = np.uint64(_LOW), np.uint64(1)
    return ((x | (x >> one)) & low) | ((x & (x >> one) & low) << one)


def _cells(classes: DataFrame) -> DataFrame:
    """``cell``, ``home`` and ``fp``: both own cells, and the cells one step above them."""
    low = F.lit(_LOW)
    above = F.shiftrightunsigned("fp", 1)
    vector = F.col("fp").bitwiseOR(above).bitwiseAND(low).bitwiseOR(
        F.shiftleft(F.col("fp").bitwiseAND(above).bitwiseAND(low), 1))
    half = 0xFFFFFFFF
    halves = classes.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("at"), vector.bitwiseAND(F.lit(half)).alias("own")),
        F.struct(F.lit(1).alias("at"), F.shiftrightunsigned(vector, 32).alias("own")))).alias("h"))
    own = F.col("h.own")

    def step(bit):
        """The vector with one more bit of its unary numbers, if the bit is their next one."""
        weight = F.lit(1 << bit)
        free = own.bitwiseAND(weight) == 0
        if bit % 2:
            free = free & (own.bitwiseAND(F.lit(1 << (bit - 1))) != 0)
        return F.when(free, own.bitwiseOR(weight))

    met = halves.select("fp", "h.at", own.alias("own"), F.explode(
        F.array_compact(F.array(own, *map(step, range(32))))).alias("cell"))
    return met.select(F.shiftleft("cell", 1).bitwiseOR(F.col("at").cast("long")).alias("cell"),
                      (F.col("cell") == F.col("own")).alias("home"), "fp")


def _dealt(classes: DataFrame) -> DataFrame:
    """Rows of cells in which something can meet, as ``cell``, ``i``, ``j``, ``mine``, ``home``, ``fp``.

    The group (cell, i, j) holds blocks i and j of a cell's members; ``mine`` is the block of
    the row. Cells of up to CELL members have the single block 0. Sizes of cells grow with the
    fingerprints, so they are shuffled and never pass through the driver.
    """
    rows = _cells(classes)
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("members"), F.count_if("home").alias("homes"))
    met = rows.join(sizes.where("homes > 0 and members > 1").hint("merge"), "cell")
    blocks = F.ceil(F.col("members") / CELL).cast("int")
    met = met.select("cell", "home", "fp", blocks.alias("blocks"),
                     F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("mine"))
    met = met.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return met.select("cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                      "mine", "home", "fp")


def _close(a, b):
    """Whether pairs of fingerprints are near: first by vectors, then bit by bit."""
    near = np.bitwise_count(_unary(a) ^ _unary(b)) <= DISTANCE
    return near & (np.bitwise_count(a ^ b) <= DISTANCE)


def _merge(label, a, b):
    """Least labels after joining the members ``a`` and ``b`` of each pair."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def _links_of_group(fp, home, mine):
    """Links (fingerprint, fingerprint) that connect what is near in one group."""
    label = np.arange(len(fp))
    crossing = mine[0] != mine[-1] or (mine != mine[0]).any()
    vectors = _unary(fp)
    homes = np.flatnonzero(home)
    step = max(1, (1 << 19) // len(fp))
    for low in range(0, len(homes), step):
        rows = homes[low:low + step]
        near = np.bitwise_count(vectors[rows][:, None] ^ vectors) <= DISTANCE
        if crossing:
            near &= mine[rows][:, None] != mine
        a, b = np.nonzero(near)
        a = rows[a]
        keep = np.bitwise_count(fp[a] ^ fp[b]) <= DISTANCE
        label = _merge(label, a[keep], b[keep])
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _links_of_rows(group, fp, home, mine):
    """Links of all groups; ``group`` numbers the rows' groups in order."""
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(np.append(starts, len(group)))
    few = np.repeat(sizes <= FEW, sizes)
    a, b = [], []
    for step in range(1, FEW):
        at = np.flatnonzero((group[:-step] == group[step:]) & few[:-step] & (home[:-step] | home[step:]))
        at = at[_close(fp[at], fp[at + step])]
        a.append(fp[at])
        b.append(fp[at + step])
    for start, size in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist()):
        own = slice(start, start + size)
        x, y = _links_of_group(fp[own], home[own], mine[own])
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _find_links(batches):
    """Links of whole groups; the last group of a batch waits for the next batch."""
    def columns(batch):
        cell, i, j, mine, home, fp = batch.columns
        return [cell.to_numpy(), i.to_numpy(), j.to_numpy(), mine.to_numpy(),
                home.to_numpy(zero_copy_only=False), fp.to_numpy().view(np.uint64)]

    def links(held):
        cell, i, j, mine, home, fp = held
        fresh = np.ones(len(cell), bool)
        fresh[1:] = (np.diff(cell) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        a, b = _links_of_rows(np.cumsum(fresh), fp, home, mine)
        return pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64), pa.int64()) for x in (a, b)], names=["a", "b"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = columns(batch)
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        last = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) & (now[2] == now[2][-1])
        ready = len(last) - int(last[::-1].argmin()) if not last.all() else 0
        if ready:
            yield links([x[:ready] for x in now])
        held = [x[ready:] for x in now]
    if held is not None:
        yield links(held)


def near_links(classes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` that connect the same ones as
    all pairs at DISTANCE or less do. Dense groups give a link per member, not per pair."""
    dealt = _dealt(classes)
    ordered = dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return ordered.mapInArrow(arrow.tidy(_find_links), "a long, b long").distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    Words are lower-cased in A-Z and parted by space and 0x09-0x0D. Fingerprints link at
    DISTANCE differing bits or fewer; ``component_id`` is the least id reachable. Every row
    gives a row, repeated rows too. A null or empty text and one without words has fingerprint
    zero and is linked like any other; fewer words than a shingle are hashed as one. A null id
    is never a least one: rows reachable from null ids only have a null ``component_id``. An
    empty table gives no rows; other columns, whatever their names, are ignored.
    """
    marked = stage.table(fingerprints(docs, id_col, text_col).withColumnRenamed(id_col, "id"), "fingerprints")
    classes = stage.table(marked.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    linked = stage.table(components(near_links(classes.select("fp"))), "linked")
    members = linked.union(linked.select("root", "root").distinct()).toDF("fp", "root")
    least = members.join(classes.hint("merge"), "fp").groupBy("root").agg(F.min("least").alias("reached"))
    reached = members.join(least.hint("merge"), "root").select("fp", "reached")
    classes = classes.join(reached.hint("merge"), "fp", "left").select(
        "fp", F.coalesce("reached", "least").alias("component_id"))
    return marked.join(classes.hint("merge"), "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
