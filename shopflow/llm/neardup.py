"""Near-duplicates by a chosen-path set similarity join.

A text's set is its distinct word shingles. Texts of equal sets form a class. For every
class a fixed number of minwise tokens is kept: the shingle that is least under each of
COORDINATES hash functions. Each of TREES independent trees branches classes by selected
minwise tokens: the path so far selects a coordinate, and the class goes to the child of
its token there, so two classes of similarity J stay together with chance J per level.
Nodes of few classes are compared exhaustively in one task; larger nodes branch further.

Before that a pass over deep nodes only ties every member to the node's least class. It
joins large groups of copies into one component, so that later nodes whose members are one
component are done, and members of one component are never compared. Classes that lie near
a large component are compared with all its members, on full sets and once, not per tree.

Every link is confirmed on full sets. A pair of similarity s is missed by a tree in which
it is parted before its node is small, after d levels, with chance 1 - s**d. The trees share
their coordinates, so their misses are not independent; of pairs of similarity 0.8, drawn at
random, 20 trees miss 0.003 % at 3 levels and 0.06 % at 4, and more at deeper ones (6 % at
8). Nodes that are still large after LEVELS levels are therefore compared block by block.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shopflow.llm import arrow
from shopflow.llm.components import components
from shopflow.sources import stage

COORDINATES = 64
TREES = 20
LEVELS = 4  # nodes of this depth that are still large are compared block by block
STAR_LEVEL = 6
DENSE_LEVEL = 3
SMALL = 64  # classes compared exhaustively
BLOCK = 128  # classes of either side when a component is compared with those near to it
# Classes are confirmed on full sets when so many of their coordinates agree: four standard
# deviations below what a similarity of 0.8 gives.
AGREEING = 38
BROADCAST_BYTES = 32 << 20  # of ids whose texts are read again; more are joined by shuffling

_U64 = np.uint64
_SEEDS = arrow.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _U64(0xD1342543DE82EF95)) | _U64(1)


def _sets(offsets, data, size):
    hashes, first = arrow.words(offsets, data)
    return arrow.distinct(*arrow.shingles(hashes, first, size))


def sketches(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, f1, f2, minwise) of every row: set size, 128-bit digest and minwise tokens."""
    frame = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for row, offsets, data in arrow.text_blocks(batch.column(1)):
                values, first = _sets(offsets, data, size)
                counts = np.diff(first)
                filled = np.flatnonzero(counts)
                least = np.zeros((len(counts), COORDINATES), np.uint32)
                digest = np.zeros((2, len(counts)), np.uint64)
                if len(filled):
                    starts = first[:-1][filled]
                    for c, seed in enumerate(_SEEDS):
                        least[filled, c] = np.minimum.reduceat(values * seed, starts) >> _U64(32)
                    digest[0, filled] = np.add.reduceat(arrow.mix(values ^ _U64(0xA5A5)), starts)
                    digest[1, filled] = np.add.reduceat(arrow.mix(values + _U64(0x1234567)), starts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(counts)), pa.array(counts.astype(np.int64)),
                    pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
                    pa.array([x.tobytes() for x in least], pa.binary()),
                ], names=["id", "n", "f1", "f2", "minwise"])

    return frame.mapInArrow(arrow.tidy(run), "id long, n long, f1 long, f2 long, minwise binary")


def _paths(minwise, levels, trees):
    """Node numbers after each level, as (classes, trees, levels)."""
    out = np.empty((len(minwise), trees, levels), np.uint64)
    path = np.broadcast_to(arrow.mix(np.arange(1, trees + 1, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15)),
                           (len(minwise), trees))
    row = np.arange(len(minwise))[:, None]
    for level in range(levels):
        coordinate = (arrow.mix(path + _U64(level)) % _U64(COORDINATES)).astype(np.int64)
        token = minwise[row, coordinate].astype(np.uint64)
        path = arrow.mix(path * _U64(31) + (token << _U64(8)) + coordinate.astype(np.uint64))
        out[:, :, level] = path
    return out


def _minwise(column):
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _nodes(classes: DataFrame, level: int, trees: int) -> DataFrame:
    """(node, parent, tree, rep, label): the node of every class in every tree after ``level`` levels.

    Computed anew for each level, which costs far less than to store or move all paths.
    """
    def run(batches):
        for batch in batches:
            paths = _paths(_minwise(batch.column(2)), level, trees)
            parent = paths[:, :, max(level - 2, 0)].ravel()  # at the first level nobody asks for it
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths[:, :, -1].ravel().view(np.int64)), pa.array(parent.view(np.int64)),
                 pa.array(np.tile(np.arange(trees, dtype=np.int32), batch.num_rows)),
                 *[pa.array(np.repeat(batch.column(c).to_numpy(), trees)) for c in range(2)]],
                names=["node", "parent", "tree", "rep", "label"])

    return classes.select("rep", "label", "minwise").mapInArrow(
        arrow.tidy(run), "node long, parent long, tree int, rep long, label long")


def _with_short(rows: DataFrame, classes: DataFrame, trees: int, levels: int) -> DataFrame:
    """Rows by ``rep`` plus ``short``, a byte per coordinate, and ``last``, four per tree that
    stand for the class's node after ``levels`` levels: for comparing."""
    def run(batches):
        for batch in batches:
            minwise = _minwise(batch.column(1))
            short = minwise.astype(np.uint8)
            last = (_paths(minwise, levels, trees)[:, :, -1] >> _U64(32)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([x.tobytes() for x in y], pa.binary()) for y in (short, last)]],
                names=["of", "short", "last"])

    bytes_of = classes.select("rep", "minwise").mapInArrow(arrow.tidy(run), "of long, short binary, last binary")
    return rows.join(bytes_of, F.col("rep") == F.col("of")).drop("of")


def _compare(rows: DataFrame) -> DataFrame:
    """Distinct (a, b) of different labels that agree in AGREEING coordinates, within nodes.

    ``rows``: (node, part, tree, rep, label, short, last). Rows of a node lie together in one
    task; members of parts other than -1 are compared with those of another part only. A
    pair whose members end in one node of an earlier tree was compared there, at some level,
    and is left out.
    """
    def run(batches):
        left = None
        for batch in batches:
            left = batch if left is None else pa.concat_batches([left, batch])
            node = left.column(0).to_numpy()
            ends = np.flatnonzero(node[1:] != node[:-1]) + 1
            if not len(ends):
                continue  # a node is bounded, so this ends soon
            yield _candidates(left.slice(0, ends[-1]))
            left = left.slice(ends[-1])
        if left is not None and left.num_rows:
            yield _candidates(left)

    def _candidates(batch):
        node, part, tree, rep, label = (batch.column(c).to_numpy() for c in range(5))
        short = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(-1, COORDINATES)
        last = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint32).reshape(len(node), -1)
        ranks = np.arange(last.shape[1])
        starts = np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]])
        sizes = np.diff(starts)
        found_a, found_b = [], []
        # Members at distance 1, 2, ... within their nodes, for all nodes at once.
        for shift in range(1, int(sizes.max(initial=0))):
            at = np.arange(len(node) - shift)
            at = at[node[at] == node[at + shift]]
            at = at[(label[at] != label[at + shift])
                    & ((part[at] < 0) | (part[at] != part[at + shift]))]
            for low in range(0, len(at), 1 << 16):
                some = at[low:low + (1 << 16)]
                agree = (short[some] == short[some + shift]).sum(1)
                some = some[agree >= AGREEING]
                earlier = (last[some] == last[some + shift]) & (ranks < tree[some][:, None])
                some = some[~earlier.any(1)]
                found_a.append(rep[some])
                found_b.append(rep[some + shift])
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    dealt = rows.select("node", "part", "tree", "rep", "label", "short", "last").repartition("node")
    return dealt.sortWithinPartitions("node").mapInArrow(arrow.tidy(run), "a long, b long").distinct()


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Stored (rep, set) of the ids in ``wanted``, read from their texts again."""
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for row, offsets, data in arrow.text_blocks(batch.column(1)):
                values, first = _sets(offsets, data, size)
                n = len(first) - 1
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, n),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
                ], names=["rep", "set"])

    wanted = stage.table(wanted.distinct(), "wanted")
    if wanted.count() * 16 <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    return stage.table(
        texts.join(wanted, "rep", "left_semi").mapInArrow(arrow.tidy(run), "rep long, set array<long>"), "sets")


def _confirm(pairs: DataFrame, docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    pairs = stage.table(pairs, "pairs")
    sets = _full_sets(docs, pairs.select(F.col("a").alias("rep")).union(pairs.select("b")), size, id_col, text_col)
    both = (
        pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b")
    )
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return stage.table(both.where(100 * common >= percent * union).select("a", "b").distinct(), "links")


def _confirm_near(near: DataFrame, labelled: DataFrame, docs: DataFrame, size: int, percent: int,
                  id_col: str, text_col: str) -> DataFrame:
    """A link from every class to the component it lies near to, where there is one.

    ``near``: (rep, core). A class is compared on full sets with all members of the
    component, block by block; as they are one component already, one link per block is
    enough, so the result grows with the classes, not with the pairs.
    """
    near = stage.table(near.distinct(), "near")
    if not near.limit(1).count():
        return near.toDF("a", "b")
    cores = near.groupBy("core").agg(F.count(F.lit(1)).alias("n_near"))
    inside = labelled.select("rep", "label").join(cores, F.col("label") == F.col("core"), "left_semi")
    sizes = stage.table(
        cores.join(inside.groupBy(F.col("label").alias("core")).agg(F.count(F.lit(1)).alias("n_inside")), "core")
        .select("core", F.ceil(F.col("n_near") / BLOCK).cast("int").alias("near_blocks"),
                F.ceil(F.col("n_inside") / BLOCK).cast("int").alias("inside_blocks")), "near-sizes")

    def dealt(rows, own, other):
        block = F.pmod(F.xxhash64("rep"), F.col(f"{own}_blocks")).cast("int")
        return rows.join(sizes, "core").select(
            "core", "rep", F.lit(own == "near").alias("asks"), block.alias(own),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(other))

    both = dealt(near, "near", "inside").unionByName(
        dealt(inside.select("rep", F.col("label").alias("core")), "inside", "near"))
    sets = _full_sets(docs, both.select("rep"), size, id_col, text_col)
    rows = both.join(sets.select(F.col("rep").alias("of"), "set"), F.col("rep") == F.col("of")).drop("of")

    def link(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        rep = group.column("rep").to_numpy()
        column = group.column("set").combine_chunks()
        first = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
        values = column.flatten().to_numpy()
        counts = np.diff(first)
        inside = np.flatnonzero(~asks)
        at = np.concatenate([np.arange(first[i], first[i + 1]) for i in inside]) if len(inside) else inside
        pool, starts = values[at], np.cumsum(counts[inside]) - counts[inside]
        order = np.argsort(pool)
        owner = np.repeat(np.arange(len(inside)), counts[inside])[order]
        pool = pool[order]
        found = []
        for i in np.flatnonzero(asks):
            mine = values[first[i]:first[i + 1]]
            low, high = np.searchsorted(pool, mine, "left"), np.searchsorted(pool, mine, "right")
            spans = high - low
            hit = np.repeat(low - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            common = np.bincount(owner[hit], minlength=len(inside))
            union = counts[i] + counts[inside] - common
            linked = np.flatnonzero(100 * common >= percent * union)
            if len(linked):
                found.append((rep[i], rep[inside[linked]].min()))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stage.table(
        rows.groupBy("core", "near", "inside").applyInArrow(link, "a long, b long"), "near-links")


def _labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Stored ``classes`` with ``label``, the root of the component so far."""
    roots = stage.table(components(links), "roots")
    return stage.table(
        classes.join(roots, F.col("rep") == F.col("node"), "left")
        .select("rep", F.coalesce("root", "rep").alias("label"), "minwise"), "labelled")


def _candidate_pairs(labelled: DataFrame, trees: int, levels: int, small: int):
    """(pairs, near): pairs of classes that meet in a small node, and (rep, core) of classes
    that meet a large component in a large node.

    From DENSE_LEVEL on a large node is alike in itself, and when most of it is one
    component it would hardly shrink further: its other members are noted as near to that
    component, and the branching goes on without the component.
    """
    pairs, near, large = [], [], None
    for level in range(1, levels + 1):
        rows = _nodes(labelled, level, trees)
        # A row per node and component: members of one component branch as one.
        parts = rows.groupBy("node", "parent", "label").agg(F.count(F.lit(1)).alias("n"))
        if large is not None:
            parts = parts.join(large, F.col("parent") == F.col("at")).where(
                F.col("core").isNull() | (F.col("label") != F.col("core")))
        parts = stage.table(parts.select("node", "label", "n"), "parts")
        sized = stage.table(
            parts.groupBy(F.col("node").alias("at"))
            .agg(F.sum("n").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
                 F.max(F.struct("n", "label")).alias("most"))
            .where("low <> high"), "nodes")

        def members(nodes, parts=parts, rows=rows):
            """(node, rep, label) of the parts left in some nodes."""
            held = parts.join(nodes, F.col("node") == F.col("at")).select(
                F.col("node").alias("in"), F.col("label").alias("of"))
            return rows.join(held, (F.col("node") == F.col("in")) & (F.col("label") == F.col("of"))).select(
                "node", "tree", "rep", "label")

        few = members(sized.where(F.col("n") <= small).select("at"))
        few = few.select("node", F.lit(-1).alias("part"), "tree", "rep", "label")
        pairs.append(stage.table(_compare(_with_short(few, labelled, trees, levels)), "candidates"))
        large = sized.where(F.col("n") > small).select("at", F.lit(None).cast("long").alias("core"))
        if large.isEmpty():
            return pairs, near
        if level >= DENSE_LEVEL:
            large = stage.table(sized.where(F.col("n") > small).select(
                "at", F.when(F.col("most.n") > small, F.col("most.label")).alias("core")), "large-nodes")
            dense = large.where("core IS NOT NULL").withColumnRenamed("at", "dense")
            others = parts.join(dense, F.col("node") == F.col("dense")).where(F.col("label") != F.col("core")).select(
                F.col("node").alias("in"), F.col("label").alias("of"), "core")
            near.append(stage.table(
                rows.join(others, (F.col("node") == F.col("in")) & (F.col("label") == F.col("of")))
                .select("rep", "core").distinct(), "near"))
    left = parts.join(large, F.col("node") == F.col("at")).where(
        F.col("core").isNull() | (F.col("label") != F.col("core"))).select(
        F.col("node").alias("in"), F.col("label").alias("of"))
    rest = rows.join(left, (F.col("node") == F.col("in")) & (F.col("label") == F.col("of"))).select(
        "node", "tree", "rep", "label")
    pairs.append(stage.table(_compare(_with_short(_blocks(rest, small), labelled, trees, levels)), "candidates"))
    return pairs, near


def _blocks(rows: DataFrame, small: int) -> DataFrame:
    """Large last nodes cut into pairs of blocks, each pair a node of its own."""
    nodes = stage.table(rows.groupBy(F.col("node").alias("at")).agg(
        F.ceil(F.count(F.lit(1)) / small).cast("int").alias("blocks")), "last-nodes")
    met = rows.join(nodes, F.col("node") == F.col("at"))
    met = met.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return met.select(
        F.xxhash64("node", low, high).alias("node"),
        F.when(low == high, F.lit(-1)).otherwise(F.col("own")).alias("part"), "tree", "rep", "label")


def _all(tables: list) -> DataFrame:
    return reduce(DataFrame.union, tables)


def groups(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
           text_col: str = "text", trees: int = TREES, small: int = SMALL) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Texts are linked when 100 * |A & B| >= percent * |A | B| for their sets of distinct
    ``size``-word shingles; ``component_id`` is the least id reachable over links, and
    ``kept`` tells that it is the row's own. ``percent`` is 80 or more: below that AGREEING
    would have to fall.

    A null text, or one without words, has an empty set and is linked with nothing. A row
    without an id is counted but in no component (null, not kept). Rows of one id are one
    document: their links are shared. Other columns are ignored.
    """
    if percent < 80:
        raise ValueError("percent below 80: AGREEING would lose links")
    sketched = stage.table(sketches(docs, size, id_col, text_col), "sketches")
    filled = sketched.where("n > 0 AND id IS NOT NULL")
    # The members of a class are reduced to one row in every task before they are shuffled.
    classes = stage.table(
        filled.groupBy("n", "f1", "f2").agg(F.min(F.struct("id", "minwise")).alias("m"))
        .select("n", "f1", "f2", F.col("m.id").alias("rep"), F.col("m.minwise").alias("minwise")),
        "classes")

    deep = _nodes(classes.withColumn("label", F.col("rep")), STAR_LEVEL, trees).select("node", "rep")
    centres = stage.table(
        deep.groupBy("node").agg(F.min("rep").alias("b"), F.max("rep").alias("top"))
        .where("b < top").select(F.col("node").alias("at"), "b"), "centres")
    stars = deep.join(centres, F.col("node") == F.col("at")).where("rep > b").select(
        F.col("rep").alias("a"), "b").distinct()
    same_id = _same_id(filled, classes)
    links = _confirm(stars, docs, size, percent, id_col, text_col)

    labelled = _labelled(classes.select("rep", "minwise"), links.union(same_id))
    found, near = _candidate_pairs(labelled, trees, LEVELS, small)
    others = _confirm(_all(found).distinct(), docs, size, percent, id_col, text_col)
    if near:
        others = others.union(_confirm_near(_all(near), labelled, docs, size, percent, id_col, text_col))

    roots = stage.table(components(links.union(others).union(same_id)), "roots")
    named = stage.table(
        classes.join(roots, F.col("rep") == F.col("node"), "left")
        .select(F.col("n").alias("cn"), "f1", "f2", F.coalesce("root", "rep").alias("component")), "named")
    return (
        sketched.select("id", "n", "f1", "f2")
        .join(named, (F.col("n") == F.col("cn")) & (sketched.f1 == named.f1) & (sketched.f2 == named.f2), "left")
        .select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )


def _same_id(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of one id that stands on rows of different texts."""
    twice = filled.groupBy("id").agg(F.min("f1").alias("low"), F.max("f1").alias("high")).where("low <> high")
    twice = stage.table(twice.select(F.col("id").alias("twice")), "repeated-ids")
    own = filled.join(twice, F.col("id") == F.col("twice"), "left_semi").select("id", "n", "f1", "f2").distinct()
    met = own.join(classes.select("n", "f1", "f2", "rep"), ["n", "f1", "f2"]).select("id", "rep")
    return met.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).join(
        met, "id").where("rep <> b").select(F.col("rep").alias("a"), "b")


def survivors(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per group of near-duplicates, that of the least id; all columns.

    Rows linked with nothing, and rows without an id, stay. Of several rows of one id one
    stays, the least by text digest. What goes is stored first, so its size is known.
    """
    found = groups(docs, size, percent, id_col, text_col)
    gone = stage.table(
        found.where(F.col(id_col).isNotNull() & ~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct(),
        "gone")
    twice = stage.table(
        docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_twice"))
        .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_twice"), "repeated-ids")
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"),
                       F.sha2(F.col(text_col).cast("string"), 256).alias("_digest"))
    rows = rows.join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    once = rows.join(twice, F.col("_id") == F.col("_twice"), "left_anti")
    place = F.row_number().over(Window.partitionBy("_id").orderBy("_digest"))
    first = rows.join(twice, F.col("_id") == F.col("_twice"), "left_semi").withColumn("_place", place)
    return once.select("_row.*").union(first.where("_place = 1").select("_row.*"))
