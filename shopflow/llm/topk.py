"""Exact top-k search by inner product with pivot-table elimination.

The distances of every vector to a fixed set of pivots are computed once. For a query q and
a row c, |d(q, p) - d(c, p)| is a lower bound of d(q, c) for every pivot p; the largest one
bounds the inner product from above, as q.c = (|q|^2 + |c|^2 - d(q, c)^2) / 2. Rows are
evaluated in the order of that bound until the bound falls below the k-th best score.

Rows lie in blocks by their two nearest pivots. The least and largest distance of a block to
every pivot bound its best inner product in the same way. A query first meets the block of
the highest bound, which gives a k-th best score to beat, and then only blocks whose bound
reaches it. A task holds one block and some of the queries sent to it, so it never grows with
the tables, and only k rows per query and block go on.
"""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shopflow.llm import arrow
from shopflow.sources import stage

PIVOTS = 24
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 16_384, 4_096
LEAST_ROWS_PER_BLOCK = 2_048
CHUNK = 256  # rows evaluated between two looks at the bound
SCALE = 256
STATISTICS_BYTES = 64 << 20  # of all blocks; with more, queries go to every block
_SLACK = 1e-9  # for rounding of distances, as a share of the squared lengths


def scaled(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): vectors as floor(scale * x), a row per row.

    Rows without an id, and vectors that are null or hold null or non-finite components,
    take no part.
    """
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
        .select(F.col(id_col).cast("long").alias("id"),
                F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    )


def _matrix(column, width):
    """A list column as a matrix of 64-bit integers; short vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), lengths),
        np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _width(*columns):
    return max([max(c.value_lengths().to_pylist() if isinstance(c, pa.Array)
                    else [n for x in c.chunks for n in x.value_lengths().to_pylist()], default=0)
                for c in columns], default=0)


def with_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """``vectors`` plus ``d``: distances to ``pivots`` rows picked by the least hash of the id."""
    picked = [r.v for r in vectors.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()]

    def run(batches):
        for batch in batches:
            width = max(_width(batch.column(1)), *map(len, picked))
            own = _matrix(batch.column(1), width).astype(np.float64)
            table = _matrix(pa.array(picked, pa.list_(pa.int64())), width).astype(np.float64)
            square = (own**2).sum(1)[:, None] + (table**2).sum(1) - 2 * own @ table.T
            d = np.sqrt(np.maximum(square, 0.0))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(d.ravel()), d.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), flat.cast(pa.list_(pa.float64()))],
                names=["id", "v", "d"])

    if not picked:
        return vectors.withColumn("d", F.array().cast("array<double>"))
    return vectors.mapInArrow(arrow.tidy(run), "id long, v array<long>, d array<double>")


def best_of_block(query_ids, queries, query_d, ids, rows, row_d, k):
    """(number of the query, id, score) of its k best rows, ties to the smaller id; own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, rows, row_d = ids[order], rows[order], row_d[order]
    exact = np.float64(np.abs(queries).max(initial=0)) * np.abs(rows).max(initial=0) * max(
        1, rows.shape[1]) < 2.0**52
    kind = np.float64 if exact else np.int64  # float64 sums of integers are exact below 2**53
    rows, queries = rows.astype(kind), queries.astype(kind)
    length = (rows.astype(np.float64)**2).sum(1)
    out = []
    for number, (at, q, d) in enumerate(zip(query_ids, queries, query_d)):
        own = (q.astype(np.float64)**2).sum()
        bound = np.abs(row_d - d).max(1, initial=0.0)
        total = own + length
        # Distances carry a rounding error of about the square root of the slack.
        bound = (total - np.maximum(bound - np.sqrt(_SLACK * total), 0.0)**2) / 2 + _SLACK * total + 1e-6
        bound[ids == at] = -np.inf
        ranked = np.argsort(-bound, kind="stable")
        best_score, best_id = np.zeros(0, kind), np.zeros(0, np.int64)
        for low in range(0, len(ranked), CHUNK):
            if bound[ranked[low]] == -np.inf or (len(best_id) == k and bound[ranked[low]] < best_score[-1]):
                break
            part = ranked[low:low + CHUNK]
            part = part[bound[part] > -np.inf]
            score = np.concatenate([best_score, rows[part] @ q])
            found = np.concatenate([best_id, ids[part]])
            top = np.lexsort((found, -score))[:k]
            best_score, best_id = score[top], found[top]
        out.append((np.full(len(best_id), number), best_id, best_score.astype(np.int64)))
    return [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [[]] * 3)]


class Blocks:
    """Numbers of blocks, and per block its ranges of pivot distances and longest row."""

    def __init__(self, block, low, high, length):
        self.block, self.low, self.high, self.length = block, low, high, length

    def bounds(self, d, own):
        """(queries, blocks): no row of the block has a larger inner product.

        ``d``: the queries' distances to the pivots, ``own`` their squared lengths.
        """
        apart = np.zeros((len(d), len(self.block)))
        for p in range(d.shape[1]):
            to = d[:, p, None]
            np.maximum(apart, np.maximum(self.low[:, p] - to, to - self.high[:, p]), out=apart)
        total = own[:, None] + self.length
        return (total - np.maximum(apart - np.sqrt(_SLACK * total), 0.0)**2) / 2 + _SLACK * total + 1e-6


def _in_blocks(vectors: DataFrame, per_block: int, pivots: int):
    """``vectors`` plus ``block``, by the two nearest pivots, and by hash where more rows meet;
    and the number of blocks, which count from 0."""
    order = F.array_sort("d")
    near = F.array_position("d", F.get(order, F.lit(0)))
    second = F.coalesce(F.array_position("d", F.get(order, F.lit(1))), F.lit(0))
    celled = vectors.withColumn("cell", F.coalesce(near * (pivots + 1) + second, F.lit(0)).cast("int"))
    # At most (pivots + 1)**2 rows.
    sizes = {r.cell: -(-r["count"] // per_block) for r in celled.groupBy("cell").count().collect()}
    places = max(sizes, default=0) + 1
    firsts, number = [0] * places, 0
    for cell, parts in sorted(sizes.items()):
        firsts[cell], number = number, number + parts
    first, parts = (F.from_json(F.lit(json.dumps(x)), "array<int>")
                    for x in (firsts, [sizes.get(cell, 1) for cell in range(places)]))
    own = F.pmod(F.xxhash64("key"), F.get(parts, F.col("cell"))).cast("int")
    return celled.withColumn("block", F.get(first, F.col("cell")) + own).drop("cell"), number


def _statistics(stored: DataFrame, pivots: int, number: int):
    """The blocks' bounds, or None where they are too many to be sent along."""
    if number * (2 * pivots + 2) * 8 > STATISTICS_BYTES:
        return None
    square = F.aggregate(F.transform("v", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x)
    found = stored.groupBy("block").agg(
        F.max(square).alias("length"),
        F.array(*[F.min(F.get("d", F.lit(p))) for p in range(pivots)]).alias("low"),
        F.array(*[F.max(F.get("d", F.lit(p))) for p in range(pivots)]).alias("high")).collect()
    return Blocks(np.array([r.block for r in found]), np.array([r.low for r in found], float),
                  np.array([r.high for r in found], float), np.array([r.length for r in found], float))


def _sent(queries: DataFrame, blocks, first: bool) -> DataFrame:
    """Queries with the ``block`` they meet: the one of the highest bound, or, with the score
    ``beat`` to reach there and not yet met, all whose bound reaches it."""
    shared = queries.sparkSession.sparkContext.broadcast(blocks)
    names = ["key", "id", "v", "d", "block"]

    def run(batches):
        blocks = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                width = _width(part.column(2))
                own = (_matrix(part.column(2), width).astype(np.float64)**2).sum(1)
                d = np.array(part.column(3).flatten()).reshape(part.num_rows, -1)
                bounds = blocks.bounds(d, own)
                if first:
                    row, to = np.arange(part.num_rows), bounds.argmax(1)
                else:
                    beat = part.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
                    met = part.column(5).to_numpy()
                    row, to = np.nonzero((bounds >= np.where(np.isnan(beat), -np.inf, beat)[:, None])
                                         & (blocks.block != met[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(pa.array(row)) for c in range(4)], pa.array(blocks.block[to], pa.int32())],
                    names=names)

    columns = ["key", "id", "v", "d"] + ([] if first else ["beat", "met"])
    return queries.select(columns).mapInArrow(
        arrow.tidy(run), "key long, id long, v array<long>, d array<double>, block int")


def _evaluated(sent: DataFrame, stored: DataFrame, k: int) -> DataFrame:
    """``key``, ``query_id``, ``found``, ``score``: the k best rows of each query in its blocks."""
    sent = stage.table(sent, "sent-queries")
    # Few of a block's queries share a task; its rows go to each of these tasks.
    chunks = stage.table(sent.groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK).cast("int").alias("chunks")), "query-chunks")
    queries = sent.join(chunks, "block").select(
        "block", F.pmod(F.xxhash64(F.lit(1), "key"), F.col("chunks")).cast("int").alias("chunk"),
        F.lit(True).alias("query"), "key", "id", "v", "d")
    rows = stored.join(chunks, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.lit(False).alias("query"), "key", "id", "v", "d")

    def best(group: pa.Table) -> pa.Table:
        asks = group.column("query").to_numpy()
        width = _width(group.column("v"))
        v = _matrix(group.column("v"), width)
        d = np.array(group.column("d").combine_chunks().flatten()).reshape(len(group), -1)
        ids, keys = group.column("id").to_numpy(), group.column("key").to_numpy()
        numbers, found, score = best_of_block(ids[asks], v[asks], d[asks], ids[~asks], v[~asks], d[~asks], k)
        return pa.table({"key": pa.array(keys[asks][numbers], pa.int64()), "query_id": pa.array(ids[asks][numbers], pa.int64()),
                         "found": pa.array(found, pa.int64()), "score": pa.array(score, pa.int64())})

    return queries.unionByName(rows).groupBy("block", "chunk").applyInArrow(
        best, "key long, query_id long, found long, score long")


def search(rows: DataFrame, is_query, k: int = 5, id_col: str = "vec_id",
           vector_col: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id_col`` and ``score`` of every query's k best rows.

    ``is_query`` is a boolean column over ``id``; every row but those of the query's own id is
    a candidate, rows that repeat an id or a vector too; with fewer than k others all are
    returned. See ``scaled`` for rows that take no part. Missing components of a shorter
    vector count as 0. Scores are exact as long as they fit 64 bits. An empty table gives no
    rows; other columns are ignored.
    """
    vectors = stage.table(scaled(rows, id_col, vector_col, scale), "vectors")
    n = vectors.count()
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    per_block = min(ROWS_PER_BLOCK, max(LEAST_ROWS_PER_BLOCK, n // (4 * parallel)))
    pivots = min(pivots, n)
    keyed = stage.table(with_pivots(vectors, pivots).withColumn("key", F.monotonically_increasing_id()), "pivot-table")
    dealt, number = _in_blocks(keyed, per_block, pivots)
    stored = stage.table(dealt, "blocks")
    queries = stored.where(is_query)
    blocks = _statistics(stored, pivots, number)
    if blocks is None:
        everywhere = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(number - 1))))
        partial = _evaluated(everywhere.select("key", "id", "v", "d", "block"), stored, k)
    elif not n:
        partial = rows.sparkSession.createDataFrame([], "key long, query_id long, found long, score long")
    else:
        first = stage.table(_sent(queries, blocks, True), "first-blocks")
        near = stage.table(_evaluated(first, stored, k), "first-scores")
        beat = near.groupBy("key").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("beat")).withColumnRenamed("key", "of")
        rest = first.withColumnRenamed("block", "met").join(beat, F.col("key") == F.col("of"), "left")
        partial = near.unionByName(_evaluated(_sent(rest, blocks, False), stored, k))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "found"))
    return partial.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("found").alias(id_col), "score")
