"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from shopflow.sources import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang neighbours on the least vertex of their star."""
    if large:
        around = edges.union(edges.select("b", "a"))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    around = around.toDF("u", "v")
    # Minima are summed up before the shuffle, and stored: so both sides of the join are
    # plain shuffles, which adaptive execution can split at a hub. They are never broadcast:
    # a table of a few MB takes a multiple of that from the driver, round after round.
    least = stage.table(
        around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars"
    ).withColumnRenamed("u", "hub")
    met = around.join(least.hint("merge"), F.col("u") == F.col("hub"))
    if large:
        moved = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("hub").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node with a link but the roots.

    ``links`` has two integer columns; order, repeats and loops do not matter. Each round
    stores its edges; rounds grow with the logarithm of the longest chain.
    """
    edges = stage.table(
        links.toDF("a", "b").where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                          F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        edges = stage.table(_star(_star(edges, True), False), "edges")
