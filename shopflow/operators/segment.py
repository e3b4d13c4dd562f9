"""Customer segments from RFM scores.

Three scores from 1 to 5 can take at most 125 combinations, so the customers are counted
per combination once and every later step works on that weighted histogram.
"""

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from shopflow import schemas
from shopflow.functions import columns as C, fixed_values as fixed
from shopflow.sources import stage

SCORES = ["rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score"]
Z = ["z_recency", "z_frequency", "z_monetary"]


def rfm_features(c360: DataFrame) -> DataFrame:
    """Customers with all three scores."""
    return c360.select("customer_id", *SCORES).na.drop(subset=SCORES)


def histogram(features: DataFrame) -> DataFrame:
    return features.groupBy(*SCORES).agg(F.count(F.lit(1)).alias("n"))


def stored_histogram(features: DataFrame) -> DataFrame:
    """The histogram as a one-file table, so that later steps do not count again."""
    one = histogram(features).repartition(1).sortWithinPartitions(*SCORES)
    return stage.table(one, "rfm-histogram")


def standardise(hist: DataFrame) -> DataFrame:
    """Mean 0 and population standard deviation 1, over customers, not combinations.

    Six integer sums of the histogram reach the driver and come back as literals.
    """
    n = F.col("n")
    sums = hist.agg(
        F.sum(n).alias("n"),
        *[F.sum(n * F.col(s)).alias(f"{s}_1") for s in SCORES],
        *[F.sum(n * F.col(s) * F.col(s)).alias(f"{s}_2") for s in SCORES],
    ).head()

    def scaled(score):
        if not sums.n:
            return F.lit(None).cast("double")
        mean = sums[f"{score}_1"] / sums.n
        variance = (sums.n * sums[f"{score}_2"] - sums[f"{score}_1"] ** 2) / sums.n**2
        return (F.col(score) - F.lit(mean)) / F.lit(variance**0.5 or 1.0)

    return hist.withColumns({z: scaled(score) for score, z in zip(SCORES, Z)})


def fit(standardised: DataFrame, k: int = len(fixed.SEGMENT_NAMES),
        seed: int = fixed.KMEANS_SEED, starts: int = fixed.KMEANS_STARTS):
    """Weighted K-Means on the histogram; the best of several starts. Returns the centres."""
    points = VectorAssembler(inputCols=Z, outputCol="features").transform(standardised)
    points = points.coalesce(1).cache()
    try:
        models = [
            KMeans(k=k, seed=seed + i, weightCol="n", featuresCol="features").fit(points)
            for i in range(starts)
        ]
        best = min(models, key=lambda m: m.summary.trainingCost)
        return [[float(x) for x in c] for c in best.clusterCenters()]
    finally:
        points.unpersist()


def lloyd(standardised: DataFrame, starts: list, steps: int = 50) -> list[list[float]]:
    """Weighted K-Means steps from fixed starting centres; the cheapest of several starts.

    A step is one aggregation of at most 125 rows to K rows: every combination goes to its
    nearest centre, and a centre moves to the mean of its customers, or stays where it has
    none. It ends when no centre moves or after ``steps``. Nothing is random, so any engine
    can follow it.
    """
    best = None
    for centres in starts:
        centres = [[float(x) for x in c] for c in centres]
        for _ in range(steps):
            means = predict(standardised, centres).groupBy("cluster_id").agg(
                *[(F.sum(F.col("n") * F.col(z)) / F.sum("n")).alias(z) for z in Z]).collect()
            moved = [list(c) for c in centres]
            for r in means:
                moved[r.cluster_id] = [r[z] for z in Z]
            done = max(abs(a - b) for old, new in zip(centres, moved) for a, b in zip(old, new)) < 1e-9
            centres = moved
            if done:
                break
        spread = cost(predict(standardised, centres)).first().cost
        if best is None or spread < best[0] - 1e-9:
            best = spread, centres
    return best[1]


def predict(standardised: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Nearest centre per combination; equal distances go to the lower cluster."""
    distances = [
        F.struct(
            sum((F.col(z) - F.lit(x)) ** 2 for z, x in zip(Z, centre)).alias("d"),
            F.lit(i).alias("cluster_id"),
        )
        for i, centre in enumerate(centres)
    ]
    return standardised.withColumn("cluster_id", F.array_min(F.array(*distances))["cluster_id"])


def cost(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances of all customers to the mean of their cluster."""
    moments = assigned.groupBy("cluster_id").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.col(z)).alias(f"s_{z}") for z in Z],
        F.sum(F.col("n") * sum(F.col(z) ** 2 for z in Z)).alias("squares"),
    )
    spread = F.col("squares") - sum(F.col(f"s_{z}") ** 2 for z in Z) / F.col("n")
    return moments.agg(F.sum(spread).alias("cost"))


def silhouette(assigned: DataFrame) -> DataFrame:
    """Mean Euclidean silhouette over all customers, exactly, from the histogram.

    The at most 125 combinations travel to every row as one array; there is no join.
    """
    cells = assigned.agg(F.collect_list(F.struct("cluster_id", "n", *Z)).alias("cells")).scalar()

    def distance(c):
        return F.sqrt(sum((F.col(z) - c[z]) ** 2 for z in Z))

    def total(cluster, what):
        """Sum of ``what`` over the customers of one cluster."""
        return F.aggregate(
            F.filter("_cells", lambda c: c["cluster_id"] == cluster),
            F.lit(0.0),
            lambda acc, c: acc + c["n"] * what(c),
        )

    def size(cluster):
        return total(cluster, lambda c: F.lit(1.0))

    own = F.col("cluster_id")
    others = F.filter(
        F.array_distinct(F.transform("_cells", lambda c: c["cluster_id"])), lambda k: k != own
    )
    a = total(own, distance) / (size(own) - 1)
    b = F.array_min(F.transform(others, lambda k: total(k, distance) / size(k)))
    s = F.when(size(own) > 1, F.col("_b") - F.col("_a")).otherwise(0.0) / F.greatest("_a", "_b")
    scored = (
        assigned.withColumn("_cells", cells)
        .withColumn("_a", F.when(size(own) > 1, a).otherwise(0.0))
        .withColumn("_b", b)
        .withColumn("_s", F.when(F.greatest("_a", "_b") > 0, s).otherwise(0.0))
    )
    return scored.agg((F.sum(F.col("n") * F.col("_s")) / F.sum("n")).alias("silhouette_score"))


def label(assigned: DataFrame) -> DataFrame:
    """Name clusters by the sum of their centroid's coordinates, largest first."""
    composite = sum(F.col("n") * F.col(z) for z in Z)
    centroids = assigned.groupBy("cluster_id").agg(
        F.sum("n").alias("customers"), (F.sum(composite) / F.sum("n")).alias("composite_score")
    )
    # At most as many rows as there are clusters.
    rank = F.row_number().over(Window.orderBy(F.desc("composite_score"), "cluster_id"))
    names = F.array(*[F.lit(n) for n in fixed.SEGMENT_NAMES])
    return centroids.withColumn("customer_segment", F.try_element_at(names, rank))


def assign(features: DataFrame, assigned: DataFrame, labels: DataFrame, run_id: str,
           now=None) -> DataFrame:
    """Segment of every customer. The histogram has at most 125 rows and is broadcast."""
    named = assigned.join(labels.select("cluster_id", "customer_segment"), "cluster_id")
    return (
        features.join(F.broadcast(named), SCORES)
        .withColumn("run_id", F.lit(run_id))
        .withColumn("segmented_at", C.stamp(now))
        .select(schemas.CUSTOMER_SEGMENTS.names)
    )


def distribution(segments: DataFrame) -> DataFrame:
    return segments.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))
