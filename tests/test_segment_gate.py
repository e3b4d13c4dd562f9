import itertools
import math

import pytest
from pyspark.ml.clustering import KMeansModel  # noqa: F401  (import check)

from shopflow import schemas
from shopflow.operators import gate, segment

FEATURE = "customer_id long, rfm_recency_score int, rfm_frequency_score int, rfm_monetary_score int"


def features(spark, groups):
    rows = [cell for cell, n in groups for _ in range(n)]
    return spark.createDataFrame([(i, *cell) for i, cell in enumerate(rows)], FEATURE)


TIGHT = [((5, 5, 5), 6), ((5, 5, 4), 3), ((4, 3, 4), 5), ((3, 2, 2), 7), ((2, 2, 2), 2), ((1, 1, 1), 9)]


def assigned_to(spark, clusters):
    """Standardised histogram with given cluster per cell."""
    df = segment.standardise(segment.histogram(features(spark, [(c, n) for c, n, _ in clusters])))
    given = spark.createDataFrame(
        [(*c, k) for c, _, k in clusters], ", ".join(f"{s} int" for s in segment.SCORES) + ", cluster_id int"
    )
    return df.join(given, segment.SCORES)


def brute_silhouette(points):
    """points: (coordinates, cluster) per customer."""
    scores = []
    for i, (p, k) in enumerate(points):
        by = {}
        for j, (q, c) in enumerate(points):
            if i != j:
                by.setdefault(c, []).append(math.dist(p, q))
        if k not in by:
            scores.append(0.0)
            continue
        a = sum(by[k]) / len(by[k])
        b = min(sum(d) / len(d) for c, d in by.items() if c != k)
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return sum(scores) / len(scores)


def test_null_scores_are_left_out(spark):
    df = spark.createDataFrame([(1, 5, 5, 5), (2, None, 1, 1)], FEATURE)
    assert [r.customer_id for r in segment.rfm_features(df).collect()] == [1]


def test_standardised_scores_have_mean_zero_and_spread_one(spark):
    rows = segment.standardise(segment.histogram(features(spark, TIGHT))).collect()
    n = sum(r.n for r in rows)
    for z in segment.Z:
        assert sum(r.n * r[z] for r in rows) / n == pytest.approx(0)
        assert sum(r.n * r[z] ** 2 for r in rows) / n == pytest.approx(1)


def test_constant_score_is_not_divided_by_zero(spark):
    rows = segment.standardise(segment.histogram(features(spark, [((3, 1, 1), 2), ((3, 5, 5), 2)]))).collect()
    assert {r.z_recency for r in rows} == {0.0}


@pytest.mark.parametrize("clusters", [
    [((5, 5, 5), 6, 0), ((5, 4, 4), 2, 0), ((3, 2, 2), 4, 1), ((1, 1, 1), 3, 2), ((1, 2, 1), 1, 3)],
    [((5, 5, 5), 1, 0), ((1, 1, 1), 9, 1)],
    [((a, b, 3), a + b, (a * b) % 4) for a, b in itertools.product(range(1, 6), range(1, 6))],
])
def test_silhouette_equals_the_all_pairs_one(spark, clusters):
    assigned = assigned_to(spark, clusters)
    points = [
        ((r.z_recency, r.z_frequency, r.z_monetary), r.cluster_id)
        for r in assigned.collect() for _ in range(r.n)
    ]
    made = segment.silhouette(assigned).first().silhouette_score
    assert made == pytest.approx(brute_silhouette(points))


def test_kmeans_separates_tight_groups_and_is_repeatable(spark):
    df = features(spark, TIGHT)
    standard = segment.standardise(segment.stored_histogram(df))
    centres = segment.fit(standard, starts=3)
    assert len(centres) == 4 and centres == segment.fit(standard, starts=3)
    assigned = segment.predict(standard, centres)
    made = segment.assign(df, assigned, segment.label(assigned), "run")
    assert made.columns == schemas.CUSTOMER_SEGMENTS.names and made.count() == df.count()
    by_cell = {
        tuple(r[s] for s in segment.SCORES): r.customer_segment
        for r in made.join(df, "customer_id").collect()
    }
    assert by_cell[(5, 5, 5)] == by_cell[(5, 5, 4)] == "Champions"
    assert by_cell[(1, 1, 1)] == "Lost Customers"
    assert by_cell[(4, 3, 4)] == "Loyal Customers" and by_cell[(3, 2, 2)] == "At Risk"
    counts = {r.customer_segment: r.customers for r in segment.distribution(made).collect()}
    assert counts["Champions"] == 9 and sum(counts.values()) == df.count()


def run_rows(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in schemas.RUNS.names))


def metric(model, version, key, value):
    return (model, version, f"run-{version}", "metric", key, value, None)


def thresholds(spark, rows):
    return spark.createDataFrame(rows, schemas.THRESHOLDS)


def test_latest_version_is_numeric(spark):
    runs = run_rows(spark, [metric("m", "9", "x", "1"), metric("m", "10", "x", "2")])
    assert [tuple(r) for r in gate.latest_version(runs).collect()] == [("m", "10", "run-10")]


def test_gate_verdicts(spark):
    runs = run_rows(spark, [
        metric("good", "9", "s", "0.01"), metric("good", "10", "s", "0.05"),
        metric("bad", "1", "e", "5.1"), metric("bare", "1", "other", "1"),
    ])
    judged = gate.validate(runs, thresholds(spark, [
        ("good", "s", ">=", 0.05), ("bad", "e", "<=", 5.0), ("bare", "s", ">=", 0.0), ("none", "s", ">=", 0.0),
    ]))
    rows = {r.model: r for r in judged.collect()}
    assert rows["good"].passed and rows["good"].version == "10"
    assert not rows["bad"].passed and rows["bad"].error is None
    assert rows["bare"].error == "run run-1 has no number for s"
    assert rows["none"].error == "model none was never run"
    total = gate.summary(judged).first()
    assert (total.all_passed, total.passed_models, total.failed_models) == (False, 1, 3)


def test_failing_model_keeps_its_champion(spark):
    runs = run_rows(spark, [metric("a", "2", "s", "1"), metric("b", "2", "s", "0")])
    judged = gate.validate(runs, thresholds(spark, [("a", "s", ">=", 0.5), ("b", "s", ">=", 0.5)]))
    before = spark.createDataFrame(
        [("a", "champion", "1", None), ("b", "champion", "1", None)], gate.CHAMPIONS
    )
    after = {r.model: r.version for r in gate.promote(before, judged).collect()}
    assert after == {"a": "2", "b": "1"}


def test_recorded_metrics_keep_their_value(spark):
    rows = gate.record_run(spark, "m", "1", "r", {"k": 4}, {"score": 0.1 + 0.2}).collect()
    assert {(r.kind, r.key) for r in rows} == {("param", "k"), ("metric", "score")}
    assert float(next(r.value for r in rows if r.kind == "metric")) == 0.1 + 0.2
