import hashlib

import numpy as np
import pytest

from orderlake.llm import centroids
from orderlake.llm.centroids import clusters, fit, nearest, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, vector int, expiry string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, 5, "x") for i, v in rows], SCHEMA)


def clouds(n, size, seed, middles=5):
    random = np.random.default_rng(seed)
    at = random.normal(0, 3, (middles, size))
    return (at[random.integers(0, middles, n)] + random.normal(0, 0.4, (n, size))).astype(np.float32)


def brute(rows, count, rounds, seed=3):
    """Plain rounds over all vectors with whole numbers of any length."""
    x = [[int(np.floor(1024 * float(v))) for v in vector] for _, vector in rows]
    order = sorted(range(len(x)), key=lambda k: (hashlib.sha256(f"{seed}:{rows[k][0]}".encode()).hexdigest(), x[k]))
    middle = [list(x[k]) for k in order[:count]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, m)) for m in middle] for v in x]
        return [min(range(len(middle)), key=lambda c: (d[c], c)) for d in far], far

    for _ in range(rounds):
        own, _ = assign()
        for c in range(len(middle)):
            mine = [v for v, o in zip(x, own) if o == c]
            if mine:
                middle[c] = [sum(column) // len(mine) for column in zip(*mine)]
    own, far = assign()
    return sorted((rows[k][0], own[k], far[k][own[k]], tuple(middle[own[k]])) for k in range(len(x)))


def found(df):
    return sorted((r.vec_id, r.cluster, r.distance, tuple(r.centroid)) for r in df.collect())


@pytest.mark.parametrize(("n", "size", "count", "rounds"), [(300, 6, 8, 6), (40, 3, 3, 2), (5, 4, 8, 3), (1, 2, 8, 2)])
def test_same_as_plain_rounds(spark, n, size, count, rounds):
    rows = list(enumerate(clouds(n, size, n).tolist()))
    df = clusters(frame(spark, rows), count, rounds, size=size)
    assert found(df) == brute(rows, count, rounds)
    first = df.collect()
    assert {r.inertia for r in first} == {sum(r.distance for r in first)}
    for c in {r.cluster for r in first}:
        assert {r.cluster_inertia for r in first if r.cluster == c} == {sum(r.distance for r in first if r.cluster == c)}


def test_ties_go_to_the_smaller_number_and_repeated_rows_count(spark):
    # On a small grid many vectors are equally near to several centroids.
    random = np.random.default_rng(2)
    rows = [(i % 40, (random.integers(-2, 3, 3) / 1024).tolist()) for i in range(200)]
    assert found(clusters(frame(spark, rows), 8, 5, size=3)) == brute(rows, 8, 5)
    same = [(i, [1.0, 2.0]) for i in range(20)]
    assert found(clusters(frame(spark, same), 4, 3, size=2)) == brute(same, 4, 3)


def test_few_vectors_are_scanned_again_when_clusters_lie_apart(spark):
    rows = list(enumerate(clouds(400, 8, 9, middles=8).tolist()))
    result = fit(whole_vectors(frame(spark, rows), 8), 8, 8)
    scanned = result.scanned()
    assert scanned[0] == 400 and scanned[-1] < 400 and sum(scanned) < 9 * 400
    assert result.assigned().count() == 400


def test_every_vector_is_held_once(spark):
    rows = list(enumerate(clouds(300, 5, 4).tolist()))
    held = fit(whole_vectors(frame(spark, rows), 5), 8, 10).assigned()
    assert sorted(r.vec_id for r in held.collect()) == list(range(300))


def test_heads_of_runs_are_a_filter_of_the_scan(spark):
    rows = list(enumerate(clouds(50, 4, 1).tolist()))
    result = fit(whole_vectors(frame(spark, rows), 4), 4, 2)
    plan = centroids._popped(result.heaps, np.zeros(4), np.arange(4.0) + 1)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThan(expiry" in pushed and "EqualTo(cluster" in pushed


def test_gap_and_first_of_equals():
    cluster, distance, gap = nearest(np.array([[0, 0], [3, 4]]), np.array([[3, 4], [-3, -4], [0, 0]]))
    assert cluster.tolist() == [2, 0] and distance.tolist() == [0, 0] and gap.tolist() == [5, 5]
    cluster, _, gap = nearest(np.array([[0, 0]]), np.array([[1, 0], [0, 1]]))
    assert cluster.tolist() == [0] and gap.tolist() == [0]


def test_odd_vectors(spark):
    good = [0.5, -1.25]
    rows = [
        (None, good),
        (None, good),
        (1, None),
        (2, []),
        (3, [1.0, None]),
        (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]),
        (6, [1.0, 2.0, 3.0]),
        (7, [-3.0, 4.0]),
        (7, good),
    ]
    result = clusters(frame(spark, rows), 2, 2, size=2).collect()
    assert sorted(map(repr, (r.vec_id for r in result))) == ["7", "7", "None", "None"]
    none = clusters(frame(spark, rows).where("vec_id = 1"), 2, 2, size=2)
    assert none.collect() == [] and none.columns[:3] == ["vec_id", "cluster", "distance"]


def test_components_that_are_too_large_are_refused(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 0.0])]
    with pytest.raises(Exception, match="beyond"):
        clusters(frame(spark, rows), 2, 1, size=2).collect()
