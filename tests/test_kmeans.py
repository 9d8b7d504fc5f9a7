"""Multi-start KMeans against a plain version and Spark's own."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from tessera.operators import kmeans


def points(seed, n, width, groups):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, width))[rng.integers(groups, size=n)] * 6 + rng.normal(size=(n, width))


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>").repartition(5)


def plain(x, centres, passes):
    centres = centres.copy()
    for _ in range(passes):
        near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
    far = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    return centres, far.min(axis=1).sum(), far.argmin(axis=1)


def test_every_start_equals_a_plain_run(spark):
    x = points(1, 300, 3, 4)
    df = frame(spark, x)
    starts = kmeans._digested(df, "v", 4, range(5), "id")
    model = kmeans.fit(df, "v", 4, range(5), max_iter=4, tol=0.0, init="digest", row_id="id")
    wanted = [plain(x, s, 4) for s in starts]
    assert np.allclose(model.centres, [w[0] for w in wanted]) and np.allclose(model.costs, [w[1] for w in wanted])
    assert model.best == int(np.argmin(np.round([w[1] for w in wanted], 6)))
    got = {r.id: r.cluster for r in model.assign(df, "v").collect()}
    assert [got[i] for i in range(300)] == wanted[model.best][2].tolist()


def test_one_scan_for_each_iteration(spark):
    x = points(2, 200, 2, 3)
    passes = []
    real = kmeans._pass
    try:
        kmeans._pass = lambda data, vec, centres: passes.append(len(centres)) or real(data, vec, centres)
        model = kmeans.fit(frame(spark, x), "v", 3, range(10), max_iter=30)
    finally:
        kmeans._pass = real
    assert len(passes) == model.iterations + 1 and passes[0] == passes[-1] == 10


def test_cost_is_no_more_than_separate_fits(spark):
    x = points(3, 600, 4, 8)
    df = frame(spark, x).cache()
    model = kmeans.fit(df, "v", 8, range(42, 52), max_iter=50)
    ml = df.withColumn("f", array_to_vector("v"))
    costs = [KMeans(k=8, seed=s, featuresCol="f").fit(ml).summary.trainingCost for s in range(42, 45)]
    assert model.cost <= min(costs) * 1.001


def test_odd_rows(spark):
    rows = [(0, None), (1, []), (2, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [5.0, 5.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0])]
    df = spark.createDataFrame([r for r in rows if r[1] != []], "id long, v array<double>")
    model = kmeans.fit(df, "v", 4, [1, 2], init="digest", row_id="id")   # more clusters than rows
    got = {r.id: r.cluster for r in model.assign(df, "v").collect()}
    assert got[0] is got[5] is got[6] is None and got[2] == got[3] != got[4] and model.cost == pytest.approx(0.0)
    nobody = kmeans.fit(df.limit(0), "v", 3, [1])
    assert nobody.cost == 0.0
