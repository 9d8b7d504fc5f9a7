import numpy as np

from tessera.llm import topk_nra

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    x = {i: np.floor(256 * np.array(v, np.float64)).astype(int) for i, v in rows}
    out = set()
    for q in x:
        if q % every == 0:
            found = sorted((-int(x[q] @ x[i]), i) for i in x if i != q and len(x[i]) == len(x[q]))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def found(df):
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()}


def test_random_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    v = rng.integers(-2, 3, (700, 6)).astype(np.float32) / 64
    v[200:500] = v[0]   # a third of all rows are one vector
    rows = [(i, v[i].tolist()) for i in range(700)]
    assert found(topk_nra.search(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_several_shards_and_blocks(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(0, 0.2, (900, 16)).astype(np.float32)
    rows = [(i, v[i].tolist()) for i in range(900)]
    x = topk_nra.integers(spark.createDataFrame(rows, SCHEMA))
    got = topk_nra.top_k(x, x.filter("vec_id % 50 = 0"), 5, shard_rows=200, block_rows=7)
    assert found(got) == brute(rows)


def test_bounds_hold_while_reading():
    rng = np.random.default_rng(3)
    x, q = rng.integers(-50, 50, (300, 8)), rng.integers(-50, 50, (20, 8)).astype(float)
    lists, exact = topk_nra.Lists(x), q @ x.T
    for depth in (1, 20, 100, 200, 299, 300):
        lists.to(depth)
        low, high = lists.bounds(q)
        assert (low <= exact).all() and (exact <= high).all()
    assert (low == high).all()


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, []), (None, [1.0, 1.0]), (50, [0.25, 0.25]), (7, [-1.0, 0.0])]
    got = found(topk_nra.search(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute([(0, [1.0, 0.5]), (50, [0.25, 0.25]), (7, [-1.0, 0.0])])
    assert topk_nra.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert topk_nra.search(spark.createDataFrame([(0, [1.0])], SCHEMA)).count() == 0


def test_each_length_apart(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, rng.choice([1, 3, 3, 3, 40])).astype(np.float32).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'keep' AS v", "'keep' AS size", "'keep' AS shard", "'keep' AS ids")
    assert found(topk_nra.search(df)) == brute(rows) and len({len(v) for i, v in rows if i % 50 == 0}) > 1
    x = topk_nra.integers(df)
    assert found(topk_nra.top_k(x, x.filter("vec_id % 50 = 0"), 5, shard_rows=20, block_rows=2)) == brute(rows)


def test_large_components_and_near_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(9e6 * rng.choice([-1.0, 1.0])), *(rng.integers(-3, 4, 7) / 256).tolist()]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = topk_nra.integers(df)
    assert found(topk_nra.top_k(x, x.filter("vec_id % 50 = 0"), 5, shard_rows=300)) == brute(rows)


def test_a_very_long_vector(spark):
    rows = [(i, [float((i * j) % 5) for j in range(3000)]) for i in range(60)]
    assert found(topk_nra.search(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
