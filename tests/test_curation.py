"""Curation operators against brute force on small fixtures."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import curate


def test_drop_all_copies_leaves_no_survivor(spark):
    data = [(1, "a", "train"), (2, "a", "train"), (3, "b", "train"), (4, "a", "test"),
            (5, "c", "test"), (6, "c", "test"), (7, None, "train")]
    df = spark.createDataFrame(data, "id INT, text STRING, split STRING")
    got = sorted(r.id for r in curate.drop_all_copies(df, "text", by=["split"]).collect())
    assert got == [3, 4, 7]


def test_drop_all_copies_random(spark):
    rng = random.Random(1)
    data = [(i, rng.choice("abcdefghij") * rng.randint(1, 3)) for i in range(400)]
    df = spark.createDataFrame(data, "id INT, text STRING")
    cnt = Counter(t for _, t in data)
    want = sorted(i for i, t in data if cnt[t] == 1)
    assert sorted(r.id for r in curate.drop_all_copies(df).collect()) == want


def test_duplicate_report(spark):
    data = [(1, "b text", 0), (2, "b text", 1), (3, "a text", 1), (4, "a text", 1),
            (5, "a text", 0), (6, "solo", 2)]
    df = spark.createDataFrame(data, "doc_id INT, text STRING, label INT")
    out = curate.duplicate_report(df, "label", "doc_id").collect()
    assert [(r.text, r.labels, r.n_copies) for r in out] == [
        ("a text", "Joy:2/Sadness:1", 3), ("b text", "Sadness:1/Joy:1", 2)]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(2,)] * 2, "label INT")
    w = {r.label: r.weight for r in curate.class_weights(df).collect()}
    assert w == {0: 1.0, 1: 2.0, 2: 3.0}


def test_length_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    lens = rng.integers(0, 200, 500)
    df = spark.createDataFrame([(int(x), "s") for x in lens], "length INT, split STRING")
    out = {r.bin: r.n for r in curate.length_histogram(df, "length", ["split"]).collect()}
    counts, _ = np.histogram(lens, bins=np.linspace(0, lens.max(), 50))
    assert {i + 1: int(c) for i, c in enumerate(counts)} == out


def test_grids_are_dense(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 2)], "split STRING, label INT")
    got = [(r.split, r.label, r.n) for r in curate.class_distribution(df, "label", ["split"], [0, 1, 2]).collect()]
    assert got == [("a", 0, 2), ("a", 1, 0), ("a", 2, 0), ("b", 0, 0), ("b", 1, 0), ("b", 2, 1)]
    weights = {r.label: r.weight for r in curate.class_weights(df, "label", [0, 1, 2]).collect()}
    assert weights == {0: 1.0, 1: None, 2: 2.0}


def test_large_strata_and_singletons(spark):
    counts = spark.createDataFrame([("a", 5_000_000_000), ("b", 5_000_000_000)] + [(f"s{i}", 1) for i in range(10)],
                                   "strat_key STRING, n LONG")
    quota = {r.strat_key: r.quota for r in curate.stratum_quotas(counts, "strat_key", 0.2).collect()}
    assert quota == {"a": 1_000_000_000, "b": 1_000_000_000} | {f"s{i}": 0 for i in range(10)}
    rows = spark.createDataFrame([(i, f"s{i}") for i in range(10)] + [(20 + i, "big") for i in range(10)], "doc_id INT, strat_key STRING")
    split = {r.doc_id: r.split for r in curate.stratified_split(rows).collect()}
    assert all(split[i] == "train" for i in range(10)) and sum(v == "validation" for v in split.values()) == 2
    assert curate.singleton_strata(rows).count() == 10


def test_dedupe_handles_nulls_and_groups(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "t", "x"), (4, "t", "y"), (5, "t", "y"), (6, "u", None), (7, "u", None)],
                               "id INT, text STRING, split STRING")
    assert sorted(r.id for r in curate.drop_all_copies(df, by=["split"]).collect()) == [1, 2, 3]


def test_deciles_and_bins(spark):
    lens = [1, 2, 2, 3, 5, 8, 13, 21, 34, 55, 89]
    df = spark.createDataFrame([(x,) for x in lens], "length INT")
    edges = curate.length_deciles(df)
    assert np.allclose(edges, np.percentile(lens, np.arange(0, 101, 10)))
    got = [r.b for r in df.select(curate.decile_bin(F.col("length"), edges).alias("b"))
           .collect()]
    assert got == [int(np.digitize(x, edges[1:-1], right=False)) for x in lens]


def _brute_split(rows, fraction=0.2, seed=42):
    import hashlib
    strata = defaultdict(list)
    for i, k in rows:
        strata[k].append(i)
    n = len(rows)
    n_val = math.ceil(n * fraction)
    base = {k: n_val * len(v) // n for k, v in strata.items()}
    rem = {k: n_val * len(v) - base[k] * n for k, v in strata.items()}
    extra = n_val - sum(base.values())
    order = sorted(strata, key=lambda k: (-rem[k], k))
    quota = {k: base[k] + (1 if r < extra else 0) for r, k in enumerate(order)}
    val = set()
    for k, ids in strata.items():
        ids = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
        val.update(ids[:quota[k]])
    return val


def test_stratified_split_exact(spark):
    rng = random.Random(5)
    rows = [(i, f"{rng.randint(0, 5)}_{rng.randint(0, 9)}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id INT, strat_key STRING")
    # few bucket bits so several rows share the cut bucket
    out = curate.stratified_split(df, "strat_key", "doc_id", 0.2, 42, bucket_bits=4)
    got = {r.doc_id for r in out.collect() if r.split == "validation"}
    assert out.count() == 2000
    assert got == _brute_split(rows)
    assert len(got) == math.ceil(2000 * 0.2)


def test_deciles_by_a_summary_keep_their_rank_error(spark):
    from bisect import bisect_left, bisect_right
    for path, col in (("documents", "n_chars"), ("events", "value")):
        df = spark.read.parquet(f"/root/testdata/sf0.1/{path}.parquet").select(col)
        values = sorted(r[0] for r in df.collect())
        for error in (0.01, 0.001):
            for q, v in zip(curate.DECILES, curate.length_deciles(df, col, rank_error=error), strict=True):
                lo, hi = bisect_left(values, v) / len(values), bisect_right(values, v) / len(values)
                assert v in (values[int(lo * len(values))], v) and lo - error <= q <= hi + error
    assert curate.length_deciles(df.limit(0), col, rank_error=0.01) == []
