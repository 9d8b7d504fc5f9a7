"""Metrics, losses and separability against hand-worked / NumPy values."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, softmax
from tessera.operators import evaluate, separability

Y_TRUE = [0, 0, 1, 1, 2, 2, 2]
Y_PRED = [0, 1, 1, 1, 0, 0, 3]      # class 2 never predicted, class 3 never true


def frame(spark, yt=Y_TRUE, yp=Y_PRED):
    return spark.createDataFrame([("m", i, a, b) for i, (a, b) in enumerate(zip(yt, yp))],
                                 "model STRING, id INT, y_true INT, y_pred INT")


def test_macro_metrics_hand_worked(spark):
    m = evaluate.classification_metrics(frame(spark)).first()
    # classes 0..3: tp 1,2,0,0; true 2,2,3,0; pred 3,3,0,1
    prec = [1 / 3, 2 / 3, 0, 0]
    rec = [1 / 2, 1, 0, 0]
    f1 = [2 * 1 / 5, 2 * 2 / 5, 0, 0]
    assert m.accuracy == pytest.approx(3 / 7)
    assert m.precision == pytest.approx(sum(prec) / 4)
    assert m.recall == pytest.approx(sum(rec) / 4)
    assert m.f1 == pytest.approx(sum(f1) / 4)
    assert m.weighted_f1 == pytest.approx((f1[0] * 2 + f1[1] * 2) / 7)


def test_confusion_matrix(spark):
    cm = {(r.y_true, r.y_pred): (r.n, r.share)
          for r in evaluate.confusion_matrix(frame(spark)).collect()}
    assert cm[(2, 0)] == (2, pytest.approx(2 / 3))
    assert cm[(0, 1)] == (1, 0.5)


def test_argmax_softmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, -1.0],)], "a ARRAY<DOUBLE>")
    r = df.select(argmax("a").alias("i"), softmax("a").alias("p")).first()
    assert r.i == 1
    x = np.array([1.0, 3.0, 3.0, -1.0])
    assert np.allclose(r.p, np.exp(x) / np.exp(x).sum())


def test_losses_match_numpy(spark):
    rng = np.random.default_rng(1)
    s = rng.normal(size=(50, 4))
    t = rng.normal(size=(50, 4))
    y = rng.integers(0, 4, 50)
    df = spark.createDataFrame([("m", int(y[i]), s[i].tolist(), t[i].tolist())
                                for i in range(50)],
                               "model STRING, y_true INT, student ARRAY<DOUBLE>, "
                               "teacher ARRAY<DOUBLE>")
    got = evaluate.losses(df).first()
    cnt = Counter(y.tolist())
    w = np.array([max(cnt.values()) / cnt[v] for v in y])
    lse = np.log(np.exp(s).sum(1))
    ce = lse - s[np.arange(50), y]
    T = 2.0

    def logsm(a):
        a = a / T
        return a - np.log(np.exp(a).sum(1, keepdims=True))
    kl = (np.exp(logsm(t)) * (logsm(t) - logsm(s))).sum(1).mean() * T * T
    assert got.weighted_ce == pytest.approx((w * ce).sum() / w.sum())
    assert got.distill_kl == pytest.approx(kl)
    assert got.hybrid_loss == pytest.approx(0.5 * got.weighted_ce + 0.5 * kl)


def _ari_ami_numpy(a, b):
    """Direct formulas (our own) for checking."""
    from math import lgamma, log
    n = len(a)
    ca, cb = Counter(a), Counter(b)
    cij = Counter(zip(a, b))
    comb = lambda x: x * (x - 1) / 2
    s_ij = sum(comb(v) for v in cij.values())
    s_a = sum(comb(v) for v in ca.values())
    s_b = sum(comb(v) for v in cb.values())
    exp = s_a * s_b / comb(n)
    ari = (s_ij - exp) / ((s_a + s_b) / 2 - exp)
    mi = sum(v / n * log(n * v / (ca[i] * cb[j])) for (i, j), v in cij.items())
    ha = -sum(v / n * log(v / n) for v in ca.values())
    hb = -sum(v / n * log(v / n) for v in cb.values())
    emi = 0.0
    for ai in ca.values():
        for bj in cb.values():
            for k in range(max(1, ai + bj - n), min(ai, bj) + 1):
                lg = (lgamma(ai + 1) + lgamma(bj + 1) + lgamma(n - ai + 1) + lgamma(n - bj + 1)
                      - lgamma(n + 1) - lgamma(k + 1) - lgamma(ai - k + 1) - lgamma(bj - k + 1)
                      - lgamma(n - ai - bj + k + 1))
                emi += k / n * log(n * k / (ai * bj)) * math.exp(lg)
    ami = (mi - emi) / ((ha + hb) / 2 - emi)
    return ari, ami


def test_ari_ami_against_direct_formulas(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 4, 300).tolist()
    b = [(x + (1 if rng.random() < 0.3 else 0)) % 5 for x in a]
    df = spark.createDataFrame(list(zip(a, b)), "a INT, b INT")
    ari, ami = _ari_ami_numpy(a, b)
    r = separability.separability(df, "a", "b").first()
    assert r.ari == pytest.approx(ari, abs=1e-9)
    assert r.ami == pytest.approx(ami, abs=1e-9)


def test_ari_identical_partitions_is_one(spark):
    df = spark.createDataFrame([(i % 3, (i % 3) + 10) for i in range(30)], "a INT, b INT")
    r = separability.separability(df, "a", "b").first()
    assert r.ari == pytest.approx(1.0) and r.ami == pytest.approx(1.0)


def test_ln_factorial_matches_lgamma(spark):
    from tessera.functions.arrays import ln_factorial
    ns = [0, 1, 5, 20, 21, 100, 12345, 10 ** 7]
    df = spark.createDataFrame([(n,) for n in ns], "n BIGINT")
    got = [r.v for r in df.select(ln_factorial("n").alias("v")).collect()]
    assert got == pytest.approx([math.lgamma(n + 1) for n in ns], rel=1e-12, abs=1e-12)


def test_latency_stats(spark):
    df = spark.createDataFrame([("m", x) for x in [0.1, 0.2, 0.3, 0.6]], "model STRING, sec DOUBLE")
    r = evaluate.latency_stats(df).first()
    assert r.total_time == pytest.approx(1.2)
    assert r.time_per_sample_std == pytest.approx(np.std([0.1, 0.2, 0.3, 0.6]))


def test_kmeans_separability_recovers_separated_clusters(spark):
    rng = np.random.default_rng(4)
    rows = []
    for lab in range(3):
        centre = np.zeros(8)
        centre[lab] = 50.0
        for _ in range(40):
            rows.append((lab, (centre + rng.normal(size=8)).tolist()))
    df = spark.createDataFrame(rows, "label INT, embedding ARRAY<DOUBLE>")
    r = separability.kmeans_separability(df, "embedding", "label", n_starts=3).first()
    assert r.k == 3
    assert r.ari == pytest.approx(1.0) and r.ami == pytest.approx(1.0)


def test_ari_of_very_large_cells(spark):
    df = spark.createDataFrame([("a", "x", 4_000_000_000), ("b", "y", 4_000_000_000)], "l STRING, c STRING, nij LONG")
    pairs = df.select(separability._pairs2(F.col("nij")).alias("p")).collect()
    assert all(r.p == pytest.approx(8e18) for r in pairs)


def test_softmax_is_linear_in_the_classes(spark):
    import time
    wide = spark.range(200).select(F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: (i % 7).cast("double")).alias("a")).cache()
    wide.count()
    t = time.time()
    total = wide.select(F.aggregate(softmax("a"), F.lit(0.0), lambda s, x: s + x).alias("t")).agg(F.sum("t")).first()[0]
    assert total == pytest.approx(200) and time.time() - t < 10


def test_pairing_by_id_never_by_position(spark):
    truth = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "id INT, y_true INT")
    pred = spark.createDataFrame([(3, 2), (1, 1)], "id INT, y_pred INT")
    got = sorted((r.id, r.y_true, r.y_pred) for r in evaluate.pair_by_id(truth, pred).collect())
    assert got == [(1, 0, 1), (2, 1, None), (3, 2, 2)]
    with pytest.raises(Exception, match="without truth"):
        evaluate.pair_by_id(truth, spark.createDataFrame([(9, 0)], "id INT, y_pred INT")).collect()


def expected_by_fractions(ai, bj, n):
    """The expected mutual information of one cell, with whole numbers."""
    out = 0.0
    for k in range(max(1, ai + bj - n), min(ai, bj) + 1):
        p = math.comb(ai, k) * math.comb(n - ai, bj - k) / math.comb(n, bj)
        out += k / n * math.log(n * k / (ai * bj)) * p
    return out


def test_expected_information_of_small_tables():
    import numpy as np
    from tessera.operators.separability import _expected_information
    cases = [(a, b, n) for n in (1, 2, 7, 40, 300) for a in {1, 2, n // 3, n - 1, n} for b in {1, n // 2, n} if 0 < a <= n and 0 < b <= n]
    got = _expected_information(*(np.array(x) for x in zip(*cases)))
    assert got == pytest.approx([expected_by_fractions(*c) for c in cases], abs=1e-13)


def test_ami_of_a_billion_rows(spark):
    """10 x 10 classes of 10^9 rows from their table, in seconds; for so many rows the expected
    information is (9 * 9) / (2 N) but for terms of 1 / N^2."""
    import time
    from tessera.operators import separability
    rows = [(i, j, 10_000_000 + (3_000_000 if i == j else 0) + 1000 * i * j - 333_333 * (i == j)) for i in range(10) for j in range(10)]
    n = sum(r[2] for r in rows)
    start = time.time()
    r = separability.adjusted_mutual_info_of_table(spark.createDataFrame(rows, "a int, b int, nij long"), "a", "b").first()
    assert time.time() - start < 60 and n > 10**9
    assert r.emi == pytest.approx(81 / (2 * n), rel=1e-4) and 0 < r.ami < 1


def test_ami_of_rows_equals_ami_of_their_table(spark):
    from tessera.operators import separability
    df = spark.range(500).selectExpr("id % 7 as a", "(id * id) % 5 as b", "id % 2 as g")
    by_rows = separability.adjusted_mutual_info(df, "a", "b", ["g"])
    by_table = separability.adjusted_mutual_info_of_table(separability.contingency(df, "a", "b", ["g"]), "a", "b", ["g"])
    assert sorted(by_rows.collect()) == sorted(by_table.collect())
