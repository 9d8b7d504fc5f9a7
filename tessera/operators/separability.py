"""Cluster separability: contingency (A13), ARI (A14), AMI (A15), L4-L6.

ARI and AMI are closed forms over the contingency table, whose size is
(#labels x #clusters) per group regardless of row count.  The expected
mutual information sums hypergeometric terms over the cell counts that are
not proved negligible: some sqrt(N) for each pair of marginal sizes, by the
ratio of neighbouring terms; the pairs are spread over tasks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import kmeans

EPS = sys.float_info.epsilon


def contingency(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts per (a, b) within ``by``."""
    return df.groupBy(*by, a, b).agg(F.count("*").alias("nij"))


def _keyed(df: DataFrame, by: Sequence[str]):
    """Use a constant group key when no grouping is asked for, so every
    combination of per-group aggregates is an equi-join (never a cross join)."""
    if by:
        return df, list(by), []
    return df.withColumn("__all", F.lit(0)), ["__all"], ["__all"]


def _pairs2(x):
    x = x.cast("double")   # a cell of 4e9 squared is no long
    return x * (x - 1) / 2.0


def adjusted_rand_index(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Adjusted Rand index per ``by`` group (1.0 for identical partitions)."""
    df, by, extra = _keyed(df, by)
    c = contingency(df, a, b, by)
    cells = c.groupBy(*by).agg(F.sum(_pairs2(F.col("nij"))).alias("s_ij"),
                               F.sum("nij").alias("N"))
    rows = (c.groupBy(*by, a).agg(F.sum("nij").alias("ai"))
            .groupBy(*by).agg(F.sum(_pairs2(F.col("ai"))).alias("s_a")))
    cols = (c.groupBy(*by, b).agg(F.sum("nij").alias("bj"))
            .groupBy(*by).agg(F.sum(_pairs2(F.col("bj"))).alias("s_b")))
    t = cells.join(rows, by).join(cols, by)
    expected = F.col("s_a") * F.col("s_b") / _pairs2(F.col("N"))
    mx = (F.col("s_a") + F.col("s_b")) / 2.0
    ari = F.when(mx == expected, F.lit(1.0)).otherwise(
        (F.col("s_ij") - expected) / (mx - expected))
    return t.select(*by, ari.alias("ari")).drop(*extra)


#: A tail of the hypergeometric distribution of less than exp(-TAIL) is left out.
TAIL = 46.0


def _expected_information(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Expected mutual information of a cell with marginals a and b in a table of n, for each triple.

    The cell count is hypergeometric.  By Hoeffding's bound it lies within sqrt(TAIL / 2 * m) of its mean but
    for 2 exp(-TAIL), m being the least of a, b, n - a and n - b, so a pair takes O(sqrt(m)) terms.  Its
    probabilities follow from the ratio of neighbours and are divided by their sum: there is no
    factorial, whose logarithm would lose the digits that count for large n."""
    out = np.zeros(len(a))
    for k, (x, y, t) in enumerate(zip(a.astype(float), b.astype(float), n.astype(float), strict=True)):
        reach = math.sqrt(TAIL / 2 * max(0.0, min(x, y, t - x, t - y))) + 1
        lo = max(0.0, x + y - t, math.floor(x * y / t - reach))
        hi = min(x, y, math.ceil(x * y / t + reach))
        cells = np.arange(lo, hi + 1)
        ratio = (x - cells[:-1]) * (y - cells[:-1]) / ((cells[:-1] + 1) * (t - x - y + cells[:-1] + 1))
        weight = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
        weight = np.exp(weight - weight.max())
        some = np.maximum(cells, 1.0)   # an empty cell adds nothing
        out[k] = (weight * (cells / t) * np.log(t * some / (x * y))).sum() / weight.sum()
    return out


def adjusted_mutual_info(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Adjusted mutual information of two columns, arithmetic normalisation."""
    return adjusted_mutual_info_of_table(contingency(df, a, b, by), a, b, by)


def adjusted_mutual_info_of_table(c: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """A15 from counted cells (by, a, b, nij): the work depends on the classes, not on the rows they count.

    EMI = sum over label i, cluster j, and feasible n of
          n/N * ln(N n / (a_i b_j)) * P_hypergeom(n; a_i, b_j, N).
    """
    c, by, extra = _keyed(c, by)
    tot = c.groupBy(*by).agg(F.sum("nij").alias("N"))
    ai = c.groupBy(*by, a).agg(F.sum("nij").alias("ai"))
    bj = c.groupBy(*by, b).agg(F.sum("nij").alias("bj"))

    def with_n(x):
        return x.join(tot, by)

    N = F.col("N").cast("double")
    # MI over cells needs both marginals of the cell.
    cell = c.join(ai, by + [a]).join(bj, by + [b])
    cell = with_n(cell)
    mi = cell.groupBy(*by).agg(F.sum(
        F.col("nij") / N * (F.log(N * F.col("nij")) - F.log(F.col("ai").cast("double") * F.col("bj")))
    ).alias("mi"))
    h_a = with_n(ai).groupBy(*by).agg(
        (-F.sum(F.col("ai") / N * (F.log(F.col("ai")) - F.log(N)))).alias("h_a"),
        F.count("*").alias("k_a"))
    h_b = with_n(bj).groupBy(*by).agg(
        (-F.sum(F.col("bj") / N * (F.log(F.col("bj")) - F.log(N)))).alias("h_b"),
        F.count("*").alias("k_b"))

    # Labels of equal size, and clusters of equal size, give equal terms: pairs of distinct
    # sizes with their multiplicities, N * 2 ** 0.5 sizes at most whatever the labels.
    sizes_a = ai.groupBy(*by, "ai").agg(F.count("*").alias("__ma"))
    sizes_b = bj.groupBy(*by, "bj").agg(F.count("*").alias("__mb"))
    pairs = with_n(sizes_a.join(sizes_b, by)).withColumn("__m", F.col("__ma") * F.col("__mb"))
    n_parts = max(1, c.sparkSession.sparkContext.defaultParallelism)

    @F.pandas_udf("double")
    def expected(ai: pd.Series, bj: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(_expected_information(ai.to_numpy(), bj.to_numpy(), n.to_numpy()))

    pairs = pairs.repartition(n_parts).withColumn("__e", expected("ai", "bj", "N"))
    emi = pairs.groupBy(*by).agg(F.sum(F.col("__e") * F.col("__m")).alias("emi"))

    def j(x, y):
        return x.join(y, by, "left")

    t = j(j(j(mi, h_a), h_b), emi).fillna({"emi": 0.0})
    denom = (F.col("h_a") + F.col("h_b")) / 2.0 - F.col("emi")
    denom = F.when(denom < 0, F.least(denom, F.lit(-EPS))).otherwise(F.greatest(denom, F.lit(EPS)))
    single = ((F.col("k_a") == 1) & (F.col("k_b") == 1))
    ami = F.when(single, F.lit(1.0)).otherwise((F.col("mi") - F.col("emi")) / denom)
    return t.select(*by, ami.alias("ami"), "mi", "emi").drop(*extra)


def separability(df: DataFrame, label: str, cluster: str, by: Sequence[str] = ()) -> DataFrame:
    """ARI and AMI side by side."""
    df, by, extra = _keyed(df, by)
    ari = adjusted_rand_index(df, label, cluster, by)
    ami = adjusted_mutual_info(df, label, cluster, by).select(*by, "ami")
    return ari.join(ami, by).drop(*extra)


# ----------------------------------------------------------- L4-L6 (Spark ML)

def reduce_2d(df: DataFrame, vec_col: str, out: str = "xy", k: int = 2) -> DataFrame:
    """L4: PCA to ``k`` components (Spark ML, distributed covariance)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    v = df.withColumn("__v", array_to_vector(F.col(vec_col)))
    model = PCA(k=k, inputCol="__v", outputCol=out).fit(v)
    return model.transform(v).drop("__v")


def best_kmeans(df: DataFrame, features: str, k: int, seeds: Sequence[int] = range(42, 52),
                out: str = "cluster") -> tuple[DataFrame, float]:
    """KMeans with k clusters, the start of lowest cost of several (ties: the earlier one), and its cost."""
    from pyspark.ml.functions import vector_to_array
    plain = features if not isinstance(df.schema[features].dataType, VectorUDT) else "__array"
    data = cut_lineage(df if plain == features else df.withColumn(plain, vector_to_array(features)))
    model = kmeans.fit(data, plain, k, seeds)
    return model.assign(data, plain, out).drop("__array"), model.cost


def kmeans_separability(df: DataFrame, vec_col: str, label: str, n_starts: int = 10,
                        seed: int = 42) -> DataFrame:
    """Vectors -> PCA(2) -> best-of-n KMeans (k = #labels) -> ARI/AMI."""
    k = df.select(label).distinct().count()
    red = reduce_2d(df.select(label, vec_col), vec_col, "xy")
    clustered, cost = best_kmeans(red, "xy", int(k), range(seed, seed + n_starts))
    res = separability(clustered, label, "cluster")
    return res.select(F.lit(int(k)).alias("k"), "ari", "ami", F.lit(float(cost)).alias("cost"))
