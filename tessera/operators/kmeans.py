"""KMeans from several starts, all of them in one pass over the data for each iteration.

A pass holds the centres of every start that still moves (starts x k x width numbers), finds the nearest
centre of each start for a batch of rows with one matrix product, and adds up sums, counts and costs per
task; Spark adds up the tasks, and only those starts x k x (width + 2) numbers reach the driver.

Rules: a row goes to the nearest centre, ties to the smaller number; a cluster without rows keeps its
centre; a start stops when no centre moves by more than ``tol``; the best start is that of least cost,
ties to the earlier one.  Rows whose vector is null, or holds null or non-finite values, take no part
in fitting and get no cluster.

Starts are drawn by k-means++ from ``SAMPLE`` rows for each cluster (the first ones by a digest of the
vector; a bound on what is collected), or with ``init="digest"`` are the first k rows by a digest of seed and
row id, which SQL can follow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows for each cluster from which starts are drawn.
SAMPLE = 100
#: Costs that differ by less, relatively, are equal: sums over tasks end in different last digits.
SAME = 1e-9


def _usable(vec: str) -> Column:
    return F.col(vec).isNotNull() & F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """rows x starts: the number of the nearest centre of each start."""
    starts, k, width = centres.shape
    flat = centres.reshape(starts * k, width)
    far = (flat ** 2).sum(axis=1) - 2.0 * (rows @ flat.T)   # the row's own length is the same for all
    return far.reshape(len(rows), starts, k).argmin(axis=2)


def _pass(data: DataFrame, vec: str, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, counts, costs) per start and cluster: one scan of the data."""
    starts, k, width = centres.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((starts, k, width + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(0))
            for s, near in enumerate(_nearest(rows, centres).T):
                found[s, :, width] += np.bincount(near, minlength=k)
                found[s, :, width + 1] += np.bincount(near, ((rows - centres[s, near]) ** 2).sum(axis=1), minlength=k)
                for d in range(width):
                    found[s, :, d] += np.bincount(near, rows[:, d], minlength=k)
        at = np.flatnonzero(found.any(axis=2).ravel())
        cell = (at[:, None] * (width + 2) + np.arange(width + 2)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(found.ravel()[cell])], names=["cell", "value"])

    sums = data.select(vec).mapInArrow(add_up, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(starts * k * (width + 2))
    for r in sums.collect():   # starts x k x (width + 2) numbers
        out[r.cell] = r.value
    out = out.reshape(starts, k, width + 2)
    return out[:, :, :width], out[:, :, width], out[:, :, width + 1]


def _sampled(data: DataFrame, vec: str, k: int, seeds: Sequence[int]) -> np.ndarray:
    """k-means++ starts from the first rows by a digest of the vector."""
    first = data.select(vec).orderBy(F.xxhash64(vec), vec).limit(SAMPLE * k).collect()
    rows = np.array([r[0] for r in first], np.float64)
    starts = []
    for seed in seeds:
        rng = np.random.default_rng(seed)
        chosen = [rows[rng.integers(len(rows))]]
        near = ((rows - chosen[0]) ** 2).sum(axis=1)
        while len(chosen) < k:
            total = near.sum()
            at = rng.choice(len(rows), p=near / total) if total > 0 else rng.integers(len(rows))
            chosen.append(rows[at])
            near = np.minimum(near, ((rows - rows[at]) ** 2).sum(axis=1))
        starts.append(chosen)
    return np.array(starts)


def _digested(data: DataFrame, vec: str, k: int, seeds: Sequence[int], row_id: str) -> np.ndarray:
    """The first k rows by md5 of ``seed:id``, for each seed."""
    each = data.select(F.explode(F.array(*[F.lit(int(s)) for s in seeds])).alias("seed"), F.col(row_id).alias("id"), F.col(vec).alias("v"))
    digest = F.md5(F.concat_ws(":", F.col("seed").cast("string"), F.col("id").cast("string")).cast("binary"))
    place = F.row_number().over(Window.partitionBy("seed").orderBy("digest", "id"))
    first = each.withColumn("digest", digest).withColumn("place", place).filter(F.col("place") <= k)
    found = {(r.seed, r.place): r.v for r in first.collect()}   # k rows for each start
    have = max((p for _, p in found), default=0)
    return np.array([[found[int(s), min(p, have)] for p in range(1, k + 1)] for s in seeds], np.float64)


@dataclass
class Model:
    """Centres (starts x k x width), the cost of each start, and which is best."""

    centres: np.ndarray
    costs: np.ndarray
    best: int
    iterations: int

    @property
    def cost(self) -> float:
        return float(self.costs[self.best])

    def assign(self, df: DataFrame, vec: str, out: str = "cluster") -> DataFrame:
        """``df`` with the cluster of the best start; null where there is no usable vector."""
        best = self.centres[self.best:self.best + 1]
        from pyspark.sql.functions import pandas_udf

        @pandas_udf(T.IntegerType())
        def nearest(vectors):
            import pandas as pd
            usable = vectors.notna().to_numpy()
            near = np.full(len(vectors), -1)
            if usable.any():
                near[usable] = _nearest(np.stack([np.asarray(v, np.float64) for v in vectors[usable]]), best)[:, 0]
            return pd.Series(near).astype("Int32").mask(near < 0)

        return df.withColumn(out, nearest(F.when(_usable(vec), F.col(vec))))


def fit(df: DataFrame, vec: str, k: int, seeds: Sequence[int], max_iter: int = 20, tol: float = 1e-4,
        init: str = "sample", row_id: str | None = None) -> Model:
    """All starts of ``seeds`` over ``df``, whose ``vec`` is an array column; pass a written or cached
    frame, as it is read once for each iteration."""
    usable = df.filter(_usable(vec))
    data = usable.withColumn(vec, F.col(vec).cast("array<double>"))
    if data.isEmpty() or k < 1:
        return Model(np.zeros((1, 1, 1)), np.zeros(1), 0, 0)
    seeds = list(seeds)
    centres = _digested(data, vec, k, seeds, row_id) if init == "digest" else _sampled(data, vec, k, seeds)
    moving = np.arange(len(seeds))
    iterations = 0
    while len(moving) and iterations < max_iter:
        sums, counts, _ = _pass(data, vec, centres[moving])
        new = np.where(counts[:, :, None] > 0, sums / np.maximum(counts, 1)[:, :, None], centres[moving])
        moved = np.sqrt(((new - centres[moving]) ** 2).sum(axis=2)).max(axis=1)
        centres[moving] = new
        moving = moving[moved > tol]
        iterations += 1
    costs = _pass(data, vec, centres)[2].sum(axis=1)
    return Model(centres, costs, int(np.flatnonzero(costs <= costs.min() * (1 + SAME))[0]), iterations)
