"""Exact top-k by inner product with no-random-access aggregation (operator 2).

Equal vectors are grouped first, each group with its ``k + 1`` smallest ids (no other row of
a group can be among the best ``k`` of a query), so a vector that a third of all rows hold is
one candidate.  Candidates are dealt to shards of about ``SHARD_ROWS`` and queries to blocks
of about ``BLOCK_ROWS``; a task holds one shard and one block.

In a task every component is a list sorted by value, read from the top for queries with a
positive weight there and from the bottom for those with a negative one.  All queries of the
block read on together, a step deeper in all lists.  What a candidate has shown so far adds
up exactly; each list that has not shown it adds at most the list's value at this depth and
at least the list's last value.  That gives lower and upper bounds (matrix products over
what has been read).  A query stops when at most ``FEW`` candidates have an upper bound that
reaches its ``k``-th lower bound: outsiders cannot qualify any more.  The scores of those
that remain are then resolved.  Lists that are read to the end make the bounds exact, so
ties and unlucky data only take longer.  The shards' best are merged by a window per query.

Vectors of each length are searched among themselves: there is no inner product with another
length.  Components are 64-bit integers.  Bounds are sums of doubles, so they are widened by what their
rounding can amount to, and the scores of what remains are resolved in whole numbers.

Defined cases: null and empty vectors and vectors with a null, infinite or NaN component take no part, nor
do null ids; components or scores beyond 64 bits end the job with an error; very long vectors make
smaller shards and blocks (``CELLS`` components at most); other columns are not read, whatever their names;
ties go to the smaller id; equal rows count once; a row is no answer to a query of its own id;
fewer than ``k`` candidates give as many answers; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, join_lookup

SCALE = 256
SHARD_ROWS = 8192
BLOCK_ROWS = 2048
#: Steps in which the lists are read, as shares of their length.
DEPTHS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
#: Candidates left to a query at which their scores are resolved.
FEW = 256
#: Queries whose bounds are held at once.
AT_ONCE = 256
#: Components of a shard or block of very long vectors.
CELLS = 1 << 21


class Lists:
    """The sorted lists of a shard, and what has been read of them from either end."""

    def __init__(self, x: np.ndarray):
        self.whole, self.x = x, x.astype(np.float64)
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.x, self.order, axis=0)
        n, d = x.shape
        self.read = 0
        # [0]: from the top, [1]: from the bottom; what is not read yet counts 0 and is unseen
        self.seen = np.zeros((2, n, d))
        self.unseen = np.ones((2, n, d))

    def to(self, depth: int) -> None:
        """Read every list on to ``depth`` entries, from both ends."""
        n, d = self.x.shape
        column = np.broadcast_to(np.arange(d), (depth - self.read, d))
        for end, rows in ((0, slice(n - depth, n - self.read)), (1, slice(self.read, depth))):
            who = self.order[rows]
            self.seen[end][who, column] = self.sorted[rows]
            self.unseen[end][who, column] = 0.0
        self.read = depth

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of every query and candidate."""
        n = len(self.x)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        known = up @ self.seen[0].T + down @ self.seen[1].T
        if self.read == n:
            return known, known
        top, bottom = self.sorted[n - self.read], self.sorted[self.read - 1]
        high = (up * top) @ self.unseen[0].T + (down * bottom) @ self.unseen[1].T
        low = (up * self.sorted[0]) @ self.unseen[0].T + (down * self.sorted[-1]) @ self.unseen[1].T
        return known + low, known + high


def best(x: np.ndarray, first: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the ``k`` best candidates of every query, ties to smaller ``first``."""
    n = len(x)
    k = min(k, n)
    lists = Lists(x)
    active = np.arange(len(q))
    # d products and as many sums, each rounded; the bounds add up four such terms
    largest = np.abs(lists.x).max(axis=0)
    slack = (np.abs(q) @ largest) * x.shape[1] * 2.0 ** -49
    exact, q = q, q.astype(np.float64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for share in DEPTHS:
        lists.to(max(1, min(n, int(np.ceil(share * n)))))
        left = []
        for a in range(0, len(active), AT_ONCE):
            who = active[a:a + AT_ONCE]
            low, high = lists.bounds(q[who])
            kth = np.partition(low, n - k, axis=1)[:, n - k]
            may = high + 2 * slack[who, None] >= kth[:, None]
            done = may.sum(1) <= FEW if lists.read < n else np.ones(len(who), bool)
            left.append(who[~done])
            row, cand = np.nonzero(may[done])
            who = who[done]
            score = np.einsum("ij,ij->i", exact[who[row]], lists.whole[cand])   # resolved
            if (np.abs(np.einsum("ij,ij->i", q[who[row]], lists.x[cand])) > 2.0 ** 63 - 2.0 ** 40).any():
                raise OverflowError("an inner product does not fit in 64 bits")
            order = np.lexsort((first[cand], -score, row))
            row, cand, score = row[order], cand[order], score[order]
            begin = np.searchsorted(row, np.arange(len(who)))
            keep = np.arange(len(row)) - begin[row] < k
            out.append((who[row[keep]], cand[keep], score[keep]))
        active = np.concatenate(left) if left else active[:0]
        if not len(active):
            break
    parts = [np.concatenate(p) for p in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return parts[0], parts[1], parts[2]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the rows that take part: v = floor(scale * x) of every component."""
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    valid = vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & (F.size(embedding) > 0)).filter(ok)
    return valid.select(F.col(vec_id).cast("long").alias("vec_id"),
                        F.transform(x, lambda c: F.floor(c * float(scale)).cast("long")).alias("v"))


def _parts(rows: DataFrame, most: int, name: str) -> DataFrame:
    """(size, name): into how many parts of about ``most`` rows the vectors of each length go."""
    most = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(CELLS) / F.col("size"))))
    return rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).select(
        "size", F.ceil(F.col("n") / most).cast("long").alias(name))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's best rows of another id.

    ``rows`` and ``queries``: (vec_id, v) as :func:`integers` gives them."""
    groups = cut(_groups(rows, k + 1))
    asked = cut(queries.distinct())
    parts = cut(_parts(groups, shard_rows, "shards").join(_parts(asked, block_rows, "blocks"), "size"))   # a row a length
    number = lambda of, *by: F.pmod(F.xxhash64(*by), F.col(of))
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    # every shard meets every block of the stated query set once
    left = join_lookup(groups.withColumn("size", F.size("v")), parts, "size").filter("blocks is not null")
    left = left.withColumn("shard", number("shards", "v")).withColumn("block", every("blocks")).drop("shards", "blocks")
    right = join_lookup(asked.withColumn("size", F.size("v")), parts.select("size", "shards", "blocks"), "size").filter("blocks is not null")
    right = right.withColumn("block", number("blocks", "vec_id", "v")).withColumn("shard", every("shards")).drop("shards", "blocks")
    right = right.select(*[F.col(c).alias(f"q_{c}") for c in right.columns])

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
        if not a.num_rows or not b.num_rows:
            return pa.table(empty)
        ids = a.column("ids").combine_chunks()
        starts, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        asked_id = b.column("q_vec_id").to_numpy()
        # one candidate more than asked for, as the query's own row takes no part
        query, cand, score = best(_matrix(a.column("v")), flat[starts[:-1]], _matrix(b.column("q_v")), k + 1)
        many = np.diff(starts)[cand]
        at = np.repeat(starts[:-1][cand] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        query, score, found = asked_id[np.repeat(query, many)], np.repeat(score, many), flat[at]
        keep = query != found
        return pa.table({"query_id": pa.array(query[keep]), "vec_id": pa.array(found[keep]),
                         "score": pa.array(score[keep].astype(np.int64))})

    found = left.groupBy("size", "shard", "block").cogroup(right.groupBy("q_size", "q_shard", "q_block")).applyInArrow(
        search, "query_id long, vec_id long, score long")
    w = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _groups(rows: DataFrame, n: int) -> DataFrame:
    """(v, ids): the distinct vectors with their ``n`` smallest ids, in order."""
    dealt = rows.distinct()
    # no list of all ids of a vector is ever built: a bounded list per salt, then of the salts
    w = W.partitionBy("v", "salt").orderBy("vec_id")
    few = (dealt.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("r", F.row_number().over(w))
           .filter(F.col("r") <= n))
    return few.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, n).alias("ids"))


def search(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The registered query: rows whose id ``every`` divides, against all rows."""
    rows = cut(integers(vectors))
    return top_k(rows, rows.filter(F.col("vec_id") % every == 0), k)
