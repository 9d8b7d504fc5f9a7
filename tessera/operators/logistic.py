"""Multinomial logistic regression for many settings at once (L2).

The loss, its gradient and every step are those of Spark ML's ``LogisticRegression`` with
``family="multinomial"``, an intercept, standardised and centred features, L1 and L2 penalties: breeze's OWL-QN
with ten pairs of memory and its backtracking line search, from the same start and with the same tests for
the end.  What differs is the traffic: there each setting reads the data by itself, once for each step, and every
part of the data gives a dense vector as wide as the features.  Here each setting is a coroutine that asks
for the loss at a point, and one scan answers some :data:`WIDTH` vectors together.

Rows are word counts packed to blocks of some :data:`BLOCK` counts: the block's distinct features, and for each
count its place among these.  IDF and standard deviations are factors of a feature, so they go into the
coefficients and not into the rows.  A scan multiplies the blocks by the coefficients and adds up the
gradient per task; tasks are added up by slices of features in the executors, so the driver gets
one vector for each vector it sent.  With two classes the coefficients of one are those of the other with
the other sign, at every step, and one vector stands for both.
"""

from __future__ import annotations

import tempfile
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Vectors of coefficients that scans hold at once, and for which the driver keeps the last steps.
WIDTH = 6
#: Counts of a packed block, and blocks for which a scan gets another task: each task moves vectors as wide as the features.
BLOCK, TASK = 1 << 17, 8
#: Features of a slice of the gradient.
SLICE = 1 << 14
#: Steps that OWL-QN remembers, and when it ends (Spark's ``tol``).
MEMORY, TOL = 10, 1e-6

BLOCKS = "features binary, place binary, counts binary, sizes binary, labels binary, weights binary"


# ------------------------------------------------------------ packed rows

def _smallest(x: np.ndarray) -> bytes:
    """Whole numbers, in the smallest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0)))).tobytes()


def _widened(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{max(1, memoryview(data).nbytes // max(1, n))}")


def pack(df: DataFrame, counts: str, label: str, weight: str | None = None, tasks: int | None = None) -> DataFrame:
    """Blocks of the rows of ``df`` (columns: a sparse vector of counts, a whole-numbered label or
    null, a weight), written once and dealt evenly to ``tasks``, or the session's cores."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0)
            index, value = vectors.field("indices"), vectors.field("values")
            ends = np.asarray(index.offsets, np.int64)
            flat, number = np.asarray(index.values), np.asarray(value.values)
            labels = np.asarray(batch.column(1).cast(pa.float64()).fill_null(np.nan), np.float64)
            weights = np.asarray(batch.column(2), np.float64)
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, side="right")) - 1)
                part = slice(ends[at], ends[to])
                features, place = np.unique(flat[part], return_inverse=True)
                row = (features.astype(np.uint32).tobytes(), _smallest(place), _smallest(number[part]),
                       np.diff(ends[at:to + 1]).astype(np.uint32).tobytes(), labels[at:to].tobytes(), weights[at:to].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], names=[c.split()[0] for c in BLOCKS.split(", ")])
                at = to

    rows = df.select(F.col(counts).alias("c"), F.col(label).cast("double").alias("y"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    return cut_lineage(rows.mapInArrow(blocks, BLOCKS).repartition(tasks or df.sparkSession.sparkContext.defaultParallelism))


class _Block:
    """A block as arrays; ``times`` and ``gathered`` are its products with vectors over its features."""

    def __init__(self, row: Sequence[bytes]):
        features, place, counts, sizes, labels, weights = row
        self.features = np.frombuffer(features, np.uint32)
        self.sizes = np.frombuffer(sizes, np.uint32).astype(np.intp)
        n = int(self.sizes.sum())
        self.place = _widened(place, n).astype(np.intp)
        self.counts = _widened(counts, n).astype(np.float64)
        self.labels, self.weights = np.frombuffer(labels, np.float64), np.frombuffer(weights, np.float64)
        self.filled = np.flatnonzero(self.sizes)   # reduceat has no empty sums
        self.starts = (np.cumsum(self.sizes) - self.sizes)[self.filled]

    def times(self, vectors: np.ndarray) -> np.ndarray:
        """vectors x rows, of vectors over all features."""
        out = np.zeros((len(vectors), len(self.sizes)))
        if len(self.filled):
            for o, v in zip(out, vectors, strict=True):
                found = v[self.features][self.place]
                found *= self.counts
                o[self.filled] = np.add.reduceat(found, self.starts)
        return out

    def add(self, rows: np.ndarray, to: np.ndarray) -> None:
        """Adds each row's counts, times its number in ``rows``, to vectors over all features."""
        for r, t in zip(rows, to, strict=True):
            each = np.repeat(r, self.sizes)
            each *= self.counts
            t[self.features] += np.bincount(self.place, each, minlength=len(self.features))


def _margins(block: _Block, vectors: np.ndarray, offsets: np.ndarray, classes: int) -> np.ndarray:
    """settings x classes x rows."""
    found = block.times(vectors).reshape(*offsets.shape, len(block.sizes)) + offsets[:, :, None]
    return np.concatenate([-found, found], axis=1) if classes == 2 else found


# ------------------------------------------------------------ one scan

def _pass(blocks: RDD, vectors: np.ndarray, offsets: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(losses per setting, sums over rows per setting and kept class, gradients per vector), weighted sums:
    one scan of the data."""
    kept, width = offsets.shape[1], vectors.shape[1]
    sent = blocks.context.broadcast((vectors, offsets))

    def add_up(rows: Iterator[Sequence[bytes]]) -> Iterator[tuple[int, np.ndarray]]:
        vectors, offsets = sent.value
        sums, gradient = np.zeros((len(offsets), 1 + kept)), None
        for block in map(_Block, rows):
            gradient = np.zeros_like(vectors) if gradient is None else gradient
            m = _margins(block, vectors, offsets, classes)
            truth = block.labels.astype(np.intp)
            at = np.arange(len(truth))
            m -= m.max(axis=1, keepdims=True)
            own = m[:, truth, at]
            np.exp(m, out=m)
            total = m.sum(axis=1)
            sums[:, 0] += (np.log(total) - own) @ block.weights
            m /= total[:, None]
            m[:, truth, at] -= 1.0
            m *= block.weights
            m = m[:, classes - kept:]
            sums[:, 1:] += m.sum(axis=2)
            block.add(m.reshape(-1, len(truth)), gradient)
        if gradient is not None:
            yield -1, sums
            for at in range(0, width, SLICE):
                yield at // SLICE, gradient[:, at:at + SLICE]

    slices = -(-width // SLICE)
    try:
        found = dict(blocks.mapPartitions(add_up).reduceByKey(np.add, min(blocks.getNumPartitions(), slices)).collect())   # one vector for each sent
    finally:
        sent.destroy()
    sums = found.pop(-1)
    return sums[:, 0], sums[:, 1:], np.concatenate([found[i] for i in range(slices)], axis=1)


# ------------------------------------------------------------ OWL-QN

class _Failed(Exception):
    """A search without a step, or steps without a curvature."""


class _Pairs:
    """The last steps and changes of the gradient, the newest first, in a file of the driver: in memory they
    would be most of what a setting takes.  ``kept`` has (place, step by change, change by change)."""

    def __init__(self, like: np.ndarray):
        self.file, self.kept, self.size = tempfile.TemporaryFile(buffering=0), [], like.nbytes

    def put(self, step: np.ndarray, change: np.ndarray, dot) -> None:
        used = {at for at, *_ in self.kept[:MEMORY - 1]}
        at = next(i for i in range(MEMORY) if i not in used)
        self.file.seek(2 * at * self.size)
        for x in (step, change):
            left = memoryview(np.ascontiguousarray(x)).cast("B")
            while left:
                left = left[self.file.write(left):]
        self.kept = [(at, np.float64(dot(step, change)), np.float64(dot(change, change))), *self.kept][:MEMORY]

    def _read(self, place: int, to: np.ndarray) -> np.ndarray:
        self.file.seek(place * self.size)
        left = memoryview(to).cast("B")
        while left:
            left = left[self.file.readinto(left):]
        return to

    def step(self, at: int, to: np.ndarray) -> np.ndarray:
        return self._read(2 * at, to)

    def change(self, at: int, to: np.ndarray) -> np.ndarray:
        return self._read(2 * at + 1, to)


def _owlqn(x: np.ndarray, l1: float, max_iter: int, twin: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Breeze's OWL-QN as a coroutine: it asks for loss and gradient at a point, and returns the last point.

    The last column (intercepts) has no penalty.  ``twin`` is the number of classes for which a vector stands."""
    def dot(a, b):
        return twin * float(np.vdot(a, b))

    def adjusted(x, value, grad):
        c, g = x[:, :-1], grad.copy()
        value += twin * l1 * float(np.abs(c).sum())
        g[:, :-1] = np.where(c != 0, grad[:, :-1] + np.sign(c) * l1, np.sign(grad[:, :-1]) * np.maximum(np.abs(grad[:, :-1]) - l1, 0.0))
        return value, g

    def direction(grad):
        d, part, a = grad.copy(), np.empty_like(grad), []
        if pairs.kept and not pairs.kept[0][1] >= 0:
            raise _Failed
        for at, sy, _ in pairs.kept:
            a.append(dot(pairs.step(at, part), d) / sy)
            if np.isnan(a[-1]):
                raise _Failed
            d -= np.multiply(a[-1], pairs.change(at, part), out=part)
        if pairs.kept:
            d *= pairs.kept[0][1] / pairs.kept[0][2]
        for (at, sy, _), ai in zip(pairs.kept[::-1], a[::-1], strict=True):
            b = ai - dot(pairs.change(at, part), d) / sy
            d += np.multiply(b, pairs.step(at, part), out=part)
        d *= -1.0
        return np.where(d * grad < 0, d, 0.0)

    def step(x, orthant, d, alpha):
        new = x + alpha * d
        new *= np.sign(new) == orthant
        return new

    value, grad = yield x
    adj, adj_grad = adjusted(x, value, grad)
    pairs = _Pairs(x)
    first, values, done, failed = adj, [np.inf], 0, False
    while not (done >= max_iter or (len(values) > 1 and abs(adj - max(values)) <= TOL * abs(first))
               or np.sqrt(dot(adj_grad, adj_grad)) <= max(TOL * abs(adj), 1e-8)):
        try:
            with np.errstate(all="ignore"):
                d = direction(adj_grad)
                alpha = float(0.5 / np.sqrt(np.float64(dot(grad, grad)))) if done < 1 else 1.0
            shrink = 0.1 if done < 1 else 0.5
            orthant = np.where(x != 0, np.sign(x), -np.sign(adj_grad))
            slope, tried, seen = dot(adj_grad, d), 0, None
            f = value    # breeze starts its search with the loss without penalty at the old point
            while True:
                if seen != alpha:
                    new = step(x, orthant, d, alpha)
                    at = yield new
                    here, here_grad = adjusted(new, *at)
                    seen, bend = alpha, dot(here_grad, d)
                    f = here if tried else f
                if tried >= 20:
                    alpha = before
                    break
                if f > adj + alpha * slope * 1e-4:
                    factor = shrink
                elif bend < 0.9 * slope:
                    factor = 2.1
                elif bend > -0.9 * slope:
                    factor = shrink
                else:
                    break
                before, alpha, tried = alpha, alpha * factor, tried + 1
                if alpha < 1e-10 or alpha > 1e10:
                    raise _Failed
            if seen != alpha:
                new = step(x, orthant, d, alpha)
                at = yield new
                here, here_grad = adjusted(new, *at)
        except _Failed:
            if failed:
                break
            failed, pairs.kept = True, []
            continue
        failed = False
        pairs.put(new - x, at[1] - grad, dot)
        x, (value, grad), adj, adj_grad, done = new, at, here, here_grad, done + 1
        values = [*values, value][-20:]
    return x


# ------------------------------------------------------------ fits and predictions

@dataclass
class Fitted:
    """Coefficients for counts, and intercepts: of class 1 where there are two, else of every class;
    ``always`` is the only class where the labels have one only."""

    vectors: np.ndarray
    offsets: np.ndarray
    classes: int
    always: int | None = None


class Task:
    """Rows to fit on: ``train`` holds ``counts``, ``label`` and ``weight``, and ``scaled`` the same rows
    with ``features``, which are the counts times ``factors``."""

    def __init__(self, train: DataFrame, counts: str, factors: np.ndarray, label: str, weight: str | None, scaled: DataFrame):
        each = F.col(weight) if weight else F.lit(1.0)
        of_label = train.groupBy(label).agg(F.sum(each).alias("w")).collect()   # one row for each class
        if any(r[0] is None or r[0] < 0 or r[0] != int(r[0]) for r in of_label):
            raise ValueError(f"labels must be whole numbers from 0: {sorted(str(r[0]) for r in of_label)}")
        share = np.zeros(int(max(r[0] for r in of_label)) + 1)
        for r in of_label:
            share[int(r[0])] = r.w
        self.classes, self.total, self.share = len(share), share.sum(), share
        self.kept = 1 if self.classes == 2 else self.classes   # vectors of a setting
        about = scaled.select(Summarizer.metrics("mean", "std", "numNonZeros").summary(F.col("features"), each).alias("s")).first().s
        std = about["std"].toArray()
        inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
        self.mean, self.scale = about["mean"].toArray() * inverse, factors * inverse
        tasks = min(train.sparkSession.sparkContext.defaultParallelism, 1 + int(about["numNonZeros"].toArray().sum()) // (TASK * BLOCK))
        # Pickled once: as rows of a frame each scan would pickle them again, which takes longer than the scan.
        self.blocks = pack(train, counts, label, weight, tasks).rdd.map(tuple)
        self.blocks.checkpoint()
        self.blocks.count()

    def fit(self, settings: Sequence[dict], width: int = WIDTH) -> Iterator[tuple[dict, Fitted]]:
        """(setting, model) for each of ``settings`` (regParam, elasticNetParam, maxIter), as they end; a
        scan holds ``width`` vectors, or those of one setting."""
        if np.count_nonzero(self.share) == 1:
            only = int(np.flatnonzero(self.share)[0])
            yield from ((s, Fitted(np.zeros((self.kept, len(self.scale))), np.zeros(self.kept), self.classes, only)) for s in settings)
            return
        if any(s["regParam"] * s["elasticNetParam"] <= 0 for s in settings):
            raise ValueError("OWL-QN is for settings with an L1 penalty")
        start = np.zeros((self.kept, len(self.scale) + 1))
        start[:, -1] = (np.log1p(self.share) - np.log1p(self.share).mean())[self.classes - self.kept:]
        waiting = list(settings)[::-1]
        running: list[tuple[dict, Generator, np.ndarray]] = []
        while waiting or running:
            while waiting and (not running or (len(running) + 1) * self.kept <= width):
                s = waiting.pop()
                search = _owlqn(start.copy(), s["regParam"] * s["elasticNetParam"], s["maxIter"], self.classes / self.kept)
                running.append((s, search, next(search)))
            asked = self._answers([(s, x) for s, _, x in running])
            still = []
            for (s, search, _), answer in zip(running, asked, strict=True):
                try:
                    still.append((s, search, search.send(answer)))
                except StopIteration as end:
                    x = end.value
                    yield s, Fitted(x[:, :-1] * self.scale, x[:, -1] - x[:, :-1] @ self.mean, self.classes)
            running = still

    def _answers(self, points: Sequence[tuple[dict, np.ndarray]]) -> Iterator[tuple[float, np.ndarray]]:
        """(loss, gradient) for each (setting, point), with the L2 penalty."""
        vectors = np.concatenate([x[:, :-1] for _, x in points])
        vectors *= self.scale
        losses, sums, gradients = _pass(self.blocks, vectors, np.stack([x[:, -1] - x[:, :-1] @ self.mean for _, x in points]), self.classes)
        del vectors
        for (s, x), loss, total, g in zip(points, losses, sums, gradients.reshape(len(points), self.kept, -1), strict=True):
            l2 = s["regParam"] * (1.0 - s["elasticNetParam"])
            grad = np.empty_like(x)
            grad[:, :-1] = (g * self.scale - np.outer(total, self.mean)) / self.total + l2 * x[:, :-1]
            grad[:, -1] = total / self.total
            squares = self.classes / self.kept * float(np.vdot(x[:, :-1], x[:, :-1]))
            yield float(loss / self.total + 0.5 * l2 * squares), grad


def predicted(blocks: DataFrame, models: Sequence[tuple[dict, Fitted]], name: str) -> DataFrame:
    """Rows (name, y_true, y_pred) of packed rows for each (setting, model), whose number is the setting's ``name``; the smallest class of those that tie."""
    sent = blocks.sparkSession.sparkContext.broadcast([(s[name], m.vectors, m.offsets, m.classes, m.always) for s, m in models])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                block = _Block([x.as_buffer() for x in row])
                truth = pa.array(np.nan_to_num(block.labels).astype(np.int32), mask=np.isnan(block.labels))
                for i, vectors, offsets, classes, always in sent.value:
                    n = len(block.sizes)
                    best = _margins(block, vectors, offsets[None], classes)[0].argmax(axis=0) if always is None else np.full(n, always)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, i, np.int32)), truth, pa.array(best.astype(np.int32))], names=[name, "y_true", "y_pred"])

    return blocks.mapInArrow(judged, f"{name} int, y_true int, y_pred int")
