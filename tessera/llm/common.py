"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: A word of the contracts: a run of anything but the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one step inside a task works on; only memory depends on it.
STEP_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Written once to the folder of ``spark.checkpoint.dir`` and read from there:
    survives lost executors, and later readers do not compute it again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of each action inside go when it ends, not when the driver happens to collect its garbage.

    For steps that ``cut`` what they keep; a frame that is computed twice inside shuffles twice."""
    return set_for(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def set_for(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the actions inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def whole(text: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly where the input has fewer partitions than the session has cores.

    Files are split by the reader; this only helps inputs of a few row groups, and
    moves nothing otherwise."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def steps(batches: Iterator[pa.RecordBatch], text: str,
          limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc_lengths(column) + 16)
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def joined_steps(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of half to one and a half times ``limit`` bytes of text, or one row, also where batches are smaller."""
    held, size = [], 0
    for batch in steps(batches, text, limit):
        held.append(batch)
        size += int(pc_lengths(batch.column(batch.schema.get_field_index(text))).sum()) + 16 * batch.num_rows
        if size >= limit // 2:
            yield pa.concat_batches(held) if len(held) > 1 else batch
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def give_back() -> None:
    """Hands memory that this process has freed, and its allocators keep for later, back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):   # other C libraries than glibc lack it
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, of a group's tables or of a task's batches, followed by :func:`give_back`.

    Spark keeps idle Python workers for later tasks, more than there are cores where a stage has two Python
    functions in a row, so what each has kept counts at once with what the others use."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    def of_group(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    def of_groups(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            give_back()

    if inspect.isgeneratorfunction(run):
        return of_task
    return of_group if len(inspect.signature(run).parameters) == 1 else of_groups   # Spark looks at the number


def pc_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text in them); null is empty."""
    import pyarrow.compute as pc
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every (start, length), one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow strings or binaries over flat bytes."""
    large = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    off = offsets.astype(np.int64 if large else np.int32)
    return pa.Array.from_buffers(kind, len(off) - 1,
                                 [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])


#: Rows of a lookup table up to which it is sent to every executor; beyond it both sides are dealt out.
LOOKUP_ROWS = 100_000
#: Parts that the rows of one key are dealt to in that case.
SALTS = 32


def join_lookup(big: DataFrame, lookup: DataFrame, key: str, rows: int = LOOKUP_ROWS) -> DataFrame:
    """``big`` with the columns of ``lookup`` (one row per key), left join.

    The lookup's size is counted: up to ``rows`` it is broadcast, and beyond that the rows of
    a key are salted, so a key with a third of all rows is not one task."""
    if lookup.count() <= rows:
        return big.join(F.broadcast(lookup), key, "left")
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (big.withColumn("_salt", F.floor(F.rand(SALTS) * SALTS).cast("int"))
            .join(salted, [key, "_salt"], "left").drop("_salt"))


BLANKS = "\x20\t\n\x0b\f\r"


def word_list(text: Column) -> Column:
    """The words of a text that is not null."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def hide(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses inside, and the new name of each column."""
    names = {c: f"d_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restore(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(hidden).alias(c) for c, hidden in names.items()])
