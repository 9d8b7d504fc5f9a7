"""Look-ups in a table of one row for each key, whatever the sizes and the skew: of a key in each row
(:func:`lookup_join`) and of all keys of an array (:func:`values_of`)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Rows of a table up to which it is broadcast.
BROADCAST_ROWS = 1_000_000
#: A key with more than this share of the rows (fewer keys than its inverse have it) is hot.
HOT_SHARE = 1000
#: Bytes of rows, their keys included, that ask together and that are worked on at once.
CHUNK_BYTES, PIECE_BYTES = 64 << 20, 8 << 20
#: Keys in one row of what a chunk asks.
ASKED = 1 << 16


def lookup_join(big: DataFrame, table: DataFrame, key: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``big`` with the columns of ``table``, null where its key is not there.

    The table is counted: up to ``limit`` rows it is broadcast.  Beyond that both are dealt by key, but for hot
    keys: their rows of the table, fewer than ``HOT_SHARE``, are broadcast to their rows of ``big``."""
    if table.count() <= limit:
        return big.join(F.broadcast(table), key, "left")
    big = cut_lineage(big)
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    rows = big.count()
    hot = cut_lineage(counts.filter(F.col("__n") > rows // HOT_SHARE + 1).join(table, key, "left").drop("__n").withColumn("__hot", F.lit(True)))
    values = [c for c in table.columns if c != key]
    marked = big.join(F.broadcast(hot.select(key, "__hot")), key, "left")
    frequent = marked.filter("__hot").drop("__hot").join(F.broadcast(hot.drop("__hot")), key, "left")
    others = marked.filter("__hot is null").drop("__hot").join(table, key, "left")
    return frequent.unionByName(others.select(key, *[c for c in big.columns if c != key], *values))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, batch.num_rows * PIECE_BYTES // max(batch.nbytes, PIECE_BYTES))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _chunk(number: int, held: list[pa.RecordBatch]) -> Iterator[dict]:
    """The distinct keys of the rows ``held``, and the rows, compressed, with places among these keys."""
    flat = [piece.column("__keys").flatten() for piece in held]
    asked = pc.unique(pa.chunked_array(flat)).drop_null()
    sink = pa.BufferOutputStream()
    at = held[0].schema.get_field_index("__keys")
    schema = held[0].schema.set(at, pa.field("__keys", pa.list_(pa.int32())))
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for piece, keys in zip(held, flat, strict=True):
            ends = np.cumsum(pc.list_value_length(piece.column("__keys")).to_numpy())
            places = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pc.index_in(keys, value_set=asked))
            out.write_batch(pa.RecordBatch.from_arrays([places if i == at else c for i, c in enumerate(piece.columns)], schema=schema))
    yield {"chunk": number, "start": len(asked), "asked": None, "packed": sink.getvalue().to_pybytes()}
    for start in range(0, len(asked), ASKED):
        yield {"chunk": number, "start": start, "asked": asked.slice(start, ASKED), "packed": None}


def values_of(docs: DataFrame, keys: Column, table: DataFrame, out: str, limit: int = BROADCAST_ROWS,
              keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (of its columns those of ``keep``, or all) with the array ``out``: for each key of the array ``keys``
    its value in ``table`` (key, value), null for a null key or one that the table lacks; a null array is an empty one.

    The rows of a task are packed to chunks of about ``CHUNK_BYTES``, written once.  A chunk asks for each of
    its distinct keys once, so that no key is hot, and what is dealt are the asked keys, their values and
    the packed rows.  The table is counted: up to ``limit`` rows it is broadcast."""
    key, value = table.schema["key"].dataType, table.schema["value"].dataType
    rest = [f for f in docs.schema.fields if f.name != out and (keep is None or f.name in keep)]
    kept = [f.name for f in rest]
    schema = T.StructType([*rest, T.StructField(out, T.ArrayType(value))])
    rows = docs.select(*kept, F.coalesce(keys, F.array()).cast(T.ArrayType(key)).alias("__keys"))
    packed_schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("start", T.LongType()),
                                  T.StructField("asked", T.ArrayType(key)), T.StructField("packed", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def handed() -> Iterator[pa.RecordBatch]:
            kind = held[0].column("__keys").type.value_type
            for row in _chunk(number, held):
                asked = pa.ListArray.from_arrays([0, len(row["asked"])], row["asked"]) if row["packed"] is None else pa.nulls(1, pa.list_(kind))
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]], pa.int64()), pa.array([row["start"]], pa.int64()), asked,
                                                  pa.array([row["packed"]], pa.binary())], names=packed_schema.names)

        for batch in batches:
            for piece in _pieces(batch):
                held.append(piece)
                size += batch.nbytes * piece.num_rows // batch.num_rows
                if size >= CHUNK_BYTES:
                    yield from handed()
                    number, held, size = number + 1, [], 0
        if held:
            yield from handed()

    dealt = cut_lineage(rows.mapInArrow(pack, packed_schema))
    asked = dealt.filter("packed is null").select(F.col("chunk").alias("of"), "start", F.posexplode("asked").alias("at", "key"))
    known = F.broadcast(table) if table.count() <= limit else table
    found = asked.join(known, "key").select("of", (F.col("start") + F.col("at")).alias("at"), "value")

    def fill(packed: pa.Table, found: pa.Table) -> pa.Table:
        values, done = found.column("value").combine_chunks(), []
        for blob, size in zip(packed.column("packed"), packed.column("start").to_pylist(), strict=True):
            where = np.full(size, -1, np.int64)
            where[found.column("at").to_numpy()] = np.arange(len(found))
            where = pa.array(where, mask=where < 0)
            with pa.ipc.open_stream(blob.as_buffer()) as stream:
                for piece in stream:
                    places = piece.column("__keys")
                    filled = pa.ListArray.from_arrays(places.offsets, values.take(where.take(places.values)))
                    done.append(pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), filled], names=schema.names))
        return pa.Table.from_batches(done)

    packed = dealt.filter("packed is not null").select("chunk", "start", "packed")
    return packed.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(fill, schema)
