"""Incremental merge of training-log records (S10 on a stream).

Records (keys, field, step, value) arrive in any order and any number of files.  The state of a key is the last
value of each field by step; a key's row is handed on when all fields are there, and again whenever a later
record changes it.  The sink replaces rows by key, so after any order of arrival the store equals
:func:`tessera.sources.stores.merge_log_records` over all records:

* a late record (a smaller step than the one kept) changes nothing;
* a repeated record changes nothing, so a batch that is run again after a failure does no harm;
* of equal steps the larger value counts; a record without a step or a value says nothing;
* the state of a key that gets no record for ``expire_after`` milliseconds is dropped (never by default); what it
  handed on stays in the store, and later records of the key start anew.

Without expiry the state is that of built-in aggregates.  With it a key's records pass through a Python
function piece by piece, so no key needs to fit in memory; that costs a call for each key.  The two keep
their state in different forms, so a checkpoint goes on with the one it began with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import cut_lineage
from ..sources.stores import upsert


def merged_stream(records: DataFrame, keys: Sequence[str], fields: Sequence[str], field_col: str = "field",
                  value_col: str = "value", step_col: str = "step", expire_after: int | None = None) -> DataFrame:
    """A row (keys, step, fields) for each key whose complete row is new or changed, in update mode; without
    ``expire_after`` also for a complete key whose records change nothing."""
    keys, fields = list(keys), list(fields)
    if expire_after is None:
        step, value = F.col(step_col).cast("long"), F.col(value_col).cast("double")
        said = records.filter(step.isNotNull() & value.isNotNull() & ~F.isnan(value))
        last = [F.max(F.when(F.col(field_col) == f, F.struct(step.alias("step"), value.alias("value")))).alias(f"__{i}")
                for i, f in enumerate(fields)]
        held = said.groupBy(*keys).agg(F.max(step).alias("__step"), *last)
        for i in range(len(fields)):
            held = held.filter(F.col(f"__{i}").isNotNull())
        return held.select(*keys, F.col("__step").alias(step_col), *[F.col(f"__{i}.value").alias(f) for i, f in enumerate(fields)])
    kinds = dict(records.dtypes)
    row = ", ".join([f"{k} {kinds[k]}" for k in keys] + [f"{step_col} long"] + [f"{f} double" for f in fields])
    held = ", ".join(["latest long"] + [f"s{i} long, v{i} double" for i in range(len(fields))])
    place = {f: i for i, f in enumerate(fields)}

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old = list(state.get) if state.exists else [None] * (1 + 2 * len(fields))
        new = list(old)
        for part in parts:
            for field, step, value in zip(part[field_col], part[step_col], part[value_col], strict=True):
                if step is None or value is None or pd.isna(step) or (isinstance(value, float) and math.isnan(value)):
                    continue
                step, value = int(step), float(value)
                new[0] = step if new[0] is None else max(new[0], step)
                i = place.get(field)
                if i is not None and (new[1 + 2 * i] is None or (step, value) > (new[1 + 2 * i], new[2 + 2 * i])):
                    new[1 + 2 * i], new[2 + 2 * i] = step, value
        if new != old:
            state.update(tuple(new))
        if expire_after is not None:
            state.setTimeoutDuration(expire_after)
        values = new[2::2]
        if new != old and all(v is not None for v in values):
            yield pd.DataFrame([[*key, new[0], *values]], columns=[*keys, step_col, *fields])

    timeout = GroupStateTimeout.NoTimeout if expire_after is None else GroupStateTimeout.ProcessingTimeTimeout
    return records.select(*keys, field_col, step_col, value_col).groupBy(*keys).applyInPandasWithState(
        update, row, held, "update", timeout)


def run_log_stream(spark: SparkSession, src_dir: str, schema: str, store: str, checkpoint: str, keys: Sequence[str],
                   fields: Sequence[str], fmt: str = "parquet", max_files_per_trigger: int | None = None,
                   expire_after: int | None = None) -> StreamingQuery:
    """Merge the new files of ``src_dir`` into the Parquet store, a row for each key, and stop
    (``availableNow``).  ``checkpoint`` is a folder that the caller keeps on shared storage."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    merged = merged_stream(reader.load(src_dir), keys, fields, expire_after=expire_after)

    def into_store(rows: DataFrame, _: int) -> None:
        rows = cut_lineage(rows)   # worked out once, read three times
        if not rows.isEmpty():
            upsert(rows.sparkSession, store, rows, list(keys))

    # batches without data would follow each other without an end where states can time out;
    # without them a state expires in the next batch that has data
    flag = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(flag)
    try:
        spark.conf.set(flag, str(expire_after is None).lower())
        return (merged.writeStream.outputMode("update").foreachBatch(into_store)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())   # takes the settings along
    finally:
        spark.conf.set(flag, before)
