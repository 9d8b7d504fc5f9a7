"""The incremental log merge against the batch one, whatever the order of the files."""

import random

import pytest

from tessera.sources.stores import merge_log_records
from tessera.streaming.log_stream import merged_stream, run_log_stream

SCHEMA = "model string, epoch int, step long, field string, value double"
FIELDS = ["loss", "f1"]


def records(seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.randint(1, 3), rng.randint(1, 30), rng.choice(["loss", "f1", "other"]), rng.choice([0.5, 1.5, 2.5]))
            for _ in range(50)]
    return [*rows, ("c", 1, 5, "loss", 1.0), ("d", 1, None, "loss", 1.0), ("d", 1, 3, "f1", None), (None, None, 1, "loss", 1.0),
            (None, None, 2, "f1", 0.25), *rows[:5]]


@pytest.mark.parametrize("seed", [1, 2])
def test_files_in_any_order_equal_the_batch(spark, tmp_path, seed):
    rows = records(seed)
    src, store = str(tmp_path / "in"), str(tmp_path / "store")
    wanted = sorted(map(tuple, merge_log_records(spark.createDataFrame(rows, SCHEMA), ["model", "epoch"], FIELDS).collect()), key=str)
    random.Random(seed).shuffle(rows)
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):   # the second run resumes
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(src)
        run_log_stream(spark, src, SCHEMA, store, str(tmp_path / "ck"), ["model", "epoch"], FIELDS,
                       max_files_per_trigger=2).awaitTermination(60)
    got = spark.read.parquet(store).select("model", "epoch", "step", *FIELDS)
    assert sorted(map(tuple, got.collect()), key=str) == wanted and len(wanted) >= 6
    # the same records again change nothing
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)
    run_log_stream(spark, src, SCHEMA, store, str(tmp_path / "ck"), ["model", "epoch"], FIELDS).awaitTermination(60)
    assert sorted(map(tuple, spark.read.parquet(store).select("model", "epoch", "step", *FIELDS).collect()), key=str) == wanted


def test_state_expires(spark, tmp_path):
    src, store, ck = (str(tmp_path / x) for x in ("in", "store", "ck"))

    def run(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)
        run_log_stream(spark, src, SCHEMA, store, ck, ["model", "epoch"], FIELDS, expire_after=1).awaitTermination(60)
    run([("a", 1, 1, "loss", 0.5)])
    run([("b", 1, 1, "loss", 0.5), ("b", 1, 2, "f1", 0.5)])   # the state of a is gone by then
    run([("a", 1, 2, "f1", 0.75)])
    assert [r.model for r in spark.read.parquet(store).collect()] == ["b"]


def test_no_python_for_each_key_and_null_keys_are_replaced(spark, tmp_path):
    src, store, ck = (str(tmp_path / x) for x in ("in", "store", "ck"))
    for rows in ([(None, 1, 1, "loss", 0.5), (None, 1, 2, "f1", 0.5)], [(None, 1, 3, "f1", 0.75)], [(None, 1, 3, "f1", 0.75)]):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)
        run_log_stream(spark, src, SCHEMA, store, ck, ["model", "epoch"], FIELDS).awaitTermination(60)
    assert list(map(tuple, spark.read.parquet(store).select("model", "epoch", "step", *FIELDS).collect())) == [(None, 1, 3, 0.5, 0.75)]
    merged = merged_stream(spark.readStream.schema(SCHEMA).parquet(src), ["model", "epoch"], FIELDS)
    assert "PandasWithState" not in merged._jdf.queryExecution().analyzed().toString()
