"""Scoring and feature jobs over keyed result stores (L3 with S7, P10 with S8, L6 with S9).

A job gets models by name and rows with a dataset and a split, works only on the keys that its
store lacks, and reads the whole answer back with partition filters:

* The store is Parquet below one folder: ``predictions`` (one partition for each dataset, model and
  split) and ``metrics`` (a row for each).  A key counts as stored when it stands in ``metrics``, which is
  written last, so a job that died between the two scores the key again and overwrites its
  partition: running a job twice gives what running it once gives.
* Keys are taken out with ``left_anti`` before the rows reach a model; if no key of a model is
  missing, there is no job at all.
* Feature stores work alike; their key is (dataset, model, model_type, method).  Each batch of vectors is
  checked against the width that the model states.

Model factories are called once for each Python worker; batches travel as Arrow.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import argmax
from ..session import cut_lineage
from ..sources.stores import exists, upsert
from . import evaluate, separability

#: A model factory returns a function of a batch (rows x inputs) that gives rows x outputs.
Factory = Callable[[], Callable[[np.ndarray], np.ndarray]]

SCORE_KEYS = ("dataset", "model", "split")
FEATURE_KEYS = ("dataset", "model", "model_type", "method")
#: Keys of one job up to which they are broadcast: there is one for each dataset, model and split.
BROADCAST_KEYS = 100_000


def _checked(found: np.ndarray, rows: int, width: int | None) -> np.ndarray:
    found = np.asarray(found)
    if found.ndim != 2 or found.shape[0] != rows or (width is not None and found.shape[1] != width):
        raise ValueError(f"the model gave shape {found.shape} for {rows} rows"
                         + ("" if width is None else f" of width {width}"))
    return found


def _batches(rows: pd.Series, size: int) -> Iterator[tuple[slice, np.ndarray]]:
    for at in range(0, len(rows), size):
        part = slice(at, min(at + size, len(rows)))
        yield part, np.stack([np.asarray(v, np.float64) for v in rows.iloc[part]])


def timed_logits(factory: Factory, inputs: str | Column, classes: int | None = None, batch_size: int = 32) -> Column:
    """struct(logits array<double>, seconds): the model's outputs and its time for each row, that of
    its batch shared out evenly."""

    @F.pandas_udf("struct<logits:array<double>,seconds:double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = factory()
        for rows in parts:
            logits, seconds = [], np.zeros(len(rows))
            for part, batch in _batches(rows, batch_size):
                start = time.perf_counter()
                found = _checked(predict(batch), len(batch), classes)
                seconds[part] = (time.perf_counter() - start) / len(batch)
                logits.extend(found.astype(np.float64))
            yield pd.DataFrame({"logits": logits, "seconds": seconds})

    return run(F.col(inputs) if isinstance(inputs, str) else inputs)


def features(factory: Factory, inputs: str | Column, width: int, batch_size: int = 256) -> Column:
    """P10: one vector of ``width`` floats for each row."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        extract = factory()
        for rows in parts:
            found = [v for _, batch in _batches(rows, batch_size)
                     for v in _checked(extract(batch), len(batch), width).astype(np.float32)]
            yield pd.Series(found, dtype=object)

    return run(F.col(inputs) if isinstance(inputs, str) else inputs)


def _missing(spark: SparkSession, done: str, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The wanted keys that do not stand in the table of finished ones."""
    wanted = wanted.select(*keys).distinct()
    if exists(spark, done):
        wanted = wanted.join(spark.read.parquet(done).select(*keys), list(keys), "left_anti")
    return cut_lineage(wanted)


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _overwrite(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Only the partitions of ``rows`` are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def _stored(spark: SparkSession, path: str, keys: Mapping[str, str | None]) -> DataFrame:
    """A stored table; each given key prunes partitions.  Keys are strings, whatever they look like."""
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in keys else f
                           for f in spark.read.parquet(path).schema.fields])
    found = spark.read.schema(schema).parquet(path)
    for name, value in keys.items():
        if value is not None:
            found = found.filter(F.col(name) == value)
    return found


# ------------------------------------------------------------- predictions

def score_missing(data: DataFrame, models: Mapping[str, Factory], path: str, inputs: str = "features",
                  row_id: str = "id", label: str | None = "label", classes: int | None = None,
                  run: str = "", batch_size: int = 32) -> DataFrame:
    """Score what the store at ``path`` lacks of ``models`` over ``data`` (dataset, split, row id, inputs
    and, if there is one, label), and return the metrics of all wanted keys.

    ``run`` is kept with every key, so a later reader sees which run scored it."""
    spark = data.sparkSession
    names = F.array(*[F.lit(m) for m in models]) if models else F.array().cast("array<string>")
    wanted = data.select("dataset", "split").distinct().withColumn("model", F.explode(names)).select(*SCORE_KEYS)
    wanted = cut_lineage(wanted)
    missing = _missing(spark, f"{path}/metrics", wanted, SCORE_KEYS)
    todo = {r.model for r in missing.select("model").distinct().collect()}   # one row a model
    if todo:
        truth = F.col(label).cast("int") if label and label in data.columns else F.lit(None).cast("int")
        scored = None
        for name in sorted(todo):
            keys = missing.filter(F.col("model") == name).select("dataset", "split")
            rows = data.join(_small(keys), ["dataset", "split"], "left_semi")
            out = rows.select("dataset", F.lit(name).alias("model"), "split", F.col(row_id).alias("id"), truth.alias("y_true"),
                              timed_logits(models[name], inputs, classes, batch_size).alias("out"))
            scored = out if scored is None else scored.unionByName(out)
        scored = scored.select(*SCORE_KEYS, "id", "y_true", "out.logits", "out.seconds", F.lit(run).alias("run"))
        _overwrite(scored.withColumn("y_pred", argmax("logits").cast("int")), f"{path}/predictions", SCORE_KEYS)
        new = stored_predictions(spark, path).join(_small(missing), list(SCORE_KEYS), "left_semi")
        upsert(spark, f"{path}/metrics", _metrics(new).withColumn("run", F.lit(run)), SCORE_KEYS)
    if not exists(spark, f"{path}/metrics"):
        return spark.createDataFrame([], METRICS)
    return spark.read.parquet(f"{path}/metrics").join(_small(wanted), list(SCORE_KEYS), "left_semi").select(
        *[c.split()[0] for c in METRICS.split(", ")])


METRICS = ("dataset STRING, model STRING, split STRING, n BIGINT, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, "
           "f1 DOUBLE, total_time DOUBLE, time_per_sample_mean DOUBLE, time_per_sample_std DOUBLE, run STRING")


def _metrics(predictions: DataFrame) -> DataFrame:
    """A row for each key: rows, quality where there are labels, and time."""
    keys = list(SCORE_KEYS)
    times = predictions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("total_time"), F.avg("seconds").alias("time_per_sample_mean"),
        F.stddev_pop("seconds").alias("time_per_sample_std"))
    quality = evaluate.classification_metrics(predictions.filter("y_true is not null").select(*keys, "y_true", "y_pred"), by=keys)
    return times.join(quality.select(*keys, "accuracy", "precision", "recall", "f1"), keys, "left")


def stored_predictions(spark: SparkSession, path: str, dataset: str | None = None, model: str | None = None,
                       split: str | None = None) -> DataFrame:
    """Stored rows; the given keys become partition filters."""
    return _stored(spark, f"{path}/predictions", {"dataset": dataset, "model": model, "split": split})


# ------------------------------------------------------------- features

def extract_missing(data: DataFrame, dataset: str, model: str, model_type: str, method: str, factory: Factory,
                    width: int, path: str, inputs: str = "features", keep: Sequence[str] = ("id", "label"),
                    batch_size: int = 256) -> DataFrame:
    """The feature vectors of ``data`` under one key, extracted unless the store has them."""
    spark = data.sparkSession
    key = dict(zip(FEATURE_KEYS, (dataset, model, model_type, method), strict=True))
    done = f"{path}/finished"
    wanted = spark.createDataFrame([tuple(key.values())], ", ".join(f"{k} STRING" for k in FEATURE_KEYS))
    missing = _missing(spark, done, wanted, FEATURE_KEYS)
    if missing.count():
        rows = data.select(*[F.lit(v).alias(k) for k, v in key.items()], *keep,
                           features(factory, inputs, width, batch_size).alias("vector"))
        _overwrite(rows, f"{path}/features", FEATURE_KEYS)
        n = stored_features(spark, path, **key).agg(F.count(F.lit(1)).alias("n")).first().n   # one number
        upsert(spark, done, missing.withColumns({"n": F.lit(n), "width": F.lit(width)}), FEATURE_KEYS)
    return stored_features(spark, path, **key)


def stored_features(spark: SparkSession, path: str, dataset: str | None = None, model: str | None = None,
                    model_type: str | None = None, method: str | None = None) -> DataFrame:
    """Stored vectors; the given keys become partition filters."""
    return _stored(spark, f"{path}/features", dict(zip(FEATURE_KEYS, (dataset, model, model_type, method), strict=True)))


def separability_of_stored(spark: SparkSession, path: str, key: Mapping[str, str], label: str = "label",
                           n_starts: int = 10, seed: int = 42) -> DataFrame:
    """L6 over stored vectors: PCA, KMeans, ARI and AMI, written to the table of results."""
    stored = stored_features(spark, path, **key)
    found = separability.kmeans_separability(stored, "vector", label, n_starts, seed)
    found = found.select(*[F.lit(key[k]).alias(k) for k in FEATURE_KEYS], "k", F.col("ari").alias("adjusted_rand_index"),
                         F.col("ami").alias("adjusted_mutual_info"), "cost")
    return _stored(spark, _written(spark, f"{path}/separability", found), dict(key))


def _written(spark: SparkSession, path: str, found: DataFrame) -> str:
    upsert(spark, path, found, FEATURE_KEYS)
    return path


# ------------------------------------------------------------- model factories

def linear(matrix: np.ndarray, bias: np.ndarray | None = None) -> Factory:
    """rows x inputs -> rows x outputs by one matrix."""
    matrix = np.asarray(matrix, np.float64)

    def make() -> Callable[[np.ndarray], np.ndarray]:
        return lambda x: x @ matrix + (0.0 if bias is None else bias)
    return make
