"""Report tables (R1-R12), early stopping (W4/W5), compression trends (M6-M8).

Report inputs are per-model aggregates (one row per model), produced by
the distributed aggregations in :mod:`evaluate`; the windows here are over
those small tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, terms


# ------------------------------------------------------------- W4 / W5

def early_stopping(log: DataFrame, metric: str = "acc", by: Sequence[str] = ("model",),
                   order: str = "epoch", patience: int = 3, start_best: float = 0.0
                   ) -> DataFrame:
    """Best-so-far with patience over a training log.

    An epoch improves iff metric > best so far (best starts at
    ``start_best``); otherwise a counter grows and training stops after the
    epoch where it reaches ``patience`` (later epochs are not run).
    Returns per group: epochs_run, stop_epoch (null if never), best_epoch,
    best_metric.  Windows are partitioned by the group key over an already
    aggregated log (one row per epoch).
    """
    by = list(by)
    w_before = (Window.partitionBy(*by).orderBy(order)
                .rowsBetween(Window.unboundedPreceding, -1))
    w_upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    t = log.withColumn("__best_before", F.coalesce(F.max(metric).over(w_before),
                                                   F.lit(float(start_best))))
    t = t.withColumn("__imp", F.col(metric) > F.greatest(F.col("__best_before"),
                                                        F.lit(float(start_best))))
    t = t.withColumn("__grp", F.sum(F.col("__imp").cast("int")).over(w_upto))
    w_grp = Window.partitionBy(*by, "__grp").orderBy(order)
    # epochs since the last improvement (the improving epoch itself is 0)
    t = t.withColumn("__counter", F.row_number().over(w_grp)
                     - F.when(F.col("__grp") > 0, 1).otherwise(0))
    stop = (t.filter(F.col("__counter") >= patience).groupBy(*by)
            .agg(F.min(order).alias("stop_epoch")))
    t = t.join(stop, by, "left")
    run = t.filter(F.col("stop_epoch").isNull() | (F.col(order) <= F.col("stop_epoch")))
    return run.groupBy(*by).agg(
        F.count("*").alias("epochs_run"),
        F.first("stop_epoch").alias("stop_epoch"),
        F.max(F.when(F.col("__imp"), F.col(order))).alias("best_epoch"),
        F.max(F.when(F.col("__imp"), F.col(metric))).alias("best_metric"))


# ------------------------------------------------------------- model table

def model_table(metrics: DataFrame, latency: DataFrame) -> DataFrame:
    """Per-model metrics joined with per-model mean latency (seconds)."""
    lat = latency.select("model", "time_per_sample_mean")
    return metrics.join(lat, "model")


def leaderboard(models: DataFrame) -> DataFrame:
    """Display name (C19), metrics, latency in ms (M6), F1 descending (O1)."""
    return (models.select(names.display_name("model").alias("model_name"),
                          "accuracy", "recall", "precision", "f1",
                          (F.col("time_per_sample_mean") * 1000).alias("time_per_sample_ms"))
            .orderBy(F.desc("f1"), "model_name"))


def display(df: DataFrame) -> DataFrame:
    """Display column names of the leaderboard."""
    return df.withColumnsRenamed({
        "model_name": "Model", "accuracy": "Accuracy", "recall": "Recall",
        "precision": "Precision", "f1": "F1 Score", "time_per_sample_ms": "Inference Time (ms)"})


def family_frontier(models: DataFrame) -> DataFrame:
    """Family, size, time (ms), F1 (%), sorted by time within family (O2).

    ``pareto`` (ours, Q9): no faster model has an F1 at least as high.
    """
    t = models.select("model", names.family("model").alias("family"),
                      names.size_class("model").alias("size"),
                      (F.col("time_per_sample_mean") * 1000).alias("time_ms"),
                      (F.col("f1") * 100).alias("f1_pct"))
    w = Window.orderBy("time_ms", "model").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("pareto", F.col("f1_pct") > F.coalesce(F.max("f1_pct").over(w),
                                                            F.lit(float("-inf"))))
    return t.withColumn("family_display", names.family_display("family")).orderBy(
        "family", "time_ms", "model")


def _compression(models: DataFrame) -> DataFrame:
    base = terms.BASELINE_MODEL
    t = models.filter((F.col("model") == base) | F.col("model").startswith("step"))
    return t.select("model", "f1", (F.col("time_per_sample_mean") * 1000).alias("runtime_ms"))


def speedup_table(models: DataFrame) -> DataFrame:
    """F1, runtime (ms) and speed-up relative to the baseline.

    The baseline value is spread with an un-partitioned window over the
    per-model table (a handful of rows), not a join.
    """
    t = _compression(models)
    full = F.max(F.when(F.col("model") == terms.BASELINE_MODEL, F.col("runtime_ms"))).over(
        Window.partitionBy())
    return t.withColumn("speedup", full / F.col("runtime_ms")).orderBy("runtime_ms", "model")


def retention_table(models: DataFrame) -> DataFrame:
    """F1 retention % and relative runtime % vs the baseline."""
    t = _compression(models)
    w = Window.partitionBy()
    base = F.col("model") == terms.BASELINE_MODEL
    f1_full = F.max(F.when(base, F.col("f1"))).over(w)
    rt_full = F.max(F.when(base, F.col("runtime_ms"))).over(w)
    t = (t.withColumn("f1_pct", F.col("f1") / f1_full * 100)
          .withColumn("runtime_pct", F.col("runtime_ms") / rt_full * 100)
          .withColumn("sort_idx", names.step_index("model")))
    # Q10: the baseline sorts first among equal indices.
    return t.orderBy("sort_idx", F.when(base, 0).otherwise(1), "model")


def metrics_long(metrics: DataFrame, by: Sequence[str] = ("model",),
                 cols: Sequence[str] = ("accuracy", "recall", "precision", "f1")) -> DataFrame:
    """One (metric, value) row per metric."""
    return metrics.unpivot(list(by), list(cols), "metric", "value")


def curves_long(log: DataFrame, keys: Sequence[str], series: Sequence[str]) -> DataFrame:
    """Training curves in long form (keys..., series, value)."""
    return log.unpivot(list(keys), list(series), "series", "value")


def pair_models(pretrained: DataFrame, finetuned: DataFrame, key: str = "model") -> DataFrame:
    """Pair per-model results of the two model types by key.

    Full outer join on the key; a model present on one side only fails the
    job (unequal pairings are an error).  The check sits in the key column
    itself, so column pruning cannot drop it.
    """
    def packed(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c != key]
        return df.select(key, F.struct(*rest).alias(name))
    j = packed(pretrained, "pretrained").join(packed(finetuned, "finetuned"), key, "full_outer")
    unpaired = F.col("pretrained").isNull() | F.col("finetuned").isNull()
    checked = F.when(unpaired, F.raise_error(F.concat(F.lit("unpaired model: "),
                                                      F.col(key).cast("string"))))
    return j.select(F.coalesce(checked.cast(j.schema[key].dataType), F.col(key)).alias(key),
                    "pretrained", "finetuned")
