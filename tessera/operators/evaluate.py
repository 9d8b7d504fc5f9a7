"""Evaluation over stored predictions.

All metrics are aggregations with map-side partial combine: the per-row
work is a projection, the shuffle carries one row per (group, class).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import log_softmax, log_sum_exp
from ..session import cut_lineage

#: Class-weight rows up to which the table is broadcast.
BROADCAST_WEIGHTS = 100_000


def confusion_matrix(df: DataFrame, by: Sequence[str] = ("model",), y_true: str = "y_true",
                     y_pred: str = "y_pred", dense: bool = False) -> DataFrame:
    """Counts per (true, predicted) and the row-normalised share; with ``dense`` a row for
    every pair of the classes seen in the group (share null for a class without rows).

    The grid is made per group from the list of its classes, which is as long as they are."""
    by = list(by)
    counts = df.groupBy(*by, y_true, y_pred).agg(F.count("*").alias("n"))
    if dense:
        seen = F.array_distinct(F.concat(F.collect_set(y_true), F.collect_set(y_pred))).alias("__c")
        grid = (counts.groupBy(*by).agg(seen).withColumn(y_true, F.explode("__c"))
                .withColumn(y_pred, F.explode("__c")).drop("__c").withColumn("n", F.lit(0).cast("long")))
        counts = counts.unionByName(grid).groupBy(*by, y_true, y_pred).agg(F.sum("n").alias("n"))
    return counts.withColumn(
        "share", F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy(*by, y_true))))


def confusion_wide(df: DataFrame, labels: Sequence, by: Sequence[str] = ("model",), y_true: str = "y_true",
                   y_pred: str = "y_pred") -> DataFrame:
    """One row per true class, one column ``pred_<label>`` per predicted class."""
    by = list(by)
    wide = confusion_matrix(df, by, y_true, y_pred, dense=True).groupBy(*by, y_true).pivot(y_pred, list(labels)).agg(F.sum("n"))
    return wide.select(*by, y_true, *[F.coalesce(F.col(f"`{x}`"), F.lit(0).cast("long")).alias(f"pred_{x}") for x in labels])


def pair_by_id(truth: DataFrame, predictions: DataFrame, id_col: str = "id", y_true: str = "y_true",
               y_pred: str = "y_pred") -> DataFrame:
    """Predictions joined with the truth of their id, never by position.

    A prediction without a truth fails the job; a truth without a prediction has
    ``y_pred`` null."""
    both = truth.withColumn("__t", F.lit(True)).join(predictions, id_col, "full")
    lost = F.raise_error(F.concat(F.lit("prediction without truth: "), F.col(id_col).cast("string")))
    return both.withColumn(y_true, F.when(F.col("__t").isNull(), lost.cast(dict(truth.dtypes)[y_true]))
                           .otherwise(F.col(y_true))).drop("__t")


def per_class_counts(df: DataFrame, by: Sequence[str] = ("model",), y_true: str = "y_true",
                     y_pred: str = "y_pred") -> DataFrame:
    """tp / true / predicted counts per class, in one aggregation.

    Each row contributes to its true class and to its predicted class, so
    classes seen in either column are present (the macro set).
    """
    by = list(by)
    ev = F.explode(F.array(
        F.struct(F.col(y_true).alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                 (F.col(y_true) == F.col(y_pred)).cast("int").alias("tp")),
        F.struct(F.col(y_pred).alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"),
                 F.lit(0).alias("tp"))))
    return (df.select(*by, ev.alias("e"))
            .groupBy(*by, F.col("e.cls").alias("cls"))
            .agg(F.sum("e.tp").alias("tp"), F.sum("e.t").alias("n_true"),
                 F.sum("e.p").alias("n_pred")))


def classification_metrics(df: DataFrame, by: Sequence[str] = ("model",), y_true: str = "y_true",
                           y_pred: str = "y_pred") -> DataFrame:
    """Accuracy, macro recall/precision/F1, support-weighted F1.

    Empty denominators count as 0 (never NaN).  Not Spark ML's weighted
    metrics: these are unweighted means over classes.
    """
    by = list(by)
    c = per_class_counts(df, by, y_true, y_pred)
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("n_true")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("n_true") + F.col("n_pred")), F.lit(0.0))
    c = c.select(*by, "tp", "n_true", prec.alias("p"), rec.alias("r"), f1.alias("f"))
    return c.groupBy(*by).agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        F.avg("r").alias("recall"),
        F.avg("p").alias("precision"),
        F.avg("f").alias("f1"),
        (F.sum(F.col("f") * F.col("n_true")) / F.sum("n_true")).alias("weighted_f1"))


def latency_stats(df: DataFrame, sec_col: str = "sec", by: Sequence[str] = ("model",)) -> DataFrame:
    """Total seconds, per-sample mean and population std."""
    return df.groupBy(*by).agg(F.count("*").alias("n"),
                               F.sum(sec_col).alias("total_time"),
                               F.avg(sec_col).alias("time_per_sample_mean"),
                               F.stddev_pop(sec_col).alias("time_per_sample_std"))


def class_weight_table(df: DataFrame, by: Sequence[str] = ("model",), y_true: str = "y_true"
                       ) -> DataFrame:
    """J2 input: weight = max count / count per class, within ``by``."""
    by = list(by)
    n = df.groupBy(*by, y_true).agg(F.count("*").alias("n"))
    return n.withColumn("w", F.max("n").over(Window.partitionBy(*by)).cast("double")
                        / F.col("n")).drop("n")


def losses(df: DataFrame, by: Sequence[str] = ("model",), student: str = "student",
           teacher: str = "teacher", y_true: str = "y_true", temperature: float = 2.0,
           alpha: float = 0.5, weights: DataFrame | None = None) -> DataFrame:
    """M3-M5 over a stored table of logits (global means, not batch means).

    * weighted_ce  = sum(w[y] * CE) / sum(w[y])           (M3, J2)
    * distill_kl   = mean over rows of KL(teacher_T || student_T) * T^2   (M4)
    * hybrid_loss  = alpha * weighted_ce + (1 - alpha) * distill_kl      (M5)

    ``weights`` (by..., y_true, w) are those of the training split; without it they
    come from the scored rows.  The table has one row per (group, class): it is
    written, counted and broadcast up to ``BROADCAST_WEIGHTS`` rows, so the logits
    are not dealt out by label; beyond that both sides are.
    """
    by = list(by)
    weights = cut_lineage(class_weight_table(df, by, y_true) if weights is None else weights)
    keys = [c for c in [*by, y_true] if c in weights.columns]
    if weights.count() <= BROADCAST_WEIGHTS:
        weights = F.broadcast(weights)
    ce = log_sum_exp(student) - F.element_at(F.col(student), F.col(y_true) + 1)
    lt = log_softmax(teacher, temperature)
    ls = log_softmax(student, temperature)
    kl = F.aggregate(F.zip_with(lt, ls, lambda a, b: F.exp(a) * (a - b)), F.lit(0.0),
                     lambda acc, x: acc + x)
    rows = df.join(weights, keys).select(*by, "w", ce.alias("ce"), kl.alias("kl"))
    agg = rows.groupBy(*by).agg(
        (F.sum(F.col("w") * F.col("ce")) / F.sum("w")).alias("weighted_ce"),
        (F.avg("kl") * F.lit(temperature ** 2)).alias("distill_kl"))
    return agg.withColumn("hybrid_loss", F.lit(alpha) * F.col("weighted_ce")
                          + F.lit(1 - alpha) * F.col("distill_kl"))
