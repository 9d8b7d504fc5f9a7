"""Distributed model jobs.

* L1  weighted text classifier: RegexTokenizer -> HashingTF -> IDF ->
      LogisticRegression with a per-row class weight (J2 join on label).
* L2  seeded random search maximising macro F1 on the validation split;
      the trials' fits share their scans over the same checkpointed counts (``logistic``).
* L3  batch scoring: clean -> model -> argmax -> metrics when labels exist.
* P9/P10  ``predict_batch_udf`` wrapper for user-supplied models
      (Arrow batches, model built once per Python worker).
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions.arrays import argmax
from ..session import cut_lineage
from . import curate, evaluate, logistic
from .evaluate import BROADCAST_WEIGHTS

#: Parts of a random search's trials, which are fitted beside each other.
LANES = 2


# ------------------------------------------------------------ evaluator

class MacroF1Evaluator(Evaluator):
    """Unweighted mean F1 over classes seen in truth or prediction (A10).

    Spark ML's MulticlassClassificationEvaluator 'f1' is support-weighted,
    which is a different number.
    """

    def __init__(self, label_col: str = "label", prediction_col: str = "prediction",
                 metric: str = "f1"):
        super().__init__()
        self.label_col, self.prediction_col, self.metric = label_col, prediction_col, metric

    def _evaluate(self, dataset: DataFrame) -> float:
        d = dataset.select(F.col(self.label_col).cast("int").alias("y_true"),
                           F.col(self.prediction_col).cast("int").alias("y_pred"))
        row = evaluate.classification_metrics(d, by=[]).first()   # one row
        return float(row[self.metric] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


# ------------------------------------------------------------ L1

def featurizer(text_col: str = "text", num_features: int = 1 << 18) -> Pipeline:
    """Word tokens -> hashed term frequencies -> IDF.  Hashing keeps the
    feature space fixed, so no vocabulary is collected to the driver."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern=r"(?U)\W+"),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="features"),
    ])


def with_class_weights(df: DataFrame, label_col: str = "label", out: str = "weight") -> DataFrame:
    """Each row gets max-count / count of its class (A4).  The weight table has one row
    per class; it is counted and broadcast up to ``evaluate.BROADCAST_WEIGHTS`` rows, so the
    texts are not dealt out by label."""
    w = cut_lineage(curate.class_weights(df, label_col).select(label_col, F.col("weight").cast("double").alias(out)))
    return df.join(F.broadcast(w) if w.count() <= BROADCAST_WEIGHTS else w, label_col)


def _weight_kw(weighted: bool) -> dict:
    return {"weightCol": "weight"} if weighted else {}


def weighted_classifier(train: DataFrame, text_col: str = "text", label_col: str = "label",
                        reg_param: float = 0.01, max_iter: int = 20,
                        elastic_net: float = 0.0, weighted: bool = True) -> PipelineModel:
    """L1: fit the full pipeline on ``train`` with class weights."""
    data = with_class_weights(train, label_col) if weighted else train
    lr = LogisticRegression(featuresCol="features", labelCol=label_col,
                            regParam=reg_param, maxIter=max_iter, elasticNetParam=elastic_net,
                            family="multinomial", **_weight_kw(weighted))
    return Pipeline(stages=[featurizer(text_col), lr]).fit(data)


# ------------------------------------------------------------ L2

def sample_param_maps(n_trials: int = 30, seed: int = 42) -> list[dict]:
    """Seeded random search space (our mapping of the reference's ranges):
    regParam log-uniform, maxIter integer, elasticNetParam uniform."""
    rng = random.Random(seed)
    out = []
    for t in range(n_trials):
        out.append({
            "trial": t,
            "regParam": math.exp(rng.uniform(math.log(1e-4), math.log(1e-1))),
            "maxIter": rng.randint(10, 20),
            "elasticNetParam": rng.uniform(0.0, 0.1),
        })
    return out


def random_search(train: DataFrame, validation: DataFrame, text_col: str = "text",
                  label_col: str = "label", n_trials: int = 30, seed: int = 42,
                  parallelism: int = logistic.WIDTH, weighted: bool = True) -> DataFrame:
    """L2: fit ``n_trials`` seeded parameter maps on train, score macro F1
    on validation.  Texts are tokenised once and their counts checkpointed (reliable
    checkpoint in the shared dir); ``parallelism`` vectors of coefficients (one for each trial
    of two classes, one for each class of more) are fitted at once, see ``logistic``.

    Returns one row per trial with its parameters and validation scores,
    ranked by F1 (ties by trial number).
    """
    spark = train.sparkSession
    tokenizer, hashing, idf = featurizer(text_col).getStages()
    words = PipelineModel([tokenizer, hashing])
    tf = cut_lineage(words.transform(train).select(label_col, "__tf"))
    idf = idf.fit(tf)
    tr = with_class_weights(tf, label_col) if weighted else tf
    va = logistic.pack(words.transform(validation).withColumn(label_col, F.col(label_col).cast("int")), "__tf", label_col)
    task = logistic.Task(tr, "__tf", idf.idf.toArray(), label_col, "weight" if weighted else None, idf.transform(tr))
    maps = sample_param_maps(n_trials, seed)

    def judge(models):
        m = evaluate.classification_metrics(logistic.predicted(va, models, "trial"), by=["trial"])
        of = {pm["trial"]: pm for pm, _ in models}
        return [(r["trial"], float(of[r["trial"]]["regParam"]), int(of[r["trial"]]["maxIter"]),
                 float(of[r["trial"]]["elasticNetParam"]), float(r["accuracy"]), float(r["f1"]))
                for r in m.collect()]   # one row per trial

    def run(lane):
        rows, models, width = [], [], max(1, parallelism // LANES)
        for found in task.fit(maps[lane::LANES], width):
            models.append(found)
            if len(models) * task.kept >= width:
                rows += judge(models)
                models = []
        return rows + (judge(models) if models else [])

    with ThreadPoolExecutor(LANES) as pool:   # one lane's scan runs beside the other's steps on the driver
        rows = [r for of_lane in pool.map(run, range(LANES)) for r in of_lane]
    if len(rows) < len(maps):
        raise ValueError("no rows to validate on")
    res = spark.createDataFrame(rows, "trial INT, reg_param DOUBLE, max_iter INT, "
                                      "elastic_net DOUBLE, val_accuracy DOUBLE, val_f1 DOUBLE")
    return res.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc("val_f1"), "trial")))


# ------------------------------------------------------------ L3

def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("doc_id",),
          label_col: str | None = "label") -> DataFrame:
    """L3 scoring step: probabilities, argmax prediction (M1), true label if any."""
    out = model.transform(df)
    probs = vector_to_array("probability").alias("probs")
    cols = [*keep, probs]
    if label_col and label_col in df.columns:
        cols.append(F.col(label_col).cast("int").alias("y_true"))
    return out.select(*cols).withColumn("y_pred", argmax("probs"))


def score_report(scored: DataFrame) -> DataFrame:
    """Metric name / value rows (only when labels exist)."""
    from .reports import metrics_long
    if "y_true" not in scored.columns:
        return scored.groupBy().agg(F.count("*").alias("value")).select(
            F.lit("n").alias("metric"), F.col("value").cast("double"))
    m = evaluate.classification_metrics(scored.select("y_true", "y_pred"), by=[])
    return metrics_long(m.withColumn("__k", F.lit(0)), ["__k"]).drop("__k")


# ------------------------------------------------------------ P9 / P10

def batch_predict(make_predict_fn: Callable, input_cols: Sequence[str], out_dim: int | None = None,
                  batch_size: int = 32, input_tensor_shapes=None):
    """A column function running a user-supplied model over Arrow
    batches of ``batch_size`` rows; returns ``array<double>`` per row.

    ``make_predict_fn()`` is called once per Python worker and returns a
    function ``ndarray[batch, ...] -> ndarray[batch, out]``.
    """
    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()),
                            batch_size=batch_size, input_tensor_shapes=input_tensor_shapes)
    return udf(*[F.col(c) for c in input_cols])


def class_centroids(df: DataFrame, vec_col: str, label_col: str) -> DataFrame:
    """Mean vector per class, element-wise, computed distributed:
    ``posexplode`` then ``groupBy(label, pos)`` (partial aggregation), and
    re-assembled per class.  One row per class, vector length = dim."""
    e = df.select(label_col, F.posexplode(vec_col).alias("__p", "__x"))
    m = e.groupBy(label_col, "__p").agg(F.avg("__x").alias("__m"))
    return (m.groupBy(label_col)
            .agg(F.array_sort(F.collect_list(F.struct("__p", "__m"))).alias("__s"))
            .select(label_col, F.transform("__s", lambda s: s["__m"]).alias("centroid")))


def nearest_centroid_fn(labels: Sequence[int], centroids: np.ndarray):
    """Model factory for :func:`batch_predict`: negative squared distance
    to every centroid (a logit vector ordered like ``labels``)."""
    cent = np.asarray(centroids, dtype=np.float64)

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            x = np.asarray(x, dtype=np.float64)
            d = ((x[:, None, :] - cent[None, :, :]) ** 2).sum(axis=2)
            return -d
        return predict
    return make
