"""Fits that share scans against Spark ML's own, one for each setting."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from tessera.operators import evaluate, logistic, ml


def texts(spark, classes, n=300, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(rng.integers(classes))
        words = [f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(0, 40)) % 200]
        rows.append((i, " ".join(words + [f"c{(y + int(rng.integers(2))) % classes}"] * int(rng.integers(3))), y))
    return spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)


def own_fit(data, pm, label="label"):
    return LogisticRegression(featuresCol="features", labelCol=label, family="multinomial", weightCol="weight",
                              regParam=pm["regParam"], maxIter=pm["maxIter"], elasticNetParam=pm["elasticNetParam"]).fit(data)


@pytest.mark.parametrize("classes", [2, 3])
def test_coefficients_are_those_of_spark(spark, classes):
    df = texts(spark, classes).select("label", F.split("text", " ").alias("w"), (1.0 + F.col("label")).alias("weight"))
    tf = HashingTF(inputCol="w", outputCol="tf", numFeatures=1 << 10).transform(df).cache()
    idf = IDF(inputCol="tf", outputCol="features").fit(tf)
    data = idf.transform(tf).cache()
    settings = ml.sample_param_maps(2, 1) + [{"trial": 2, "regParam": 1e-5, "maxIter": 40, "elasticNetParam": 0.5},
                                             {"trial": 3, "regParam": 10.0, "maxIter": 10, "elasticNetParam": 0.5}]
    task = logistic.Task(tf, "tf", idf.idf.toArray(), "label", "weight", data)
    found = {s["trial"]: m for s, m in task.fit(settings)}
    for pm in settings:
        model, got = own_fit(data, pm), found[pm["trial"]]
        vectors, offsets = got.vectors, got.offsets
        if classes == 2:
            vectors, offsets = np.concatenate([-vectors, vectors]), np.concatenate([-offsets, offsets])
        assert np.allclose(vectors, model.coefficientMatrix.toArray() * idf.idf.toArray(), atol=1e-8)
        assert np.allclose(offsets - offsets.mean(), model.interceptVector.toArray(), atol=1e-8)


def test_search_scores_are_those_of_single_fits_and_scans_are_shared(spark, monkeypatch):
    train, validation = texts(spark, 2), texts(spark, 2, 120, 4)
    scans = []
    real, wide = logistic._pass, ml.featurizer
    monkeypatch.setattr(ml, "featurizer", lambda text_col="text": wide(text_col, 1 << 12))
    monkeypatch.setattr(logistic, "_pass", lambda blocks, vectors, *a: scans.append(len(vectors)) or real(blocks, vectors, *a))
    got = {r["trial"]: r for r in ml.random_search(train, validation, n_trials=6, seed=5).collect()}
    maps = ml.sample_param_maps(6, 5)
    # Each step of each trial was a scan of its own before.
    assert len(scans) < sum(pm["maxIter"] for pm in maps) * 0.6 and max(scans) == logistic.WIDTH // ml.LANES
    feat = ml.featurizer().fit(train)
    data, held = feat.transform(ml.with_class_weights(train)).cache(), feat.transform(validation).cache()
    for pm in maps[:1]:
        scored = own_fit(data, pm).transform(held).select(F.col("label").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))
        m = evaluate.classification_metrics(scored, by=[]).first()
        assert got[pm["trial"]]["val_f1"] == pytest.approx(m["f1"]) and got[pm["trial"]]["val_accuracy"] == pytest.approx(m["accuracy"])
    assert [got[t]["rank"] for t in sorted(got, key=lambda t: (-got[t]["val_f1"], t))] == list(range(1, 7))


def test_one_class_and_bad_labels(spark, monkeypatch):
    wide = ml.featurizer
    monkeypatch.setattr(ml, "featurizer", lambda text_col="text": wide(text_col, 1 << 12))
    rows = [(i, "a b c" if i % 2 else "b c d", 1) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    held = df.withColumn("label", F.when(F.col("doc_id") < 3, 0).otherwise(1))
    got = ml.random_search(df, held, n_trials=2).collect()
    assert [(r["val_accuracy"], r["rank"]) for r in got] == [(0.5, 1), (0.5, 2)]
    with pytest.raises(ValueError):
        ml.random_search(df.withColumn("label", -F.col("label")), held, n_trials=1)


def test_packed_rows_come_back(spark):
    wide = [(["x"] * 300 + [f"w{i}" for i in range(70)], 1), ([], 0), ([f"w{i}" for i in range(9)], None)]
    df = spark.createDataFrame(wide, "w array<string>, label int").coalesce(1)
    tf = HashingTF(inputCol="w", outputCol="tf", numFeatures=1 << 10).transform(df)
    wanted = {r.label: r.tf.toArray() for r in tf.collect()}
    found = {}
    for row in logistic.pack(tf, "tf", "label").collect():
        block = logistic._Block(row)
        for i, label in enumerate(block.labels):
            back = np.zeros((1, 1 << 10))
            block.add(np.eye(len(block.labels))[i][None], back)
            found[None if np.isnan(label) else int(label)] = back[0]
            assert block.times(back)[0, i] == pytest.approx((back ** 2).sum())
    assert found.keys() == wanted.keys() and all((found[k] == wanted[k]).all() for k in wanted)
