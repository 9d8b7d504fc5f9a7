"""Scoring and feature jobs over stores: nothing is worked on twice, and a broken run is made good."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import scoring


def never():
    raise AssertionError("a stored key was worked on again")


def make(spark, n=60):
    rows = [("d1" if i % 3 else "007", "test" if i % 4 == 0 else "train", i, [float(i % 5), float(i % 7), 1.0], i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "dataset string, split string, id long, features array<double>, label int")


ONE = scoring.linear(np.array([[1.0, 0.0], [0.0, 1.0], [0.0, 0.5]]))
TWO = scoring.linear(np.array([[0.0, 1.0], [1.0, 0.0], [0.0, 0.0]]))


def test_a_store_is_filled_once(spark, tmp_path):
    data, path = make(spark), str(tmp_path / "store")
    first = scoring.score_missing(data.filter("dataset = 'd1'"), {"a": ONE}, path, run="1")
    assert {(r.dataset, r.model, r.split, r.run) for r in first.collect()} == {("d1", "a", s, "1") for s in ("test", "train")}
    second = scoring.score_missing(data, {"a": ONE, "b": TWO}, path, run="2").collect()
    assert len(second) == 8 and {r.run for r in second if r.dataset == "d1" and r.model == "a"} == {"1"}
    assert sum(r.n for r in second) == 120
    again = scoring.score_missing(data, {"a": never, "b": never}, path, run="3")
    assert sorted(again.collect()) == sorted(second)
    rows = scoring.stored_predictions(spark, path, dataset="007", model="b", split="train")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "007" in plan
    for r in rows.collect():
        logits = [float(r.id % 7), float(r.id % 5)]
        assert r.logits == logits and r.y_pred == int(np.argmax(logits)) and r.y_true == r.id % 2 and r.seconds >= 0


def test_a_run_that_died_before_its_metrics_is_scored_again(spark, tmp_path, monkeypatch):
    data, path = make(spark), str(tmp_path / "store")

    def dies(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(scoring, "_metrics", dies)
        with pytest.raises(RuntimeError):
            scoring.score_missing(data, {"a": TWO}, path)
    found = scoring.score_missing(data, {"a": ONE}, path)
    assert sum(r.n for r in found.collect()) == 60 == scoring.stored_predictions(spark, path).count()
    assert all(r.logits[0] == r.id % 5 for r in scoring.stored_predictions(spark, path).collect())


def test_rows_without_labels_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "store")
    found = scoring.score_missing(make(spark).drop("label"), {"a": ONE}, path).collect()
    assert len(found) == 4 and all(r.accuracy is None and r.n > 0 and r.time_per_sample_mean >= 0 for r in found)
    nobody = make(spark).limit(0)
    assert scoring.score_missing(nobody, {"a": never}, str(tmp_path / "none")).collect() == []
    assert scoring.score_missing(make(spark), {}, str(tmp_path / "none")).collect() == []


def test_a_wrong_shape_fails_the_job(spark, tmp_path):
    with pytest.raises(Exception, match="shape"):
        scoring.score_missing(make(spark), {"a": ONE}, str(tmp_path / "s"), classes=3)
    with pytest.raises(Exception, match="shape"):
        scoring.extract_missing(make(spark), "d", "m", "t", "x", ONE, 3, str(tmp_path / "f"))


def test_features_are_extracted_once_and_by_key(spark, tmp_path):
    data, path = make(spark), str(tmp_path / "f")
    found = scoring.extract_missing(data, "d", "m", "pretrained", "one", ONE, 2, path)
    assert {r.id: r.vector for r in found.collect()} == {i: [float(i % 5), i % 7 + 0.5] for i in range(60)}
    scoring.extract_missing(data, "d", "m", "pretrained", "two", TWO, 2, path)
    again = scoring.extract_missing(data, "d", "m", "pretrained", "one", never, 2, path)
    assert sorted(again.collect()) == sorted(found.collect())
    assert scoring.stored_features(spark, path).count() == 120
    assert dict(scoring.stored_features(spark, path, method="two").dtypes)["vector"] == "array<float>"


def test_separability_is_written_beside_the_features(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = [(i, i % 2, [10.0 * (i % 2) + (i % 5) / 10, (i % 3) / 10, 0.0]) for i in range(80)]
    data = spark.createDataFrame(rows, "id long, label int, features array<double>")
    keys = []
    for method, factory in (("one", ONE), ("zero", scoring.linear(np.array([[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]])))):
        scoring.extract_missing(data, "d", "m", "tuned", method, factory, 2, path)
        keys.append(dict(zip(scoring.FEATURE_KEYS, ("d", "m", "tuned", method), strict=True)))
        found = scoring.separability_of_stored(spark, path, keys[-1], n_starts=3).collect()
        assert [r.method for r in found] == [method]
    results = {r.method: r for r in spark.read.parquet(f"{path}/separability").collect()}
    assert results["one"].adjusted_rand_index == pytest.approx(1.0) and results["zero"].adjusted_rand_index < 0.1
    assert spark.read.parquet(f"{path}/separability").filter(F.col("k") == 2).count() == 2
