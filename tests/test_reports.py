"""Reports, name parsing and early stopping against small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import names
from tessera.operators import reports


def test_model_names(spark):
    df = spark.createDataFrame([("hub/google/electra-base-discriminator/",),
                                ("roberta-large",), ("step12",), ("Full",), ("odd",)], "p STRING")
    r = df.select(names.model_key("p", 2).alias("k"), names.model_key("p", 0).alias("w"),
                  names.family(names.model_key("p", 0)).alias("f"),
                  names.size_class("p").alias("s"),
                  names.display_name(names.model_key("p", 2)).alias("d"),
                  names.step_index("p").alias("i")).collect()
    assert [(x.k, x.w, x.f, x.s, x.d, x.i) for x in r] == [
        ("electra-base", "electra-base-discriminator", "electra", "base", "ELECTRA-base", 99),
        ("roberta-large", "roberta-large", "roberta", "large", "RoBERTa-large", 99),
        ("step12", "step12", "step12", "base", "STEP12-", 12),
        ("Full", "Full", "Full", "base", "FULL-", 0),
        ("odd", "odd", "odd", "base", "ODD-", 99)]


def _early_stop_py(accs, patience=3):
    best, counter, best_epoch = 0.0, 0, None
    for e, a in enumerate(accs, 1):
        if a > best:
            best, counter, best_epoch = a, 0, e
        else:
            counter += 1
            if counter >= patience:
                return e, e, best_epoch
    return len(accs), None, best_epoch


@pytest.mark.parametrize("accs", [[0.5, 0.6, 0.55, 0.58, 0.59, 0.7],
                                  [0.1, 0.2, 0.3], [0.0, 0.0, 0.0, 0.0],
                                  [0.4, 0.3, 0.45, 0.44, 0.43, 0.42, 0.9]])
def test_early_stopping_matches_loop(spark, accs):
    log = spark.createDataFrame([("m", e, a) for e, a in enumerate(accs, 1)],
                                "model STRING, epoch INT, acc DOUBLE")
    r = reports.early_stopping(log, "acc", patience=3).first()
    run, stop, best_epoch = _early_stop_py(accs)
    assert (r.epochs_run, r.stop_epoch, r.best_epoch) == (run, stop, best_epoch)


def test_speedup_and_retention(spark):
    m = spark.createDataFrame([("Full", 0.9, 0.010), ("step1", 0.8, 0.005), ("step2", 0.6, 0.002)],
                              "model STRING, f1 DOUBLE, time_per_sample_mean DOUBLE")
    sp = {r.model: r.speedup for r in reports.speedup_table(m).collect()}
    assert sp == pytest.approx({"Full": 1.0, "step1": 2.0, "step2": 5.0})
    rt = reports.retention_table(m).collect()
    assert [r.model for r in rt] == ["Full", "step1", "step2"]
    assert rt[1].f1_pct == pytest.approx(80 / 0.9) and rt[2].runtime_pct == pytest.approx(20.0)


def test_pair_models(spark):
    a = spark.createDataFrame([("x", 0.1), ("y", 0.2)], "model STRING, ari DOUBLE")
    b = spark.createDataFrame([("x", 0.8), ("y", 0.9)], "model STRING, ari DOUBLE")
    got = sorted((r.model, r.pretrained.ari, r.finetuned.ari)
                 for r in reports.pair_models(a, b).collect())
    assert got == [("x", 0.1, 0.8), ("y", 0.2, 0.9)]
    c = spark.createDataFrame([("x", 0.8)], "model STRING, ari DOUBLE")
    with pytest.raises(Exception):
        reports.pair_models(a, c).select("model").collect()
