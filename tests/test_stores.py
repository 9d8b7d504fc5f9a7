"""Sources, sinks and stores (S1-S11) on small files written by the tests."""

import json
import os

import pytest

from pyspark.sql import functions as F

from tessera.sources import stores


def test_label_mapping_and_csv_dataset(spark, tmp_path):
    (tmp_path / "classes.json").write_text(json.dumps({"0": "Sadness", "1": "Joy"}))
    classes = stores.load_label_mapping(spark, str(tmp_path / "classes.json"))
    assert sorted(map(tuple, classes.collect())) == [(0, "Sadness"), (1, "Joy")]
    (tmp_path / "train.csv").write_text('text,label\n"hi, there",1\nbye,Sadness\n')
    (tmp_path / "test.csv").write_text("text,label\n\"multi\nline\",0\n")
    df = stores.load_csv_dataset(spark, {"train": str(tmp_path / "train.csv"),
                                         "test": str(tmp_path / "test.csv")}, classes)
    got = sorted((r.split, r.text, r.label) for r in df.collect())
    assert got == [("test", "multi\nline", 0), ("train", "bye", 0), ("train", "hi, there", 1)]


def test_scoring_csv_without_labels(spark, tmp_path):
    (tmp_path / "s.csv").write_text("text\nhello\n")
    df = stores.load_scoring_csv(spark, str(tmp_path / "s.csv"))
    assert df.columns == ["text"] and df.count() == 1


def test_model_stats(spark, tmp_path):
    d = tmp_path / "org" / "m-small"
    d.mkdir(parents=True)
    (d / "config.json").write_text(json.dumps({"hidden_size": 256, "num_attention_heads": 4,
                                               "num_hidden_layers": 12, "vocab_size": 30522,
                                               "other": 1}))
    bad = tmp_path / "org" / "broken"
    bad.mkdir()
    (bad / "config.json").write_text("{not json")
    out = stores.model_stats(spark, str(tmp_path)).collect()
    assert [(r.model, r.hidden_size, r.vocab_size) for r in out] == [("org/m-small", 256, 30522)]


def test_training_logs_and_merge(spark, tmp_path):
    d = tmp_path / "runs" / "m1"
    d.mkdir(parents=True)
    (d / "training_log.csv").write_text(
        "epoch,step,loss,eval_loss,eval_accuracy,eval_recall,eval_precision,eval_f1\n"
        "1,10,0.5,0.4,0.8,0.7,0.75,0.72\n")
    logs = stores.training_logs(spark, str(tmp_path / "runs")).collect()
    assert [(r.model, r.epoch, r.eval_f1) for r in logs] == [("m1", 1.0, 0.72)]
    rec = spark.createDataFrame(
        [("m", 1, 5, "loss", 0.9), ("m", 1, 7, "loss", 0.8), ("m", 1, 8, "eval_loss", 0.7),
         ("m", 2, 9, "loss", 0.6)],
        "model STRING, epoch INT, step INT, field STRING, value DOUBLE")
    out = stores.merge_log_records(rec, ["model", "epoch"], ["loss", "eval_loss"]).collect()
    assert [(r.epoch, r.step, r.loss, r.eval_loss) for r in out] == [(1, 8, 0.8, 0.7)]


def test_hparams_roundtrip(spark, tmp_path):
    root = str(tmp_path / "hp")
    assert stores.load_hparams(spark, root, "x").count() == 0
    df = spark.createDataFrame([("x", 2e-5, 12, 0.05, 0.01)], stores.HPARAM_SCHEMA)
    stores.write_hparams(df, root)
    got = stores.load_hparams(spark, root, "x").first()
    assert (got.model, got.num_train_epochs) == ("x", 12)


def test_compute_if_absent_and_upsert(spark, tmp_path):
    path = str(tmp_path / "preds")
    calls = []

    def compute(keys):
        calls.append(sorted(r.model for r in keys.collect()))
        return keys.withColumn("acc", F.lit(0.5))

    wanted = spark.createDataFrame([("a", "test"), ("b", "test")], "model STRING, split STRING")
    out = stores.compute_if_absent(spark, path, wanted, ["model", "split"], compute)
    assert out.count() == 2 and calls == [["a", "b"]]
    wanted2 = spark.createDataFrame([("a", "test"), ("c", "test")], "model STRING, split STRING")
    out2 = stores.compute_if_absent(spark, path, wanted2, ["model", "split"], compute)
    assert sorted(r.model for r in out2.collect()) == ["a", "c"] and calls[-1] == ["c"]
    mpath = str(tmp_path / "metrics")
    first = spark.createDataFrame([("a", "ft", 0.1), ("b", "ft", 0.2)],
                                  "model STRING, model_type STRING, ari DOUBLE")
    stores.upsert(spark, mpath, first, ["model", "model_type"])
    new = spark.createDataFrame([("a", "ft", 0.9)], "model STRING, model_type STRING, ari DOUBLE")
    got = stores.upsert(spark, mpath, new, ["model", "model_type"])
    assert sorted(map(tuple, got.collect())) == [("a", "ft", 0.9), ("b", "ft", 0.2)]


def test_write_pairs(spark, tmp_path):
    df = spark.createDataFrame([("soooo", "soo")], "text STRING, cleaned STRING")
    stores.write_pairs(df, str(tmp_path / "pairs"))
    txt = "".join(open(os.path.join(tmp_path / "pairs", f)).read()
                  for f in os.listdir(tmp_path / "pairs") if f.startswith("part-"))
    assert txt == "soooo\nsoo\n"


def test_label_to_index_rejects_unknown(spark):
    import pytest
    df = spark.createDataFrame([("x", "Nope")], "text STRING, label STRING")
    with pytest.raises(Exception):
        df.transform(stores.label_to_index("label", stores.load_label_mapping(spark))).collect()


def test_upsert_keeps_the_store_on_schema_drift_and_read_errors(spark, tmp_path):
    path = str(tmp_path / "store")
    stores.upsert(spark, path, spark.createDataFrame([("a", 1)], "k STRING, v INT"), ["k"])
    stores.upsert(spark, path, spark.createDataFrame([("b", 2.5)], "k STRING, w DOUBLE"), ["k"])
    assert sorted((r.k, r.v, r.w) for r in spark.read.parquet(path).collect()) == [("a", 1, None), ("b", None, 2.5)]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        stores.upsert(spark, str(broken), spark.createDataFrame([("a", 1)], "k STRING, v INT"), ["k"])
    assert (broken / "part-0.parquet").read_text() == "not parquet"
    with pytest.raises(Exception):
        stores.missing_keys(spark, str(broken), spark.createDataFrame([("a",)], "k STRING"), ["k"]).collect()


def test_readers_go_by_name_and_check_labels(spark, tmp_path):
    a, b, c = (tmp_path / f"{x}.csv" for x in "abc")
    a.write_text("label,id,text\nJoy,7,hello\n1,8,there\n")
    b.write_text("id,text\n77,only text\n")
    c.write_text("text,label\nbad,17\n")
    assert [(r.text, r.label) for r in stores.load_csv_dataset(spark, {"train": str(a)}).collect()] == [("hello", 1), ("there", 1)]
    assert [r.text for r in stores.load_scoring_csv(spark, str(b)).collect()] == ["only text"]
    with pytest.raises(Exception, match="unknown label"):
        stores.load_csv_dataset(spark, {"train": str(c)}).collect()
    with pytest.raises(ValueError, match="no column"):
        stores.load_csv_dataset(spark, {"train": str(b)})


def test_bad_rows_stand_beside_the_good_ones(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        'text,label\n"hi, there",1\nbye,Sadness\ntoo,1,many\nfew\nwho,Nope\n"two\nlines",2\nnone,\n,3\n"quo""te",Joy\n')
    (tmp_path / "test.csv").write_text('label,text\n1,ok\n2,"open quote\n3,swallowed\n')
    good, bad = stores.load_csv_checked(spark, {"train": str(tmp_path / "train.csv"), "test": str(tmp_path / "test.csv")})
    assert sorted((r.split, r.text or "", r.label) for r in good.collect()) == [
        ("test", "ok", 1), ("train", "", 3), ("train", "bye", 0), ("train", "hi, there", 1), ("train", 'quo"te', 1),
        ("train", "two\nlines", 2)]
    found = sorted((r.split, r.reason, r.record) for r in bad.collect())
    assert [(s, r) for s, r, _ in found] == [("test", "open quote"), ("train", "fields"), ("train", "fields"), ("train", "no label"),
                                             ("train", "unknown label")]
    assert found[0][2].startswith("open quote\n3,swallowed") and {f[2] for f in found[1:3]} == {"too,1,many", "few"}
    assert found[4][2] == "who,Nope" and all(r.path.endswith(".csv") for r in bad.collect())


def test_bad_rows_of_scoring_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("text\nhello\na,b\n")
    good, bad = stores.load_csv_checked(spark, {"score": str(tmp_path / "s.csv")}, labelled=False)
    assert [(r.text, r.label) for r in good.collect()] == [("hello", None)]
    assert [(r.record, r.reason) for r in bad.collect()] == [("a,b", "fields")]
    with pytest.raises(ValueError, match="label"):
        stores.load_csv_checked(spark, {"train": str(tmp_path / "s.csv")})
