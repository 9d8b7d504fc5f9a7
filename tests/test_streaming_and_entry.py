"""Streaming cleaner, driver entry points, oracle agreement at sf0.001."""

import os

import pytest

from driver_tables import SF_SMALL


def test_clean_stream_available_now(spark, tmp_path):
    from tessera.streaming.clean_stream import cleaned_stream, run_clean_stream
    src = tmp_path / "in"
    spark.createDataFrame([(1, "i m soooo happy"), (2, "ok"), (3, "idk lol u r gr8")],
                          "id INT, text STRING").write.parquet(str(src))
    q = run_clean_stream(spark, str(src), "id INT, text STRING", str(tmp_path / "out"),
                         checkpoint=str(tmp_path / "stream"))
    q.awaitTermination(120)
    got = sorted((r.id, r.cleaned) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    batch = cleaned_stream(spark.read.parquet(str(src)))
    assert got == sorted((r.id, r.cleaned) for r in batch.collect())
    assert [i for i, _ in got] == [1, 3]


def test_restarted_stream_reads_new_files_only(spark, tmp_path):
    from tessera.streaming.clean_stream import run_clean_stream
    src, out = tmp_path / "in", str(tmp_path / "out")
    for k, session in enumerate((spark, spark.newSession())):
        session.createDataFrame([(k, f"row number {k}")], "id INT, text STRING").write.mode("append").parquet(str(src))
        run_clean_stream(session, str(src), "id INT, text STRING", out,
                         checkpoint=str(tmp_path / "stream")).awaitTermination(120)
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(k + 1))


def test_cleaning_is_planned_once(spark):
    """The rules stand once in the optimised plan, and above the joins of the dedupe."""
    from tessera.functions import text as T
    from tessera.operators import curate
    from tessera.streaming.clean_stream import cleaned_stream
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "x y z")], "doc_id INT, text STRING")
    single = curate.replace_texts(curate.drop_all_copies(df), T.clean_sample("text"), 2, length_col="length")
    for frame in (cleaned_stream(df), single.filter("length >= 0")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("encoding") == cleaned_stream(df)._jdf.queryExecution().analyzed().toString().count("encoding")
    lines = single._jdf.queryExecution().optimizedPlan().toString().split("\n")
    rule = next(i for i, x in enumerate(lines) if "encoding" in x)
    assert not any("Join" in x for x in lines[:rule])


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables absent")
def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["source", "n", "proportion"]
    assert df.count() > 0


FAST = ["drop_all_copies", "duplicate_report", "repeated_chars", "fix_apostrophes", "slang",
        "metadata_window", "contractions", "clean_pipeline", "html_to_text",
        "class_distribution", "length_histogram", "stratified_split", "macro_metrics",
        "hybrid_loss", "ari", "ami", "early_stop", "retention", "log_merge", "cache_miss"]


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables absent")
@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, name):
    import duckdb
    import __spark_entry__ as E
    from tessera.sources.tables import TABLES
    sys_path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools")
    import sys
    sys.path.insert(0, sys_path)
    from check_oracle import digest
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == \
        digest(ocols, cur.fetchall())[0]


def test_score_stream_matches_batch(spark, tmp_path):
    from tessera.functions import text as T
    from tessera.operators import ml
    from tessera.streaming.clean_stream import run_score_stream
    train = spark.createDataFrame(
        [(i, t, lab) for i, (t, lab) in enumerate(
            [("i am so happy today", 1), ("what a joy this is", 1), ("so sad and blue", 0),
             ("i feel sad today", 0), ("happy happy joy", 1), ("tears and sadness", 0)] * 3)],
        "id INT, text STRING, label INT")
    model = ml.weighted_classifier(train, max_iter=10)
    src = tmp_path / "in"
    new = spark.createDataFrame([(100, "soooo happy"), (101, "very sad")], "id INT, text STRING")
    new.write.parquet(str(src))
    q = run_score_stream(spark, model, str(src), "id INT, text STRING", str(tmp_path / "out"),
                         checkpoint=str(tmp_path / "stream"))
    q.awaitTermination(180)
    got = sorted((r.id, r.y_pred) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    batch = ml.score(model, new.withColumn("text", T.clean_sample("text")), keep=["id"],
                     label_col=None)
    assert got == sorted((r.id, r.y_pred) for r in batch.collect())
