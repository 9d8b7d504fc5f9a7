import zlib

from tessera.llm import toxicity_bags


def test_held_out_accuracy_and_misspellings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity_bags.toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r.toxic for r in labels.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    yes, no = [s for s, t in held if t], [s for s, t in held if not t]
    better = sum((a > b) + (a == b) / 2 for a in yes for b in no) / (len(yes) * len(no))
    assert better > 0.9
    assert sum(s >= 0.5 for s in no) < 0.05 * len(no)
    spoken = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    for lang, least in (("en", 0.85), ("de", 0.6), ("fr", 0.5), ("es", 0.5)):
        toxic = [r.predicted for r in rows if r.held_out and known.get(r.doc_id) and spoken[r.doc_id] == lang]
        assert sum(toxic) >= least * len(toxic), lang

    model = toxicity_bags.train(*toxicity_bags.sample(docs, labels))
    import pyarrow as pa
    score = lambda *t: model.scores(*toxicity_bags.distinct_words(pa.array(t)), len(t)).tolist()
    clean, word, misspelt = score("the and of to in", "the and of to idiot", "the and of to idiott")
    assert clean < misspelt and clean < word


def test_labels_of_held_out_rows_do_not_matter(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert sorted(toxicity_bags.toxicity(sample, labels).collect()) == sorted(toxicity_bags.toxicity(sample, other).collect())


def test_odd_rows(odd, labels, none):
    rows = toxicity_bags.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 7)}) == 1 and all(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in toxicity_bags.toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity_bags.toxicity(none, labels).count() == 0


def test_the_sample_is_even_and_bounded(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * 3, "en" if i % 10 else "fr") for i in range(1000)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(1000)], "doc_id long, toxic int")
    words, toxic, spoken, share = toxicity_bags.sample(docs, labels, rows=120)
    assert len(words) == 120 and abs(share - 1 / 7) < 0.03
    from collections import Counter
    got = Counter(zip(toxic.tolist(), spoken.tolist()))
    assert set(got) == {(0, "en"), (0, "fr"), (1, "en"), (1, "fr")} and got[0, "en"] - got[1, "en"] <= 1 and got[1, "fr"] <= 15
    long = spark.createDataFrame([(i, " ".join(f"t{j}" for j in range(5000)), "en") for i in range(2, 30)], docs.schema)
    words, *_ = toxicity_bags.sample(long, labels)
    assert all(len(w) == toxicity_bags.TRAIN_WORDS for w, _ in words) and len({tuple(w) for w, _ in words}) == len(words)
