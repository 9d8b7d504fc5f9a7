"""Vocabularies, exact encoding and table dictionaries, both ways of looking up."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions import terms
from tessera.functions import text as T
from tessera.operators import lookup
from tessera.operators import vocabulary as V


def texts(seed, n=80):
    rng = random.Random(seed)
    ws = ["the", "The", "of", "Zoë", "ß", "it's", "x y", "日本", *[f"w{i}" for i in range(40)]]
    out = [" ".join(rng.choice(ws[: rng.choice([4, 48])]) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*out, None, "", "  \t ", "the " * 5000, out[0], out[0]]


def learned(rows, min_count=1):
    counts = Counter(w for t in rows for w in (t or "").lower().split())
    return [(w, n, i + 2) for i, (w, n) in enumerate(sorted(
        ((w, n) for w, n in counts.items() if n >= min_count), key=lambda x: (-x[1], x[0].encode())))]


def frame(spark, rows):
    return spark.createDataFrame([(i // 2, t) for i, t in enumerate(rows)], "id long, text string")


def test_ids_are_ranks(spark):
    rows = texts(1)
    df = frame(spark, rows).repartition(6)
    assert sorted(map(tuple, V.learn(df).collect()), key=lambda r: r[2]) == learned(rows)
    assert sorted(map(tuple, V.learn(df, min_count=3).collect()), key=lambda r: r[2]) == learned(rows, 3)
    assert sorted(map(tuple, V.learn(df, size=7).collect()), key=lambda r: r[2]) == learned(rows)[:5]
    assert V.learn(df.limit(0)).collect() == []


@pytest.mark.parametrize("sent", [10**6, 0])
def test_encoding_and_back(spark, monkeypatch, sent):
    monkeypatch.setattr(lookup, "HOT_SHARE", 20)
    rows = texts(2)
    df = frame(spark, rows)
    known = {w: i for w, _, i in learned(rows, 2)}
    vocabulary = V.learn(df, min_count=2)
    coded = V.encode(df.withColumn("word", F.lit("keep")), vocabulary, sent=sent)
    wanted = sorted((i // 2, t, [known.get(w, 1) for w in (t or "").lower().split()]) for i, t in enumerate(rows) if t is not None)
    assert sorted((r.id, r.text, r.input_ids) for r in coded.collect() if r.text is not None) == wanted
    assert [r.input_ids for r in coded.filter("text is null").collect()] == [[]]
    full = V.learn(df)
    back = V.decode(V.encode(df, full, sent=sent), full, sent=sent)
    assert all(r.decoded == " ".join((r.text or "").lower().split()) for r in back.collect()) and back.count() == len(rows)
    padded = spark.createDataFrame([([2, 1, 0, 0],), ([],), (None,)], "input_ids array<long>")
    assert [r.decoded for r in V.decode(padded, full, sent=sent).orderBy(F.desc(F.size("input_ids"))).collect()] == [
        learned(rows)[0][0] + " [UNK]", "", ""]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_expansion_equals_the_literal_rule(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "HOT_SHARE", 5)
    rng = random.Random(3)
    ws = ["dont", "Don't", "'dont", "im", "I'm", "y'all've", "ok", "Zoë", "can't", "''", "it's", "gonna"]
    seps = [" ", "\n", ", ", "-", "…", "  "]
    rows = ["".join(rng.choice(ws) + rng.choice(seps) for _ in range(rng.randint(0, 25))) for _ in range(60)]
    rows += [None, "", "no hit here", "dont " * 3000, rows[0], rows[0]]
    df = frame(spark, rows).withColumn("key", F.lit("keep"))
    table = spark.createDataFrame(list(terms.CONTRACTIONS.items()), "key string, value string")
    got = V.expand(df, table, limit=limit)
    wanted = df.withColumn("expanded", T.expand_contractions("text"))
    order = lambda r: (r.id, r.text or "", r.expanded or "")
    assert sorted(got.collect(), key=order) == sorted(wanted.collect(), key=order)


def test_a_million_keys(spark):
    table = spark.range(1_000_000).selectExpr("concat('k', id) as key", "concat('value ', id) as value")
    df = spark.range(2000).selectExpr("id", "concat('K', id * 499, ' and k', id, ', kx') as text")
    got = {r.id: r.expanded for r in V.expand(df, table, limit=1000).collect()}
    assert got == {i: (f"Value {i * 499}" if i * 499 < 10**6 else f"K{i * 499}") + f" and value {i}, kx" for i in range(2000)}


def test_what_is_dealt_grows_with_distinct_words_of_a_chunk(spark, monkeypatch):
    written, cut = [], lookup.cut_lineage

    def counted(df):
        found = cut(df)
        written.append(found.count())
        return found

    monkeypatch.setattr(lookup, "cut_lineage", counted)
    df = spark.range(0, 40, 1, 2).selectExpr("id", "concat(repeat('the Of ', 1000), 'w', id) as text")
    words = V.learn(df)
    back = V.decode(V.encode(df, words, sent=0), words, sent=0)
    assert {r.id: r.decoded for r in back.collect()} == {i: "the of " * 1000 + f"w{i}" for i in range(40)}
    assert 0 < max(written) < 100   # 80,000 words


def test_many_chunks_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(lookup, "CHUNK_BYTES", 500)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        df = spark.range(0, 100, 1, 2).selectExpr("id", "if(id % 9 = 0, null, concat('w', id % 13, ' x', id, ' w1')) as text")
        words = V.learn(df)
        back = V.decode(V.encode(df, words, sent=0), words, sent=0).collect()
        assert len(back) == 100 and all(r.decoded == (r.text or "") for r in back)
        kept = V.encode(df, words, sent=0, keep=["id"])
        assert kept.columns == ["id", "input_ids"] and kept.count() == 100
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_expansion_deals_distinct_words_of_a_chunk(spark, monkeypatch):
    written, cut = [], lookup.cut_lineage

    def counted(df):
        found = cut(df)
        written.append(found.count())
        return found

    monkeypatch.setattr(lookup, "cut_lineage", counted)
    df = spark.range(0, 40, 1, 2).selectExpr("id", "concat(repeat('the Of ', 1000), 'w', id) as text")
    table = spark.createDataFrame([("the", "a"), ("w7", "seven")], "key string, value string")
    got = {r.id: r.expanded for r in V.expand(df, table, limit=0).collect()}
    assert got == {i: "a Of " * 1000 + ("seven" if i == 7 else f"w{i}") for i in range(40)}
    assert 0 < max(written) < 100   # 80,000 words
