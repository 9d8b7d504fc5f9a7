import math
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import kn_quality


TOKEN = re.compile(" ?[\u3040-\u30ff\u3400-\u9fff]| ?[^\\W\u3040-\u30ff\u3400-\u9fff]+| ?[^\\w\\s]|\\s")


def discounts(counts):
    n = Counter(counts)
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    return [0] + [min(float(j), max(0.1, j - (j + 1) * y * n[j + 1] / n[j])) if n[j] else 0.5 for j in (1, 2, 3)]


def model(top, order, floor):
    """p(gram) by the textbook's recursion, from the counts of the longest n-grams."""
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    less = {k: discounts(c.values()) for k, c in counts.items()}

    def p(g):
        k = len(g)
        if not k:
            return floor
        same = [c for h, c in counts[k].items() if h[:-1] == g[:-1]]
        low = p(g[1:]) if k > 1 else floor(g[0]) if callable(floor) else floor
        freed, c = sum(less[k][min(c, 3)] for c in same), counts[k].get(g, 0)
        return (c - less[k][min(c, 3)] + freed * low) / sum(same) if same else low

    return p


def brute(texts, trusted):
    """Perplexities from tuples of words and characters."""
    letter = lambda c: ord(c) - 32 if 32 <= ord(c) < 127 else 95 + ord(c) % 31
    spell = lambda w: [126, 126, *map(letter, w), 127]
    grams = lambda x, n: [tuple(x[i - n + 1:i + 1]) for i in range(n - 1, len(x))]
    words = {w for t in trusted for w in TOKEN.findall(t)}
    letters = model(Counter(g for w in words for g in grams(spell(w), 3)), 3, 1 / 128)
    spelled = lambda w: math.prod(letters(g) for g in grams(spell(w), 3))
    p = model(Counter(g for t in trusted for g in grams(["", *TOKEN.findall(t)], 2)), 2, spelled)
    return {i: math.exp(-sum(math.log(p(g)) for g in grams(["", *TOKEN.findall(t)], 2)) / len(t)) if t else None for i, t in texts.items()}


@pytest.mark.parametrize("trusted", [["the cat sat on the mat", "the dog sat on the log", "a cat and  a_dog!", "日本語 and the ñandú\n\t x"], []])
def test_perplexity_is_the_textbook_one(spark, trusted):
    other = ["the cat", "zzz qqq", "", "日本", "on the log sat the 🎉", " ", "  a\u3000b"]
    rows = [(i, t, i < len(trusted)) for i, t in enumerate(trusted + other)] + [(99, None, False)]
    got = kn_quality.word_perplexity(spark.createDataFrame(rows, "doc_id long, text string, _train boolean")).collect()
    wanted = brute({i: t or "" for i, t, _ in rows}, trusted)
    assert len(got) == len(rows)
    for r in got:
        assert (r._ppl is None) == (wanted[r.doc_id] is None)
        if r._ppl is not None:
            assert r._ppl == pytest.approx(wanted[r.doc_id], rel=1e-4), r.text


def test_words_are_those_of_the_pattern(sample):
    texts = ["", "  two  blanks ", "a-b_c 1.5 \t\r\n x", "日本語 ab日c", "e\u0301 🎉🎉", *(r.text for r in sample.limit(50).collect())]
    got = kn_quality.Words(pa.array(texts))
    of = {}
    for i, t in enumerate(texts):
        own = TOKEN.findall(t or "")
        keys = got.key[got.to[i]:got.to[i + 1]].tolist()
        assert len(keys) == len(own)
        for w, k in zip(own, keys, strict=True):
            assert of.setdefault(w, k) == k
    assert len(set(of.values())) == len(of)


def test_very_long_words_are_unlikely(spark):
    rows = [(i, t, i < 3) for i, t in enumerate(["the cat sat on the mat"] * 3 + ["zqx" * 400_000, "the cat", "a " * 500_000])]
    got = {r.doc_id: r for r in kn_quality.word_perplexity(spark.createDataFrame(rows, "doc_id long, text string, _train boolean")).collect()}
    assert got[3]._chars == 1_200_000 and got[3]._ppl > 10 * got[4]._ppl and got[5]._chars == 1_000_000


def test_several_chunks_agree(spark, sample, monkeypatch):
    docs = sample.withColumn("_train", F.col("doc_id") % 2 == 0)
    one = {r.doc_id: r._ppl for r in kn_quality.word_perplexity(docs).collect()}
    monkeypatch.setattr(kn_quality, "CHUNK_CHARS", 50_000)
    monkeypatch.setattr(kn_quality, "BUCKET_CHARS", 20_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {r.doc_id: r._ppl for r in kn_quality.word_perplexity(docs).collect()} == pytest.approx(one)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_junk_goes_and_clean_text_stays(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = kn_quality.classify(docs, labels).join(labels, "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_odd_rows(odd, labels, none):
    kept = kn_quality.keep_good(odd, labels)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert {2, 3} & {r.doc_id for r in rows} == set() and all(r["_ppl"] == "keep _ppl" for r in rows)
    assert sum(r.doc_id == 6 for r in rows) in (0, 2)
    assert kn_quality.classify(none, labels).count() == 0
    # without trusted documents, what has characters stays
    free = kn_quality.classify(odd, labels.limit(0)).collect()
    assert {r.kept for r in free if r.doc_id not in (2, 3)} == {True} and {r.kept for r in free if r.doc_id in (2, 3)} == {False}


def test_word_order_counts_and_unseen_words_are_spelled(spark):
    trusted = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog sat on the rug"] * 5
    other = ["the cat sat on the log", "log the on cat sat the", "the the the the the the", "the cats sat on the log", "the xqzv sat on the log", "", " \n"]
    rows = [(i, t, i < len(trusted)) for i, t in enumerate(trusted + other)] + [(99, None, False)]
    got = {r.text: r._ppl for r in kn_quality.word_perplexity(spark.createDataFrame(rows, "doc_id long, text string, _train boolean")).collect()}
    good, shuffled, repeated, near, far, empty, blank = (got[t] for t in other)
    assert 2 * good < shuffled and 1.5 * good < repeated and good < near < far and empty is None and got[None] is None and blank > 1


def test_word_tables_grow_with_the_text(spark):
    n = {}
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("text").distinct()
        tables = kn_quality.pair_tables(kn_quality.count_pairs(docs, 2), 2)
        n[sf] = kn_quality._counts_of_counts(tables, kn_quality.PAIRS)[4]
    assert n["sf0.01"] > 3 * n["sf0.001"]


def test_waves_leave_no_shuffle_files(spark, sample, monkeypatch):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in map(str, manager.getAllFiles().mkString("\n").split("\n")) if "/shuffle_" in f}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs, setting, before = sample.withColumn("_train", F.col("doc_id") % 2 == 0), spark.conf.get(name), files()
    monkeypatch.setattr(kn_quality, "CHUNK_CHARS", 50_000)
    one = {r.doc_id: r._ppl for r in kn_quality.word_perplexity(docs).collect()}
    for _ in range(50):   # they go shortly after the action
        if left := files() - before:
            time.sleep(0.2)
    assert not left and spark.conf.get(name) == setting
    monkeypatch.setattr(kn_quality, "WAVES", 1)
    assert {r.doc_id: r._ppl for r in kn_quality.word_perplexity(docs).collect()} == pytest.approx(one)


def test_distinct_keys_and_places():
    keys = np.array([5, 3, 5, 9, 3, 0], np.int64)
    found, first, of = kn_quality._grouped(keys)
    assert found.tolist() == kn_quality._distinct(keys).tolist() == [0, 3, 5, 9]
    assert keys[first].tolist() == found.tolist() and found[of].tolist() == keys.tolist()
    assert len(kn_quality._distinct(keys[:0])) == 0 and all(len(x) == 0 for x in kn_quality._grouped(keys[:0]))
