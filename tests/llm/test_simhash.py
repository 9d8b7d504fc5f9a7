from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash_pivots


def fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c not in "\t\n\x0b\x0c\r" else " "
                                for c in text or "").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(items, linked):
    """Smallest item of each item's component."""
    parent = {x: x for x in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in linked:
        a, b = sorted((root(x), root(y)))
        parent[b] = a
    return {x: root(x) for x in items}


def near(fps, bits=2):
    a = np.array(sorted(fps), np.int64).view(np.uint64)
    return [(int(a.view(np.int64)[i]), int(a.view(np.int64)[j])) for i in range(len(a))
            for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits) + i + 1]


def test_documents(sample):
    fps = {r.doc_id: fingerprint(r.text) for r in sample.collect()}
    ids = sorted(fps)
    wanted = classes(ids, [(i, j) for i in ids for j in ids if i < j and (fps[i] ^ fps[j]).bit_count() <= 2])
    for r in simhash_pivots.near_duplicates(sample).collect():
        assert r.fingerprint == f"{fps[r.doc_id]:016x}" and r.component_id == wanted[r.doc_id]


def linked_classes(spark, fps, hot=None, monkeypatch=None):
    if hot:
        monkeypatch.setattr(simhash_pivots, "HOT_KEY", hot)
    edges = simhash_pivots.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    got = {r.node: r.root for r in simhash_pivots.components(edges).collect()}
    pairs = [(r.x, r.y) for r in edges.collect()]
    return pairs, {f: got.get(f, f) for f in fps}


def clustered():
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 25):
        x = int(centre)
        for _ in range(20):   # walks of one to three bits, so that chains form
            for b in rng.integers(0, 63, rng.integers(1, 4)):
                x ^= 1 << int(b)
            fps.add(x)
    return fps


def test_no_link_is_lost(spark):
    fps = clustered()
    pairs, got = linked_classes(spark, fps)
    assert sorted(pairs) == sorted(near(fps)) and got == classes(fps, near(fps))


def test_hot_keys_give_the_same_components(spark, monkeypatch):
    fps = clustered()
    _, got = linked_classes(spark, fps, 1, monkeypatch)
    assert got == classes(fps, near(fps))


def test_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    assert {r.root for r in simhash_pivots.components(edges).collect()} == {0}


def test_odd_rows(odd, none):
    rows = simhash_pivots.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = Counter((r.doc_id, r.component_id) for r in rows)
    assert got[2, 2] == got[3, 2] == got[7, 2] == 1 and got[5, 1] == 1 and got[None, 1] == 1   # no words: fingerprint zero
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3, 7)} == {"0" * 16}
    assert simhash_pivots.near_duplicates(none).count() == 0
    kept = simhash_pivots.keep_one(odd)
    assert kept.columns == odd.columns and simhash_pivots.keep_one(none).count() == 0
    texts = Counter((r.doc_id, (r.text or "")[:20]) for r in kept.collect())
    fps = {simhash_pivots.fingerprint(r.text, 3) for r in odd.collect()}
    signed = {f - (1 << 64) if f >= 1 << 63 else f for f in fps}
    assert sum(texts.values()) == len(set(classes(signed, near(signed)).values())) and max(texts.values()) == 1
