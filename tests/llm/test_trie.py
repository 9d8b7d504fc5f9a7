"""The prefix trie against a brute-force version and its SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """(conv_id, turn, role, text) without equal turn numbers, or with equal rows there."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), role or "", text or ""))
    said = {c: [x[1:] for x in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    full = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(said.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    kids, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for key, m in members.items():
        words = len(WORD.findall(key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in kids
            saved[key[:d]] += (len(m) - 1) * words
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(
        ",".join(map(str, sorted(c for c in m if len(full[c]) == len(k)))).encode()).hexdigest()) for k, m in members.items())


def got(df, **kw):
    found = prefix_trie.trie(prefix_trie.rebuilt(df), **kw).drop(*prefix_trie.KEY)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in found.collect())


def made(seed, convs, longest, words=3):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        n = rng.choice([1, 2, 3, rng.randint(1, longest)])
        rows += [(c, t if t else rng.choice([0, None]), rng.choice(["u", "a", None]), rng.choice(["x", "y  z", "", None, "a b c"][:words]))
                 for t in range(n)]
    rng.shuffle(rows)
    return rows


def test_random_conversations(spark):
    for seed, convs, longest in ((1, range(0, 130), 6), (2, [*range(5, 60, 3), 1000, 10**12, 7 + 10**12], 5), (3, [4], 3)):
        rows = made(seed, convs, longest)
        assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_deep_conversations_and_narrow_bands(spark):
    rows = made(4, range(0, 45), 90, words=1)
    df = spark.createDataFrame(rows, SCHEMA).cache()
    wanted = brute(rows)
    for band in (2, 3, 16, 200):
        assert got(df, band=band) == wanted, band


def test_a_conversation_in_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(20, t, "u", f"t{t % 7} w") for t in range(400)] + [(21, t, "u", f"t{t % 7} w") for t in range(300)]
        rows += [(22, 5, "u", "same turn")] * 50 + made(5, range(40, 80), 5)
        df = spark.createDataFrame(rows, SCHEMA)
        parts = df.repartitionByRange("conv_id", "turn").select("conv_id", F.spark_partition_id().alias("p"))
        assert parts.filter("conv_id = 20").distinct().count() > 2
        assert got(df) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_nodes(spark, monkeypatch):
    rows = [(20 * c + 10**6, t, "u", f"m{t}" if c % 3 else f"m{t}{c}") for c in range(900) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(prefix_trie, "HOT", 5)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 10)
    monkeypatch.setattr(prefix_trie, "RUN_BITS", 6)
    assert got(df) == brute(rows)


def test_odd_cases(spark):
    rows = [(None, 0, "u", "x"), (1, None, None, None), (1, 0, "", ""), (0, 3, "u", "long " * 200_000), (0, 3, "u", "long " * 200_000),
            (3, None, "u", "a"), (45, 0, "u", "gone"), (59, 1, "a", "ÄÖ 🎉\u0000")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("keep") for c in ("conv", "depth", "part", "n1", "words", "h", "place")})
    assert got(df) == brute(rows)
    assert any(zlib.crc32(str(c).encode()) % 4 > 1 for c in (45, 59))   # one is left without turns or keeps few
    for nobody in ([], [(None, 1, "u", "x")]):
        assert got(spark.createDataFrame(nobody, SCHEMA)) == []


@pytest.mark.parametrize("seed", [7, 8])
def test_sql(spark, seed):
    rows = [(c, t, r, x) for c, t, r, x in made(seed, range(0, 90), 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    with duckdb.connect() as db:
        db.register("conversations", df.toArrow())
        found = db.sql(prefix_trie.oracle_sql()).fetchall()
    assert sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in found) == brute(rows) == got(df)
