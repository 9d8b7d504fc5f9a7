import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import mix_sources

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        goal = {s: 2.0 * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        over = {s for s in order if s not in full and goal[s] > 2 * sizes[s]}
        if not over:
            return goal
        full |= over


def check(docs):
    rows = mix_sources.mix(docs).collect()
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text", "source").collect():
        texts[r.doc_id].append((len(WORD.findall(r.text or "")), r.source))
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, n) for i, x in texts.items() for n, _ in x)
    sizes = Counter()
    for x in texts.values():
        for n, s in x:
            sizes[s] += n
    goal, longest = goals(sizes), max(r["size"] for r in rows)
    taken = Counter()
    for r in rows:
        s = next(s for n, s in texts[r.doc_id] if n == r["size"])
        assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s]) and 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= longest, s
    return rows


def test_documents(sample):
    assert sorted(check(sample)) == sorted(mix_sources.mix(sample).collect())   # reruns agree


def test_odd_rows(odd, none):
    key = lambda r: tuple((x is not None, x) for x in r)
    rows = mix_sources.mix(odd).collect()
    assert len(rows) == odd.count() and sorted(map(key, rows)) == sorted(map(key, mix_sources.mix(odd).collect()))
    assert all(r.taken <= 2 * r["size"] for r in rows)
    assert mix_sources.mix(none).count() == 0


def test_epochs_come_first_and_fractions_follow_the_keys(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"),
                                    F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    rows = mix_sources.mix(docs).collect()
    by = defaultdict(Counter)
    for r in rows:
        by[r.doc_id % 3][r.taken // 4] += 1
    assert by[0] == {2: 1000}                       # at its limit: two whole epochs
    assert set(by[1]) <= {1, 2} and set(by[2]) <= {0, 1}   # one epoch and a part; a part
    assert abs(by[1][2] - 666) <= 1 and abs(by[2][1] - 833) <= 1 or sum(r.taken for r in rows) == pytest.approx(18000, abs=12)


def test_repeated_documents(odd):
    wanted = Counter()
    for r in mix_sources.mix(odd).collect():
        if r["size"]:
            wanted[r.doc_id] += r.taken // r["size"]
    done = mix_sources.repeat(odd)
    assert done.columns == odd.columns
    got = Counter(r.doc_id for r in done.collect() if WORD.search(r.text or ""))
    assert got == Counter({k: n for k, n in wanted.items() if n})
