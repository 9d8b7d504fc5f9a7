"""Collocations against a brute-force version and their SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import collocations as C

CUTS = re.compile(r"[.,;:!?\x0A-\x0D]")
WORD = re.compile(r"[^\x20\x09]+")
UPPER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def brute(rows, least, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in CUTS.split((text or "").translate(UPPER)):
            words = WORD.findall(piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in candidates.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def made(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "York", "é", "日本", "x y", "a\x1cb", "\u0000", "İ", "zürich", *[f"w{i}" for i in range(12)]]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "; ", "!?"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.choice([5, 24])]) + rng.choice(seps) for _ in range(rng.randint(0, 60)))
        text += rng.choice(["", "new york city hall ", "New York city"])
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return [*rows, (None, "en"), ("", None), (" \t", "xx"), ("...", "en")]


def got(df, **kw):
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


@pytest.mark.parametrize("least,chunk,lookup,entries", [(2, 1 << 20, 1_000_000, 1000), (4, 700, 0, 60)])
def test_against_brute_force(spark, monkeypatch, least, chunk, lookup, entries):
    monkeypatch.setattr(C, "LOOKUP_ROWS", lookup)
    monkeypatch.setattr(C, "ENTRIES", entries)
    rows = made(least)
    df = spark.createDataFrame(rows, "text string, lang string").withColumns(
        {c: F.lit("keep") for c in ("x", "y", "k", "a", "chunk", "id", "rank", "word", "score")})
    wanted = brute(rows, least)
    assert len(wanted) > 50 and got(df, least=least, chunk_bytes=chunk) == wanted


def test_top_and_ties(spark):
    rows = made(9)
    for top in (1, 3, 10):
        assert got(spark.createDataFrame(rows, "text string, lang string"), least=3, top=top) == brute(rows, 3, top)


def test_repeated_rows_and_a_very_long_text(spark):
    rows = [("alpha beta gamma delta, " * 200_000, "en")] + [("alpha beta", "en")] * 40
    wanted = [("en", 1, "alpha beta gamma delta", 200_000, 200_040, 200_000, 800_080, 2_000_000 * 200_000 // 400_040)]
    assert got(spark.createDataFrame(rows, "text string, lang string")) == wanted
    overlap = [("ha ha ha ha", "en")] * 30
    assert got(spark.createDataFrame(overlap, "text string, lang string")) == brute(overlap, 30)


def test_parts_of_a_text_end_after_pieces():
    text = b"one two. three, four five six; " * 50
    parts = list(C._parts(text, 100))
    assert b"".join(parts) == text and len(parts) > 10 and all(p[-1:] in b".,;" for p in parts[:-1])
    assert list(C._parts(b"no piece ends here " * 50, 100)) == [b"no piece ends here " * 50]


def test_ids_of_32_bits():
    big = (1 << 32) - 1
    ids, flags = np.array([big, 5, big, big, 0, 7]), np.array([True, True, False, False, False, False])
    _, x, y = C.merge_join(ids, flags, 4)
    assert [v & (1 << 64) - 1 for v in x.tolist()] == [big << 32 | 5]
    assert [v & (1 << 64) - 1 for v in y.tolist()] == [big << 32 | big]


def test_empty_tables(none):
    assert got(none) == [] and C.collocations(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_sql(spark):
    rows = made(12, 60)
    rows = [(t.replace("\u0000", "n"), x) if t else (t, x) for t, x in rows]
    with duckdb.connect() as db:
        db.register("documents", spark.createDataFrame(rows, "text string, lang string").toArrow())
        found = sorted(db.sql(C.oracle_sql(least=3)).fetchall())
    assert found == brute(rows, 3)
