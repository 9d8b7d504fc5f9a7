import hashlib
import re

import pytest

from tessera.llm import pii_boost

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ROWS = 1600


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 13 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    return True


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def check(df):
    for r in df.collect():
        wanted = base(r["text_copy"])
        assert r["base_sha256"] == hashlib.sha256(",".join(wanted).encode()).hexdigest(), (r["text_copy"] or "")[:90]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x.startswith(k) for x in wanted) for k in PATTERNS]
        assert set(wanted) <= set(r["spans"].split(","))


@pytest.fixture(scope="module")
def texts(spark):
    made = [
        "a@b.c_d@e.f", "x..y@z.w..q@r.s", "a@b", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.4", "0255.1.1.1", "+1 (614) 555-8001.",
        "+49 89 1234567 +12 34", "4111 1111 1111 1111", "4111  1111", "5" * 5000, "1 " * 9000, "a@" + "b." * 3000 + "c", "🎉 é a@b.co 日 1.1.1.1",
        "3782 822463 10005 and 4111-1111-1111-1111-", "+" * 50 + "12345678901", "1.1.1.1.", "9" * 13 + " " + "0" * 13, None, ""]
    return spark.createDataFrame([(t, t) for t in made], "text string, text_copy string")


def test_base_spans(texts):
    check(pii_boost.detect(texts, rows=ROWS))


def test_documents(sample):
    check(pii_boost.detect(sample.withColumn("text_copy", sample.text), rows=ROWS))


def test_method_adds_spans_and_leaves_clean_text(spark):
    yes = ["please mail me ann7 (at) example (dot) com today", "call (614) 555-8001 now", "our server 10[.]20[.]30[.]40 is down"]
    no = ["order 1234 5678 9012 3456 shipped", "the year 1990-2000 was good", "look (at) house. and go", "version 1.2.3", "plain words only"]
    rows = pii_boost.detect(spark.createDataFrame([(t,) for t in yes + no], "text string").withColumn("t", pii_boost.F.col("text"))).collect()
    got = {r["t"]: r["spans"] for r in rows}
    assert all(got[t] for t in yes), got
    assert not any(got[t] for t in no), got


def test_redacted_table(odd, none):
    done = pii_boost.redact(odd, chars="n_chars", rows=ROWS)
    assert done.columns == odd.columns
    rows = done.collect()
    assert len(rows) == odd.count() and all(r["_base"] == "keep _base" for r in rows)
    text = next(r for r in rows if r["doc_id"] == 8)
    assert text["text"] == "mail <EMAIL> or <PHONE> from <IP>, card <CARD>" and text["n_chars"] == len(text["text"])
    assert next(r for r in rows if r["doc_id"] == 2)["text"] is None
    assert pii_boost.detect(none, rows=ROWS).count() == 0
