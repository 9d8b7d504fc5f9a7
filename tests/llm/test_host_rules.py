import re
from collections import Counter

from tessera.llm import host_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    many = Counter(windows)
    inside = {j for i, w in enumerate(windows) if many[w] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside)


def test_counts_and_base(odd, sample):
    for docs in (odd, sample):
        texts = Counter((r.doc_id, counts(r.text)) for r in docs.collect())
        rows = host_rules.judge(docs).collect()
        assert texts == Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows)
        for r in rows:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_bad_host_loses_its_documents_and_small_hosts_are_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good, "fine") for i in range(200)] + [(1000 + i, "too short", "bad") for i in range(150)]
    rows += [(2000 + i, good, "bad") for i in range(10)] + [(3000, "too short", "tiny"), (3001, good, "tiny")]
    rows += [(4000 + 10 * h + i, good, f"host{h}") for h in range(20) for i in range(10)]
    got = {r.doc_id: r.kept for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] for i in range(200)) and not any(got[2000 + i] for i in range(10))
    assert got[3001] and not got[3000]


def test_empty_table(none):
    assert host_rules.judge(none).count() == 0
