"""Quality rules with host verdicts (operator 4).

DataFrame functions only.  Each document is tested by its own rules in one pass over its
text; failures are then added up by host (here: ``source``), each host's failure rates are
shrunk towards those of all hosts by a beta prior fitted to the hosts (moments), and a host
one of whose shrunk rates is over ``HOST_LIMIT`` loses all its documents.  The counts are
pre-aggregated before the shuffle, so a host with a third of all rows is no hot task.

Defined cases: a null text has no words and fails; null hosts are one host; with one host, or
hosts that do not differ, the prior has the strength ``MOST_STRENGTH``; other columns pass
through :func:`keep`; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, join_lookup, whole, word_list, BLANKS

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: A host whose shrunk rate of a failed rule is over this loses its documents.
HOST_LIMIT = 0.6
#: Documents that the prior counts for, at most and at least.
MOST_STRENGTH, LEAST_STRENGTH = 1000.0, 1.0


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes; equal ones are neighbours after sorting (hash,
    place), and the words that their places cover are added up in order of place."""
    n = F.size(words)
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
        F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))).otherwise(
        F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(placed, lambda s: _let(F.array_sort(F.transform(F.filter(
            F.transform(s, lambda x, k: F.struct(
                x.i.alias("i"),
                ((F.coalesce(F.get(s, k - 1).h == x.h, F.lit(False)))
                 | F.coalesce(F.get(s, k + 1).h == x.h, F.lit(False))).alias("twice"))),
            lambda x: x.twice), lambda x: x.i)), lambda p: F.coalesce(F.aggregate(
                F.transform(p, lambda x, k: F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - x), F.lit(3))),
                F.lit(0), lambda a, x: a + x), F.lit(0))))

    return _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_m`` of the counts that the rules test."""
    t = whole(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _let(lines, lambda x: F.size(x)).cast("long").alias("n_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"))

    return docs.withColumn("_m", _let(word_list(t), counts))


def rules(m: str = "_m") -> dict[str, Column]:
    """Rule name -> whether a document fails it."""
    c = lambda x: F.col(f"{m}.{x}")
    return {
        "base": (c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > 50 * c("n_words")),
        "symbols": 10 * c("n_symbols") > c("word_chars"),
        "lines": 10 * c("n_dup_lines") > 3 * c("n_lines"),
        "length": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words")),
    }


def hosts(measured: DataFrame, host: str = "_host") -> DataFrame:
    """(host, documents, failure counts) of a measured table."""
    return measured.groupBy(host).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(failed.cast("long")).alias(f"f_{name}") for name, failed in rules().items()])


def verdicts(counted: DataFrame, host: str = "_host", limit: float = HOST_LIMIT) -> DataFrame:
    """(host, host_rejected): rates shrunk by a beta prior of the moments over the hosts.

    With m the rate over all documents and v the weighted variance of the hosts' rates beyond
    what their size explains, the prior counts for m (1 - m) / v - 1 documents."""
    names = list(rules())
    total = counted.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("H"), *[
        F.sum(f"f_{x}").alias(f"F_{x}") for x in names]).first()   # one row
    documents = total["N"] or 1
    rate = {x: (total[f"F_{x}"] or 0) / documents for x in names}
    spread = counted.agg(*[F.sum(F.col("n") * F.pow(F.col(f"f_{x}") / F.col("n") - rate[x], 2)).alias(x)
                           for x in names]).first()
    rejected = F.lit(False)
    for x in names:
        noise = rate[x] * (1 - rate[x])
        between = ((spread[x] or 0.0) - (total["H"] - 1) * noise) / documents
        strength = min(MOST_STRENGTH, max(LEAST_STRENGTH, noise / between - 1)) if between > 0 else MOST_STRENGTH
        rejected = rejected | ((F.col(f"f_{x}") + strength * rate[x]) / (F.col("n") + strength) > limit)
    return counted.select(host, rejected.alias("host_rejected"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, the counts, base_failed, host_rejected and kept."""
    measured = measure(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.concat(F.lit("s"), F.col(host).cast("string")), F.lit("")).alias("_host")))
    measured = cut(measured.drop("text"))   # the texts are read once
    done = join_lookup(measured, cut(verdicts(cut(hosts(measured)))), "_host")
    failed = rules()["base"]
    return done.select("doc_id", "_m.*", failed.alias("base_failed"), "host_rejected",
                       (~failed & ~F.col("host_rejected")).alias("kept"))


def oracle_sql() -> str:
    """The verdicts on ``documents`` in DuckDB."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
x AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
y AS (SELECT r, i, x, lead(x) OVER o AS x1, lead(x, 2) OVER o AS x2 FROM x WINDOW o AS (PARTITION BY r ORDER BY i)),
z AS (SELECT r, i, count(*) OVER (PARTITION BY r, x, x1, x2) AS n FROM y WHERE x2 IS NOT NULL),
p AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM z WHERE n > 1) GROUP BY r),
c AS (
  SELECT r, doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(p.n, 0) AS n_repeat_words
  FROM d LEFT JOIN p USING (r)),
m AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > word_chars AS f2, 10 * n_dup_lines > 3 * n_lines AS f3,
         word_chars < 2 * n_words OR word_chars > 15 * n_words AS f4 FROM c),
q AS (SELECT source, count(*) AS n, [count(*) FILTER (WHERE base_failed), count(*) FILTER (WHERE f2),
             count(*) FILTER (WHERE f3), count(*) FILTER (WHERE f4)] AS fs FROM m GROUP BY source),
h AS (SELECT source, n, unnest([1, 2, 3, 4]) AS rule, unnest(fs) AS f FROM q),
t AS (SELECT rule, sum(n) AS docs, count(*) AS hosts, sum(f) / sum(n) AS rate FROM h GROUP BY rule),
v AS (SELECT rule, docs, hosts, rate, rate * (1 - rate) AS noise,
             (sum(n * (f / n - rate) * (f / n - rate)) - (hosts - 1) * rate * (1 - rate)) / docs AS between_
      FROM h JOIN t USING (rule) GROUP BY rule, docs, hosts, rate),
s AS (SELECT rule, rate, CASE WHEN between_ > 0 THEN least({MOST_STRENGTH}, greatest({LEAST_STRENGTH}, noise / between_ - 1))
                         ELSE {MOST_STRENGTH} END AS strength FROM v),
j AS (SELECT source, bool_or((f + strength * rate) / (n + strength) > {HOST_LIMIT}) AS rejected
      FROM h JOIN s USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM m JOIN j ON m.source IS NOT DISTINCT FROM j.source"""
