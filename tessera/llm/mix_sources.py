"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 5).

DataFrame functions only.  Targets come from the per-source sizes.  A source gives its whole
epochs first; the rest of its target is filled by documents in the order of their keys
``-ln(u) / weight`` (u from a digest of the id, weight from the text), summed up as a prefix.

No source is ranked in one task: sizes are summed by (source, bucket of the key), the bucket
in which the budget ends is summed by finer buckets, and only the finest one (a share of
about 1 / ``BUCKETS`` squared of a source) is ranked, which gives the last key the source
takes.  Each document is then compared with that key.

Defined cases: null texts have no words; null sources are one source, the last; empty sources
have target 0; rows with equal id and size are taken or left together; a null id is digested
as an empty one; other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, hide, join_lookup, restore, whole, word_list

SHARES = (5, 2, 1)
TOTAL = 1.5
MOST_EPOCHS = 2.0
BUCKETS = 4096
#: How much a share of symbols lowers a document's weight.
SYMBOL_PENALTY = 100.0
SYMBOLS = "#*$%&|<>"


def quality_weight(text: Column) -> Column:
    """Between 0 and 1: less the more of the text is symbols."""
    text = whole(text)
    n = F.length(text)
    share = (n - F.length(F.translate(text, SYMBOLS, ""))) / F.greatest(n, F.lit(1))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(SYMBOL_PENALTY) * share)


def _keyed(docs: DataFrame, text: str, source: str, doc_id: str, weight: Column | None) -> DataFrame:
    """(_id, _source, _size, _key) beside the other columns."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)
    weight = quality_weight(F.col(text)) if weight is None else weight
    return docs.withColumns({
        "_id": F.col(doc_id), "_source": F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("")),
        "_size": F.size(word_list(whole(text))).cast("long"), "_key": -F.log(u) / weight})


def targets(sizes: DataFrame, shares: tuple[int, ...] = SHARES, total: float = TOTAL,
            most: float = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (_source, source_size) with target: the sources' windows run over one row
    per source in one task, so sources are few beside documents."""
    order = W.orderBy((F.col("_source") == "").cast("int"), "_source")
    n = F.row_number().over(order)
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in shares]), (n - 1) % len(shares) + 1)
    found = sizes.withColumn("weight", weight).withColumn("most", F.lit(most) * F.col("source_size"))
    by_limit = W.orderBy(F.col("most") / F.col("weight"), "_source")
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    found = found.withColumns({
        "left": F.lit(total) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("most").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    level = F.col("left") / F.col("open")
    # the first source that the level does not fill: its level holds for all that follow
    fits = F.when(level * F.col("weight") <= F.col("most"), level)
    found = found.withColumn("level", F.first(fits, ignorenulls=True).over(
        by_limit.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return found.select("_source", "source_size", F.coalesce(
        F.least("most", F.col("level") * F.col("weight")), F.col("most")).alias("target"))


def _bucket(level: int) -> Column:
    return F.floor(F.col("_key") / (F.col("_key") + 1.0) * F.lit(float(BUCKETS ** level))).cast("long")


def _cut_bucket(sums: DataFrame, bucket: str, start: str, to: str) -> DataFrame:
    """Per source, the first bucket whose words go over the budget, and the words before it."""
    w = W.partitionBy("_source").orderBy(bucket)
    run = sums.withColumn("upto", F.col(start) + F.sum("words").over(w))
    found = run.filter(F.col("upto") > F.col("budget")).groupBy("_source").agg(
        F.min(F.struct(bucket, (F.col("upto") - F.col("words")).alias("before"))).alias("c"))
    return found.select("_source", F.col(f"c.{bucket}").alias(to), F.col("c.before").alias(f"{to}_before"))


def plan(keyed: DataFrame) -> DataFrame:
    """One row per source: source_size, target, epochs and last (the last key that gets one
    epoch more: key, id, size; null if none does)."""
    sizes = cut(keyed.groupBy("_source").agg(F.sum("_size").alias("source_size")))
    goal = targets(sizes).withColumn("epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
    goal = cut(goal.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    first = keyed.groupBy("_source", _bucket(1).alias("b1")).agg(F.sum("_size").alias("words"))
    cut1 = cut(_cut_bucket(join_lookup(first, goal.select("_source", "budget"), "_source").withColumn(
        "zero", F.lit(0)), "b1", "zero", "c1").join(goal.select("_source", "budget"), "_source"))
    inside = join_lookup(keyed, cut1, "_source").filter(_bucket(1) == F.col("c1"))
    second = inside.groupBy("_source", _bucket(2).alias("b2")).agg(
        F.sum("_size").alias("words"), F.first("budget").alias("budget"), F.first("c1_before").alias("c1_before"))
    cut2 = cut(_cut_bucket(second, "b2", "c1_before", "c2"))
    inside = join_lookup(inside, cut2, "_source").filter(_bucket(2) == F.col("c2"))
    order = W.partitionBy("_source").orderBy("_key", "_id", "_size")
    inside = inside.withColumn("upto", F.col("c2_before") + F.sum("_size").over(order))
    took = inside.filter(F.col("upto") - F.col("_size") / 2 <= F.col("budget"))
    last = took.groupBy("_source").agg(F.max(F.struct("_key", "_id", "_size")).alias("last"))
    return (goal.join(cut1.select("_source", "c1"), "_source", "left").join(cut2.select("_source", "c2"), "_source", "left")
            .join(last, "_source", "left"))


def _epochs() -> Column:
    """Times that a document of a keyed table with its source's plan is taken."""
    more = (F.when(F.col("c1").isNull(), True)   # the budget is never passed: the whole source fits
            .when(_bucket(1) != F.col("c1"), _bucket(1) < F.col("c1"))
            .when(_bucket(2) != F.col("c2"), _bucket(2) < F.col("c2"))
            .otherwise(F.coalesce(F.struct("_key", "_id", "_size") <= F.col("last"), F.lit(False))))
    return F.col("epochs") + F.when((F.col("budget") > 0) & more, 1).otherwise(0)


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weight: Column | None = None) -> DataFrame:
    """Per row: doc_id, size, source_size, target and taken (words, repeats counted)."""
    narrow = cut(_keyed(docs, text, source, doc_id, weight).select("_id", "_source", "_size", "_key"))
    done = join_lookup(narrow, cut(plan(narrow)), "_source")
    return done.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
                       (_epochs() * F.col("_size")).alias("taken"))


def repeat(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
           weight: Column | None = None) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its epochs say.

    A ``weight`` of one's own is a column expression that does not name columns of ``docs``."""
    hidden, names = hide(docs)
    keyed = _keyed(hidden, names[text], names[source], names[doc_id], weight)
    found = cut(plan(cut(keyed.select("_id", "_source", "_size", "_key"))))
    done = join_lookup(keyed, found.drop("source_size", "target"), "_source")
    times = F.array_repeat(F.lit(0), _epochs().cast("int"))
    return restore(done.withColumn("_time", F.explode(times)), names)


def oracle_sql() -> str:
    """The mix of ``documents`` in DuckDB, with one window per source."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
k AS (
  SELECT r, doc_id, source, size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE))
             / CAST({2 ** 52} AS DOUBLE))
         / (CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + CAST({SYMBOL_PENALTY} AS DOUBLE)
            * ((length(t) - length(translate(t, '{SYMBOLS}', ''))) / greatest(length(t), 1)))) AS key
  FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
o AS (SELECT *, CAST({list(SHARES)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(SHARES)} + 1] AS DOUBLE) AS weight,
             CAST({MOST_EPOCHS} AS DOUBLE) * source_size AS most FROM s),
l AS (SELECT *, (CAST({TOTAL} AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(most) OVER b, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM o WINDOW b AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT level FROM l WHERE level * weight <= most ORDER BY most / weight, source NULLS LAST LIMIT 1),
g AS (SELECT source, source_size, coalesce(least(most, (SELECT level FROM v) * weight), most) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM g),
f AS (SELECT k.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size) AS upto
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN budget > 0 AND upto - size / 2 <= budget THEN size ELSE 0 END AS BIGINT) AS taken
FROM f"""
