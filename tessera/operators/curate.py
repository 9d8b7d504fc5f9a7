"""Curation: duplicates, short texts, distributions, weights, deciles, split.

Scale notes (every function here is written for tables far larger than one
executor):

* duplicate detection never groups whole texts of *all* rows: rows are first
  counted by a 64-bit hash (partial aggregation, so a text repeated by a
  third of the table collapses map-side); full texts are compared only for
  rows whose hash repeats.
* joins against key sets are left-semi/anti joins on hashed keys; AQE picks
  broadcast from measured sizes and splits skewed partitions.
* the stratified split ranks rows only inside the one hash bucket per
  stratum where the quota cut falls, never a whole stratum in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import terms
from ..functions.text import word_count


def classes_frame(spark, mapping: dict[int, str] | None = None) -> DataFrame:
    """Dimension table ``classes(label INT, name STRING)`` (fixed, tiny)."""
    mapping = terms.CLASSES if mapping is None else mapping
    return spark.createDataFrame(sorted(mapping.items()), "label INT, name STRING")


# ------------------------------------------------------------------ A1

def _flag_candidates(df: DataFrame, text_col: str, by: list[str]) -> DataFrame:
    """``df`` with ``__h`` and ``__rep`` (set where the text's hash repeats within ``by``)."""
    keyed = df.withColumn("__h", F.xxhash64(text_col))
    repeated = (keyed.groupBy(*by, "__h").agg(F.count("*").alias("__rep")).filter("__rep > 1"))
    same = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in [*by, "__h"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return keyed.alias("a").join(repeated.alias("b"), on, "left").select("a.*", "b.__rep")


def duplicated_texts(df: DataFrame, text_col: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Exact set of (by..., __h, text) whose text occurs more than once."""
    by = list(by)
    cand = _flag_candidates(df.select(*by, text_col), text_col, by).filter("__rep IS NOT NULL")
    return (cand.filter(F.col(text_col).isNotNull()).groupBy(*by, "__h", text_col).count()
            .filter("count > 1").drop("count"))


def drop_all_copies(df: DataFrame, text_col: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """A1: remove every row whose text occurs more than once within ``by``.

    Unlike ``dropDuplicates`` no copy survives.  Nulls are kept (they are
    not texts).  The texts are dealt out once, by hash: rows whose hash is
    single pass straight through, and only the others are grouped by text,
    where a row comes back if its text is single after all (a collision).
    A hot text is folded by the partial aggregate.
    """
    by, columns = list(by), df.columns
    flagged = _flag_candidates(df, text_col, by)
    single = flagged.filter(F.col("__rep").isNull() | F.col(text_col).isNull())
    others = flagged.filter(F.col("__rep").isNotNull() & F.col(text_col).isNotNull())
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    alone = (others.groupBy(*by, "__h", text_col).agg(F.count("*").alias("__n"), F.first(row).alias("__row"))
             .filter("__n = 1"))
    return single.select(*[F.col(f"`{c}`") for c in columns]).unionByName(alone.select("__row.*"))


def duplicate_report(df: DataFrame, label_col: str = "label", order_col: str = "doc_id",
                     text_col: str = "text", n: int = 5, classes: DataFrame | None = None
                     ) -> DataFrame:
    """A2 + O4: the first ``n`` duplicated texts (by text) with their labels.

    ``labels`` lists every class of the copies with its number of copies, in
    order of first copy (``Joy:2/Sadness:1``), so each copy is counted and
    the group state is bounded by the number of classes however many copies
    a text has; ``n_copies`` is their sum.
    """
    classes = classes if classes is not None else classes_frame(df.sparkSession)
    top = duplicated_texts(df, text_col).orderBy(text_col).limit(n)   # <= n rows
    rows = (df.withColumn("__h", F.xxhash64(text_col))
            .join(F.broadcast(top), ["__h", text_col])
            .join(F.broadcast(classes.withColumnRenamed("label", label_col)), label_col, "left"))
    per_label = (rows.groupBy(text_col, F.coalesce("name", F.col(label_col).cast("string"), F.lit("null")).alias("name"))
                 .agg(F.min(order_col).alias("__first"), F.count("*").alias("__n")))
    return (per_label.groupBy(text_col)
            .agg(F.array_sort(F.collect_list(F.struct("__first", "name", "__n"))).alias("__s"),
                 F.sum("__n").alias("n_copies"))
            .select(F.array_join(F.transform("__s", lambda s: F.concat_ws(":", s["name"], s["__n"].cast("string"))), "/")
                    .alias("labels"), F.col(text_col), "n_copies")
            .orderBy(text_col))


# ------------------------------------------------------------- P3 / C16

def filter_short_texts(df: DataFrame, min_words: int = 3, text_col: str = "text") -> DataFrame:
    """Keep rows with at least ``min_words`` whitespace-separated words."""
    return df.filter(word_count(text_col) >= min_words)


def replace_texts(df: DataFrame, value: Column, min_words: int = 0, text_col: str = "text",
                  length_col: str | None = None) -> DataFrame:
    """``df`` with ``text_col`` = ``value`` where that has at least ``min_words`` words, and
    its word count in ``length_col`` if named.

    The value, its count and the test are made in one generator, so no optimizer rule
    can evaluate the value again in a filter, let alone push it below a join.
    """
    made = F.transform(F.array(value), lambda t: F.struct(t.alias("__t"), word_count(t).cast("int").alias("__n")))
    kept = df.withColumn("__x", F.explode(F.filter(made, lambda x: x["__n"] >= min_words)))
    out = kept.withColumn(text_col, F.col("__x.__t"))
    return (out.withColumn(length_col, F.col("__x.__n")) if length_col else out).drop("__x")


def with_length(df: DataFrame, text_col: str = "text", out: str = "length") -> DataFrame:
    """Word-count length column (the default length function, Q12)."""
    return df.withColumn(out, word_count(text_col).cast("int"))


# ------------------------------------------------------------------ A3 / A4

def class_distribution(df: DataFrame, label_col: str = "label", by: Sequence[str] = ("split",),
                       labels: Sequence | None = None) -> DataFrame:
    """A3 + W3 + O3: counts and share of each label within each ``by`` group, in order of
    group and class.  With ``labels`` the grid is dense: each group has a row for each of
    them, with 0 where it has none; labels outside them stay.  The window runs over one
    row per group and class."""
    by = list(by)
    counts = df.groupBy(*by, label_col).agg(F.count("*").alias("n"))
    if labels is not None:
        groups = counts.select(*by).distinct() if by else df.sparkSession.range(1).select()
        kind = dict(df.dtypes)[label_col]
        zero = groups.withColumn(label_col, F.explode(F.array(*[F.lit(x).cast(kind) for x in labels]))
                                 ).withColumn("n", F.lit(0).cast("long"))
        counts = counts.unionByName(zero).groupBy(*by, label_col).agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return counts.withColumn("proportion", F.try_divide(F.col("n"), F.sum("n").over(w))).orderBy(*by, label_col)


def class_weights(df: DataFrame, label_col: str = "label", labels: Sequence | None = None) -> DataFrame:
    """A4: weight = max class count / class count, as float32; a class of ``labels`` that does
    not occur has n = 0 and no weight.  The window runs over one row per class."""
    counts = class_distribution(df, label_col, (), labels).drop("proportion")
    return counts.withColumn(
        "weight", F.try_divide(F.max("n").over(Window.partitionBy()), F.col("n")).cast("float"))


# ------------------------------------------------------------------ A5 / A6

def length_histogram(df: DataFrame, length_col: str = "length", by: Sequence[str] = ("split",),
                     bins: int = 49) -> DataFrame:
    """A5: shared edges ``linspace(0, max, bins + 1)``, density per group.

    Rows are first counted per exact length (partial aggregation; the
    result has at most #groups x #distinct lengths rows), and the global
    maximum, bins and densities are derived from that small table, so the
    input is read once and nothing goes through the driver.  Every group has
    a row for each bin, with n = 0 where it is empty.
    """
    by = list(by)
    per_len = df.groupBy(*by, length_col).agg(F.count("*").alias("__n"))
    mx = F.max(length_col).over(Window.partitionBy())            # over the small table
    t = per_len.withColumn("__mx", mx.cast("double"))
    width = F.when(F.col("__mx") > 0, F.col("__mx") / F.lit(float(bins))).otherwise(F.lit(1.0))
    b = F.least(F.floor(F.col(length_col) * F.lit(float(bins))
                        / F.when(F.col("__mx") > 0, F.col("__mx")).otherwise(F.lit(1.0))) + 1,
                F.lit(bins)).cast("int")
    filled = t.select(*by, b.alias("bin"), F.col("__n").alias("n"), width.alias("__width"))
    empty = (filled.groupBy(*by).agg(F.first("__width").alias("__width")) if by
             else filled.agg(F.first("__width").alias("__width")).filter("__width IS NOT NULL"))
    empty = empty.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins)))).withColumn("n", F.lit(0).cast("long"))
    counts = (filled.unionByName(empty).groupBy(*by, "bin")
              .agg(F.sum("n").alias("n"), F.first("__width").alias("__width")))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return (counts
            .withColumn("lo", (F.col("bin") - 1) * F.col("__width"))
            .withColumn("hi", F.col("bin") * F.col("__width"))
            .withColumn("density", F.col("n") / (F.sum("n").over(w) * F.col("__width")))
            .drop("__width"))


def length_stats(df: DataFrame, length_col: str = "length", by: Sequence[str] = ("split",)
                 ) -> DataFrame:
    """Mean and exact median length per group."""
    return df.groupBy(*by).agg(F.count("*").alias("n_docs"),
                               F.avg(length_col).alias("mean_length"),
                               F.percentile(length_col, 0.5).alias("median_length"))


# ------------------------------------------------------------------ A7 / W1

DECILES = [i / 10 for i in range(11)]


def length_deciles(df: DataFrame, length_col: str = "length", rank_error: float | None = None) -> list[float]:
    """The 11 decile values (linear interpolation) as driver floats.

    ``percentile`` keeps a value->count map per partial aggregate, so its
    state is bounded by the number of distinct lengths, not rows.  For columns
    with too many distinct values for that, ``rank_error`` chooses a mergeable summary of some
    1 / ``rank_error`` entries instead: each value then is one of the column's whose rank is wrong by at
    most that share of the rows.
    """
    wanted = F.array(*[F.lit(q) for q in DECILES])
    if rank_error is None:
        found = F.percentile(length_col, wanted)
    else:
        if not 0 < rank_error < 1:
            raise ValueError("rank_error is a share of the rows between 0 and 1")
        found = F.percentile_approx(F.col(length_col).cast("double"), wanted, round(1 / rank_error))
    row = df.agg(found).first()
    return [float(v) for v in row[0]] if row and row[0] is not None else []


def decile_bin(length: Column, edges: Sequence[float]) -> Column:
    """Number of inner decile edges <= length (0..9), like np.digitize."""
    inner = F.array(*[F.lit(round(e, 9)) for e in list(edges)[1:-1]])
    return F.size(F.filter(inner, lambda e: e <= length))


def with_strat_key(df: DataFrame, edges: Sequence[float], label_col: str = "label",
                   length_col: str = "length") -> DataFrame:
    return (df.withColumn("length_bin", decile_bin(F.col(length_col), edges))
            .withColumn("strat_key", F.concat_ws("_", F.col(label_col).cast("string"),
                                                 F.col("length_bin").cast("string"))))


# ------------------------------------------------------------------ W2

def stratum_quotas(counts: DataFrame, strat_col: str, fraction: float) -> DataFrame:
    """Exact per-stratum quotas summing to ceil(fraction * N), largest remainder, where N
    counts the strata of more than one row: a single row stays in train (see
    :func:`singleton_strata`).

    ``counts`` holds one row per stratum with its size ``n``, so the
    un-partitioned windows here see only (#strata) rows; products are
    decimals, as two sizes of 5e9 overflow a long.
    """
    all_ = Window.partitionBy()
    exact = lambda c: c.cast("decimal(38,0)")
    counts = counts.withColumn("__m", F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0).cast("long")))
    total = F.sum("__m").over(all_)
    num = round(fraction * 1_000_000)       # fraction as k/1e6
    n_val = F.ceil(exact(total) * F.lit(num).cast("decimal(10,0)") / F.lit(1_000_000).cast("decimal(10,0)")).cast("long")
    q = counts.withColumn("__nval", n_val).withColumn("__total", total)
    share = exact(F.col("__nval").cast("decimal(19,0)") * F.col("__m").cast("decimal(19,0)"))
    q = q.withColumn("__share", share)
    q = q.withColumn("__base", F.when(F.col("__total") > 0, F.expr("__share div __total")).otherwise(0).cast("long"))
    q = q.withColumn("__rem", F.col("__share") - F.col("__base").cast("decimal(19,0)") * F.col("__total").cast("decimal(19,0)"))
    q = q.withColumn("__extra", F.col("__nval") - F.sum("__base").over(all_))
    rank = F.row_number().over(Window.orderBy(F.desc("__rem"), F.asc(strat_col)))
    return q.withColumn("quota", F.col("__base") + F.when(rank <= F.col("__extra"), 1).otherwise(0)
                        ).select(strat_col, "n", "quota")


def singleton_strata(df: DataFrame, strat_col: str = "strat_key") -> DataFrame:
    """The strata of a single row, which the split leaves in train."""
    return df.groupBy(strat_col).agg(F.count("*").alias("n")).filter("n = 1").drop("n")


def stratified_split(df: DataFrame, strat_col: str = "strat_key", id_col: str = "doc_id",
                     fraction: float = 0.2, seed: int = 42, bucket_bits: int = 16,
                     split_col: str = "split") -> DataFrame:
    """Exact stratified split; the ``fraction`` share goes to 'validation'.

    Within each stratum rows are ordered by ``md5('{seed}:{id}')`` and the
    first ``quota`` rows are validation.  To avoid ranking a whole stratum
    in one task, rows are bucketed by the leading ``bucket_bits`` bits of
    the key; bucket counts locate the bucket holding the cut, and only that
    bucket is ranked.  Every other row is decided by comparison alone.

    The input is read by the bucket count and by the two decision branches,
    so pass a materialised frame when it is expensive to recompute (see
    :func:`tessera.plans.pipelines.preprocess`).
    """
    hexd = (bucket_bits + 3) // 4
    keyed = (df.withColumn("__ord", F.md5(F.concat_ws(":", F.lit(str(seed)),
                                                       F.col(id_col).cast("string"))))
             .withColumn("__b", F.conv(F.substring("__ord", 1, hexd), 16, 10).cast("long")))
    # One aggregation feeds both the quotas and the cumulative bucket counts.
    per_bucket = keyed.groupBy(strat_col, "__b").agg(F.count("*").alias("__bn"))
    quotas = stratum_quotas(per_bucket.groupBy(strat_col).agg(F.sum("__bn").alias("n")),
                            strat_col, fraction)
    wcum = Window.partitionBy(strat_col).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (per_bucket.withColumn("__cum", F.sum("__bn").over(wcum))
           .join(quotas, strat_col)
           .withColumn("__before", F.col("__cum") - F.col("__bn")))
    # The cut bucket: first bucket whose cumulative count reaches the quota.
    cut = (cum.filter((F.col("__cum") >= F.col("quota")) & (F.col("__before") < F.col("quota")))
           .select(strat_col, F.col("__b").alias("__cut"), (F.col("quota") - F.col("__before"))
                   .alias("__need")))
    # One row per stratum: bounded by the number of strata.
    decided = keyed.join(F.broadcast(cut), strat_col, "left")
    in_cut = F.col("__b") == F.col("__cut")
    direct = (decided.filter(~in_cut | F.col("__cut").isNull())
              .withColumn(split_col, F.when(F.col("__cut").isNotNull() & (F.col("__b") < F.col("__cut")),
                                            "validation").otherwise("train")))
    w = Window.partitionBy(strat_col, "__b").orderBy("__ord", id_col)
    ranked = (decided.filter(in_cut)
              .withColumn(split_col, F.when(F.row_number().over(w) <= F.col("__need"), "validation")
                          .otherwise("train")))
    return direct.unionByName(ranked).drop("__ord", "__b", "__cut", "__need")
