"""Readers for the driver tables and the derived fixture views (FIXTURES.md §4).

Every view is a lazy DataFrame over the parquet tables, so its work grows
with them.  The same views are written in DuckDB SQL in
:mod:`tessera.plans.oracle` and must stay identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import terms
from ..functions.arrays import argmax, to_double_array
from ..functions.text import word_count

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


#: Tables of whole texts, whose rows cost much more than reading them.
TEXTS = ("documents", "pages")
#: Bytes up to which such a table is dealt out: one split of the reader.
ONE_SPLIT = 128 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXTS else df


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table that is no larger than one split, dealt to all cores.

    The reader cuts files at row groups, so such a table often is one task; the size is the
    optimizer's own and costs no job.  Larger tables are left as the reader splits them."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > ONE_SPLIT:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


# Tails appended to the noisy fixture, chosen by doc_id % 8 (our fixture).
NOISY_TAILS = (
    "i m sure you ll say it s ok",
    "don t ask they ve gone",
    "idk lol u r gr8 b c 2day",
    "soooooo haaaappy",
    "a href http www",
    "width li style border px list style margin px px",
    "encoding utf locale en_us type application rss xml x",
    "",
)


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """noisy(id, text, label): every document, whole, plus a tail.

    Documents carry no markup, slang or missing apostrophes, so a tail
    chosen by ``doc_id % 8`` adds them.
    """
    d = table(spark, sf_dir, "documents")
    tails = F.array(*[F.lit(t) for t in NOISY_TAILS])
    tail = F.element_at(tails, (F.col("doc_id") % len(NOISY_TAILS) + 1).cast("int"))
    text = F.when(tail == "", F.col("text")).otherwise(F.concat_ws(" ", "text", tail))
    return d.select(F.col("doc_id").alias("id"), text.alias("text"),
                    (F.col("doc_id") % 6).cast("int").alias("label"))


def _shift(k: int):
    return F.when(F.col("vec_id") % k == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """preds(id, model, y_true, y_pred, student, teacher) from embeddings.

    One row per (vector, model): the six models are generated per row
    (a Generate, not a join).
    """
    e = table(spark, sf_dir, "embeddings")
    def folded(shift: int):
        """Ten logits: the sums of every tenth entry of the whole vector."""
        x = to_double_array("embedding")
        return F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.aggregate(
            F.filter(x, lambda v, i: (i + shift) % 10 == k), F.lit(0.0), lambda a, v: a + v))

    student, teacher = folded(0), folded(5)
    e = e.select("vec_id", "label", student.alias("student"), teacher.alias("teacher"))
    e = e.withColumn("model", F.explode(F.array(*[F.lit(m) for m in terms.FIXTURE_MODELS])))
    m = F.col("model")
    y_pred = (F.when(m == "alpha-small", argmax("student"))
              .when(m == "alpha-large", argmax("teacher"))
              .when(m == "beta-base", _shift(5))
              .when(m == "Full", _shift(11))
              .when(m == "step0", _shift(7))
              .otherwise(_shift(3)))
    return e.select(F.col("vec_id").alias("id"), "model", F.col("label").alias("y_true"),
                    y_pred.cast("int").alias("y_pred"), "student", "teacher")


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """training_log(model, epoch, acc): events per user and day, avg(value)."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("user_id").cast("string").alias("model"),
                       F.unix_date(F.to_date("ts")).alias("epoch"))
            .agg(F.avg("value").alias("acc")))


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """latency(model, sec): events.value / 1000, model by event_id % 6."""
    ev = table(spark, sf_dir, "events")
    models = F.array(*[F.lit(m) for m in terms.FIXTURE_MODELS])
    return ev.select(F.element_at(models, (F.col("event_id") % 6 + 1).cast("int")).alias("model"),
                     (F.col("value") / 1000).alias("sec"))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """curated(doc_id, text, label, length): documents joined to labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id").withColumn("length", word_count("text").cast("int"))
