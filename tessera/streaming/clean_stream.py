"""Cleaning on a file stream.

The cleaning rules (C1-C14), the apply-and-flag step (P2) and the short
text filter (P3) are stateless column expressions, so the same plan runs
on a streaming DataFrame unchanged.  Duplicate removal (A1) needs every
copy of a text and is not offered on streams.

The stream's checkpoint is a folder that the caller names (``checkpoint``) and keeps, on
storage that all nodes share: a restarted query, in another session too, resumes from its
last committed batch.  Spark's own checkpoint folder is no place for it, as that one is
new in each application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators import curate


def cleaned_stream(stream: DataFrame, text_col: str = "text", min_words: int = 2,
                   markup: bool = True) -> DataFrame:
    """P2 + C14 + P3 on a (streaming or batch) DataFrame."""
    out = curate.replace_texts(stream.withColumn("cleaned", F.lit(None).cast("string")),
                               T.clean_sample(text_col, markup), min_words, "cleaned")
    return out.withColumn("is_cleaned", ~F.equal_null(F.col("cleaned"), F.col(text_col)))


def run_clean_stream(spark: SparkSession, src_dir: str, schema: str, out_dir: str,
                     checkpoint: str, fmt: str = "parquet",
                     text_col: str = "text", min_words: int = 2,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Read new files of ``src_dir``, clean them, append Parquet to ``out_dir``.

    ``trigger(availableNow=True)``: processes everything present, in
    bounded batches, then stops (a scheduled incremental job).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(src_dir)
    out = cleaned_stream(stream, text_col, min_words)
    return (out.writeStream.format("parquet").option("path", out_dir)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())


def run_score_stream(spark: SparkSession, model, src_dir: str, schema: str, out_dir: str,
                     checkpoint: str, keep=("id",), fmt: str = "parquet",
                     text_col: str = "text") -> StreamingQuery:
    """L3 on a stream: clean (C14) then score with a fitted PipelineModel
    (stateless, so the batch plan runs unchanged); predictions appended."""
    from ..operators.ml import score
    stream = spark.readStream.schema(schema).format(fmt).load(src_dir)
    cleaned = stream.withColumn(text_col, T.clean_sample(text_col))
    out = score(model, cleaned, keep=list(keep), label_col=None)
    return (out.writeStream.format("parquet").option("path", out_dir)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
