"""Readers, writers and result stores.

All readers take explicit schemas (nothing is inferred).  Stores are
partitioned Parquet: "compute if absent" is a ``left_anti`` join of the
wanted keys against the stored keys, and writes use dynamic partition
overwrite so only the partitions being written are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import terms
from ..session import cut_lineage

#: Keys of a class mapping up to which it is broadcast.
BROADCAST_CLASSES = 100_000


def _csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a headed CSV as strings, wherever they stand in it."""
    raw = (spark.read.option("header", True).option("multiLine", True).option("inferSchema", False)
           .option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    if lost := [c for c in columns if c not in raw.columns]:
        raise ValueError(f"{path} has no column {', '.join(lost)}; it has {', '.join(raw.columns)}")
    return raw.select(*columns)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# ------------------------------------------------------------------ S3

def load_label_mapping(spark: SparkSession, json_path: str | None = None) -> DataFrame:
    """S3: ``classes(label INT, name STRING)`` from a JSON object
    ``{"0": "Sadness", ...}``; the built-in mapping when no path is given.
    The reverse direction is the same frame joined on ``name``."""
    if json_path is None:
        return spark.createDataFrame(sorted(terms.CLASSES.items()), "label INT, name STRING")
    raw = spark.read.option("multiLine", True).text(json_path, wholetext=True)
    m = F.from_json("value", "map<string,string>")
    return (raw.select(F.explode(m).alias("k", "name"))
            .select(F.col("k").cast("int").alias("label"), "name"))


def _indexed(df: DataFrame, classes: DataFrame, label: str = "label") -> DataFrame:
    """``df`` with the index of its label in __idx, null if there is none."""
    known = classes.select(F.explode(F.array(F.col("name"), F.col("label").cast("string"))).alias("__key"),
                           F.col("label").alias("__idx")).dropDuplicates(["__key"])
    text = F.trim(F.col(label).cast("string"))
    key = F.coalesce(text.try_cast("int").cast("string"), text)   # " 07" is 7
    # counted first: a mapping of classes is small, and the texts are not dealt by label
    small = F.broadcast(known) if known.count() <= BROADCAST_CLASSES else known
    return df.withColumn("__key", key).join(small, "__key", "left")


def label_to_index(label: str, classes: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A label column holding an index or a class name -> INT index.
    Unknown labels fail the job (the reference raises a key error)."""
    def run(df: DataFrame) -> DataFrame:
        j = _indexed(df, classes, label)
        bad = F.col("__idx").isNull() & F.col(label).isNotNull()
        checked = F.when(bad, F.raise_error(F.concat(F.lit("unknown label: "), F.col(label).cast("string"))))
        return (j.withColumn(label, F.coalesce(checked.cast("int"), F.col("__idx"))).select(*df.columns))
    return run


# ------------------------------------------------------------------ S1 / S2

def load_csv_dataset(spark: SparkSession, paths: dict[str, str],
                     classes: DataFrame | None = None) -> DataFrame:
    """One frame with a ``split`` column from ``{split: csv_path}``.
    Labels may be indices or class names; both become INT indices."""
    classes = classes if classes is not None else load_label_mapping(spark)
    frames = [_csv(spark, p, ["text", "label"]).withColumn("split", F.lit(s))
              for s, p in paths.items()]
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f)
    return df.transform(label_to_index("label", classes))


def load_scoring_csv(spark: SparkSession, path: str, classes: DataFrame | None = None
                     ) -> DataFrame:
    """A CSV to score; ``label`` is optional (index or name)."""
    head = spark.read.option("header", True).csv(path).columns
    if "label" not in head:
        return _csv(spark, path, ["text"])
    classes = classes if classes is not None else load_label_mapping(spark)
    return _csv(spark, path, ["text", "label"]).transform(label_to_index("label", classes))


# ------------------------------------------------------------- S1 / S2 with bad rows

BAD = "split STRING, path STRING, record STRING, reason STRING"
_CORRUPT = "__corrupt"


def _checked_csv(spark: SparkSession, path: str, split: str, required: Sequence[str]) -> DataFrame:
    """Every record of a headed CSV: its columns as strings, and the record itself where its
    number of fields or its quotes are wrong."""
    names = spark.read.option("header", True).csv(path).columns
    if lost := [c for c in required if c not in names]:
        raise ValueError(f"{path} has no column {', '.join(lost)}; it has {', '.join(names)}")
    schema = StructType([StructField(c, StringType()) for c in [*names, _CORRUPT]])
    raw = (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).csv(path))
    wanted = [F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in ("text", "label")]
    return raw.select(*wanted, F.lit(split).alias("split"), F.col("_metadata.file_path").alias("path"), _CORRUPT)


def load_csv_checked(spark: SparkSession, paths: dict[str, str], classes: DataFrame | None = None,
                     labelled: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1/S2 with a side output: (rows text, label, split; bad rows split, path, record, reason).

    Reasons are ``fields`` (too few or too many), ``open quote`` (the last record of a file whose quotes do not
    pair: it swallowed the rest), ``no label`` (only where labels are asked for) and ``unknown label``.
    Every record of the files stands in exactly one of the two frames, which both come from
    one written table."""
    classes = classes if classes is not None else load_label_mapping(spark)
    frames = [_checked_csv(spark, p, s, ["text", "label"] if labelled else ["text"]) for s, p in paths.items()]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    reason = F.when(F.col(_CORRUPT).isNotNull(), "fields")
    if labelled:
        reason = reason.when(F.trim("label") == "", "no label").when(F.col("label").isNull(), "no label")
    rows = _indexed(rows, classes).withColumn("reason", reason.when(
        F.col("label").isNotNull() & F.col("__idx").isNull(), "unknown label"))
    rows = cut_lineage(rows.withColumn("__at", F.monotonically_increasing_id()))   # a file is read by one task, in order
    lines = spark.read.text(list(paths.values())).select(F.col("_metadata.file_path").alias("path"), (
        F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    odd = lines.groupBy("path").agg(F.sum("quotes").alias("quotes")).filter(F.col("quotes") % 2 == 1).select("path")
    last = rows.join(odd, "path").groupBy("path").agg(F.max("__at").alias("__last"))   # a row for each such file
    rows = rows.join(last, "path", "left").withColumn("reason", F.coalesce(
        "reason", F.when(F.col("__at") == F.col("__last"), "open quote")))
    good = rows.filter("reason is null").select("text", F.col("__idx").alias("label"), "split")
    record = F.coalesce(_CORRUPT, F.concat_ws(",", "text", "label"))
    return good, rows.filter("reason is not null").select("split", "path", record.alias("record"), "reason")


# ------------------------------------------------------------------ S4

CONFIG_FIELDS = ("hidden_size", "num_attention_heads", "num_hidden_layers", "vocab_size")


def model_stats(spark: SparkSession, root: str, parameters: DataFrame | None = None
                ) -> DataFrame:
    """Walk ``root/org/model/config.json``; model = 'org/model' taken
    from the file path.  Unreadable files are skipped (PERMISSIVE +
    corrupt-record filter).  Parameter counts need weights, so they come in
    as an optional ``(model, parameters)`` frame."""
    schema = ", ".join(f"{c} INT" for c in CONFIG_FIELDS) + ", _corrupt_record STRING"
    raw = (spark.read.schema(schema).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "config.json").option("multiLine", True)
           .option("mode", "PERMISSIVE").json(root))
    model = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)/config\.json$", 1)
    out = raw.filter(F.col("_corrupt_record").isNull()).select(model.alias("model"),
                                                                *CONFIG_FIELDS)
    if parameters is not None:
        out = out.join(parameters, "model", "left")
    else:
        out = out.withColumn("parameters", F.lit(None).cast("bigint"))
    return out.select("model", "parameters", *CONFIG_FIELDS)


# ------------------------------------------------------------------ S5 / S10

LOG_FIELDS = ("epoch", "step", "loss", "eval_loss", "eval_accuracy", "eval_recall",
              "eval_precision", "eval_f1")


def training_logs(spark: SparkSession, root: str) -> DataFrame:
    """Every ``training_log.csv`` under ``root``; model = its folder
    relative to ``root``."""
    schema = ", ".join(f"{c} DOUBLE" for c in LOG_FIELDS)
    raw = (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "training_log.csv").csv(root))
    prefix = root.rstrip("/") + "/"
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:", "")
    rel = F.regexp_replace(F.substring_index(path, prefix, -1), "/training_log\\.csv$", "")
    return raw.select(rel.alias("model"), *LOG_FIELDS)


def merge_log_records(records: DataFrame, keys: Sequence[str], fields: Sequence[str],
                      field_col: str = "field", value_col: str = "value",
                      step_col: str = "step") -> DataFrame:
    """Partial log records -> complete rows.

    Per key, each field takes its last value by ``step`` (later logs
    overwrite; of equal steps the larger value), and a row is emitted only when every field is present.
    A record without a step or a value says nothing.
    One aggregation, partial (map-side) maximum per field.
    """
    said = records.filter(F.col(value_col).isNotNull() & F.col(step_col).isNotNull())
    aggs = [F.max(F.when(F.col(field_col) == f, F.struct(step_col, value_col))).getField(value_col).alias(f) for f in fields]
    out = said.groupBy(*keys).agg(F.max(step_col).alias(step_col), *aggs)
    complete = None
    for f in fields:
        c = F.col(f).isNotNull()
        complete = c if complete is None else complete & c
    return out.filter(complete)


def append_log(df: DataFrame, path: str) -> None:
    """S10 sink: append complete rows as CSV with a header."""
    df.write.mode("append").option("header", True).csv(path)


# ------------------------------------------------------------------ S6

HPARAM_SCHEMA = ("model STRING, learning_rate DOUBLE, num_train_epochs INT, "
                 "warmup_ratio DOUBLE, weight_decay DOUBLE")
#: What the random search (L2) finds, stored beside them.
SEARCH_SCHEMA = "reg_param DOUBLE, max_iter INT, elastic_net DOUBLE, val_f1 DOUBLE"


def write_hparams(df: DataFrame, root: str) -> None:
    """One JSON folder per model (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("model").json(root))


def load_hparams(spark: SparkSession, root: str, model: str | None = None) -> DataFrame:
    """Stored hyperparameters; a missing store or model gives an empty
    frame (the reference returns None)."""
    if not exists(spark, root):
        return spark.createDataFrame([], f"{HPARAM_SCHEMA}, {SEARCH_SCHEMA}")
    body = f'{HPARAM_SCHEMA.split(", ", 1)[1]}, {SEARCH_SCHEMA}'
    df = spark.read.schema(body + ", model STRING").json(root)
    if model is not None:
        df = df.filter(F.col("model") == model)    # partition pruning
    return df.select(*[c.split()[0] for c in f"{HPARAM_SCHEMA}, {SEARCH_SCHEMA}".split(", ")])


# ------------------------------------------------------------------ S7 / S8 / J3

def _stored_keys(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """The store's keys; None if there is no store.  A store that cannot be read is an error."""
    return spark.read.parquet(path).select(*keys).distinct() if exists(spark, path) else None


def missing_keys(spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str]
                 ) -> DataFrame:
    """Wanted keys not yet in the store (``left_anti``)."""
    stored = _stored_keys(spark, path, keys)
    return wanted if stored is None else wanted.join(stored, list(keys), "left_anti")


def compute_if_absent(spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str],
                      compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Compute results only for the missing keys, append them as new
    partitions, and return the stored rows of every wanted key.

    ``compute(missing_keys_df)`` returns result rows carrying ``keys``.
    Stored rows are read back with partition filters (pruning).
    """
    miss = missing_keys(spark, path, wanted, keys)
    if not miss.isEmpty():
        new = compute(miss)
        (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(path))
    stored = spark.read.parquet(path)
    return stored.join(wanted.select(*keys).distinct(), list(keys), "left_semi")


# ------------------------------------------------------------------ S9

def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str],
           partition_by: Sequence[str] = ()) -> DataFrame:
    """Old rows not replaced by ``new`` (``left_anti`` on keys) plus
    ``new``; columns that one of them lacks are null there.  The merged frame is checkpointed (reliable, shared dir)
    before the old files are overwritten, so reading and replacing the
    same path is safe."""
    merged = new
    if exists(spark, path):   # any error of reading it goes up: the store stays as it is
        old = spark.read.parquet(path)
        gone = new.select(*[F.col(k).alias(f"__new_{k}") for k in keys])
        kept = old.join(gone, [old[k].eqNullSafe(gone[f"__new_{k}"]) for k in keys], "left_anti")   # null is a key too
        merged = kept.unionByName(new, allowMissingColumns=True)
    merged = cut_lineage(merged)
    w = merged.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ S11

def write_pairs(df: DataFrame, path: str, a: str = "text", b: str = "cleaned") -> None:
    """before/after pairs as text, one line each."""
    df.select(F.concat_ws("\n", F.col(a), F.col(b)).alias("value")).write.mode(
        "overwrite").text(path)
