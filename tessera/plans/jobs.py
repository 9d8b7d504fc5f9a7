"""Registered queries of the jobs that keep stores, learn vocabularies or iterate: Spark plans and SQL."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions.regex import sql_str as S
from ..functions.text import WORD_WITH_APOSTROPHES
from ..operators import kmeans, scoring, vocabulary
from ..sources import stores, tables
from ..streaming.log_stream import run_log_stream
from . import oracle as O


def r6(c):
    return F.round(c, 6)


def _folder(spark: SparkSession) -> str:
    """A store of this run in the shared checkpoint folder."""
    return f"{session.checkpoint_dir(spark).rstrip('/')}/stores/{uuid.uuid4().hex}"


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    """The embeddings as a dataset with three splits, and their width."""
    split = F.when(F.col("vec_id") % 10 < 8, "train").when(F.col("vec_id") % 10 == 8, "validation").otherwise("test")
    e = tables.table(spark, d, "embeddings").select(
        F.lit("embeddings").alias("dataset"), split.alias("split"), F.col("vec_id").alias("id"),
        F.col("embedding").alias("features"), "label")
    return e, e.select(F.max(F.size("features"))).first()[0]   # one number


def _folded(width: int, shift: int) -> scoring.Factory:
    """Ten logits: the sums of every tenth entry, places moved by ``shift``."""
    matrix = np.zeros((width, 10))
    matrix[np.arange(width), (np.arange(width) + shift) % 10] = 1.0
    return scoring.linear(matrix)


def _never() -> scoring.Factory:
    raise AssertionError("a stored key was worked on again")


def scored_store(spark, d):
    """L3 + S7: two models over three splits.  A first run scores one of them on two splits, a second
    one what is missing, and a third nothing: its models fail if a row reaches them."""
    data, width = _vectors(spark, d)
    path = _folder(spark)
    models = {"alpha-small": _folded(width, 0), "alpha-large": _folded(width, 5)}
    scoring.score_missing(data.filter("split <> 'test'"), {"alpha-small": models["alpha-small"]}, path, classes=10, run="first")
    scoring.score_missing(data, models, path, classes=10, run="second")
    found = scoring.score_missing(data, dict.fromkeys(models, _never), path, classes=10, run="third")
    return found.select("model", "split", "n", *[r6(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "run")


SQL_SCORED_STORE = """
WITH p AS (SELECT model, y_true, y_pred,
                  CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'validation' ELSE 'test' END AS split
           FROM preds WHERE model IN ('alpha-small', 'alpha-large')),
cls AS (SELECT model, split, y_true AS c FROM p UNION SELECT model, split, y_pred FROM p),
pc AS (SELECT model, split, c, count(*) FILTER (y_true = c AND y_pred = c) AS tp, count(*) FILTER (y_true = c) AS nt,
              count(*) FILTER (y_pred = c) AS np FROM cls JOIN p USING (model, split) GROUP BY model, split, c)
SELECT model, split, CAST(sum(nt) AS BIGINT) AS n, round(sum(tp) / sum(nt), 6) AS accuracy,
       round(avg(CASE WHEN np = 0 THEN 0 ELSE tp / np END), 6) AS precision,
       round(avg(CASE WHEN nt = 0 THEN 0 ELSE tp / nt END), 6) AS recall, round(avg(2 * tp / (nt + np)), 6) AS f1,
       CASE WHEN model = 'alpha-small' AND split <> 'test' THEN 'first' ELSE 'second' END AS run
FROM pc GROUP BY model, split
"""


def _differences(width: int) -> scoring.Factory:
    """Half as many features: the differences of neighbours."""
    matrix = np.zeros((width, width // 2))
    matrix[np.arange(0, width - 1, 2), np.arange(width // 2)] = 1.0
    matrix[np.arange(1, width, 2)[:width // 2], np.arange(width // 2)] = -1.0
    return scoring.linear(matrix)


FEATURE_KEY = {"dataset": "embeddings", "model": "alpha-small", "model_type": "pretrained", "method": "differences"}


def feature_store(spark, d):
    """P10 + S8: a vector of every row, extracted once; the second request reads the store."""
    data, width = _vectors(spark, d)
    path = _folder(spark)
    scoring.extract_missing(data, *FEATURE_KEY.values(), _differences(width), width // 2, path)
    found = scoring.extract_missing(data, *FEATURE_KEY.values(), _never, width // 2, path)
    each = F.transform("vector", lambda x, i: x.cast("double") * (i + 1))
    return found.select("id", "label", F.size("vector").cast("long").alias("width"),
                        F.round(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), 4).alias("checksum"))


SQL_FEATURE_STORE = """
WITH x AS (SELECT vec_id AS id, label, embedding, unnest(range(1, len(embedding) // 2 + 1)) AS i FROM embeddings)
SELECT id, label, count(*) AS width,
       round(sum(i * CAST(CAST(CAST(embedding[2 * i - 1] AS DOUBLE) - CAST(embedding[2 * i] AS DOUBLE) AS FLOAT) AS DOUBLE)), 4) AS checksum
FROM x GROUP BY id, label
"""


def stored_separability(spark, d):
    """L4-L6 + S9: ARI and AMI of the KMeans clusters of stored vectors, from the table of results."""
    data, width = _vectors(spark, d)
    path = _folder(spark)
    scoring.extract_missing(data, *FEATURE_KEY.values(), _differences(width), width // 2, path)
    found = scoring.separability_of_stored(spark, path, FEATURE_KEY)
    return found.select("model", "model_type", "method", "k", *[
        r6(F.col(c)).alias(c) for c in ("adjusted_rand_index", "adjusted_mutual_info")])


STARTS, CLUSTERS, PASSES = range(42, 52), 10, 6


def kmeans_starts(spark, d):
    """Ten starts of KMeans in one scan for each iteration; the clusters of the best one."""
    e = session.cut_lineage(tables.table(spark, d, "embeddings").select("vec_id", "embedding"))
    model = kmeans.fit(e, "embedding", CLUSTERS, STARTS, max_iter=PASSES, tol=0.0, init="digest", row_id="vec_id")
    return model.assign(e, "embedding").select("vec_id", "cluster", F.lit(int(STARTS[model.best])).alias("seed"),
                                               F.round(F.lit(model.cost), 4).alias("cost"))


def _sql_kmeans() -> str:
    steps = []
    for i in range(PASSES + 1):
        steps.append(f"""
n{i} AS (SELECT seed, vec_id, v, c, dist FROM (
    SELECT k{i}.seed, p.vec_id, p.v, k{i}.c, pow(list_distance(p.v, k{i}.m), 2) AS dist FROM p JOIN k{i} ON true)
    QUALIFY row_number() OVER (PARTITION BY seed, vec_id ORDER BY round(dist, 9), c) = 1)""")
        if i < PASSES:
            steps.append(f"""
m{i} AS (SELECT seed, c, list(x ORDER BY i) AS m FROM (
    SELECT seed, c, i, avg(v[i]) AS x FROM (SELECT seed, c, v, unnest(range(1, len(v) + 1)) AS i FROM n{i}) GROUP BY seed, c, i)
    GROUP BY seed, c),
k{i + 1} AS (SELECT k{i}.seed, k{i}.c, coalesce(m{i}.m, k{i}.m) AS m FROM k{i} LEFT JOIN m{i} USING (seed, c))""")
    return f"""
WITH p AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
k0 AS (SELECT seed, CAST(row_number() OVER (PARTITION BY seed ORDER BY md5(seed || ':' || vec_id), vec_id) - 1 AS INTEGER) AS c, v AS m
       FROM p, (SELECT unnest(range({STARTS[0]}, {STARTS[-1] + 1})) AS seed) s
       QUALIFY row_number() OVER (PARTITION BY seed ORDER BY md5(seed || ':' || vec_id), vec_id) <= {CLUSTERS}),
{','.join(steps)},
cost AS (SELECT seed, sum(dist) AS cost FROM n{PASSES} GROUP BY seed),
best AS (SELECT seed, cost FROM cost ORDER BY round(cost, 6), seed LIMIT 1)
SELECT vec_id, c AS cluster, CAST(seed AS INTEGER) AS seed, round(cost, 4) AS cost FROM n{PASSES} JOIN best USING (seed)
""".replace(" AS (SELECT seed, vec_id", " AS MATERIALIZED (SELECT seed, vec_id")


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return tables.table(spark, d, "documents").select("doc_id", "text")


def token_vocabulary(spark, d):
    """C17: the words of all documents with their counts and ids."""
    return vocabulary.learn(_texts(spark, d))


_SQL_VOCABULARY = f"""
said AS (SELECT doc_id, word, pos FROM (
    SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM (SELECT doc_id, {O.words("lower(text)")} AS ws FROM documents))),
vocabulary AS (SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, word) + 1 AS id FROM said GROUP BY word)"""

SQL_TOKEN_VOCABULARY = f"""
WITH {_SQL_VOCABULARY.strip()}
SELECT word, n, id FROM vocabulary
"""


def vocabulary_encoding(spark, d):
    """C17: ids of all words under the vocabulary of words that occur twice, and what they decode to."""
    docs = _texts(spark, d)
    words = session.cut_lineage(vocabulary.learn(docs, min_count=2))
    ids = F.array_join(F.transform("input_ids", lambda i: i.cast("string")), " ")
    coded = vocabulary.encode(docs, words, keep=["doc_id"]).select(
        "doc_id", F.size("input_ids").cast("long").alias("length"), F.md5(ids.cast("binary")).alias("ids_md5"), "input_ids")
    back = vocabulary.decode(coded, words, keep=["doc_id", "length", "ids_md5"])
    return back.select("doc_id", "length", "ids_md5", F.md5(F.col("decoded").cast("binary")).alias("decoded_md5"))


SQL_VOCABULARY_ENCODING = f"""
WITH {_SQL_VOCABULARY.strip()},
coded AS (SELECT doc_id, pos, CASE WHEN n > 1 THEN id ELSE 1 END AS id, CASE WHEN n > 1 THEN word ELSE '[UNK]' END AS word
          FROM said JOIN vocabulary USING (word))
SELECT doc_id, CAST(count(pos) AS BIGINT) AS length, md5(coalesce(string_agg(coded.id::VARCHAR, ' ' ORDER BY pos), '')) AS ids_md5,
       md5(coalesce(string_agg(coded.word, ' ' ORDER BY pos), '')) AS decoded_md5
FROM documents LEFT JOIN coded USING (doc_id) GROUP BY doc_id
"""


def dictionary_expansion(spark, d):
    """C11 with a table: every odd-numbered word of the vocabulary that a word pattern finds whole
    becomes itself and its number."""
    docs = _texts(spark, d)
    words = vocabulary.learn(docs).filter((F.col("id") % 2 == 1) & F.col("word").rlike(f"^(?:{vocabulary.WORD})$"))
    table = session.cut_lineage(words.select(F.col("word").alias("key"), F.concat_ws("_", "word", F.col("id").cast("string")).alias("value")))
    return vocabulary.expand(docs, table).select("doc_id", F.length("expanded").cast("long").alias("n_chars"),
                                                 F.md5(F.col("expanded").cast("binary")).alias("expanded_md5"))


_RX = WORD_WITH_APOSTROPHES.replace(r"\w", f"[{O.WORD_CHARS}]")


def _sql_cased(core: str, value: str) -> str:
    return (f"CASE WHEN left({core}, 1) <> lower(left({core}, 1)) THEN upper(left({value}, 1)) || substr({value}, 2) ELSE {value} END")


SQL_DICTIONARY_EXPANSION = f"""
WITH {_SQL_VOCABULARY.strip()},
dictionary AS (SELECT word AS key, word || '_' || id AS value FROM vocabulary
               WHERE id % 2 = 1 AND regexp_full_match(word, {S(_RX)})),
parts AS (SELECT doc_id, pos, between_[pos] AS before, found[pos] AS word FROM (
    SELECT doc_id, between_, found, unnest(range(1, len(between_) + 1)) AS pos FROM (
        SELECT doc_id, regexp_split_to_array(text, {S(_RX)}) AS between_, regexp_extract_all(text, {S(_RX)}) AS found FROM documents))),
new AS (SELECT doc_id, pos, before, coalesce({_sql_cased("word", "w.value")},
               CASE WHEN starts_with(word, chr(39)) THEN chr(39) || ({_sql_cased("substr(word, 2)", "b.value")}) END, word, '') AS word
        FROM parts LEFT JOIN dictionary w ON w.key = lower(word)
        LEFT JOIN dictionary b ON starts_with(word, chr(39)) AND b.key = lower(substr(word, 2))),
whole AS (SELECT doc_id, string_agg(before || word, '' ORDER BY pos) AS expanded FROM new GROUP BY doc_id)
SELECT doc_id, CAST(length(expanded) AS BIGINT) AS n_chars, md5(expanded) AS expanded_md5 FROM whole
"""


#: Files of :func:`checked_csv`.
FILES = 8


def checked_csv(spark, d):
    """S1 with bad rows: all labelled documents as a CSV in which every tenth row has a field too many, every
    tenth one too few, every tenth no label and every tenth an unknown one; what is read, and what is not."""
    labelled = tables.table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label")).join(
        _texts(spark, d), "doc_id")
    text = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    turn = F.col("doc_id") % 10
    record = (F.when(turn == 1, F.concat_ws(",", text, "label", F.lit("more"))).when(turn == 2, text)
              .when(turn == 3, F.concat(text, F.lit(","))).when(turn == 4, F.concat_ws(",", text, F.lit("Nope")))
              .otherwise(F.concat_ws(",", text, "label")))
    path = f"{_folder(spark)}/csv"
    records = labelled.select(F.pmod(F.xxhash64("doc_id"), F.lit(FILES)).alias("g"), F.lit(1).alias("place"), record.alias("record"))
    heads = spark.range(FILES).select(F.col("id").alias("g"), F.lit(0).alias("place"), F.lit("text,label").alias("record"))
    (records.unionByName(heads).repartition("g").sortWithinPartitions("g", "place").select("g", "record")
     .write.partitionBy("g").text(path))
    good, bad = stores.load_csv_checked(spark, {f"part {g}": f"{path}/g={g}" for g in range(FILES)})
    found = good.select(F.lit("good").alias("outcome"), "label", F.length("text").alias("chars")).unionByName(
        bad.select(F.col("reason").alias("outcome"), F.lit(None).cast("int").alias("label"), F.lit(0).alias("chars")))
    return found.groupBy("outcome", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").cast("long").alias("chars"))


SQL_CHECKED_CSV = """
WITH l AS (SELECT doc_id, quality, text, doc_id % 10 AS turn FROM labels JOIN documents USING (doc_id)),
o AS (SELECT CASE WHEN turn IN (1, 2) THEN 'fields' WHEN turn = 3 THEN 'no label' WHEN turn = 4 THEN 'unknown label'
                  ELSE 'good' END AS outcome, quality, text FROM l)
SELECT outcome, CASE WHEN outcome = 'good' THEN quality END AS label, count(*) AS n,
       CAST(sum(CASE WHEN outcome = 'good' THEN length(text) ELSE 0 END) AS BIGINT) AS chars
FROM o GROUP BY 1, 2
"""


def log_stream(spark, d):
    """S10 on a stream: the events as partial records in files, dealt by a digest and so in no order,
    merged in two runs."""
    from .catalog import LOG_TYPES, _log_records
    folder = _folder(spark)
    records = _log_records(spark, d).withColumn("turn", F.xxhash64("step") % 4)
    schema = "model string, epoch int, step long, field string, value double"
    for half in (0, 2):
        part = records.filter(F.pmod("turn", F.lit(4)).isin(half, half + 1)).drop("turn")
        part.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")]).write.mode("append").parquet(f"{folder}/in")
        run_log_stream(spark, f"{folder}/in", schema, f"{folder}/store", f"{folder}/stream", ["model", "epoch"],
                       LOG_TYPES).awaitTermination()
    return spark.read.parquet(f"{folder}/store").select("model", "epoch", "step", *LOG_TYPES)


QUERIES = {
    "scored_store": (scored_store, SQL_SCORED_STORE),
    "feature_store": (feature_store, SQL_FEATURE_STORE),
    "stored_separability": (stored_separability, None),
    "kmeans_starts": (kmeans_starts, _sql_kmeans()),
    "token_vocabulary": (token_vocabulary, SQL_TOKEN_VOCABULARY),
    "vocabulary_encoding": (vocabulary_encoding, SQL_VOCABULARY_ENCODING),
    "dictionary_expansion": (dictionary_expansion, SQL_DICTIONARY_EXPANSION),
    "checked_csv": (checked_csv, SQL_CHECKED_CSV),
}
