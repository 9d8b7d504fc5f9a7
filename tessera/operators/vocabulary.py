"""Word vocabularies learned from a corpus, exact encoding and decoding (C17), and dictionary
expansion with tables of any size (C11).

* :func:`learn`: words are counted with partial aggregation; ids are the ranks by (count, word), found
  without bringing the words together: they are range-partitioned, ranked inside each partition, and moved
  by the sizes of the partitions before.
* :func:`encode` / :func:`decode`: chunks of rows ask for their distinct words or ids (see
  :func:`tessera.operators.lookup.values_of`); a vocabulary of up to ``SENT_WORDS`` words is counted and
  sent to the workers.  Every id stands for one word, so decoding gives the words back; unknown
  words have an id of their own.
* :func:`expand`: like :func:`tessera.functions.text.expand_contractions`, with a table of (key, value)
  instead of a literal map, looked up likewise.  Only texts that hold a key are put together again.

Words are Python's ``str.split`` of the lower-cased text.  Null texts have no words; rows may
repeat, and every other column passes through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.regex import java
from ..functions.text import WORD_WITH_APOSTROPHES, let, no_recursion, words
from ..session import cut_lineage
from .lookup import BROADCAST_ROWS, values_of

PAD, UNKNOWN, FIRST = 0, 1, 2
#: What an unknown id decodes to.
UNKNOWN_WORD = "[UNK]"
#: Words up to which a vocabulary is sent to every worker.
SENT_WORDS = 2_000_000


def _words(text: str) -> Column:
    return words(F.lower(F.coalesce(F.col(text), F.lit(""))))


def _ranked(counts: DataFrame, order: list[Column]) -> DataFrame:
    """``counts`` with place, from 0, in ``order``: no task sees more than its own range."""
    dealt = cut_lineage(counts.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))   # a row for each task
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (dealt.withColumn("__inside", inside).join(F.broadcast(sizes), "__part")
            .withColumn("place", (F.col("__before") + F.col("__inside") - 1).cast("long")).drop("__part", "__inside", "__before"))


def learn(docs: DataFrame, text: str = "text", min_count: int = 1, size: int | None = None) -> DataFrame:
    """(word, n, id): words of at least ``min_count`` occurrences, by count and then word; ``size``
    limits the number of ids, the two reserved ones included."""
    counts = docs.select(F.explode(_words(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = _ranked(counts.filter(F.col("n") >= min_count), [F.col("n").desc(), F.col("word")])
    found = found.select("word", "n", (F.col("place") + FIRST).alias("id"))
    return found if size is None else found.filter(F.col("id") < size)


def encode(docs: DataFrame, vocabulary: DataFrame, text: str = "text", out: str = "input_ids",
           sent: int = SENT_WORDS, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the ids of all words of ``text`` (array of long), in order; of the other columns only
    those of ``keep``, if given, are carried along."""
    table = vocabulary.select(F.col("word").alias("key"), F.col("id").alias("value"))
    return values_of(docs, _words(text), table, out, sent, keep).withColumn(
        out, F.transform(out, lambda i: F.coalesce(i, F.lit(UNKNOWN).cast("long"))))


def decode(docs: DataFrame, vocabulary: DataFrame, ids: str = "input_ids", out: str = "decoded",
           sent: int = SENT_WORDS, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the words of ``ids``, joined by blanks; padding drops out; of the other columns only
    those of ``keep``, if given, are carried along."""
    table = vocabulary.select(F.col("id").alias("key"), F.col("word").alias("value"))
    return values_of(docs, F.filter(ids, lambda i: i != PAD), table, out, sent, keep).withColumn(
        out, F.array_join(out, " ", UNKNOWN_WORD))


# ------------------------------------------------------------------ dictionaries (C11)

WORD = java(no_recursion(WORD_WITH_APOSTROPHES))


def _bare(word: Column) -> Column:
    """A word without its leading apostrophe."""
    return F.substring(word, 2, 1 << 30)


def _cased(core: Column, value: Column) -> Column:
    """The value with a capital if the word has one."""
    return F.when(core.substr(1, 1) != F.lower(core.substr(1, 1)), F.concat(
        F.upper(value.substr(1, 1)), F.substring(value, 2, 1 << 30))).otherwise(value)


def expand(docs: DataFrame, dictionary: DataFrame, text: str = "text", out: str = "expanded",
           limit: int = BROADCAST_ROWS) -> DataFrame:
    """C11 with a table: ``docs`` with every word that is a key of ``dictionary`` (key, value; keys in lower
    case, one row each) replaced.  A word is looked up whole first, then without its leading apostrophe."""
    spoken = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    bare = lambda ws: F.transform(ws, lambda w: F.when(w.startswith("'"), F.lower(_bare(w))))
    # Second keys follow the first ones, for texts with a leading apostrophe only.
    keys = let(spoken, lambda ws: F.concat(F.transform(ws, F.lower), F.when(
        F.exists(ws, lambda w: w.startswith("'")), bare(ws)).otherwise(F.array().cast("array<string>"))))
    found = values_of(docs, keys, dictionary.select("key", "value"), out, limit)

    def new(word: Column, whole: Column, rest: Column) -> Column:
        return F.coalesce(_cased(word, whole), F.when(word.startswith("'"), F.concat(
            F.lit("'"), _cased(_bare(word), rest))), word)

    rebuilt = let(spoken, lambda ws: F.array_join(F.zip_with(
        F.split(text, WORD, -1), F.transform(ws, lambda w, i: new(w, F.get(F.col(out), i), F.get(F.col(out), F.size(ws) + i))),
        lambda between, word: F.concat(between, F.coalesce(word, F.lit("")))), ""))
    return found.withColumn(out, F.when(F.exists(out, F.isnotnull), rebuilt).otherwise(F.col(text)))
