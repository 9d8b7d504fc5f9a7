"""Token-id encoding (C17).

Word tokens (Python ``str.split`` semantics, lower-cased) are mapped to ids
by hashing, so no vocabulary is built, collected or broadcast: the id of a
word is fixed by the word itself, and encoding is a map-only projection.
Id 0 is reserved for padding.  A sub-word tokenizer can be plugged in as a
pandas UDF producing the same three columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c, let, words

VOCAB_SIZE = 30522      # our default hashed vocabulary size (parameter)


def token_id(w: Column, vocab_size: int = VOCAB_SIZE) -> Column:
    """1 + (first 32 bits of md5(lower(w)) mod (vocab_size - 1))."""
    h = F.conv(F.substring(F.md5(F.lower(w)), 1, 8), 16, 10).cast("long")
    return (F.lit(1) + h % F.lit(vocab_size - 1)).cast("int")


def encode(c: ColumnOrName, max_len: int | None = None, vocab_size: int = VOCAB_SIZE) -> Column:
    """struct(input_ids, attention_mask, length): ids of all words, or of the first
    ``max_len`` if the caller sets that limit, a mask of ones, and the encoded length."""
    def body(ws: Column) -> Column:
        ids = F.transform(ws if max_len is None else F.slice(ws, 1, max_len), lambda w: token_id(w, vocab_size))
        return F.struct(ids.alias("input_ids"),
                        F.transform(ids, lambda _: F.lit(1)).alias("attention_mask"),
                        F.size(ids).alias("length"))
    return let(words(_c(c)), body)
