"""End-to-end jobs composed from the operators (E1 preprocess)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens
from ..operators import curate
from ..session import cut_lineage


def preprocess(df: DataFrame, text_col: str = "text", label_col: str = "label",
               id_col: str = "doc_id", split_col: str = "split", min_words: int = 2,
               validation_size: float = 0.2, seed: int = 42, clean: bool = True,
               encode: bool = False) -> DataFrame:
    """Drop every copy of repeated texts (per split, on raw text, Q3),
    clean (C14), drop texts under ``min_words`` words, add word length,
    then split 'train' into train/validation by (label, train length decile).

    With ``encode`` each row also gets the token ids of its whole text
    (``input_ids``, ``attention_mask``).  Rows whose ``split`` is not 'train' (e.g. 'test') keep their split.
    Shuffles: A1's hash count + anti join, one aggregate for the deciles,
    the split's bucket counts.  Cleaning and filtering are map-only.
    """
    if split_col not in df.columns:
        df = df.withColumn(split_col, F.lit("train"))
    df = curate.drop_all_copies(df, text_col, by=[split_col])
    df = curate.replace_texts(df, T.clean_sample(text_col) if clean else F.col(text_col), min_words, text_col, "length")
    # Cleaning is the expensive, map-only part; the decile barrier and the
    # split read its result several times, so it is written once (reliable
    # checkpoint in the shared checkpoint dir, survives executor loss).
    df = cut_lineage(df)
    train = df.filter(F.col(split_col) == "train")
    rest = df.filter(F.col(split_col) != "train")
    edges = curate.length_deciles(train, "length")        # 11 doubles (bounded)
    keyed = curate.with_strat_key(train.drop(split_col), edges, label_col, "length")
    split = curate.stratified_split(keyed, "strat_key", id_col, validation_size, seed,
                                    split_col=split_col)
    out = split.drop("length_bin", "strat_key").unionByName(rest)
    if encode:
        out = (out.withColumn("__e", tokens.encode(text_col))
               .withColumns({c: F.col(f"__e.{c}") for c in ("input_ids", "attention_mask")}).drop("__e"))
    return out
