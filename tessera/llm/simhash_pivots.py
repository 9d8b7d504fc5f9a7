"""Near duplicates by SimHash with pivot distance tables (operator 8).

1. Every whole text becomes a 64-bit fingerprint inside tasks (words of the lower-cased
   text, shingles, XXH64 with seed 42, majority per bit); equal fingerprints are grouped.
2. Each distinct fingerprint gets its Hamming distances to reference fingerprints: the
   zero fingerprint and one per block of two bits, whose distance less that to zero
   tells the bits set in the block, and further pseudo-random ones.
3. Two fingerprints at most ``max_bits`` apart differ in at most ``max_bits`` of the block
   coordinates.  The blocks form ``max_bits + 3`` groups, so three groups at least have
   equal coordinates; one table per choice of three groups, keyed by their coordinates,
   loses no pair.  Pairs that share a key are discarded when their largest difference in
   a pivot distance exceeds ``max_bits`` (triangle inequality) and the rest is verified.
   A key of over ``HOT_KEY`` distinct fingerprints makes no pairs: its members meet at the
   fingerprints around them instead (within half the bits of each), which is as exact and
   whose groups are bounded by the number of such neighbours.
4. Components by alternating large and small stars over the links, each round written to
   the checkpoint folder; no link, component or fingerprint list reaches the driver.

Defined cases: null texts are empty, texts without words have the fingerprint zero and
link like any other; equal rows are separate rows of one component; a component whose ids
are all null has a null id; other columns pass through, and columns with the names of the
results are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import cut, hide, restore, steps

SEED = 42
BLOCK_BITS = 2
#: Pseudo-random reference fingerprints beside those of the blocks.
RANDOM_PIVOTS = 16
#: Distinct fingerprints of a key from which on they meet at their neighbours.
HOT_KEY = 512
#: Shingles whose bits are counted at once.
COUNT_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one whole text as an unsigned integer."""
    import xxhash

    words = (text or "").encode().lower().split()   # on bytes: A-Z, and the six white-space characters
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(joined, SEED)]
    else:
        after = list(accumulate([len(w) + 1 for w in words]))
        hashes = [digest(joined[a:b - 1], SEED)
                  for a, b in zip([0, *after], after[shingle - 1:], strict=False)]
    ones = np.zeros(64, np.int64)
    h = np.array(hashes, dtype=">u8")
    for k in range(0, len(h), COUNT_AT_ONCE):
        bits = np.unpackbits(h[k:k + COUNT_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """``df`` without ``text``, with the fingerprint as a signed 64-bit integer."""
    df = df.drop(*[out] if out != text else [])
    schema = T.StructType([*[f for f in df.schema.fields if f.name != text], T.StructField(out, T.LongType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            have[out] = pa.array(np.array([fingerprint(x, shingle) for x in have[text].to_pylist()],
                                          np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([have[n] for n in names], names=names)

    return df.mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _distance(fp: Column, reference: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(reference)).cast("long")))


def block_references() -> list[int]:
    return [((1 << BLOCK_BITS) - 1) << k for k in range(0, 64, BLOCK_BITS)]


def random_references(n: int = RANDOM_PIVOTS) -> list[int]:
    rng = np.random.default_rng(SEED)
    return [int(x) for x in rng.integers(0, 1 << 64, n, dtype=np.uint64)]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(x, y), x < y: the linked pairs of a table of distinct fingerprints ``fp``;
    pairs met at a neighbour may stand for the longer way round in one component."""
    groups = max_bits + 3
    references = block_references()
    zero = _distance(F.col("fp"), 0)
    table = fps.select("fp", F.array(*[
        (zero - _distance(F.col("fp"), r)).cast("byte") for r in references]).alias("block"))
    edges = np.linspace(0, len(references), groups + 1).astype(int)
    part = [F.slice("block", int(a) + 1, int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    keyed = table.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.xxhash64(*[part[g] for g in chosen]).alias("key"))
        for i, chosen in enumerate(combinations(range(groups), 3))])).alias("k"))
    keyed = keyed.select("fp", F.col("k.t").alias("t"), F.col("k.key").alias("key"))
    shared = keyed.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("t", "key"))).filter("n > 1")
    shared = cut(shared)   # the few fingerprints with company

    near = shared.filter(F.col("n") <= HOT_KEY)
    pivots = F.array(*[_distance(F.col("fp"), r).cast("byte") for r in random_references()])
    near = near.select("t", "key", "fp", pivots.alias("pivots"))
    a, b = near.alias("a"), near.alias("b")
    gap = F.array_max(F.zip_with(F.col("a.pivots"), F.col("b.pivots"),
                                 lambda p, q: F.abs(p.cast("int") - q.cast("int"))))
    pairs = (a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key"))
                    & (F.col("a.fp") < F.col("b.fp")) & (gap <= max_bits)
                    & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits))
             .select(F.col("a.fp").alias("x"), F.col("b.fp").alias("y")))
    hot = shared.filter(F.col("n") > HOT_KEY).select("fp").distinct()
    return pairs.unionByName(_by_neighbours(hot, max_bits)).distinct()


def _by_neighbours(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links that join the fingerprints around a common neighbour.

    With an even ``max_bits``, two fingerprints link exactly if some fingerprint is at
    most half of it from both; each such neighbour ties its group to the smallest."""
    if max_bits % 2:
        raise ValueError("an even number of bits is needed")
    masks = [sum(1 << i for i in c) for k in range(max_bits // 2 + 1) for c in combinations(range(64), k)]
    around = fps.select("fp", F.explode(F.transform(
        F.array(*[F.lit(_signed(m)).cast("long") for m in masks]),
        lambda m: F.col("fp").bitwiseXOR(m))).alias("z"))
    least = F.min("fp").over(W.partitionBy("z"))   # at most len(masks) rows each
    return around.select(least.alias("x"), F.col("fp").alias("y")).filter("x < y")


def components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(node, root): the smallest node of each component, for every node of an edge."""
    state = cut(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                .filter("u <> v").distinct())
    seen = None
    for _ in range(most_rounds):
        mark = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                         F.bit_xor(F.xxhash64("v", "u"))).first()   # one row
        if mark == seen:
            break
        seen = mark
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        state = cut(small)
    else:
        raise RuntimeError("components did not settle")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _labels(marked: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``marked`` (doc_id, fp)."""
    firsts = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(firsts.select("fp"), max_bits))
    tied = firsts.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    tied = tied.withColumn("root", F.coalesce("root", "fp"))
    least = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    return tied.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """Per row: doc_id, fingerprint (hex) and component_id, the smallest id reachable."""
    marked = cut(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                              "text", shingle))
    return (marked.join(_labels(marked, max_bits), "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
             max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id (rows without
    an id come last; of equal ids in a component one row stays)."""
    docs, names = hide(docs)
    text, doc_id = names[text], names[doc_id]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = cut(fingerprints(narrow, "text", shingle))
    labels = _labels(marked, max_bits)
    found = marked.join(labels, "fp")
    roots = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    several = (marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
               .filter("rows > 1 or doc_id is null").select("doc_id"))
    single = roots.join(several, "doc_id", "left_anti").filter("doc_id is not null").select(
        F.col("doc_id").alias("_id"))
    kept = docs.join(single, docs[doc_id] == F.col("_id"), "left_semi")

    # rows whose id is null or not unique: few; of each, one row per component stays
    again = several.select(F.col("doc_id").alias("_id"))
    rows = docs.join(again, docs[doc_id].eqNullSafe(F.col("_id")), "left_semi")
    packed = rows.select(F.struct(*rows.columns).alias("row"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    packed = fingerprints(packed, "text", shingle).join(labels, "fp")
    packed = (packed.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("root").agg(F.min("row").alias("row")))
    return restore(kept.unionByName(packed.select("row.*")), names)
