"""Phrase collocations by SETM: occurrence relations, merge joins, group counts, semi-joins (operator 13).

Texts are lower-cased (A-Z) and cut into pieces, pieces into words; everything is per language (null:
``und``).  A candidate is a phrase of 2 to 4 words that occurs ``LEAST`` times or more.

1. *Occurrences.*  Tasks number the words of ``CHUNK_BYTES`` of text of one language at a time.  A chunk is
   one row: its word numbers in order of (piece, position), compressed, and its words with their counts.
   The relation is written once and is never shuffled as one row per word.
2. *Words.*  Chunk counts are added up; words of ``LEAST`` or more get an id of 32 bits, ranked within
   256 buckets so that no task sees the whole vocabulary.
3. *Merge join.*  Within a chunk, the relation of k words is joined with itself on equal piece and adjacent
   position, which gives that of k + 1 words, as both of its parts must be frequent.  Each chunk sends its
   distinct phrases with counts, dealt to buckets by a hash and compressed: their number grows with the
   occurrences, so a bucket fits in a task, and the most frequent phrase has one entry a chunk.
4. *Semi-join.*  Each bucket adds up its phrases and answers each chunk with a bit for each of its entries;
   each chunk drops occurrences that are in no frequent phrase.  The reduced, sorted relation is written,
   and 3. follows, until four words.
5. *Scores.*  Counts of the two parts of each cut come by joins on phrase keys (two 64-bit integers of four
   word ids, no hash).  Products are decimals and the division is whole, so scores are exact.  A
   candidate goes if the largest count of a longer candidate that holds it is at least 80 % of its own.

Lookup tables are counted: up to ``LOOKUP_ROWS`` rows they are broadcast, beyond that both sides are
dealt out, salted.  The first ``TOP`` of each language are the feature; ranking drops the others
task by task before the last sort.

Defined cases: a null or empty text has no words; a very long text is several chunks, cut at the end of a piece;
repeated rows count each; ties go to smaller cuts, then to larger counts and to the smaller phrase in
UTF-8; other columns are not read, whatever their names; an empty table gives no rows; more than
2 ** 32 - 1 frequent words end the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, cut, steps

LEAST = 30
TOP = 2000
LONGEST = 4
#: A longer candidate with this share of the count, in hundredths, makes a phrase redundant.
SHARE = 80
SCALE = 2_000_000
CHUNK_BYTES = 16 << 20
#: Bytes of text split into words at once.
AT_ONCE = 2 << 20
#: Occurrences for each bucket of phrases; a bucket's entries are no more, and fit in a task.
ENTRIES = 3_000_000
LOOKUP_ROWS = 1_000_000
BUCKETS = 256
BOUNDARIES = b".,;:!?\n\x0b\x0c\r"
#: Lower case, every boundary as a line feed, every blank as a space.
PLAIN = bytes(10 if b in BOUNDARIES else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
PHRASE = ["x", "y"]


# ------------------------------------------------------------------ occurrences

def _squeeze(data: np.ndarray) -> bytes:
    """Compressed, the first bytes of all numbers before the second ones and so on."""
    planes = np.ascontiguousarray(data).view(np.uint8).reshape(-1, data.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _expand(blob: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(blob, n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class _Chunk:
    """Word numbers of texts of one language: 0 where pieces end, words from 1."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {b"": -1, b"\n": 0}
        self.codes: list[np.ndarray] = []
        self.bytes = 0

    def add(self, text: bytes) -> None:
        known = self.known
        words = text.translate(PLAIN).replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter((known.setdefault(w, len(known) - 1) for w in words), np.int32, len(words))
        self.codes.append(codes[codes >= 0])
        self.codes.append(np.zeros(1, np.int32))
        self.bytes += len(text)

    def row(self, lang: str, number: int) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        codes = codes[(codes > 0) | np.r_[True, codes[:-1] > 0]]
        counts = np.bincount(codes, minlength=len(self.known) - 1)
        words = [w.decode("utf-8") for w in list(self.known)[2:]]
        return pa.RecordBatch.from_arrays([
            pa.array([number]), pa.array([lang]), pa.array([len(codes)]), pa.array([_squeeze(codes)], pa.binary()),
            pa.array([words], pa.list_(pa.string())), pa.array([counts[1:].tolist()], pa.list_(pa.int64()))],
            names=["chunk", "lang", "size", "codes", "words", "counts"])


def _parts(text: bytes, limit: int) -> Iterator[bytes]:
    """A text in parts of about ``limit`` bytes, cut after the end of a piece."""
    at = 0
    while len(text) - at > limit:
        ends = [e for e in (text.find(bytes([b]), at + limit) for b in BOUNDARIES) if e >= 0]
        if not ends:
            break
        yield text[at:min(ends) + 1]
        at = min(ends) + 1
    yield text[at:]


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: chunk, lang, size, codes (word numbers in order, 0 between pieces), words, counts."""
    narrow = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                         F.col(text).cast("string").alias("text")).filter("text != ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, _Chunk] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in steps(batches, "text", AT_ONCE):
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                for part in _parts(body, AT_ONCE):
                    chunk = open_.setdefault(name, _Chunk())
                    chunk.add(part)
                    largest = name
                    if chunk.bytes < chunk_bytes:
                        if sum(c.bytes for c in open_.values()) < 2 * chunk_bytes:
                            continue
                        largest = max(open_, key=lambda k: open_[k].bytes)
                    yield open_.pop(largest).row(largest, number)
                    number += 1
        for name, chunk in open_.items():
            yield chunk.row(name, number)
            number += 1

    return narrow.mapInArrow(run, "chunk long, lang string, size long, codes binary, words array<string>, counts array<long>")


def _collapse(ids: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One zero for each run of zeros."""
    keep = (ids > 0) | np.r_[True, ids[:-1] > 0] if len(ids) else np.zeros(0, bool)
    return ids[keep], flags[keep]


def _relation(chunk: int, ids: np.ndarray, flags: np.ndarray) -> pa.Table:
    """The chunk's occurrences: word ids in order of (piece, position), 0 between what is not
    adjacent, and flags, whether a frequent phrase of the last length starts there."""
    ids, flags = _collapse(ids, flags)
    return _table(RELATION, [(chunk, len(ids), _squeeze(ids.astype("<u4")), _squeeze(flags.astype(np.uint8)))])


def _table(kinds: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds.items(), columns, strict=True)})


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{n} {'binary' if pa.types.is_binary(t) else 'long'}" for n, t in kinds.items())


RELATION = {"chunk": pa.int64(), "size": pa.int64(), "ids": pa.binary(), "flags": pa.binary()}
#: The distinct phrases of a chunk that fall into a bucket, in order of (x, y), with their counts.
ASKED = {"bucket": pa.int64(), "of": pa.int64(), "n": pa.int64(), "xs": pa.binary(), "ys": pa.binary(), "cs": pa.binary()}
#: Which of them are frequent, and the (x, y, a) of those that no other row of the bucket hands on.
ANSWERS = {"bucket": pa.int64(), "of": pa.int64(), "n": pa.int64(), "yes": pa.binary(), "n_found": pa.int64(), "found": pa.binary()}


def _read(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return _expand(row["ids"], row["size"], "<u4").astype(np.int64), _expand(row["flags"], row["size"], "u1").astype(bool)


def merge_join(ids: np.ndarray, flags: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, x, y) of the phrases of k words both of whose parts of k - 1 words are frequent."""
    at = np.flatnonzero(flags[:-1] & flags[1:]) if len(ids) > 1 else np.zeros(0, np.int64)
    word = lambda d: ids[at + d]
    x = word(0) << 32 | word(1)
    y = np.zeros(len(at), np.int64) if k == 2 else word(2) << 32 | (word(3) if k == 4 else 0)
    return at, x, y


def _groups(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, number of the group of each in that order) by (x, y)."""
    order = np.lexsort((y, x)) if y.any() else np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    new = np.r_[False, (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(x) else np.zeros(0, bool)
    return order, np.cumsum(new)


def _distinct(ids: np.ndarray, flags: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(starts, number of the phrase at each start, x, y and c of the phrases in order of (x, y))."""
    at, x, y = merge_join(ids, flags, k)
    order, group = _groups(x, y)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
    of = np.empty(len(group), np.int64)
    of[order] = group
    return at, of, x[order][first], y[order][first], np.diff(np.r_[first, len(group)])


def _bucket(x: np.ndarray, y: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (y.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(x: np.ndarray, y: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by bucket, buckets there are, where each starts in that order and where the last ends)."""
    bucket = _bucket(x, y, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    return order, bucket[starts], np.r_[starts, len(bucket)]


def count_phrases(relation: DataFrame, k: int, least: int = LEAST, buckets: int = 1) -> DataFrame:
    """The frequent phrases of k words, and for each chunk and bucket which of its own are.

    Phrases are dealt to buckets by a hash; a chunk's share of a bucket is one compressed row.  A
    phrase has at most one entry a chunk, so no phrase fills a bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, x, y, c = _distinct(*_read(row), k)
                order, found, ends = _by_bucket(x, y, buckets)
                x, y, c = x[order], y[order], c[order]
                rows = [(b, row["chunk"], hi - lo, _squeeze(np.diff(x[lo:hi], prepend=0)), _squeeze(y[lo:hi]), _squeeze(c[lo:hi]))
                        for b, lo, hi in zip(found.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield from _table(ASKED, rows).to_batches()

    def answer(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        x = np.concatenate([np.cumsum(_expand(r["xs"], r["n"], "<i8")) for r in rows])
        y = np.concatenate([_expand(r["ys"], r["n"], "<i8") for r in rows])
        order, group = _groups(x, y)
        total = np.bincount(group, weights=np.concatenate([_expand(r["cs"], r["n"], "<i8") for r in rows])[order]).astype(np.int64)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sums, yes = np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        sums[order[first]] = np.where(total >= least, total, 0)   # the sort is stable: the first chunk's entry
        yes[order] = (total >= least)[group]
        out, at = [], 0
        for r in rows:
            mine = slice(at, at + r["n"])
            at += r["n"]
            if yes[mine].any():
                held = np.flatnonzero(sums[mine]) + mine.start
                out.append((r["bucket"], r["of"], r["n"], _squeeze(yes[mine].astype(np.uint8)), len(held),
                            _squeeze(np.concatenate([x[held], y[held], sums[held]]))))
        return _table(ANSWERS, out)

    return relation.mapInArrow(ask, _ddl(ASKED)).groupBy("bucket").applyInArrow(answer, _ddl(ANSWERS))


def _distinct(ids: np.ndarray, flags: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(starts, number of the phrase at each start, x, y and c of the phrases in order of (x, y))."""
    at, x, y = merge_join(ids, flags, k)
    order, group = _groups(x, y)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
    of = np.empty(len(group), np.int64)
    of[order] = group
    return at, of, x[order][first], y[order][first], np.diff(np.r_[first, len(group)])


def semi_join(relation: DataFrame, answers: DataFrame, k: int, buckets: int = 1) -> DataFrame:
    """The relation without the occurrences that are in no frequent phrase of k words."""

    def reduce(kept: pa.Table, found: pa.Table) -> pa.Table:
        row = kept.to_pylist()[0]
        ids, flags = _read(row)
        at, of, x, y, _ = _distinct(ids, flags, k)
        order, held, ends = _by_bucket(x, y, buckets)
        start = dict(zip(held.tolist(), ends[:-1].tolist(), strict=True))
        yes = np.zeros(len(x), bool)
        for r in found.select(["bucket", "n", "yes"]).to_pylist():
            lo = start[r["bucket"]]
            yes[order[lo:lo + r["n"]]] = _expand(r["yes"], r["n"], "u1").astype(bool)
        at = at[yes[of]]
        flags, inside = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        flags[at] = True
        for d in range(k):
            inside[at + d] = True
        return _relation(row["chunk"], np.where(inside, ids, 0), flags)

    return relation.groupBy("chunk").cogroup(answers.drop("n_found", "found").groupBy("of")).applyInArrow(reduce, _ddl(RELATION))


def frequent(answers: DataFrame) -> DataFrame:
    """(x, y, a) of all frequent phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, blob in zip(*(batch.column(c).to_pylist() for c in ("n_found", "found")), strict=True):
                found = _expand(blob, 3 * n, "<i8").reshape(3, n)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], names=["x", "y", "a"])

    return answers.select("n_found", "found").mapInArrow(run, "x long, y long, a long")


def _small(table: DataFrame) -> bool:
    return table.count() <= LOOKUP_ROWS


# ------------------------------------------------------------------------ words

def vocabulary(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, word, a, id) of the words that occur ``least`` times or more in their language."""
    counted = chunks.select("lang", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("c"))).alias("w"))
    counted = counted.groupBy("lang", "w.word").agg(F.sum("w.c").alias("a")).filter(F.col("a") >= least)
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(BUCKETS))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word")).cast("long")
    return counted.withColumn("bucket", bucket).withColumn("id", (place - 1) * BUCKETS + F.col("bucket") + 1).drop("bucket")


def frequent_words(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """The relation of one word: occurrences of frequent words only, as ids."""
    own = chunks.select(F.col("chunk").alias("of"), "lang", F.posexplode("words").alias("code", "word"))
    known = words.select("lang", "word", "id")
    answers = own.join(F.broadcast(known) if _small(known) else known, ["lang", "word"]).select("of", "code", "id")

    def number(kept: pa.Table, found: pa.Table) -> pa.Table:
        row = kept.to_pylist()[0]
        codes = _expand(row["codes"], row["size"], "<i4")
        ids = np.zeros(int(codes.max()) + 1 if len(codes) else 1, np.int64)
        ids[found.column("code").to_numpy() + 1] = found.column("id").to_numpy()
        return _relation(row["chunk"], ids[codes], ids[codes] > 0)

    return chunks.select("chunk", "size", "codes").groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(number, _ddl(RELATION))


# ----------------------------------------------------------------------- scores

def _key(words: list[Column]) -> Column:
    """The phrase key of up to four word ids."""
    w = [*words, *[F.lit(0).cast("long")] * (LONGEST - len(words))]
    return F.struct(F.shiftleft(w[0], 32).bitwiseOR(w[1]).alias("x"), F.shiftleft(w[2], 32).bitwiseOR(w[3]).alias("y"))


def _word(i: int) -> Column:
    half = F.col(PHRASE[i // 2])
    return F.shiftrightunsigned(half, 32) if i % 2 == 0 else half.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def _of_length(make) -> Column:
    """``make(k)`` for a row's number of words k."""
    out = make(2)
    for k in range(3, LONGEST + 1):
        out = F.when(F.col("k") == k, make(k)).otherwise(out)
    return out


def _lookup(big: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``big`` with the columns of ``table``, which has one row for each key."""
    if _small(table):
        return big.join(F.broadcast(table), keys)
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*[c for c in big.columns]), F.lit(SALTS)).cast("int")
    return big.withColumn("salt", salt).join(salted, [*keys, "salt"]).drop("salt")


def scored(counts: DataFrame) -> DataFrame:
    """(k, x, y, a, l, r, score) of the candidates that no longer one makes redundant.

    ``counts`` (k, x, y, a) has all frequent phrases, single words included, and is written already."""
    candidates, table = counts.filter("k > 1"), counts.select(*PHRASE, "a")
    part = lambda k, a, b: _key([_word(i) for i in range(a, b)])
    cuts = candidates.select("k", *PHRASE, "a", F.explode(_of_length(lambda k: F.array(*[F.struct(
        F.lit(c).alias("cut"), part(k, 0, c).alias("first"), part(k, c, k).alias("rest")) for c in range(1, k)]))).alias("p"))
    cuts = cuts.select("k", F.col("x").alias("cx"), F.col("y").alias("cy"), "a", "p.cut", "p.rest", "p.first.x", "p.first.y")
    cuts = _lookup(cuts, table.withColumnRenamed("a", "l"), PHRASE)
    cuts = cuts.select("k", "cx", "cy", "a", "cut", "l", "rest.x", "rest.y")
    cuts = _lookup(cuts, table.withColumnRenamed("a", "r"), PHRASE)
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy(F.col("cx").alias("x"), F.col("cy").alias("y"), "k", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    inside = candidates.filter("k > 2").select("a", F.explode(_of_length(lambda k: F.array(*[
        part(k, i, i + n) for n in range(2, max(k, 3)) for i in range(k - n + 1)]))).alias("s"))
    longer = inside.groupBy("s.x", "s.y").agg(F.max("a").alias("most"))
    return (best.join(longer, PHRASE, "left")
            .filter(F.col("most").isNull() | (100 * F.col("most") < SHARE * F.col("a")))
            .select("k", *PHRASE, "a", "best.l", "best.r", "best.score"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per language, its ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    chunks = cut(occurrences(docs, text, lang, chunk_bytes))
    words = cut(vocabulary(chunks, least))
    if (words.agg(F.max("id")).first()[0] or 0) >= 1 << 32:   # one number
        raise ValueError("more frequent words than 32 bits number")
    totals = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)).alias("n"))
    relation = cut(frequent_words(chunks, words))
    counts = words.select(F.lit(1).alias("k"), F.shiftleft("id", 32).alias("x"), F.lit(0).cast("long").alias("y"), "a")
    for k in range(2, LONGEST + 1):
        buckets = 1 + (relation.agg(F.sum("size")).first()[0] or 0) // ENTRIES   # one number
        answers = cut(count_phrases(relation, k, least, buckets))
        counts = counts.unionByName(frequent(answers).withColumn("k", F.lit(k)))
        if k < LONGEST:
            relation = cut(semi_join(relation, answers, k, buckets))
    counts = cut(counts)

    found = scored(counts).withColumn("id", _word(0))
    found = _lookup(found, words.select("id", "lang"), ["id"]).drop("id")
    order = [F.col("score").desc(), F.col("a").desc()]
    first = cut(found.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top))
    spelled = first.select(*PHRASE, F.posexplode(_of_length(lambda k: F.array(*[_word(i) for i in range(k)]))).alias("i", "id"))
    spelled = spelled.join(words.select("id", "word"), "id").groupBy(*PHRASE).agg(   # four words at most
        F.array_join(F.sort_array(F.collect_list(F.struct("i", "word"))).getField("word"), " ").alias("phrase"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
    return (first.join(spelled, PHRASE).withColumn("rank", place).filter(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def oracle_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same phrases in DuckDB, over lists of words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = "\n    UNION ALL\n    ".join(
        f"SELECT lang, {k} AS k, list_slice(words, i, i + {k - 1}) AS phrase FROM (SELECT lang, words, unnest(range(1, len(words) - {k - 2})) AS i FROM pieces)"
        for k in range(1, LONGEST + 1))
    return f"""
WITH pieces AS MATERIALIZED (
    SELECT lang, words FROM (
        SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\\n\\x0b\\x0c\\r]')), '[^ \\t]+') AS words
        FROM (SELECT coalesce(lang, 'und') AS lang, translate(text, '{upper}', '{lower}') AS text FROM documents WHERE text IS NOT NULL))
    WHERE len(words) > 0),
grams AS MATERIALIZED (
    SELECT lang, k, phrase, count(*) AS a FROM (
    {grams})
    GROUP BY lang, k, phrase HAVING count(*) >= {least}),
candidates AS (SELECT * FROM grams WHERE k > 1),
cuts AS (
    SELECT c.lang, c.phrase, c.k, c.a, c.cut, f.a AS l, g.a AS r,
           ({SCALE}::HUGEINT * c.a) // (f.a::HUGEINT + g.a) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN grams f ON f.lang = c.lang AND f.phrase = list_slice(c.phrase, 1, c.cut)
    JOIN grams g ON g.lang = c.lang AND g.phrase = list_slice(c.phrase, c.cut + 1, c.k)),
best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
    SELECT lang, list_slice(phrase, i, i + m - 1) AS phrase, max(a) AS most
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))
    GROUP BY ALL),
kept AS (
    SELECT b.lang, array_to_string(b.phrase, ' ') AS phrase, b.a, b.l, b.r, b.score
    FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE i.most IS NULL OR 100 * i.most < {SHARE} * b.a),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, t.n::BIGINT AS n,
       r.score::BIGINT AS score
FROM ranked r JOIN (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang) t USING (lang)
WHERE r.rank <= {top}"""
