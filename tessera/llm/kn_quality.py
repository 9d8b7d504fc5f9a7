"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model (operator 6).

The model is of word bigrams over hashes of 48 bits, so its tables grow with the corpus and word
order counts.  Words are runs of letters and digits, and single other characters, with the blank
before them.  Below the unigrams, a word is spelled by a Kneser-Ney model of character trigrams of
the distinct trusted words, so misspelt and unseen words have a probability of their own;
perplexities are per character.

1. Tasks count the bigrams of trusted texts; a step's bigrams go to buckets by ranges of their keys,
   each as one compressed row, and a bucket adds up its own.
2. Each bucket hands on, word by word, what its bigrams say of their first word (occurrences, and
   followers met once, twice, more often) and of their second one (words before it); buckets of
   words add that up.  A word has one entry a bucket, so no word is a hot key.
3. Documents are dealt to chunks of about ``CHUNK_CHARS`` by a hash of the whole row, packed as compressed Arrow.  Each
   chunk asks the buckets for the counts of its distinct bigrams and words, and interpolates.  The chunks are judged in
   ``WAVES``, and the shuffle files of one go before the next begins, so texts, questions and answers are never
   all on disk at once; the documents are read once for each wave.
4. The spelling model has ``CLASSES`` classes of characters, so its table is of ``CLASSES`` ** 3
   numbers at any size of the corpus, and each task has it whole.
5. Short texts say little: for the verdict, each text gets ``PRIOR_CHARS`` more characters at
   the mean of its language's trusted text.  A document is rejected if that perplexity is
   over the ``QUANTILE`` of the trusted documents of its language, times ``SLACK``.

Trusted documents are those with the label quality = 1.  Four fifths of them, by a digest of
the id, train the model, and the rest, which it has not seen, give the means and quantiles: text
that was counted looks better than it is, the more so the less there is.  The ids are counted: up to ``BROADCAST_IDS`` they are sent out, beyond that both sides are dealt by id.

Defined cases: null and empty texts have no perplexity and are rejected; languages without
trusted documents (null is one language) use the quantile over all trusted ones; without
any trusted document every text with characters stays; conflicting labels of an id do not
make it trusted; equal rows are judged alike, and a perplexity at the limit stays; texts of any
length are whole, a run of letters without end is one word; other columns pass through; an empty
table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, freed_shuffles, gather, hide, join_lookup, joined_steps, restore, set_for, steps, text_bytes, tidy, whole

CHUNK_CHARS = 10_000_000
#: Parts of the chunks that are judged one after the other; disk, and how often the documents are read, depend on it.
WAVES = 4
#: Characters of all texts for each bucket of the tables.
BUCKET_CHARS = 12_000_000
BROADCAST_IDS = 1_000_000
#: Bytes of text whose words a task takes apart at once.
AT_ONCE = 1 << 19
#: Bytes of text whose counts, and whose packed rows, are handed on at once.
COUNT_AT_ONCE = 4 << 20
PACK_AT_ONCE = 8 << 20
#: Documents that a task is handed at once; 10,000 are 34 MB of text, in the task's buffers and in Python's.
ROWS_AT_ONCE = 1_000
PRIOR_CHARS = 50
QUANTILE = 0.99
SLACK = 1.2
#: One of so many trusted documents is kept from the counts, for the thresholds.
HOLD = 5
#: Classes of characters in spellings: printable ASCII, 31 for all others, before and after a word.
CLASSES = 128
BEFORE, AFTER = 126, 127
#: Scripts without blanks: every character is a word.
CJK = "぀-ヿ㐀-鿿"
KEY_BITS = 48
#: Odd numbers for hashing; BASE - 1 has one factor of two.
BASE, MIX1, MIX2 = 0xD1342543DE82EF97, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


# ------------------------------------------------------------------------ words

@functools.lru_cache(1)
def _kinds() -> np.ndarray:
    """Of each code point: 1 in words, 2 white space, 3 the blank, 0 anything else."""
    every = "".join(map(chr, range(0x110000)))
    kinds = np.zeros(0x110000, np.uint8)
    for number, pattern in ((1, rf"[^\W{CJK}]+"), (2, r"\s+")):
        for m in re.finditer(pattern, every):
            kinds[m.start():m.end()] = number
    kinds[0x20] = 3
    return kinds


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    back = pow(BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.r_[np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]) for b in (BASE, back))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(1)
def _mixed_points() -> np.ndarray:
    return _mixed(np.arange(1, 0x110001, dtype=np.uint64))


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, where each is found, the place of every key among them)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    return ordered[new], order[new], of


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order; numpy's unique hashes them, which takes several times as long and more memory."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


class Words:
    """The words of all texts of a column: ``cps`` code points, ``at`` offsets of the texts in them,
    ``begins`` where words begin, ``to`` offsets of the texts in these, ``key`` hash of each word."""

    def __init__(self, column: pa.Array) -> None:
        raw, off = text_bytes(column)
        self.cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        self.at = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][off]
        kind = _kinds()[self.cps]
        start = np.ones(len(kind), bool)
        start[1:] = ~(((kind[1:] == 1) & (kind[:-1] == 1)) | ((kind[:-1] == 3) & (kind[1:] < 2)))
        start[self.at[:-1][np.diff(self.at) > 0]] = True
        self.begins = np.flatnonzero(start)
        self.ends = np.r_[self.begins[1:], len(kind)] if len(kind) else self.begins
        self.to = np.searchsorted(self.begins, self.at)
        up, down = _powers(1 << max(10, int(len(kind) - 1).bit_length()))
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_mixed_points()[self.cps] * up[:len(kind)])]
        own = (sums[self.ends] - sums[self.begins]) * down[self.begins]
        self.key = np.maximum(_mixed(own + (self.ends - self.begins).astype(np.uint64)) >> np.uint64(64 - KEY_BITS), 1).astype(np.int64)

    def before(self) -> np.ndarray:
        """The key of the word before each in its text, or 0."""
        found = np.r_[0, self.key[:-1]] if len(self.key) else self.key
        found[self.to[:-1][np.diff(self.to) > 0]] = 0
        return found

    def spelling(self, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the character trigrams of all words or of ``some``, those with which words end, and where words begin in the first."""
        if some is None:
            cps, begins, ends = self.cps, self.begins, self.ends
        else:
            size = self.ends[some] - self.begins[some]
            cps, ends = self.cps[gather(self.begins[some], size)], np.cumsum(size)
            begins = ends - size
        one = spelled_class(cps)
        two = np.r_[np.int32(BEFORE), one[:-1]].astype(np.int32)[:len(one)]
        two[begins] = BEFORE
        three = np.r_[np.int32(BEFORE), two[:-1]].astype(np.int32)[:len(one)]
        three[begins] = BEFORE
        last = ends - 1
        return (three * CLASSES + two) * CLASSES + one, (two[last] * CLASSES + one[last]) * CLASSES + AFTER, begins


def spelled_class(cps: np.ndarray) -> np.ndarray:
    return np.where((cps >= 32) & (cps < 127), cps - np.uint32(32), 95 + cps % 31).astype(np.int32)


def pair_key(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    mixed = _mixed(x.astype(np.uint64) * np.uint64(BASE) + y.astype(np.uint64) * np.uint64(MIX2))
    return (mixed >> np.uint64(64 - KEY_BITS)).astype(np.int64)


# ----------------------------------------------------------------- packed tables

ROW = "kind int, bucket long, of long, n long, keys binary, data binary"
FIELDS = {"kind": pa.int32(), "bucket": pa.int64(), "of": pa.int64(), "n": pa.int64(), "keys": pa.binary(), "data": pa.binary()}
PAIRS, WORDS = 0, 1
#: Numbers of a word: occurrences before another, followers met once, twice, more often, words met before it.
OF_WORD = 5


def _squeeze(data: np.ndarray) -> bytes:
    """Compressed, the first bytes of all numbers before the second ones and so on."""
    planes = np.ascontiguousarray(data).view(np.uint8).reshape(-1, data.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _expand(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(blob, n * 8, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def _rows(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(FIELDS)
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(FIELDS.items(), columns, strict=True)})


def _ranges(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys, by ranges of the keys."""
    edges = np.array([-(-(b << KEY_BITS) // buckets) for b in range(buckets + 1)], np.int64)
    ends = np.searchsorted(keys, edges).tolist()
    return [(b, lo, hi) for b, (lo, hi) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if hi > lo]


def _dealt(kind: int, of: int, keys: np.ndarray, data: np.ndarray | None, buckets: int) -> list[tuple]:
    """Rows of sorted ``keys`` and the columns of ``data``, by bucket."""
    return [(kind, b, of, hi - lo, _squeeze(np.diff(keys[lo:hi], prepend=0)), b"" if data is None else _squeeze(data[:, lo:hi].ravel()))
            for b, lo, hi in _ranges(keys, buckets)]


def _keys(row: dict) -> np.ndarray:
    return np.cumsum(_expand(row["keys"], row["n"]))


def _added(keys: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sums of the columns of ``data``, where each key is found)."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(data[:, order], first, axis=1) if len(first) else data[:, :0], order[first]


def count_pairs(texts: DataFrame, buckets: int) -> DataFrame:
    """Packed rows of ``texts`` (text): the bigrams with their words and counts, by bucket, once for each step."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in joined_steps(batches, "text", COUNT_AT_ONCE):
            held = []
            for batch in steps(iter([big]), "text", AT_ONCE):
                words = Words(batch.column(batch.schema.get_field_index("text")))
                x, y = words.before(), words.key
                keys, c, first = _added(pair_key(x, y), np.ones((1, len(y)), np.int64))
                held.append((keys, c[0], x[first], y[first]))
            key, c, x, y = (np.concatenate(v) for v in zip(*held, strict=True))
            keys, sums, first = _added(key, c[None])
            x, y, out = x[first], y[first], []
            for b, lo, hi in _ranges(keys, buckets):
                by = np.argsort(x[lo:hi], kind="stable")   # equal words side by side
                out.append((PAIRS, b, 0, hi - lo, _squeeze(np.diff(x[lo:hi][by], prepend=0)),
                            _squeeze(np.r_[sums[0, lo:hi][by], y[lo:hi][by]])))
            yield from _rows(out).to_batches()

    return texts.mapInArrow(run, ROW)


def pair_tables(counted: DataFrame, buckets: int) -> DataFrame:
    """Packed rows: each bucket's distinct bigrams with their counts, and what they say of their words."""

    @tidy
    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        x = np.concatenate([_keys(r) for r in rows])
        c, y = np.concatenate([_expand(r["data"], 2 * r["n"]).reshape(2, -1) for r in rows], axis=1)
        keys, sums, first = _added(pair_key(x, y), c[None])
        c, x, y = sums[0], x[first], y[first]
        words, of = np.unique(np.r_[x, y], return_inverse=True)
        first, second = of[:len(x)], of[len(x):]
        many = lambda at, weights=None: np.bincount(at, weights, len(words)).astype(np.int64)
        numbers = np.stack([many(first, c), many(first[c == 1]), many(first[c == 2]), many(first[c > 2]), many(second)])
        return _rows([(PAIRS, rows[0]["bucket"], 0, len(keys), _squeeze(np.diff(keys, prepend=0)), _squeeze(c)),
                      *_dealt(WORDS, rows[0]["bucket"], words, numbers, buckets)])

    return counted.groupBy("bucket").applyInArrow(merge, ROW)


def word_tables(tables: DataFrame) -> DataFrame:
    """Packed rows: each bucket's distinct words with their numbers."""

    @tidy
    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words, numbers, _ = _added(np.concatenate([_keys(r) for r in rows]), np.concatenate(
            [_expand(r["data"], OF_WORD * r["n"]).reshape(OF_WORD, -1) for r in rows], axis=1))
        return _rows([(WORDS, rows[0]["bucket"], 0, len(words), _squeeze(np.diff(words, prepend=0)), _squeeze(numbers.ravel()))])

    return tables.filter(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(merge, ROW)


def less(n: list[int]) -> np.ndarray:
    """Discounts of the counts 0, 1, 2 and more, from how many n-grams have the counts 1 to 4; a tenth
    at least, so that what was not met has a probability."""
    n = [0, *n]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    return np.array([0.0, *(min(float(k), max(0.1, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.5 for k in (1, 2, 3))])


def _counts_of_counts(tables: DataFrame, kind: int) -> list[int]:
    """How many keys have the counts 1, 2, 3, 4, how many any, and the sum of the counts."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = _expand(row["data"], row["n"] * (OF_WORD if kind == WORDS else 1))[-row["n"]:]   # words: the last column
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (
                    *(int((c == k).sum()) for k in range(1, 5)), int((c > 0).sum()), int(c.sum()))], names=list("abcdef"))

    found = tables.filter(F.col("kind") == kind).mapInArrow(run, "a long, b long, c long, d long, e long, f long")
    return [x or 0 for x in found.agg(*[F.sum(c) for c in "abcdef"]).first()]   # one row


def spelling_table(texts: DataFrame) -> np.ndarray:
    """Log probability of every character trigram, from the distinct words of ``texts`` (text)."""

    @tidy
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in joined_steps(batches, "text", COUNT_AT_ONCE):
            seen: dict[int, str] = {}
            for batch in steps(iter([big]), "text", AT_ONCE):
                w = Words(batch.column(batch.schema.get_field_index("text")))
                keys, first = np.unique(w.key, return_index=True)
                for key, i in zip(keys.tolist(), first.tolist(), strict=True):
                    if key not in seen:
                        seen[key] = w.cps[w.begins[i]:w.ends[i]].tobytes().decode("utf-32-le")
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.string())], names=["key", "text"])

    @tidy
    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined_steps(batches, "text", AT_ONCE):
            w = Words(batch.column(batch.schema.get_field_index("text")))
            g, c = np.unique(np.concatenate(w.spelling()[:2]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int64)), pa.array(c)], names=["g", "c"])

    distinct = texts.mapInArrow(words, "key long, text string").groupBy("key").agg(F.min("text").alias("text"))
    found = distinct.select("text").mapInArrow(trigrams, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(CLASSES ** 3, np.int64)   # CLASSES ** 3 rows at most
    counts[found.column("g").to_numpy()] = found.column("c").to_numpy()
    return spelling_probabilities(counts)


def spelling_probabilities(counts: np.ndarray) -> np.ndarray:
    """Natural logarithms of the interpolated probabilities, by the code of the trigram."""
    p = np.full(CLASSES, 1.0 / CLASSES)
    for order in (1, 2, 3):
        c = counts.reshape([CLASSES] * 3)
        for _ in range(3 - order):   # how many different characters come before
            c = (c > 0).sum(0)
        d = less([int((c == k).sum()) for k in range(1, 5)])[np.minimum(c, 3)]
        total, freed = c.sum(-1, keepdims=True), d.sum(-1, keepdims=True)
        p = np.where(total > 0, (c - d + freed * p) / np.maximum(total, 1), p)
    return np.log(p).astype(np.float32).ravel()


# ---------------------------------------------------------------------- scoring

def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.filter("doc_id is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("least"), F.count("quality").alias("n")).filter("least = 1 and n > 0")
            .select(F.col("doc_id").alias("_trusted_id")))


def with_trust(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the columns _train and _hold."""
    ids = cut(trusted_ids(labels))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    turn = F.pmod(F.xxhash64(F.coalesce(docs[doc_id].cast("string"), F.lit(""))), F.lit(HOLD))
    return (docs.drop("_train", "_hold").join(ids, docs[doc_id] == F.col("_trusted_id"), "left")
            .withColumns({"_train": F.col("_trusted_id").isNotNull() & (turn != 0),
                          "_hold": F.col("_trusted_id").isNotNull() & (turn == 0)}).drop("_trusted_id"))


def _pack(docs: DataFrame, text: str, chunks: int, wave: int, waves: int) -> DataFrame:
    """(_chunk, packed): the rows of ``docs`` in every ``waves``-th chunk from ``wave``, several to a row, as compressed Arrow streams."""
    plain = [c for c, kind in docs.dtypes if not kind.startswith("map")]
    dealt = docs.withColumn("_chunk", F.pmod(F.xxhash64(*plain), F.lit(chunks))).filter(F.col("_chunk") % waves == wave)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined_steps(batches, text, PACK_AT_ONCE):
            chunk = batch.column(batch.schema.get_field_index("_chunk")).to_numpy()
            found, blobs = np.unique(chunk), []
            for c in found:
                sink = pa.BufferOutputStream()
                part = batch.take(pa.array(np.flatnonzero(chunk == c)))
                options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
                with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                    out.write_batch(part)
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], names=["_chunk", "packed"])

    return dealt.mapInArrow(run, "_chunk long, packed binary")


def _unpack(packed: pa.Table, text: str) -> Iterator[pa.RecordBatch]:
    for blob in packed.column("packed"):
        with pa.ipc.open_stream(blob.as_buffer()) as stream:
            yield from steps(stream, text, AT_ONCE)


def _ask(packed: DataFrame, text: str, buckets: int) -> DataFrame:
    """Packed rows: the distinct bigrams and words of each chunk, by bucket."""

    @tidy
    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows([])
        held: dict[int, list[np.ndarray]] = {PAIRS: [], WORDS: []}
        for batch in _unpack(table, text):
            w = Words(batch.column(batch.schema.get_field_index(text)))
            for kind, keys in ((PAIRS, pair_key(w.before(), w.key)), (WORDS, np.r_[0, w.key])):
                held[kind].append(_distinct(keys))
                if len(held[kind]) > 8 and sum(map(len, held[kind][1:])) > len(held[kind][0]):
                    held[kind] = [_distinct(np.concatenate(held[kind]))]
        pairs, words = (_distinct(np.concatenate([np.zeros(0, np.int64), *held[kind]])) for kind in (PAIRS, WORDS))
        chunk = table.column("_chunk")[0].as_py()
        return _rows([*_dealt(PAIRS, chunk, pairs, None, buckets), *_dealt(WORDS, chunk, words, None, buckets)])

    return packed.groupBy("_chunk").applyInArrow(run, ROW)


def _answer(asked: DataFrame, tables: DataFrame) -> DataFrame:
    """Packed rows: of each asked row the keys that the tables hold, with their numbers."""

    @tidy
    def run(asked: pa.Table, table: pa.Table) -> pa.Table:
        if not asked.num_rows or not table.num_rows:
            return _rows([])
        own = table.to_pylist()[0]
        width = OF_WORD if own["kind"] == WORDS else 1
        keys, data = _keys(own), _expand(own["data"], width * own["n"]).reshape(width, -1)
        out = []
        for batch in asked.to_batches(max_chunksize=64):
            for row in batch.to_pylist():
                mine, at, _ = np.intersect1d(keys, _keys(row), assume_unique=True, return_indices=True)
                if len(mine):
                    out.append((row["kind"], row["bucket"], row["of"], len(mine), _squeeze(np.diff(mine, prepend=0)), _squeeze(data[:, at].ravel())))
        return _rows(out)

    by = ["kind", "bucket"]
    return asked.groupBy(*by).cogroup(tables.groupBy(*by)).applyInArrow(run, ROW)


def _lookup(keys: np.ndarray, data: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The columns of ``data`` for the ``wanted`` keys in order, zeros for those that ``keys`` lacks."""
    if not len(keys):
        return np.zeros((len(data), len(wanted)), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, data[:, at], 0)


def _probabilities(words: Words, pairs: tuple, known: tuple, spelled: np.ndarray, d1: np.ndarray, d2: np.ndarray,
                   total: int, freed: float) -> np.ndarray:
    """Natural log probability of each word after the one before it, worked out once for each distinct bigram."""
    own, first, of = _grouped(words.key)
    inside, last, begins = words.spelling(first)
    spell = np.add.reduceat(spelled[inside].astype(np.float64), begins) + spelled[last]
    numbers = _lookup(*known, np.r_[0, own])   # at 0 what begins a text
    before = np.r_[0, of[:-1] + 1]
    before[words.to[:-1][np.diff(words.to) > 0]] = 0
    keys, at, of_pair = _grouped(pair_key(np.r_[0, own][before], words.key))
    x, y = before[at], of[at]
    met, (occurs, once, twice, more) = numbers[4, y + 1], numbers[:4, x]
    c = _lookup(*pairs, keys)[0]
    left = once * d2[1] + twice * d2[2] + more * d2[3]
    lp = spell[y]
    with np.errstate(divide="ignore"):   # in logarithms, as the spelling of a very long word is beyond floats
        if total:
            lp = np.logaddexp(np.log((met - d1[np.minimum(met, 3)]) / total), np.log(freed / total) + lp)
        some = np.maximum(occurs, 1)
        return np.where(occurs > 0, np.logaddexp(np.log((c - d2[np.minimum(c, 3)]) / some), np.log(left / some) + lp), lp)[of_pair]


def word_perplexity(docs: DataFrame, text: str = "text", train: str = "_train", keep_text: bool = True) -> DataFrame:
    """``docs`` with _chars and _ppl, each text's perplexity per character (null without any) under
    the word model of the texts for which ``train`` is true; written and read again."""
    rows = set_for(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    with freed_shuffles(docs.sparkSession), rows:
        return _word_perplexity(docs, text, train, keep_text)


def _word_perplexity(docs: DataFrame, text: str, train: str, keep_text: bool) -> DataFrame:
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0   # one number
    chunks, buckets = (max(1, -(-chars // each)) for each in (CHUNK_CHARS, BUCKET_CHARS))
    trusted = docs.filter(F.col(train)).select(whole(text).alias("text"))
    tables = cut(pair_tables(count_pairs(trusted, buckets), buckets))
    of_words = cut(word_tables(tables))
    d2, n1 = less(_counts_of_counts(tables, PAIRS)[:4]), _counts_of_counts(of_words, WORDS)
    d1, total = less(n1[:4]), n1[5]
    freed = n1[0] * d1[1] + n1[1] * d1[2] + (n1[4] - n1[0] - n1[1]) * d1[3]
    spelled = spelling_table(trusted)

    docs = docs.drop("_ppl", "_chars", "_chunk")
    tables = tables.filter(F.col("kind") == PAIRS).unionByName(of_words)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, T.StructField("_chars", T.LongType()), T.StructField("_ppl", T.DoubleType())])
    names = [f.name for f in schema.fields]

    @tidy
    def add_up(texts: pa.Table, table: pa.Table) -> pa.Table:
        held = {}
        for kind, width in ((PAIRS, 1), (WORDS, OF_WORD)):
            rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
            held[kind] = (np.concatenate([np.zeros(0, np.int64), *map(_keys, rows)]), np.concatenate(
                [np.zeros((width, 0), np.int64), *(_expand(r["data"], width * r["n"]).reshape(width, -1) for r in rows)], axis=1))
        out = []
        for batch in _unpack(texts, text):
            words = Words(batch.column(batch.schema.get_field_index(text)))
            lp = _probabilities(words, held[PAIRS], held[WORDS], spelled, d1, d2, total, freed) if len(words.key) else np.zeros(0)
            sums, size = np.r_[0.0, np.cumsum(lp)], np.diff(words.at)
            with np.errstate(invalid="ignore", divide="ignore"):
                ppl = np.exp(-(sums[words.to[1:]] - sums[words.to[:-1]]) / size)
            have = dict(zip(batch.schema.names, batch.columns, strict=True))
            have |= {"_chars": pa.array(size.astype(np.int64)), "_ppl": pa.array(ppl, pa.float64(), mask=size == 0)}
            out.append(pa.RecordBatch.from_arrays([have[n] for n in names], names=names))
        return pa.Table.from_batches(out)

    waves, scored = min(WAVES, chunks), []
    for wave in range(waves):
        packed = _pack(docs, text, chunks, wave, waves)
        answers = _answer(_ask(packed, text, buckets), tables)
        scored.append(cut(packed.groupBy("_chunk").cogroup(answers.groupBy("of")).applyInArrow(add_up, schema)))
    return functools.reduce(DataFrame.unionByName, scored)


def decide(scored: DataFrame, lang: str = "lang", quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """``scored`` (lang, _hold, _chars, _ppl) with _smooth, _limit and _keep."""
    keyed = scored.withColumns({
        "_lang": F.coalesce(F.concat(F.lit("l"), F.col(lang).cast("string")), F.lit("")),
        "_bits": F.log("_ppl") * F.col("_chars")})
    mean = lambda: F.sum(F.when(F.col("_hold"), F.col("_bits"))) / F.sum(
        F.when(F.col("_hold") & F.col("_ppl").isNotNull(), F.col("_chars")))
    over_all = keyed.agg(mean()).first()[0]   # one number
    means = cut(keyed.groupBy("_lang").agg(F.coalesce(mean(), F.lit(over_all).cast("double")).alias("_mean")))
    keyed = join_lookup(keyed, means, "_lang").withColumn("_smooth", F.exp(
        (F.col("_bits") + PRIOR_CHARS * F.coalesce(F.col("_mean"), F.lit(0.0))) / (F.col("_chars") + PRIOR_CHARS)))
    cut_off = lambda: F.percentile_approx(F.when(F.col("_hold"), F.col("_smooth")), quantile, 100_000) * slack
    over_all = keyed.agg(cut_off()).first()[0]   # one number
    limits = cut(keyed.groupBy("_lang").agg(F.coalesce(cut_off(), F.lit(over_all).cast("double")).alias("_limit")))
    keep = F.col("_ppl").isNotNull() & (F.col("_limit").isNull() | (F.col("_smooth") <= F.col("_limit")))
    return join_lookup(keyed, limits, "_lang").drop("_lang", "_mean", "_bits").withColumn("_keep", keep)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 128-bit key of the whole row."""
    plain = [c for c, kind in docs.dtypes if not kind.startswith("map")]
    return docs.withColumns({"_k1": F.xxhash64(*plain), "_k2": F.xxhash64(F.lit(1), *plain)})


def _rejected(decided: DataFrame) -> DataFrame:
    return decided.filter(~F.col("_keep")).select("_k1", "_k2").distinct()


def _sent(rejected: DataFrame) -> DataFrame:
    """Rejected keys are counted: up to ``BROADCAST_IDS`` they are sent out, beyond that both sides are dealt."""
    rejected = cut(rejected)
    return F.broadcast(rejected) if rejected.count() <= BROADCAST_IDS else rejected


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang",
             doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, lang, perplexity, limit and kept."""
    narrow = with_trust(_keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))), labels)
    decided = decide(word_perplexity(narrow, keep_text=False))
    return decided.select("doc_id", "lang", F.col("_ppl").alias("perplexity"), F.col("_limit").alias("limit"),
                          F.col("_keep").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang",
              doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that the model rejects.

    Rows are judged by their id, language and text alone; the rejected ones are found again
    by a 128-bit key of the whole row, so no other column goes through the tasks."""
    hidden, names = hide(docs)
    keyed = _keyed(hidden)
    narrow = with_trust(keyed.select(F.col(names[doc_id]).alias("doc_id"), F.col(names[lang]).alias("lang"),
                                     F.col(names[text]).alias("text"), "_k1", "_k2"), labels)
    rejected = _rejected(decide(word_perplexity(narrow, keep_text=False)))
    return restore(keyed.join(_sent(rejected), ["_k1", "_k2"], "left_anti"), names)
