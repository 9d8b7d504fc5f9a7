"""Toxicity by bags of subword embeddings averaged into a linear softmax (operator 9).

A word (lower case, without punctuation at its ends) is the mean of the embeddings of its
character n-grams, begin and end marked, and of itself, each hashed to a bucket; a document
is the mean of its words; a linear softmax over it gives the score.  Embeddings and softmax
are trained jointly in numpy.  Misspellings share most n-grams with the word they come from.

The fit takes a bounded sample of labelled rows: ``TRAIN_ROWS`` rows, filled evenly by label and
language in the order of a digest of their ids, so small languages and the rarer label come in whole first.
Of a very long row it takes ``TRAIN_WORDS`` distinct words with their counts, drawn by a digest of row and word,
so what reaches the driver has a fixed bound.  Training draws toxic and clean rows equally often, and
each language equally often within them; embeddings begin near zero and are drawn there (``SHRINK``), so n-grams
that training rarely saw weigh little.  Languages only steer the drawing: no score looks at them.  Scoring
covers whole texts in tasks: the distinct words of a step are scored once each.

Defined cases: null and empty texts and texts without words score the share of toxic rows among all
that may train; very long texts are scored whole; repeated rows score alike; nothing is ranked, so there are no ties;
ids that are labelled more than once count as toxic if one row says so; rows
without a label or with a null one do not train; without any labelled rows of both kinds every score is the
share (0 if there are none); rows whose id is null count as held out; other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, gather, steps

TRAIN_ROWS = 5000
TRAIN_WORDS = 2000
BUCKETS = 1 << 16
DIMENSIONS = 4
#: Lengths of the character n-grams.
GRAMS = (3, 4, 5, 6)
#: Steps of the training; small samples are gone over oftener.
STEPS = 1000
BATCH = 100
RATE = 0.02
SHRINK = 1e-4
#: Words of the sample that are taken apart at once.
WORDS_AT_ONCE = 20_000
#: Spread of the embeddings at the start.
START = 0.005
#: Documents are means over many words; this brings them to the scale of a unit.
SCALE = 20.0
SEED = 42
EDGES = string.punctuation + "¡¿«»“”„’‘…–—"


def distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(text, word, count) of every distinct word of every text, and the words."""
    texts = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    parts = pc.ascii_split_whitespace(texts)
    text = pc.list_parent_indices(parts).to_numpy()
    words = pc.utf8_trim(pc.list_flatten(parts), characters=EDGES).dictionary_encode()
    names = words.dictionary.to_pylist()
    code = words.indices.to_numpy()
    keep = (np.array([bool(w) for w in names], bool)[code] if names else np.zeros(0, bool))
    key, count = np.unique(text[keep] * max(1, len(names)) + code[keep], return_counts=True)
    return key // max(1, len(names)), key % max(1, len(names)), count, names


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams of all words, n-grams of each word)."""
    marked = [f"<{w}>" for w in words]
    cps = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(w) for w in marked], np.int64)
    start = np.cumsum(size) - size
    of = [np.arange(len(words))]
    mix = np.uint64(0x100000001B3)
    prefix = np.r_[np.uint64(0), _prefix(cps, mix)]
    power = _powers(int(size.max(initial=1)) + 1, mix)
    whole_word = prefix[start + size] - prefix[start] * power[size]
    found = [_bucket(whole_word, 0)]
    for n in GRAMS:
        many = np.maximum(0, size - n + 1)
        at = gather(start, many)
        found.append(_bucket(prefix[at + n] - prefix[at] * power[n], n))
        of.append(np.repeat(np.arange(len(words)), many))
    of_word = np.concatenate(of)
    order = np.argsort(of_word, kind="stable")
    return np.concatenate(found)[order], np.bincount(of_word, minlength=len(words))


def _powers(n: int, mix: np.uint64) -> np.ndarray:
    return np.r_[np.uint64(1), np.cumprod(np.full(n, mix, np.uint64), dtype=np.uint64)]


def _prefix(cps: np.ndarray, mix: np.uint64) -> np.ndarray:
    """Polynomial hashes of all prefixes, modulo 2**64: the wrap-around is the modulus."""
    # h[i] = sum of c[j] * mix**(i - j) = mix**i * sum of c[j] * inverse**j
    inverse = np.uint64(pow(int(mix), -1, 1 << 64))
    back, forth = _powers(len(cps), inverse), _powers(len(cps), mix)
    return forth[:len(cps)] * np.cumsum((cps + np.uint64(1)) * back[:len(cps)], dtype=np.uint64)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    h = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(33)) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    embedding: np.ndarray   # buckets x dimensions
    weight: np.ndarray      # dimensions x 2
    bias: np.ndarray        # 2
    share: float

    def scores(self, text: np.ndarray, word: np.ndarray, count: np.ndarray, names: list[str], n: int) -> np.ndarray:
        """Probability of toxic of each of ``n`` texts."""
        out = np.full(n, self.share)
        if not len(text) or not len(self.embedding):
            return out
        vectors = word_vectors(self.embedding, *buckets_of(names))
        per_word = SCALE * vectors @ (self.weight[:, 1] - self.weight[:, 0])
        total = np.bincount(text, weights=count, minlength=n)
        mean = np.bincount(text, weights=count * per_word[word], minlength=n)
        has = total > 0
        logit = mean[has] / total[has] + self.bias[1] - self.bias[0]
        out[has] = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        return out


def word_vectors(embedding: np.ndarray, buckets: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.add.reduceat(embedding[buckets], np.cumsum(many) - many, axis=0) / many[:, None]


def train(docs: list[tuple[list[str], np.ndarray]], labels: np.ndarray, languages: np.ndarray, share: float) -> Model:
    """Joint training with Adam over batches of documents (words, counts); ``share`` is that of toxic rows."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros((0, DIMENSIONS)), np.zeros((DIMENSIONS, 2)), np.zeros(2), share)
    vocabulary: dict[str, int] = {}
    codes = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64) for words, _ in docs]
    names = list(vocabulary)
    parts = [buckets_of(names[at:at + WORDS_AT_ONCE]) for at in range(0, len(names), WORDS_AT_ONCE)]
    buckets, many = np.concatenate([b.astype(np.int32) for b, _ in parts]), np.concatenate([n for _, n in parts])
    del parts, names
    start = np.cumsum(many) - many
    # each document as its buckets and what each adds to the mean
    bags = []
    for own, (_, counts) in zip(codes, docs, strict=True):
        per_gram = counts / max(1, counts.sum()) / many[own] * SCALE
        bag = np.bincount(buckets[gather(start[own], many[own])], weights=np.repeat(per_gram, many[own]))
        at = np.flatnonzero(bag)
        bags.append((at.astype(np.int32), bag[at].astype(np.float32)))
    rng = np.random.default_rng(SEED)
    drawn = np.zeros(len(labels))
    for label in (0, 1):
        kinds = np.unique(languages[labels == label])
        for kind in kinds:
            own = (labels == label) & (languages == kind)
            drawn[own] = 0.5 / len(kinds) / own.sum()
    p = [rng.normal(0, START, (BUCKETS, DIMENSIONS)).astype(np.float32),
         rng.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32),
         np.log(np.array([1 - share, share], np.float32))]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for step in range(1, STEPS + 1):
        rate = RATE * (1 - step / STEPS)
        chosen = rng.choice(len(docs), BATCH, p=drawn)
        at = np.concatenate([bags[i][0] for i in chosen])
        part = np.concatenate([bags[i][1] for i in chosen])
        sizes = np.array([len(bags[i][0]) for i in chosen])
        doc = np.add.reduceat(p[0][at] * part[:, None], np.cumsum(sizes) - sizes, axis=0)
        z = doc @ p[1] + p[2]
        z = np.exp(z - z.max(1, keepdims=True))
        error = z / z.sum(1, keepdims=True)
        error[np.arange(len(chosen)), labels[chosen]] -= 1
        error /= len(chosen)
        back = np.repeat(error @ p[1].T, sizes, axis=0) * part[:, None]
        grads = [np.stack([np.bincount(at, weights=back[:, d], minlength=BUCKETS) for d in range(DIMENSIONS)], 1) + SHRINK * p[0],
                 doc.T @ error, error.sum(0)]
        for j, g in enumerate(grads):
            m[j] += 0.1 * (g.astype(np.float32) - m[j])
            v[j] += 0.01 * (np.square(g, dtype=np.float32) - v[j])
            p[j] -= np.float32(rate / (1 - 0.9 ** step)) * m[j] / (np.sqrt(v[j] / np.float32(1 - 0.99 ** step)) + np.float32(1e-8))
    return Model(*p, share)


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list, np.ndarray, np.ndarray, float]:
    """Words of a bounded sample of labelled rows that are not held out, their labels and languages, and
    the share of toxic rows among all that are not held out."""
    known = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out("doc_id"))
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    here = docs.select("doc_id", lang.alias("lang")).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    known = cut(known.join(here, "doc_id"))
    share = known.agg(F.avg("toxic")).first()[0] or 0.0   # one number
    digest = [F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")]
    place = F.row_number().over(Window.partitionBy("toxic", "lang").orderBy(*digest))
    known = cut(known.withColumn("place", place).filter(F.col("place") <= rows).orderBy("place", *digest).limit(rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "toxic", "text")   # ``rows`` rows
    schema = "doc_id long, toxic int, words array<string>, counts array<long>"

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            text, word, count, names = distinct_words(batch.column(2))
            out_words, out_counts = [], []
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            for doc, a, b in zip(batch.column(0).to_pylist(), ends[:-1], ends[1:], strict=True):
                own, many = word[a:b], count[a:b]
                if len(own) > TRAIN_WORDS:
                    drawn = [zlib.crc32(names[w].encode("utf-8", "surrogatepass"), zlib.crc32(str(doc).encode())) for w in own]
                    keep = np.sort(np.argsort(drawn, kind="stable")[:TRAIN_WORDS])
                    own, many = own[keep], many[keep]
                out_words.append([names[w] for w in own])
                out_counts.append(many.tolist())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int32()),
                pa.array(out_words, pa.list_(pa.string())), pa.array(out_counts, pa.list_(pa.int64()))],
                names=["doc_id", "toxic", "words", "counts"])

    one: dict[str, str] = {}   # each word is held once
    found = [(r.doc_id, [one.setdefault(w, w) for w in r.words], np.array(r.counts, np.int32), int(r.toxic > 0))
             for r in texts.mapInArrow(words, schema).toLocalIterator() if r.words]
    found.sort(key=lambda x: (x[0], x[1]))
    spoken = {r.doc_id: r.lang for r in known.select("doc_id", "lang").collect()}   # ``rows`` rows
    return ([(w, c) for _, w, c, _ in found], np.array([t for *_, t in found], np.int64),
            np.array([spoken[i] for i, *_ in found], object).astype(str), float(share))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` without ``text``, with the score of the whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)   # BUCKETS x DIMENSIONS floats
    docs = docs.drop(*[out] if out != text else [])
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != text], T.StructField(out, T.DoubleType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            have[out] = pa.array(sent.value.scores(*distinct_words(have[text]), batch.num_rows))
            yield pa.RecordBatch.from_arrays([have[n] for n in names], names=names)

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    plain = docs.select("doc_id", "text")
    model = train(*sample(docs, labels, rows))
    return score(plain, model).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
