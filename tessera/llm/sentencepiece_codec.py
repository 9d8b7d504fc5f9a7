"""SentencePiece BPE encoding and decoding as vectorised merge rounds (operator 1).

The vocabulary file is a parameter; its bytes (bounded by the vocabulary, not by
the data) are broadcast.  A step of a few MB of text is handled as flat arrays:

* the texts, each with the dummy prefix, are cut into words (a run of spaces and
  what follows it; no piece crosses such a border, which loading verifies);
* the distinct words of the step become one flat array of symbols;
* a round finds the smallest pair rank of every word (``minimum.reduceat``), merges
  all its occurrences leftmost first, looks up only the pairs that changed, and
  drops words without a pair left; rounds go on until no word is left;
* symbols outside the vocabulary become byte pieces, and the pieces of the words
  are gathered back into texts.

Simultaneous merges equal one-at-a-time merges unless a merge makes a pair of the
same or a smaller rank; such a word merges its first occurrence alone in that round.
A word of over ``LONG_WORD`` symbols is merged by the same rule with a heap, since
rounds over it would cost its length times its merges.

Defined cases: a null or empty text has the begin and end ids alone and decodes to
an empty text; ids out of range make the task fail; other columns pass through.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import gather, steps, strings, text_bytes, tidy

#: No such pair.
NONE = np.int32(2**31 - 1)
#: Bytes of text, or of packed ids, that a task works on at once (some 30 times that in memory).
AT_ONCE = 1 << 20
#: Symbols of a word from which on it is merged with a heap.
LONG_WORD = 2048
SPACE = "▁"


@dataclass
class Vocabulary:
    """Tables of one model: pieces by id, symbols by code point, merges by pair."""

    bos: int
    eos: int
    symbol: np.ndarray      # code point -> id, or -1 - code point
    rank: np.ndarray        # id -> rank of the piece as a merge, equal for equal scores
    slots: np.ndarray       # hash table of pairs: left * size + right, or -1
    merged: np.ndarray      # id that the pair of the slot makes
    mask: int
    probes: int
    byte_id: np.ndarray     # byte -> id
    piece_bytes: np.ndarray
    piece_at: np.ndarray    # id -> offset in piece_bytes
    control: np.ndarray     # id -> drops out when decoded
    from_byte: np.ndarray   # id -> is a byte piece

    @staticmethod
    @lru_cache(maxsize=4)
    def load(model: bytes) -> Vocabulary:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (train.model_type != 2 or not train.byte_fallback or norm.precompiled_charsmap
                or not norm.add_dummy_prefix or norm.remove_extra_whitespaces
                or train.treat_whitespace_as_suffix or proto.denormalizer_spec.precompiled_charsmap):
            raise ValueError("a BPE model with byte fallback, dummy prefix and no normalisation is needed")
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = len(proto.pieces)
        kinds = np.array([p.type for p in proto.pieces])
        names = [p.piece for p in proto.pieces]
        if set(kinds) - {1, 2, 3, 6}:
            raise ValueError("user-defined or unused pieces are not supported")
        normal = {p: i for i, p in enumerate(names) if kinds[i] == 1}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece crosses words")
        scores = np.array([p.score for p in proto.pieces])
        rank = np.full(n, NONE, np.int32)
        ids = np.flatnonzero(kinds == 1)
        rank[ids] = np.unique(-scores[ids], return_inverse=True)[1]
        symbol = -1 - np.arange(0x110000, dtype=np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                symbol[ord(p)] = i
        symbol[0x20] = symbol[ord(SPACE)]
        pairs = [(normal[p[:k]] * n + normal[p[k:]], i) for p, i in normal.items()
                 for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        size = 1 << (8 * len(pairs)).bit_length()
        slots, merged, probes = [-1] * size, [0] * size, 1
        first = _slot(np.array([k for k, _ in pairs], np.int64), size - 1).tolist()
        for at, (key, i) in zip(first, pairs, strict=True):
            tries = 1
            while slots[at] >= 0:
                at, tries = (at + 1) & (size - 1), tries + 1
            slots[at], merged[at], probes = key, i, max(probes, tries)
        slots, merged = np.array(slots, np.int64), np.array(merged, np.int32)
        byte_id = np.zeros(256, np.int32)
        raw = []
        for i, p in enumerate(names):
            if kinds[i] == 6:
                byte_id[int(p[3:5], 16)] = i
            raw.append(bytes([int(p[3:5], 16)]) if kinds[i] == 6 else b"" if kinds[i] == 3
                       else train.unk_surface.encode() if kinds[i] == 2
                       else p.replace(SPACE, " ").encode())
        return Vocabulary(
            sp.bos_id(), sp.eos_id(), symbol, rank, slots, merged, size - 1, probes, byte_id,
            np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]),
            kinds == 3, kinds == 6)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair; NONE where there is none."""
        key = left.astype(np.int64) * len(self.rank) + right
        key[(left < 0) | (right < 0)] = -2
        at = _slot(key, self.mask)
        hit = self.slots[at] == key
        for _ in range(self.probes - 1):
            open_ = np.flatnonzero(~hit & (self.slots[at] >= 0))
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            hit[open_] = self.slots[at[open_]] == key[open_]
        made = np.where(hit, self.merged[at], 0)
        return np.where(hit, self.rank[made], NONE), made


def _slot(key: np.ndarray, mask: int) -> np.ndarray:
    x = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) & np.uint64(mask)).astype(np.int64)


def merge_words(v: Vocabulary, sym: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every word (``lengths`` symbols each) to the end: (symbols, lengths)."""
    n_words = len(lengths)
    out_len = np.zeros(n_words, np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []   # (word of each symbol, symbol)
    word = np.repeat(np.arange(n_words, dtype=np.int64), lengths)
    for w in np.flatnonzero(lengths > LONG_WORD):
        at = int(lengths[:w].sum())
        done = _merge_long(v, sym[at:at + lengths[w]])
        parts.append((np.full(len(done), w), done))
    if parts:
        keep = (lengths <= LONG_WORD)[word]
        sym, word = sym[keep], word[keep]
    sym = sym.copy()
    rank = np.full(len(sym), NONE, np.int32)
    made = np.zeros(len(sym), np.int32)
    todo = np.flatnonzero(word[:-1] == word[1:])
    while len(sym):
        rank[todo], made[todo] = v.pair(sym[todo], sym[todo + 1])
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[first, len(sym)])
        least = np.repeat(np.minimum.reduceat(rank, first), sizes)
        over = least == NONE
        if over.any():
            parts.append((word[over], sym[over]))
            keep = ~over
            sym, word, rank, made, least = sym[keep], word[keep], rank[keep], made[keep], least[keep]
            if not len(sym):
                break
        hits = np.flatnonzero(rank == least)
        # leftmost first: of touching occurrences every second one
        run = np.r_[True, np.diff(hits) > 1]
        begin = np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
        hits = hits[(np.arange(len(hits)) - begin) % 2 == 0]
        hits = _safe(v, sym, word, made, least, hits)
        sym[hits] = made[hits]
        keep = np.ones(len(sym), bool)
        keep[hits + 1] = False
        new_at = np.cumsum(keep) - 1
        merged = new_at[hits]
        sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
        rank[merged] = NONE
        changed = np.zeros(len(sym) + 1, bool)
        changed[merged] = changed[merged - 1] = True
        todo = np.flatnonzero(changed[:max(len(sym) - 1, 0)])
        todo = todo[word[todo] == word[todo + 1]]
    if not parts:
        return np.zeros(0, np.int32), out_len
    words, symbols = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(words, kind="stable")
    return symbols[order].astype(np.int32), np.bincount(words, minlength=n_words)


def _safe(v, sym, word, made, least, hits):
    """Without the later occurrences of words in which a merge makes a pair that goes first."""
    inner = np.flatnonzero(word[hits[1:]] == word[hits[:-1]])
    if not len(inner):
        return hits
    several = np.zeros(len(hits), bool)
    several[inner] = several[inner + 1] = True
    some = hits[several]
    bad = np.zeros(len(some), bool)
    right = some + 2
    ok = right < len(sym)
    ok[ok] = word[right[ok]] == word[some[ok]]
    bad[ok] = v.pair(made[some[ok]], sym[right[ok]])[0] <= least[some[ok]]
    left = some - 1
    ok = left >= 0
    ok[ok] = word[left[ok]] == word[some[ok]]
    before = sym[np.maximum(left, 0)]
    joined = np.isin(some - 2, some)
    before[joined] = made[some[joined] - 2]
    bad[ok] |= v.pair(before[ok], made[some[ok]])[0] <= least[some[ok]]
    if not bad.any():
        return hits
    alone = np.isin(word[hits], word[some[bad]])
    later = np.r_[False, word[hits[1:]] == word[hits[:-1]]]
    return hits[~(alone & later)]


def _merge_long(v: Vocabulary, sym: np.ndarray) -> np.ndarray:
    """One word by the same order, smallest rank and then leftmost, with a heap."""
    n = len(sym)
    s, after, before, gone = sym.tolist(), [*range(1, n), -1], [*range(-1, n - 1)], bytearray(n)
    rank, made = v.pair(sym[:-1], sym[1:])
    heap = [(int(rank[i]), int(i), s[i], s[i + 1], int(made[i])) for i in np.flatnonzero(rank != NONE)]
    heapq.heapify(heap)
    known: dict[tuple[int, int], tuple[int, int]] = {}
    while heap:
        _, i, a, b, m = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j < 0 or s[i] != a or s[j] != b:
            continue
        s[i], gone[j], after[i] = m, 1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0:
                if (p := (s[x], s[y])) not in known:
                    r, k = v.pair(np.array(p[:1]), np.array(p[1:]))
                    known[p] = int(r[0]), int(k[0])
                if known[p][0] != NONE:
                    heapq.heappush(heap, (known[p][0], x, *p, known[p][1]))
    return np.array([x for x, g in zip(s, gone, strict=True) if not g], np.int32)


def encode_texts(v: Vocabulary, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets of each text in them), begin and end ids included."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    filled = pc.binary_length(column).to_numpy(zero_copy_only=False) > 0
    # white space of the model and a blank are one symbol; each text gets the dummy prefix
    column = pc.replace_substring(column, SPACE, " ")
    raw, off = text_bytes(pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x
                                                    for x in ("", column, " "))))
    blank = raw == 0x20
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[off[:-1]] = True
    at = np.flatnonzero(start)
    words = strings(raw, np.r_[at, len(raw)], pa.large_binary()).dictionary_encode()
    uniq = words.dictionary
    ubytes, uoff = text_bytes_of(uniq)
    cps = np.frombuffer(ubytes.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    chars = np.r_[0, np.cumsum((ubytes & 0xC0) != 0x80)]
    pieces, plen = merge_words(v, v.symbol[cps], np.diff(chars[uoff]))
    pieces, plen = _bytes_for_unknown(v, pieces, plen)
    pstart = np.cumsum(plen) - plen
    index = words.indices.to_numpy()
    of_text = np.searchsorted(off[1:], at, side="right")
    keep = filled[of_text]
    index, of_text = index[keep], of_text[keep]
    ids = pieces[gather(pstart[index], plen[index])]
    counts = np.bincount(of_text, weights=plen[index], minlength=len(filled)).astype(np.int64)
    out_off = np.r_[0, np.cumsum(counts + 2)]
    out = np.empty(out_off[-1], np.int32)
    inner = np.ones(len(out), bool)
    inner[out_off[:-1]] = inner[out_off[1:] - 1] = False
    out[out_off[:-1]], out[out_off[1:] - 1] = v.bos, v.eos
    out[inner] = ids
    return out, out_off


def text_bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64, len(array) + 1, array.offset * 8)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def _bytes_for_unknown(v: Vocabulary, pieces, lengths):
    lost = np.flatnonzero(pieces < 0)
    if not len(lost):
        return pieces, lengths
    raw = [chr(-1 - int(p)).encode("utf-8") for p in pieces[lost]]
    size = np.ones(len(pieces), np.int64)
    size[lost] = [len(r) for r in raw]
    out = np.repeat(pieces, size)
    out[np.repeat(pieces < 0, size)] = v.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    of_word = np.repeat(np.arange(len(lengths)), lengths)
    return out, np.bincount(of_word, weights=size, minlength=len(lengths)).astype(np.int64)


def _one_by_one(error):
    return "�", error.start + 1


codecs.register_error("each_byte", _one_by_one)


def decode_ids(v: Vocabulary, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 of all texts, offsets): control ids drop out, the dummy prefix goes,
    byte pieces that are no character become U+FFFD."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(v.rank)):
        raise ValueError("an id is outside the vocabulary")
    size = np.diff(v.piece_at)[ids]
    raw = v.piece_bytes[gather(v.piece_at[ids], size)]
    at = np.r_[0, np.cumsum(size)]
    # the first piece that is no control id loses its leading blank
    real = np.flatnonzero(~v.control[ids])
    k = np.searchsorted(real, off[:-1])
    first = real[np.minimum(k, max(len(real) - 1, 0))] if len(real) else np.zeros(len(k), np.int64)
    has = (k < len(real)) & (first < off[1:]) if len(real) else np.zeros(len(k), bool)
    lead = at[first[has]]
    lead = lead[(raw[lead] == 0x20) & ~v.from_byte[ids[first[has]]]]
    keep = np.ones(len(raw), bool)
    keep[lead] = False
    total = np.r_[0, np.cumsum(keep)]
    return raw[keep], total[at[off]]


def _valid(raw: np.ndarray, off: np.ndarray) -> pa.Array:
    try:
        raw.tobytes().decode("utf-8")
        cut_inside = (raw[np.minimum(off[:-1], len(raw) - 1)] & 0xC0) == 0x80 if len(raw) else np.zeros(0, bool)
        if not (cut_inside & (np.diff(off) > 0)).any():
            return strings(raw, off, pa.large_string()).cast(pa.string())
    except UnicodeDecodeError:
        pass
    data = raw.tobytes()
    return pa.array([data[a:b].decode("utf-8", "each_byte") for a, b in zip(off[:-1], off[1:], strict=True)], pa.string())


def _model(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids",
           count: str = "n_tokens") -> DataFrame:
    """``df`` without ``text``, with ``ids`` (binary: little-endian unsigned 32-bit
    ids, the form training files have) and their number; columns of these names are replaced."""
    model = _model(df, model_path)
    df = df.drop(*[c for c in (ids, count) if c != text])
    kept = [f for f in df.schema.fields if f.name != text]
    out = T.StructType([*kept, T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType())])
    names = [f.name for f in out.fields]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.load(model.value)  # once per worker
        for batch in steps(batches, text, AT_ONCE):
            flat, off = encode_texts(v, batch.column(batch.schema.get_field_index(text)))
            have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            have[ids] = strings(flat.astype("<u4").view(np.uint8), off * 4, pa.binary())
            have[count] = pa.array(np.diff(off))
            yield pa.RecordBatch.from_arrays([have[n] for n in names], names=names)

    return df.mapInArrow(run, out)


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its ``ids`` (as :func:`encode` packs them; null: empty)."""
    model = _model(df, model_path)
    df = df.drop(text)
    out = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])
    names = [f.name for f in out.fields]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.load(model.value)  # once per worker
        for batch in steps(batches, ids, AT_ONCE):
            packed = pc.fill_null(batch.column(batch.schema.get_field_index(ids)), b"").cast(pa.large_binary())
            _, offsets, data = packed.buffers()
            off = np.frombuffer(offsets, np.int64, len(packed) + 1, packed.offset * 8)
            flat = np.frombuffer(data, np.uint8)[off[0]:off[-1]].view("<u4") if data is not None else np.zeros(0, "<u4")
            have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            have[text] = _valid(*decode_ids(v, flat.astype(np.int64), (off - off[0]) // 4))
            yield pa.RecordBatch.from_arrays([have[n] for n in names], names=names)

    return df.mapInArrow(run, out)


def digests(df: DataFrame, model_path: str) -> DataFrame:
    """The query's columns, from the operator's ids and texts."""
    coded = decode(encode(df, model_path), model_path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
