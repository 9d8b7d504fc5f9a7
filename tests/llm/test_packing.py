"""Packing: ids against the tokenizers library, places against the rules, bins against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from tessera.llm import best_fit

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return best_fit.Encoder(f.read())


def test_ids_are_the_library_s(library, encoder):
    rng = random.Random(5)
    alphabet = [*"ab  '\n\t.,1²", "é", "ß", "日", "🎉", "́", " ", " ", "\x1c", "\x85", "\u0000", "<|endoftext|>", "'ll", "ᲀ", "𝟘"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x2FFFF)])) for _ in range(30)) for _ in range(2000)]
    texts += ["a<|endoftext|><|endoftext|> b", "<|endoftext", "x" * 5000, " " * 3000, "it's 12,000 — don't", "ab " * 3000]
    assert encoder.fast is not None
    for t in texts:
        if t:
            assert encoder.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_slices_do_not_change_ids(encoder):
    rng = random.Random(6)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "é", ".", "'s", " x", " "]) for _ in range(5000))
    parts = list(best_fit.slices(text, 100))
    assert "".join(parts) == text and len(parts) > 50
    whole = encoder.fast.encode_ordinary(text)
    assert [i for p in parts for i in encoder.fast.encode_ordinary(p)] == whole
    assert list(best_fit.slices("x" * 500, 100)) == ["x" * 500]


def test_bins_against_brute_force():
    rng = random.Random(7)
    for most in (1, 3, 1000):
        bins, size = best_fit.Bins(100, most), 100
        open_, made = {}, 0   # bin: free space
        for _ in range(3000):
            n = rng.choice([rng.randint(1, 100), rng.randint(1, 20), 100])
            number, offset = bins.place(n)
            fits = [f for f in open_.values() if f >= n]
            if fits:
                assert open_[number] == min(fits)
            else:
                assert number == made
                made += 1
                if n < size and len(open_) == most:
                    fullest = min(open_.values())
                    closed = [b for b, f in open_.items() if f == fullest]
                    gone = next(b for b in closed if b not in {x for s in bins.free for x in s})
                    del open_[gone]
                open_[number] = size
            assert offset == size - open_[number]
            open_[number] -= n
            if not open_[number]:
                del open_[number]
            assert len(open_) == bins.open <= most
            assert sorted(open_) == sorted(x for s in bins.free for x in s)


def test_pieces():
    assert best_fit.cut_pieces(1, 4) == [(0, 1)] and best_fit.cut_pieces(4, 4) == [(0, 4)]
    assert best_fit.cut_pieces(5, 4) == [(0, 1), (1, 4)] and best_fit.cut_pieces(8, 4) == [(0, 4), (4, 4)]


def check(docs, library, **kw):
    """Every rule of the contract, over all rows; returns the numbers of sequences and least sequences."""
    found = best_fit.digests(best_fit.pack(docs, PATH, **kw)).collect()
    wanted = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        cuts = best_fit.cut_pieces(len(ids))
        wanted[r.doc_id] += [(k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts)]
    got, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(n for v in wanted.values() for _, _, n, _ in v)
    return len(sequences), -(-total // 1024)


def test_odd_documents(odd, library):
    made, least = check(odd, library)
    assert made <= 1.1 * least + 4


def test_small_windows_and_few_bins(sample, library):
    check(sample, library, window=7, most=3)


def test_documents_fill_their_sequences(sample, library):
    made, least = check(sample.coalesce(1), library)
    assert made <= 1.02 * least + 1


def test_an_empty_table(none):
    assert best_fit.digests(best_fit.pack(none, PATH)).collect() == []


def test_other_files_are_run_by_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        encoder = best_fit.Encoder(f.read())
    assert encoder.library is not None
    assert encoder.ids("A word").tolist() == tokenizers.Tokenizer.from_file(path).encode("A word", add_special_tokens=False).ids
