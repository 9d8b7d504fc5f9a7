import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from tessera.llm import sentencepiece_codec as codec

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return codec.Vocabulary.load(f.read())


def compare(library, vocabulary, texts):
    ids, off = codec.encode_texts(vocabulary, pa.array(texts, pa.string()))
    back = codec._valid(*codec.decode_ids(vocabulary, ids, off)).to_pylist()
    for i, text in enumerate(texts):
        wanted = library.encode(text or "", add_bos=True, add_eos=True)
        assert ids[off[i]:off[i + 1]].tolist() == wanted, repr(text)[:80]
        assert back[i] == library.decode(wanted), repr(text)[:80]


def test_odd_texts(library, vocabulary):
    compare(library, vocabulary, [
        "", None, " ", "  ", "a", "\n\n a\x00b", "▁▁ a ▁b", "日本語 🎉🎉", "a" * 100, "  " * 57 + "x", " " * 33, " " * 3000,
        "aaaa bbbb " * 30, "ab" * 5000, "x" * 3000 + " " + "ÿ" * 2500, "\x85 a\xa0b", "<s> </s> <unk> <0x41>"])
    compare(library, vocabulary, [])


def test_random_texts(library, vocabulary):
    pick = random.Random(7)
    parts = ["a", "b", "e", "t", "h", " ", "  ", "\n", "é", "▁", "ü", "in", "er", "日", "🎉", "1", "0", "00", "aa"]
    compare(library, vocabulary, ["".join(pick.choices(parts, k=pick.randint(0, 60))) for _ in range(1500)])


def test_documents(library, vocabulary, sample):
    compare(library, vocabulary, [r.text for r in sample.select("text").collect()])


def test_any_ids_decode(library, vocabulary):
    pick = random.Random(3)
    for _ in range(300):
        ids = [pick.randint(1, 600) for _ in range(pick.randint(0, 12))]
        raw, off = codec.decode_ids(vocabulary, np.array(ids, np.int64), np.array([0, len(ids)]))
        assert codec._valid(raw, off).to_pylist() == [library.decode(ids)], ids


def test_table(odd, none, library):
    coded = codec.decode(codec.encode(odd, PATH), PATH)
    rows = coded.collect()
    assert len(rows) == odd.count() and rows[0]["epochs"] == "keep epochs"
    for a, b in zip(odd.collect(), rows, strict=True):
        ids = np.frombuffer(b["ids"], "<u4").tolist()
        assert ids == library.encode(a["text"] or "", add_bos=True, add_eos=True) and b["n_tokens"] == len(ids)
        assert b["decoded"] == library.decode(ids)
    assert codec.digests(none, PATH).count() == 0
