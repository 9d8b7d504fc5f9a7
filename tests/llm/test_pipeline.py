"""The pipeline against the operators' own results, stage by stage."""

import ctypes
import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import sentencepiece

import corpus_pipeline
from tessera.llm import kn_quality, mix_sources, pii_boost, sentencepiece_codec, simhash_pivots

SF = "/root/testdata/sf0.001"


def test_stages(spark, sample):
    docs = sample.cache()
    stage = dict(corpus_pipeline.STAGES)
    names = list(stage)
    assert len(names) == 5

    kept = stage[names[0]](spark, docs, SF).cache()
    verdict = kn_quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in verdict.filter("kept").collect())

    single = stage[names[1]](spark, kept, SF).cache()
    groups = simhash_pivots.near_duplicates(kept).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})

    clean = stage[names[2]](spark, single, SF).cache()
    assert clean.columns == docs.columns
    before = {r.doc_id: r.text for r in single.collect()}
    spans = {r.doc_id: r.spans for r in pii_boost.detect(single).collect()}
    for r in clean.collect():
        assert (r.text == before[r.doc_id]) == (not spans[r.doc_id]) and r.n_chars == len(r.text)
    assert all(not r.spans or "<" in r.text for r in pii_boost.detect(clean.selectExpr("*", "text AS t")).withColumnRenamed("t", "text").collect())

    mixed = stage[names[3]](spark, clean, SF).cache()
    taken = {r.doc_id: r.taken // r["size"] for r in mix_sources.mix(clean).collect() if r["size"]}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: n for k, n in taken.items() if n})

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    rows = stage[names[4]](spark, mixed, SF).collect()
    assert len(rows) == mixed.count()
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run_goes_through_parquet(spark, sample):
    import os
    docs = sample
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
    done = corpus_pipeline.run(spark, SF)
    assert done.schema.names == docs.schema.names
    one = lambda df: Counter((r.doc_id, r.ids_sha256) for r in df.select("doc_id", "ids_sha256").collect())
    assert one(done) == one(docs)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    runs = os.listdir(f"{folder}/pipeline")
    assert len(runs) == 1 and sorted(os.listdir(f"{folder}/pipeline/{runs[0]}")) == ["0", "1", "2", "3"]


def test_odd_and_empty_tables(spark, odd, none, tmp_path, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs, empty in ((odd, False), (none, True)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            done = stage(spark, docs, str(tmp_path)).cache()
            if k + 1 < len(corpus_pipeline.STAGES):
                assert done.columns == docs.columns
            docs = done
        assert (docs.count() == 0) == empty


def test_idle_workers_keep_little(spark):
    """What a Python worker frees goes back to the system when its task ends, since Spark keeps it for later ones."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(30_000)]
    rows = [(i, " ".join(rng.choices(words, k=600)), i % 2 == 0) for i in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _train boolean").repartition(4)

    def kept(batches):
        """MB that the allocator could hand back now."""
        size = lambda: sum(int(x) for x in re.findall(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())) / 1024  # noqa: E731, SIM115
        for _ in batches:
            before = size()
            ctypes.CDLL(None).malloc_trim(0)
            yield pa.RecordBatch.from_arrays([pa.array([before - size()])], names=["mb"])

    def most():
        return spark.range(0, 64, 1, 64).mapInArrow(kept, "mb double").agg({"mb": "max"}).first()[0]

    most()
    kn_quality.word_perplexity(docs).count()
    assert most() < 32
    model = public_tokenizers.path("piece_bpe_32k.model")
    sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model).write.format("noop").mode("overwrite").save()
    assert most() < 32
