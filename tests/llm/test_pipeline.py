import collections

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm import toxicity


def test_stages_in_order(spark, docs, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "exact_dedup",
        "simhash_near_dedup",
        "source_mixing",
        "bpe_encoding",
    ]
    now = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf_dir)
        if name != "bpe_encoding":
            assert out.dtypes == docs.dtypes
            now = spark.createDataFrame(out.collect(), docs.schema)
        seen[name] = out
    rejected = {r["doc_id"] for r in toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect() if r["predicted"]}
    kept = {r["doc_id"] for r in seen["toxicity"].collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - rejected
    texts = collections.Counter(r["text"] for r in seen["exact_dedup"].collect())
    assert max(texts.values()) == 1
    near = {r["doc_id"] for r in seen["simhash_near_dedup"].collect()}
    assert {r["doc_id"] for r in seen["source_mixing"].collect()} == near
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_id = {r["doc_id"]: r["text"] for r in docs.collect()}
    final = seen["bpe_encoding"].collect()
    assert {r["doc_id"] for r in final} == near
    for r in final[:50]:
        ids = library.encode(by_id[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == ids
        assert r["n_tokens"] == len(ids)


def test_run(spark, sf_dir):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids"]


def test_stages_on_odd_rows_and_empty_tables(spark, odd, empty, sf_dir):
    """Nulls, ties, repeats and clashing names pass through every stage; an empty table stays empty."""
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf_dir)
        assert out.columns == odd.columns
        kept[name] = out.collect()
        nothing = stage(spark, empty, sf_dir)
        assert nothing.columns == odd.columns
        assert nothing.count() == 0
    assert {r["doc_id"] for r in kept["toxicity"]} == {r["doc_id"] for r in odd.collect()}
    texts = collections.Counter(r["text"] or "" for r in kept["exact_dedup"])
    assert max(texts.values()) == 1
    assert {r["doc_id"] for r in kept["source_mixing"]} == {r["doc_id"] for r in odd.collect()}
    encoded = corpus_pipeline.encode(spark, odd, sf_dir).collect()
    assert len(encoded) == odd.count()
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in encoded)
    assert corpus_pipeline.encode(spark, empty, sf_dir).count() == 0
