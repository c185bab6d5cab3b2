"""The pipeline, stage by stage, against plain versions."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_operators import normal, plain_classes, plain_measures
from tributary.llm import bpe, mixing, rules
from tributary.llm.common import text_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sample, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "tokenize"]
    rows = {(r.doc_id, r.text) for r in sample.collect()}

    def step(name, docs):
        path = str(tmp_path / name)
        stages[name](spark, docs, "/root/testdata/sf0.001").write.parquet(path)
        return spark.read.parquet(path)

    ruled = step("quality_rules", sample)
    assert ruled.columns == COLUMNS
    kept = {(r.doc_id, r.text) for r in ruled.collect()}
    assert kept <= rows
    for doc_id, text in rows:
        n, _, symbols, _, repeats = plain_measures(text)
        if n < 50 or 100 * repeats > 50 * n or 100 * symbols > 30 * n:
            assert (doc_id, text) not in kept
    assert kept == {
        (r.doc_id, r.text) for r in sample.join(rules.judged(rules.ledger(sample)).filter("kept"), "doc_id").collect()
    }

    once = step("exact_dedup", ruled)
    assert once.columns == COLUMNS
    best = {}
    for doc_id, text in kept:
        best[normal(text)] = max(best.get(normal(text), -1), doc_id)
    assert sorted(r.doc_id for r in once.collect()) == sorted(best.values())

    apart = step("near_dedup", once)
    assert apart.columns == COLUMNS
    classes = plain_classes([(r.doc_id, r.text) for r in once.collect()])
    assert sorted(r.doc_id for r in apart.collect()) == sorted({c for _, c, _ in classes})

    mixed = step("mix_sources", apart)
    assert mixed.columns == COLUMNS
    shares, _ = mixing.mix(apart)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert copies == Counter({r.doc_id: n for r in shares.collect() if r["size"] and (n := math.floor(r.taken / r["size"] + 0.5))})

    last = step("tokenize", mixed)
    assert last.count() == mixed.count()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.VOCABULARY)
    library.no_padding()
    library.no_truncation()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in last.limit(60).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)


def test_stages_over_odd_tables(spark, wide, empty, tmp_path):
    for docs in (wide, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            if name != "tokenize":
                assert set(COLUMNS) <= set(docs.columns)
        docs.write.format("noop").mode("overwrite").save()


def test_identical_rows_are_folded(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(7, text, "en", "a", 1)] * 5 + [(7, text.upper(), "en", "a", 1), (3, text, "en", "a", 1), (8, "other " + text, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    once = stages["exact_dedup"](spark, docs, "")
    assert sorted(r.doc_id for r in once.collect()) == [7, 8]
    apart = stages["near_dedup"](spark, docs, "")
    assert [r.doc_id for r in apart.collect()] == [3]
    assert apart.select(text_key(F.col("text"))).count() == 1
