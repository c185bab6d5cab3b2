"""The registered queries that SQL cannot express, against plain versions, over whole tables."""

import hashlib
import zlib

import numpy as np
import pytest

from test_llm_operators import PATTERNS, check_shards, library, plain_classes, plain_spans  # noqa: F401
from tributary.llm import pii, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def run(spark, name):
    return queries.QUERIES[name](spark, SF_DIR)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_held_out(spark, documents):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    found = run(spark, "op2_language_id").collect()
    assert sorted(r.doc_id for r in found) == sorted(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    right = [r.lang_pred == documents[r.doc_id].lang for r in found if r.held_out]
    assert sum(right) >= 0.95 * len(right)
    scored = run(spark, "op3_quality_classifier").collect()
    assert sorted(r.doc_id for r in scored) == sorted(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in scored)
    good = [r.predicted for r in scored if labels.get(r.doc_id) == 1]
    assert sum(good) >= 0.95 * len(good)


def test_personal_data(spark, documents):
    found = run(spark, "op6_personal_data").collect()
    assert sorted(r.doc_id for r in found) == sorted(documents)
    for r in found:
        spans = plain_spans(documents[r.doc_id].text)
        assert [r[f"n_{kind}"] for kind, _, _ in PATTERNS] == [sum(k == i for _, _, k in spans) for i in range(4)]
        assert r.base_sha256 == sha(pii.told(spans).encode())
        assert set(filter(None, pii.told(spans).split(","))) <= set(r.spans.split(","))


def test_bpe(spark, documents, library):  # noqa: F811
    found = run(spark, "op7_bpe").collect()
    assert sorted(r.doc_id for r in found) == sorted(documents)
    for r in found:
        ids = library.encode(documents[r.doc_id].text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False).encode())


def test_near_dedup(spark, documents):
    found = sorted((r.doc_id, r.class_id, r.class_size) for r in run(spark, "op9_minhash_near_dedup").collect())
    assert found == sorted(plain_classes([(d, r.text) for d, r in documents.items()]))


def test_sharding(spark, documents):
    rows = [(d, r.text) for d, r in documents.items()]
    check_shards(run(spark, "op10_sharding"), rows, 2 * max(len(t.encode()) for _, t in rows))


def test_pipeline(spark, documents):
    """Its rows are the stages' rows; each stage has a plain version of its own."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    wanted = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in docs.collect())
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in run(spark, "pipeline").collect()) == wanted
    assert corpus_pipeline.ORACLE_SQL is None and {d for d, _, _ in wanted} <= set(documents)
