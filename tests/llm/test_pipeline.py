"""The pipeline against a brute-force version, and its stages on odd tables."""

import collections
import hashlib
import re

import corpus_pipeline
from loadcycle.llm import mixing
from tests.llm.test_text_operators import CLASHES, DOCS, ODD, _fingerprint, _groups
from pyspark.sql import functions as F


def _deduplicated(rows):
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        if key not in best or (-len(r.text), r.doc_id) < (-len(best[key].text), best[key].doc_id):
            best[key] = r
    return sorted(best.values(), key=lambda r: r.doc_id)


def test_pipeline_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    told = sorted(corpus_pipeline.language_id(spark, docs, small).collect(), key=lambda r: r.doc_id)
    assert len(told) >= 0.99 * docs.count() and told[0].__fields__ == docs.columns
    once = _deduplicated(told)
    roots = _groups([_fingerprint(r.text) for r in once])
    near = spark.createDataFrame([r for i, r in enumerate(once) if roots[i] == i], docs.schema)
    taken = {r.doc_id: r.copies for r in mixing.mix_report(*mixing.mixing_plan(near)).collect()}
    want = sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in near.select("doc_id", "text").collect() for _ in range(taken[i]))
    got = corpus_pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in got) == want
    assert max(collections.Counter(r.doc_id for r in got).values()) == 2


def test_stages_on_odd_and_empty_tables(spark, small):
    odd = spark.createDataFrame(ODD, DOCS).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
    for table in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, small)
            assert name == "byte_level_bpe" or out.columns == table.columns
            assert out.count() <= 2 * table.count()
