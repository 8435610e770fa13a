"""What of the labelled texts reaches the dictionaries, and how much of it the driver."""

import random

import pytest

from loadcycle.llm import quality


@pytest.fixture
def given(monkeypatch):
    """Pieces that the driver builds dictionaries from: of good text, of bad text."""
    seen, build = [], quality.build_dictionary
    monkeypatch.setattr(quality, "build_dictionary", lambda pieces, *a: (seen.append(pieces), build(pieces, *a))[1])
    return seen


def test_sample_is_taken_from_documents_at_hand(spark, given):
    docs = spark.range(0, 4000, 40).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(id % 80 = 0 as int) as quality")
    quality.train(docs, labels, per_class=64)
    assert all(len(pieces) > 15 for pieces in given)


def _long(kind, seed, chunks=100):
    text = bytearray(random.Random(seed).randbytes(chunks * quality.CHUNK // 2).hex().encode())  # nothing repeats but the passage
    text[quality.CHUNK * 2 : quality.CHUNK * 3] = (f"{kind} passage between strides; ".encode() * 200)[: quality.CHUNK]
    return bytes(text).decode()


def test_all_chunks_of_long_texts_count(spark):
    rows = [(i, _long("good" if i % 2 else "bad", i, 40)) for i in range(24)]
    model = quality.train(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    )
    assert b"good passage between" in model.good and b"bad passage between" in model.bad


def test_long_texts_stay_off_the_driver(spark, given):
    rows = [(i, _long("good" if i % 2 else "bad", i)) for i in range(48)]
    quality.train(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    )
    for pieces in given:
        assert 0 < sum(map(len, pieces)) <= 24 * quality.PART and max(map(len, pieces)) <= quality.CHUNK
