"""The language model's files, its order in production and the shards of hot words."""

import collections
import os
import resource

import numpy as np
import pytest
import xxhash

from loadcycle.llm import arrays, kneser_ney, queries
from loadcycle.llm.common import fold


def test_query_uses_two_words_of_context(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = kneser_ney.train(docs.filter(fold("doc_id", 5) != 1), order=3)
    want = {r.doc_id: r.score for r in kneser_ney.score(docs, model).collect()}
    got = {r.doc_id: r.score for r in queries.op10_lm_scoring(spark, small).collect()}
    assert got.keys() == want.keys() and np.allclose([got[i] for i in want], list(want.values()), rtol=1e-9)


def test_packed_keys_are_found_exactly(tmp_path):
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 64, kneser_ney.MANY + 5000, np.uint64)
    near = keys[:3000]
    keys = np.unique(np.concatenate((keys, near ^ np.uint64(1), near ^ np.uint64(1 << 16), [np.uint64(0), ~np.uint64(0)])))
    absent = np.setdiff1d(np.concatenate((keys ^ np.uint64(2), keys ^ np.uint64(1 << 17))), keys)
    for some in (keys, keys[:100], keys[:0]):
        arrays.save(tmp_path.as_uri(), f"k{len(some)}", kneser_ney._packed_keys("keys", some))
        held = arrays.mapped(tmp_path.as_uri(), f"k{len(some)}")
        hit, at = kneser_ney._find(held, "keys", some)
        assert hit.all() and (at == np.arange(len(some))).all()
        assert not kneser_ney._find(held, "keys", absent)[0].any()


def test_large_counts_lie_apart(tmp_path):
    counts = np.array([[1, 1], [254, 3], [255, 255], [256, 0], [1 << 40, 1 << 33], [2, 0]])
    arrays.save(tmp_path.as_uri(), "c", kneser_ney._packed_counts("c", counts))
    at = np.array([5, 4, 2, 2, 0, 1, 3])
    assert (kneser_ney._counts(arrays.mapped(tmp_path.as_uri(), "c"), "c", at) == counts[at]).all()


def test_few_files_stay_open_however_many_shards(spark, small, monkeypatch):
    """One file for each level and shard, and no more of them mapped at once than the table holds."""
    monkeypatch.setattr(kneser_ney, "SHARD", 600)
    monkeypatch.setattr(arrays, "MAPS", 20)
    docs = queries.tables(spark, small, "documents")
    model = kneser_ney.train(docs, order=3)
    assert model.shards > 60
    texts = [(r.text or "").encode() for r in docs.limit(60).collect()]
    before = len(os.listdir("/proc/self/fd"))
    limits = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (before + 60, limits[1]))
    try:
        own, flat, place, number = kneser_ney.numbered(texts, 3)
        few, _ = kneser_ney.log_chances(model, own, flat, place)
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, limits)
    assert len(os.listdir("/proc/self/fd")) <= before + 25
    monkeypatch.setattr(arrays, "MAPS", 10_000)
    assert (few == kneser_ney.log_chances(model, own, flat, place)[0]).all() and len(number) == len(few)


def test_word_shards_grow_with_the_texts(spark, small, monkeypatch):
    docs = queries.tables(spark, small, "documents")
    want = kneser_ney.train(docs, order=2)
    monkeypatch.setattr(kneser_ney, "WORD_BYTES", 10_000)
    many = kneser_ney.train(docs, order=2)
    assert many.word_shards > 3 * want.word_shards
    scores = [{r.doc_id: r.score for r in kneser_ney.score(docs, m).collect()} for m in (want, many)]
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-6 for i in scores[0])


@pytest.mark.parametrize("wide", [10, 40])
def test_combined_counts_of_narrow_and_wide_columns(wide):
    rng = np.random.default_rng(2)
    near, words = rng.integers(0, 1 << wide, (400, 2)) % 5 * (1 << wide - 4), rng.integers(0, 3, 400)
    got = kneser_ney.combine(near, words, np.ones(400, np.int64))
    want = collections.Counter(zip(*near.T.tolist(), words.tolist()))
    assert [(*k, int(w)) for k, w in zip(got[0].tolist(), got[1])] == sorted(want)
    assert [int(c) for c in got[2]] == [want[k] for k in sorted(want)]


def test_words_are_split_at_ascii_white_space_and_only_a_to_z_is_lowered():
    texts = [b" A  b\x0bB ", None, b"x\xff\xfeY\x1cz \xc2\xa0a\x00b", b"  ", "ÄB äb".encode()]
    own, flat, place, number = kneser_ney.numbered(texts, 3)
    words = [[b"a", b"b", b"b"], [], [b"x\xff\xfey\x1cz", b"\xc2\xa0a\x00b"], [], ["Äb".encode(), "äb".encode()]]
    begin, end = int(kneser_ney._BEGIN), int(kneser_ney._END)
    want = [h for some in words for h in (begin, begin, *map(xxhash.xxh64_intdigest, some), end)]
    assert own[flat].tolist() == want and number.tolist() == [0] * 4 + [1] + [2] * 3 + [3] + [4] * 3
    assert [want[i] for i in place] == [h for h in want if h != begin]
    assert all(not len(x) for x in kneser_ney.numbered([], 3)[1:])


def test_ngrams_are_combined_without_sorting_column_by_column(monkeypatch):
    """Three columns that do not fit in one key, as those of any large vocabulary."""
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 3, (5000, 3)) * np.array([1, 1 << 24, (1 << 24) + 1]) + rng.integers(0, 2, (5000, 3))
    counts = rng.integers(1, 9, 5000)
    want = {}
    for row, n in zip(map(tuple, rows.tolist()), counts.tolist()):
        want[row] = want.get(row, 0) + n

    def never(*_):
        raise AssertionError("sorted column by column")

    monkeypatch.setattr(np, "lexsort", never)
    rows = (rows * (1 << 14 if rows.max() < 1 << 26 else 1)).astype(np.uint64)
    near, words, sums = kneser_ney.combine(rows[:, :2], rows[:, 2], counts)
    got = [(*map(int, a), int(w)) for a, w in zip(near, words)]
    assert got == sorted(got) and {tuple(x >> 14 for x in g): n for g, n in zip(got, sums.tolist())} == want


def test_equal_ngrams_of_a_batch_are_reckoned_once(monkeypatch, spark):
    docs = spark.createDataFrame([(i, "the cat saw the cat and the cat ran") for i in range(20)], "doc_id long, text string")
    model = kneser_ney.train(docs, order=3)
    own, flat, place, _ = kneser_ney.numbered([b"the cat saw the cat and the cat ran"] * 50, 3)
    sizes, log10 = [], np.log10
    monkeypatch.setattr(np, "log10", lambda x: sizes.append(len(x)) or log10(x))
    chance, counts = kneser_ney.log_chances(model, own, flat, place)
    assert sizes == [10] and len(chance) == len(counts) == 500
    assert np.allclose(chance.reshape(50, 10), chance[:10])
