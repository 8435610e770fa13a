"""The text operators against brute force, round trips and their edge cases."""

import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F

from checks.compare import connect, differences
from loadcycle.llm import (
    bpe, chat, components, exact_dedup, kneser_ney, language, mixing, quality, queries, simhash, token_counts, top_k,
)
from loadcycle.llm.common import SAMPLE_SALTS, candidates, keep_rows, sampled

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = ("word " * 40_000) + "é" * 30_000
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "Hello  world, it's", "en", None, 5),
    (5, "Hello world, it's", "en", "b", 5), (5, "Hello world, it's", "en", "b", 5), (None, "no id here", "fr", "b", 9),
    (None, None, "fr", "b", 0), (7, LONG, "en", "c", len(LONG)), (8, "123 !!", None, "c", 6), (9, "ß\x85 ï\U0001F600 \x1c", "de", "c", 3),
    (10, "hello WORLD, it's", "en", "c", 4),
]
CLASHES = ["size", "kept", "digest", "fp", "rank", "score", "copies", "__text", "h", "label", "place", "u", "target", "n"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, DOCS).repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="module")
def none(spark, odd):
    return odd.limit(0)


def _rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", list(queries.all_oracles()))
def test_same_as_sql(spark, small, name):
    got = queries.all_queries()[name](spark, small).toArrow()
    assert differences(got, connect(small).sql(queries.all_oracles()[name]).to_arrow_table()) is None


# Byte-level BPE ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    return bpe.codec(queries.VOCABULARY, queries.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(queries.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_definition(codec, reference):
    pick = random.Random(5)
    bits = ["the", "ing", " ", "  ", "\n", "'s", "a", "aaaa", "!!", "123", "\x1c", "\x85", "é", "ß", "tion", "日本", "\U0001F600"]
    for _ in range(3000):
        text = "".join(pick.choice(bits) if pick.random() < 0.7 else chr(pick.randrange(1, 0x3000)) for _ in range(pick.randrange(20)))
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_tables_that_start_anew_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_TRANSITIONS", 50)
    monkeypatch.setattr(bpe, "PAIR_PLACES", 8)
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    own = bpe.Codec(queries.VOCABULARY, queries.PATTERN)
    text = "unbelievable reconstruction of antidisestablishmentarianism " * 3
    assert own.encode(text) == reference.encode_ordinary(text)


def test_tokens_come_out_before_the_end(codec):
    machine, state, early = codec.transducer, 0, 0
    for byte in b"internationalisation" * 3:
        step = machine._next[state].get(byte) or machine._make(state, byte)
        state, early = step[0], early + len(step[1])
    assert early > 3


def test_streaming_decode_holds_back_split_characters(codec):
    pick = random.Random(2)
    for _ in range(300):
        text = "".join(chr(pick.choice([65, 0xE9, 0x20AC, 0x1F600, 0x7FF, 0xFFFD])) for _ in range(20))
        ids = codec.encode(text)
        assert "".join(codec.decode_stream(ids, step=1)) == text
    for _ in range(500):
        raw, stream = bytes(pick.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xF0, 0x9F, 0xED, 0xA0, 0xFF]) for _ in range(12)), bpe.Utf8Stream()
        at = pick.randrange(12)
        assert stream.feed(raw[:at]) + stream.feed(raw[at:]) + stream.end() == raw.decode("utf-8", "replace")


def test_round_trip_on_odd_rows(odd, none, reference):
    got = bpe.round_trip(odd, queries.VOCABULARY, queries.PATTERN)
    want = []
    for r in ODD:
        ids = reference.encode_ordinary(r[1] or "")
        told = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r[0], len(ids), told, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert _rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bpe.round_trip(none, queries.VOCABULARY, queries.PATTERN).count() == 0
    assert bpe.encode(odd, queries.VOCABULARY, queries.PATTERN).filter("doc_id = 5").count() == 2


# Exact duplicates ----------------------------------------------------------------------------

def _classes(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = []
    for content, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(members), hashlib.sha256(content.encode()).hexdigest()) for r in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda c: hashlib.sha256(c).hexdigest()[:1], lambda c: ""])
def test_classes_compare_whole_texts(odd, none, digest):
    got = exact_dedup.duplicate_classes(odd, digest=digest)
    rows = got.collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in rows], key=repr) == sorted([c[:3] for c in _classes(ODD)], key=repr)
    assert sum(r.kept for r in rows) == len({c[3] for c in _classes(ODD)})
    assert exact_dedup.duplicate_classes(none).count() == 0


def test_hot_digests_meet_over_salts(spark, monkeypatch):
    rows = [(i, "same" if i % 3 else f"own {i}", None, None, None) for i in range(900)]
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    got = exact_dedup.duplicate_classes(df).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3} == {(1, 600)} and sum(r.kept for r in got) == 301


def test_deduplicate_keeps_columns_and_one_row_of_each_class(odd, none):
    got = exact_dedup.deduplicate(odd)
    assert got.columns == odd.columns and got.count() == len({c[3] for c in _classes(ODD)})
    assert exact_dedup.deduplicate(none).count() == 0


# Top-k ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("spread", [3, 1000])
def test_threshold_algorithm_against_all_scores(spread):
    pick = np.random.default_rng(0)
    for _ in range(150):
        n, d, k = int(pick.integers(1, 400)), int(pick.integers(1, 6)), int(pick.integers(1, 8))
        vectors, ids, query = pick.integers(-spread, spread + 1, (n, d)), pick.permutation(1000)[:n], pick.integers(-spread, spread + 1, d)
        asked, best = np.array([query, vectors[0], -query, 0 * query]), top_k.Best(4, k)
        own = np.array([ids[0], ids[0], -1, ids[-1]])
        for part in np.array_split(np.arange(n), int(pick.integers(1, 4))):  # the k best are carried from block to block
            if len(part):
                top_k.SortedLists(ids[part], vectors[part]).search(own, asked, best, np.arange(4))
        for q in range(4):
            whole = vectors @ asked[q]
            want = [i for i in np.lexsort((ids, -whole)) if ids[i] != own[q]][:k]
            found = best.scores[q] != top_k._NONE
            assert list(best.ids[q][found]) == list(ids[want]) and list(best.scores[q][found]) == list(whole[want])


def test_queries_that_are_settled_open_no_more_blocks(spark):
    pick = np.random.default_rng(1)
    middles = pick.normal(size=(8, 16)) * 4
    rows = [(i, [float(x) for x in middles[i % 8] + pick.normal(size=16) / 20]) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    asked = df.filter("vec_id % 20 = 0")
    found = top_k.walks(df, asked, 4, block=50, pack=8).collect()
    assert len(found) == asked.count() * 4  # as many rows leave the tasks as are asked for, however many blocks there are
    assert all(r.blocks >= 32 and r.searched < r.blocks / 2 and r.scored < 800 for r in found)
    whole = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows}
    for q in range(0, 1600, 80):
        want = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:4]
        assert sorted((-r.score, r.vec_id) for r in found if r.query_id == q) == want


def test_rows_that_share_an_id_or_a_vector(spark):
    rows = [(i % 3 * 20, [1.0, 2.0]) for i in range(300)] + [(i, [0.5, float(i % 2)]) for i in range(7, 17)] + [(99, [])] * 2 + [(100, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = top_k.top_k(df, df.filter("vec_id % 20 = 0").dropDuplicates(["vec_id"]), 5, block=16, pack=2).collect()
    assert {(r.query_id, r.vec_id, r.score) for r in got} == {
        (0, 20, 20480), (20, 0, 20480), (40, 0, 20480), (100, 99, 0)} and sorted(r["rank"] for r in got) == [1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 4, 4, 4, 5, 5, 5]


def test_odd_vectors_take_no_part(spark):
    rows = [(i, [float(i % 7), float(-i % 5)]) for i in range(100)] + [(200, None), (220, [1.0, None]), (240, [float("nan"), 1.0]),
            (260, [float("inf"), 1.0]), (None, [1.0, 1.0]), (280, [1.0, 2.0, 3.0]), (0, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).repartition(4)
    got = top_k.top_k(df, df.filter("vec_id % 20 = 0"), 3, block=16, pack=2).collect()
    real = {i: v for i, v in rows[:100]}
    for q in (20, 40, 60, 80):
        scores = sorted((-sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(real[q], v)), i) for i, v in real.items() if i != q)
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == scores[:3]
    assert not {r.query_id for r in got} & {200, 220, 240, 260} and not any(r.query_id == 280 for r in got)
    assert top_k.top_k(df.limit(0), df.limit(0), 3).count() == 0


# Mixing --------------------------------------------------------------------------------------

def test_mix_meets_targets_and_repeats_itself(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    report = mixing.mix_report(*mixing.mixing_plan(docs)).collect()
    again = mixing.mix_report(*mixing.mixing_plan(docs.repartition(5))).collect()
    assert sorted(report) == sorted(again)
    by = collections.defaultdict(list)
    for r in report:
        assert 0 <= r.taken <= 2 * r["size"]
        by[r.source].append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r["size"] for r in rows) / 2 + 1
    rows = mixing.mix(docs)
    assert rows.columns == docs.columns and rows.count() == sum(r.copies for r in report)


def test_favoured_documents_are_taken_more_often(spark):
    rows = [(i, "w " * 10, None, "s" if i % 2 else "t", 0) for i in range(4000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("favour", F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0))
    plan = mixing.mixing_plan(df, weights=(1, 1), share=0.5, most=1, favour_col="favour")
    found = mixing.mix_report(*plan).withColumn("f", F.col("doc_id") % 4 < 2).groupBy("f").agg(F.sum("taken").alias("t")).collect()
    taken = {r.f: r.t for r in found}
    assert 2.5 < taken[True] / taken[False] < 3.5 and sum(taken.values()) == 20_000
    mixed = mixing.mix(df, weights=(1, 1), share=0.5, most=1, favour_col="favour")
    assert mixed.count() == 2000 and mixed.columns == df.columns


def test_mix_on_odd_rows(odd, none):
    rows = mixing.mix_report(*mixing.mixing_plan(odd)).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 2 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0 and mixing.mix_report(*mixing.mixing_plan(none)).count() == 0


# Chat ----------------------------------------------------------------------------------------

def test_layouts_give_the_same_turns(spark):
    records = [
        (1, {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}),
        (2, {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}),
        (3, {"prompt": "hi", "completion": "yo"}), (4, {"instruction": "hi", "output": "yo", "input": ""}),
        (5, {"messages": []}), (6, {"who": "knows"}), (7, [1]), (8, {"instruction": "hi", "input": "there", "output": "yo", "system": "be brief"}),
        (9, {"prompt": "hi", "response": None}),
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in records] + [(10, None), (11, "no json")], "id long, record string")
    got = collections.defaultdict(list)
    for r in chat.canonical_turns(df, id_col="id", record_col="record").collect():
        got[r.conv_id].append((r.layout, r.turn, r.role, r.text))
    for i in (1, 2, 3, 4):
        assert [t[2:] for t in sorted(got[i], key=lambda t: t[1])] == [("user", "hi"), ("assistant", "yo")]
    assert 5 not in got and all(got[i][0][0] is None for i in (6, 7, 10, 11)) and got[11][0][3] == "no json"
    assert [t[2:] for t in sorted(got[8], key=lambda t: t[1])] == [("system", "be brief"), ("user", "hi\n\nthere"), ("assistant", "yo")]
    assert got[9][1][3] == ""


def test_escaping_is_reversible_and_hides_control_strings():
    pick = random.Random(3)
    bits = ["<", "^", "|", "turn", "|turn|>", "<|end|>", "</s>", "[INST]", "[^INST]", "[", "/INST]", "\n", "\\", "x", "<^^/s>"]
    for _ in range(3000):
        text = "".join(pick.choice(bits) for _ in range(pick.randrange(9)))
        told = chat.escape(text)
        assert chat.unescape(told) == text
        assert not any(c in told for c in ("<|turn|>", "<|end|>", "</s>", "[INST]", "[/INST]"))
        assert chat.read_turns(chat.TURN + chat._line(text) + "\n" + told + chat.END) == [(text, text)]


def test_conversations_in_parts(spark, monkeypatch):
    rows = [(i % 3, i, "assistant" if i % 2 else "user", f"text {i} </s>" * (i % 5)) for i in range(300)]
    rows += [(None, 0, None, None), (5, None, "user", "first"), (5, 0, "assistant", "second"), (5, 0, "assistant", "second")]
    monkeypatch.setattr(chat, "PART_CHARS", 200)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    for conv in (0, 1, 2, None, 5):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        learnt = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# Language and quality ------------------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op6_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert held[0] > 0.97 and 0 <= held[1] <= held[2] <= 1


def test_samples_are_bounded_even_and_the_same_again(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("label"))
    for most in (1500, 70):
        got = [sorted(map(tuple, sampled(rows.repartition(n), "label", F.col("id"), most).collect())) for n in (2, 9)]
        counts = collections.Counter(r[1] for r in got[0])
        assert got[0] == got[1] and counts["hot"] == -(-most // SAMPLE_SALTS) * SAMPLE_SALTS and counts["rare"] <= 600
        assert sorted(r[2] for r in got[0] if r[1] == "hot") == list(range(1, counts["hot"] + 1))
        assert most < 600 or counts["rare"] == 600
    assert sampled(rows.limit(0), "label", F.col("id"), 5).count() == 0


def test_sample_groups_do_not_grow_with_tasks_or_repeats(spark):
    rows = spark.range(60_000).select("id", F.lit("hot").alias("label"))
    few, many = (candidates(rows.repartition(n), "label", F.col("id"), 10).count() for n in (4, 64))
    assert few == many and 10 * SAMPLE_SALTS <= few <= 4 * 10 * SAMPLE_SALTS
    again = rows.withColumn("id", F.when(F.col("id") < 40_000, 5).otherwise(F.col("id") % 3000))
    assert candidates(again.repartition(64), "label", F.col("id"), 4).count() <= 3000  # repeats are gone before the groups
    got = {r.id for r in sampled(again, "label", F.col("id"), 64).collect()}
    by_salt = collections.defaultdict(list)
    for r in again.distinct().select("id", F.xxhash64("id").alias("h")).collect():
        by_salt[r.h % SAMPLE_SALTS].append((r.h, r.id))
    assert got == {i for salt in by_salt.values() for _, i in sorted(salt)[:2]}


def test_long_texts_are_counted_whole():
    text = "aé" * 300_000
    counts, short = language.term_counts(text), language.term_counts(text[: 1 << 18])
    n = len(text)
    assert counts.sum() == n + n - 1 + n - 2 and short.sum() < counts.sum()


def test_elastic_net_leaves_most_weights_at_zero():
    data = [(np.array([i % 2, 50 + i % 7]), np.array([1.0, 0.05]), i % 2) for i in range(400)]
    weights = language.follow_leader(data, 2, l1=1.0)
    assert (weights[:2] != 0).all() and (weights[2:-1] == 0).mean() > 0.99


def test_language_of_odd_rows(odd, none):
    model = language.train(odd)
    got = {(r.doc_id, r.lang_pred == "und", r.score) for r in language.identify(odd, model).collect()}
    assert {g[0] for g in got if g[1]} == {1, 2, 3, 8, None}
    assert language.identify(none, model).count() == 0 and language.filter_by_language(odd, model, least=0.0).columns == odd.columns
    nothing = language.train(none)
    assert {r.lang_pred for r in language.identify(odd, nothing).collect()} == {"und"}


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op7_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out")
    rows = got.select("quality", "score", "predicted").collect()
    assert sum(r.quality == r.predicted for r in rows) / len(rows) > 0.9
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1), (7, 1), (10, 0), (99, None)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    assert quality.quality(odd, model).count() == len(ODD) and quality.quality(none, model).count() == 0
    empty = quality.train(none, labels)
    assert {r.score for r in quality.quality(odd, empty).collect()} == {0.5}


# Token counts --------------------------------------------------------------------------------

def _greedy(word, initial, inner):
    at, n = 0, 0
    while at < len(word):
        pieces = inner if at else initial
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_counts_are_those_of_greedy_matching():
    pick = random.Random(4)
    for _ in range(200):
        pieces = [{bytes(pick.choice(b"abc") for _ in range(pick.randrange(1, 6))) for _ in range(pick.randrange(1, 15))} for _ in range(2)]
        match = token_counts.LongestMatch(*pieces)
        for _ in range(30):
            word = bytes(pick.choice(b"abc") for _ in range(pick.randrange(0, 12)))
            assert match.count(word) == _greedy(word, *pieces)


def test_token_counts_of_whole_texts(spark, small, odd, none):
    initial, inner = token_counts.pieces_of_ranks(queries.VOCABULARY)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text.encode().split() for r in docs.select("doc_id", "text").collect()}
    for r in queries.op8_token_counts(spark, small).collect():
        assert (r.n_words, r.n_tokens) == (len(texts[r.doc_id]), sum(_greedy(w, initial, inner) for w in texts[r.doc_id]))
    got = token_counts.token_counts(odd, queries.VOCABULARY)
    assert got.count() == len(ODD) and got.filter("doc_id in (1, 2, 3)").agg(F.sum("n_tokens")).first()[0] == 0
    assert token_counts.token_counts(none, queries.VOCABULARY).count() == 0


# SimHash -------------------------------------------------------------------------------------

def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(values, radius=2):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def test_simhash_against_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    marks = [_fingerprint(r.text) for r in docs]
    roots = _groups(marks)
    got = {r.doc_id: r for r in queries.op9_simhash(spark, small).collect()}
    for r, mark, root in zip(docs, marks, roots):
        assert (got[r.doc_id].fingerprint, got[r.doc_id].component_id) == (f"{mark:016x}", docs[root].doc_id)


@pytest.mark.parametrize("place", [2048, 16])
def test_crowded_places_lose_no_link(spark, place):
    pick = random.Random(1)
    values = set()
    for base in [pick.getrandbits(64) for _ in range(3)]:
        for _ in range(120):
            value = base
            for bit in pick.sample(range(64), pick.randrange(5)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(values | {pick.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.near_links(df, 2, place)).collect()}
    mine, want = collections.defaultdict(set), collections.defaultdict(set)
    for i, (v, g) in enumerate(zip(signed, _groups(values))):
        mine[roots.get(v, v)].add(i)
        want[g].add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_bit_planes_give_every_distance():
    pick = np.random.default_rng(3)
    for radius in (0, 1, 2, 3, 5):
        block = pick.integers(0, 1 << 63, 130, dtype=np.uint64)
        block[1::3] = block[0] ^ (np.uint64(1) << pick.integers(0, 64, len(block[1::3]), dtype=np.uint64))
        got = set(zip(*map(list, simhash.within(simhash.planes(block), len(block), block, radius))))
        want = {(i, j) for i in range(130) for j in range(130) if bin(int(block[i]) ^ int(block[j])).count("1") <= radius}
        assert {(int(a), int(b)) for a, b in got} == want


def test_simhash_of_odd_rows(odd, none):
    got = simhash.near_duplicates(odd)
    rows = got.collect()
    assert len(rows) == len(ODD) and {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in rows if r.doc_id in (4, 5, 10)} == {4}
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len({(r.root) for r in rows})
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.components(links).collect()} == {0}
    assert components.components(links.limit(0)).count() == 0


# Language model ------------------------------------------------------------------------------

@pytest.mark.parametrize("order", [2, 3])
def test_language_model_against_the_definition(spark, small, order, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD", 5000)  # several shards, so hot words are dealt
    monkeypatch.setattr(kneser_ney, "RUN", 4000)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = kneser_ney.train(docs.filter("crc32(cast(doc_id as string)) % 5 <> 1"), order=order)
    assert model.shards > 3 and len(model.hot) > 1
    got = {r.doc_id: r for r in kneser_ney.score(docs, model).collect()}
    texts = {r.doc_id: [w.lower() for w in (r.text or "").encode().split()] for r in docs.select("doc_id", "text").collect()}
    train = [w for i, w in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = {order: collections.Counter()}
    for words in train:
        run = ["<s>"] * (order - 1) + words + ["</s>"]
        counts[order].update(tuple(run[i - order + 1 : i + 1]) for i in range(order - 1, len(run)))
    for level in range(order - 1, 0, -1):
        counts[level] = collections.Counter(g[1:] for g in counts[level + 1])
    single = collections.Counter(w for words in train for w in [*words, "</s>"])
    total, types, less, contexts = sum(single.values()), len(single), {}, {}
    for level, grams in counts.items():
        n1, n2, n3, n4 = (sum(c == i for c in grams.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        less[level] = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        contexts[level] = collections.defaultdict(lambda: [0, 0, 0, 0])
        for g, c in grams.items():
            contexts[level][g[:-1]][0] += c
            contexts[level][g[:-1]][min(c, 3)] += 1

    def chance(gram):
        if not gram:
            return 1 / (types + 1)
        sums, lower = contexts[len(gram)].get(gram[:-1]), chance(gram[1:])
        if not sums:
            return lower
        c, d = counts[len(gram)][gram], less[len(gram)]
        return max(c - d[min(c, 3)], 0) / sums[0] + sum(d[i] * sums[i] for i in (1, 2, 3)) / sums[0] * lower

    for i, words in texts.items():
        run = ["<s>"] * (order - 1) + words + ["</s>"]
        score = sum(math.log10(chance(tuple(run[j - order + 1 : j + 1]))) for j in range(order - 1, len(run)))
        base = sum(math.log10((single[w] + 0.5) / (total + 0.5 * (types + 1))) for w in [*words, "</s>"])
        assert got[i].score == pytest.approx(score, rel=1e-9) and got[i].base_score == pytest.approx(base, rel=1e-9)
        assert (got[i].n_tokens, got[i].train_tokens) == (len(words) + 1, total)
        assert got[i].n_known == sum(w in single for w in [*words, "</s>"])


def test_language_model_on_odd_rows(odd, none):
    model = kneser_ney.train(odd)
    got = kneser_ney.score(odd, model).collect()
    assert len(got) == len(ODD) and all(r.score <= 0 for r in got) and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert kneser_ney.score(none, model).count() == 0
    empty = kneser_ney.train(none)
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score <= 0 for r in kneser_ney.score(odd, empty).collect())


def test_keep_rows_matches_null_ids(odd):
    wanted = odd.filter("doc_id is null").select("doc_id", F.xxhash64("text").alias("__row_hash"))
    assert keep_rows(odd, wanted).count() == 2


def test_keep_rows_shuffles_texts_once_and_chooses_alike(spark, tmp_path):
    rows = [(i % 50 if i % 50 else None, "t" * (i % 50), i, {"a": i}) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int, m map<string, int>")
    kept = docs.filter("coalesce(doc_id, 0) % 2 = 0").select("doc_id", F.xxhash64("text").alias("__row_hash"))
    got = [_rows(keep_rows(docs.repartition(n), kept), "doc_id", "text", "other") for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == 25 and keep_rows(docs, kept).columns == docs.columns
    for name, df in (("docs", docs), ("kept", kept)):
        df.write.parquet(f"{tmp_path}/{name}")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keep_rows(spark.read.parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/kept"))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 2  # the rows with their texts, and the keys that stay
