"""Piece encoding, token alignment and conversation repair against the libraries, brute force and odd tables."""

import collections
import hashlib
import itertools
import random


import numpy as np

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import differences
from loadcycle.llm import alignment, arrays, queries, repair
from loadcycle.llm import sentence_pieces as sp

DOCS = "doc_id long, text string, lang string"
LONG = "word " * 30_000 + "é" * 20_000 + "x" * 20_000 + " " * 5_000
ODD = [
    (1, None, None), (2, "", "en"), (3, " \t\n ", "en"), (4, "Hello  world, it's", None), (5, "a▁b", "en"), (5, "a▁b", "en"),
    (None, "no id", "fr"), (None, None, "fr"), (7, LONG, "en"), (8, "<s> </s> <0x41> <unk> <|endoftext|>", None),
    (9, "ß\x85 ï\U0001F600 \x1c\x00", "de"), (10, "日本語 text ²_{x}", "ja"),
]
CLASHES = ["n_tokens", "ids", "n_a", "pairs", "times", "best", "__text", "a", "b", "file", "keep", "kind", "fault", "key"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, DOCS).repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


@pytest.fixture(scope="module")
def byte_level():
    found = Tokenizer.from_file(queries.BYTE_LEVEL)
    found.encode_special_tokens = True
    return found


def _texts(count, seed, most=20):
    pick = random.Random(seed)
    bits = ["the", "ing", " ", "  ", "   ", "\n", "'s", "a", "aaaa", "!!", "123", "\x1c", "é", "日本", "\U0001F600", "▁", "<s>", "_{", "²."]
    for _ in range(count):
        yield "".join(pick.choice(bits) if pick.random() < 0.7 else chr(pick.randrange(1, 0x3000)) for _ in range(pick.randrange(most)))


def _sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# Pieces -------------------------------------------------------------------------------------

def test_pieces_are_those_of_the_library(library):
    own, pick = sp.codec(queries.PIECES), random.Random(4)
    for text in _texts(3000, 5):
        assert own.encode(text) == library.encode(text)
        assert own.decode(own.encode(text)) == library.decode(library.encode(text))
        ids = [pick.randrange(3, 400) if pick.random() < 0.6 else pick.randrange(32000) for _ in range(6)]
        assert own.decode(ids) == library.decode(ids)


def test_each_prefix_has_one_last_piece(library):
    table = sp.codec(queries.PIECES).table
    text = "▁unbelievable▁▁▁reconstruction"
    last = table.last_pieces(text)
    for end in range(1, len(text) + 1):
        assert table.texts[last[end]] == sp.merge_by_score(text[:end], table.rank)[-1]


def test_piece_tables_that_start_anew_change_nothing(library, monkeypatch):
    monkeypatch.setattr(sp, "MAX_PARTS", 3)
    monkeypatch.setattr(sp, "MAX_PAIRS", 5)
    own, text = sp.Codec(sp.read_model(queries.PIECES)), "unbelievable reconstruction of antidisestablishmentarianism " * 3
    assert own.encode(text) == library.encode(text)


def test_safe_cuts_follow_the_vocabulary():
    import re

    for pieces, text, want in (
        (["▁a", "ab", "!!"], "▁ab!!▁▁ab", ["▁ab", "!!", "▁▁ab"]),
        (["▁a", "!a", "ab"], "▁ab!!ab", ["▁ab", "!!ab"]),
        (["a!", "ab"], "ab!!ab", ["a", "b", "!!", "ab"]),
        (["a▁", "ab"], "ab▁▁ab", ["ab▁▁ab"]),
    ):
        found = re.findall(sp.safe_cuts(pieces), text)
        assert "".join(found) == text
        assert found == want or pieces == ["a!", "ab"]
        for left, right in zip(found, found[1:]):
            assert not any(left[-1] + right[0] in p for p in pieces)


def test_other_models_are_refused(tmp_path):
    broken = tmp_path / "unigram.model"
    broken.write_bytes(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError, match="merge type"):
        sp.read_model(str(broken))


def test_round_trip_of_pieces_on_odd_rows(odd, library):
    got = sp.round_trip(odd, queries.PIECES)
    want = []
    for doc_id, text, _ in ODD:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids))))
    rows = [tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert sp.round_trip(odd.limit(0), queries.PIECES).columns == got.columns
    assert sp.round_trip(odd.limit(0), queries.PIECES).count() == 0


# Alignment ----------------------------------------------------------------------------------

def _aligned(text, byte_level, library):
    """Ids, groups and links by comparing all tokens with each other."""
    ids_a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = library.encode(text) if text else []
    own = alignment._aligner(queries.BYTE_LEVEL, queries.PATTERN, queries.PIECES)
    if not text or any(b"".join(side.bytes[i] for i in ids) != (" " + text).encode() for ids, side in ((ids_a, own.a), (ids_b, own.b))):
        return [], [], [], []
    ends_a = list(itertools.accumulate(len(own.a.bytes[i]) for i in ids_a))
    ends_b = list(itertools.accumulate(len(own.b.bytes[i]) for i in ids_b))
    groups, i, j = [], 0, 0
    for k, end in enumerate(ends_a):
        if end in set(ends_b):
            to = ends_b.index(end) + 1
            groups.append((ids_a[i : k + 1], ids_b[j:to]))
            i, j = k + 1, to
    links = [
        (a, b) for a, end, start in zip(ids_a, ends_a, [0, *ends_a]) for b, stop, begin in zip(ids_b, ends_b, [0, *ends_b])
        if start < stop and begin < end
    ]
    return ids_a, ids_b, groups, links


def _alignment_rows(docs, byte_level, library):
    found = [(doc_id, *_aligned(text, byte_level, library)) for doc_id, text in docs]
    count = collections.Counter(link for *_, links in found for link in links)
    most = collections.defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    for doc_id, a, b, groups, links in found:
        told = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield (
            doc_id, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
            _sha(told) if groups else "",
        )


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _align(docs):
    return alignment.align_corpus(docs, queries.BYTE_LEVEL, queries.PATTERN, queries.PIECES)


@pytest.mark.parametrize("window", [2, 4096])
def test_alignment_is_that_of_all_tokens_compared(spark, byte_level, library, window, monkeypatch):
    monkeypatch.setattr(alignment, "WINDOW", window)
    own = alignment._aligner(queries.BYTE_LEVEL, queries.PATTERN, queries.PIECES)
    texts = list(_texts(400, 6, 40))
    for text, (n_a, n_b, n_groups, n_links, told, packed) in zip(texts, own.align([t.encode() for t in texts])):
        a, b, groups, links = _aligned(text, byte_level, library)
        assert (n_a, n_b, n_groups, n_links) == (len(a), len(b), len(groups), len(links))
        keys, counts = alignment._pairs(packed)
        assert {(int(k) & 0xFFFFFFFF, int(k) >> 32): int(c) for k, c in zip(keys, counts)} == collections.Counter(links)


def test_alignment_of_odd_rows(spark, odd, byte_level, library):
    rows = [(doc_id, text) for doc_id, text, _ in ODD if text != LONG]
    got = _align(odd.filter(F.col("doc_id").isNull() | (F.col("doc_id") != 7)))
    want = _alignment_rows(rows, byte_level, library)
    assert sorted((tuple(r[c] for c in NAMES) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert _align(odd.limit(0)).count() == 0
    alone = _align(odd.filter("doc_id = 7")).first()
    ids = byte_level.encode(" " + LONG, add_special_tokens=False).ids, library.encode(LONG)
    assert (alone.n_a, alone.n_b) == tuple(map(len, ids))
    assert alone.n_links == alone.n_a + alone.n_b - alone.n_groups


def test_alignment_of_the_documents(spark, small, byte_level, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect() if len(r.text or "") < 3000]
    short = spark.read.parquet(f"{small}/documents.parquet").filter("text IS NULL OR length(text) < 3000")
    got = [tuple(r[c] for c in NAMES) for r in _align(short).collect()]
    assert sorted(got) == sorted(_alignment_rows(docs, byte_level, library))


def test_array_files_come_back_and_leave_the_table(tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "MAPS", 2)
    folder = f"file://{tmp_path}"
    for i in range(5):
        arrays.save(folder, str(i), {"x": np.arange(i), "y": np.arange(2 * i, dtype="<u2").reshape(i, 2), "z": np.array([i > 2])})
    held = arrays.mapped(folder, "4")["y"]
    for i in range(5):
        found = arrays.mapped(folder, str(i))
        assert found["x"].tolist() == list(range(i)) and found["y"].shape == (i, 2) and found["z"][0] == (i > 2)
    assert len(arrays._MAPPED) <= 2 and held.tolist() == np.arange(8).reshape(4, 2).tolist()
    assert arrays.mapped(folder, "none") == {}


# Repair -------------------------------------------------------------------------------------

def _least(rows):
    """The least cost and audit of every state, row after row."""
    def widened(labels):
        for _ in range(4):
            for state, (cost, audit) in list(labels.items()):
                to, path = repair._NEXT[state], (cost + 3, audit + "I")
                labels[to] = min(labels.get(to, path), path)
        return labels

    labels = {"N": (0, "")}
    for row in rows:
        found = collections.defaultdict(list)
        for state, (cost, audit) in widened(labels).items():
            found[state].append((cost + 4, audit + "D"))
            if not row.gone:
                if state + row.initial in ("Ns", "Nu", "Su", "Au", "Ua"):
                    found[row.initial.upper()].append((cost + row.extra, audit + "K"))
                found["A" if state == "U" else "U"].append((cost + row.extra + 3, audit + "R"))
        labels = {state: min(paths) for state, paths in found.items()}
    return min(path for state, path in widened(labels).items() if state in "NA")


def test_both_heaps_find_the_least_audit():
    pick = random.Random(1)
    for _ in range(2000):
        rows = [repair.Step(pick.choice("suuaax"), pick.random() < 0.2, 3 * (pick.random() < 0.3)) for _ in range(pick.randrange(14))]
        want, cut = _least(rows), pick.randrange(len(rows) + 1)
        assert repair.search(rows, "N", "NA") == want
        assert repair.cheapest(repair.join_paths(repair.all_paths(rows[:cut]), repair.all_paths(rows[cut:]))) == want


def _plan(rows):
    """All of a conversation's results from its rows, in order."""
    seen, steps, faults = set(), [], []
    for _, role, text in rows:
        solid = "".join(c for c in text if c not in " \t\n\v\f\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        steps.append(repair.Step(role[:1], fault in ("blank", "duplicate"), 3 * (fault == "truncated")))
    cost, audit = _least(steps)
    told, at, state = [], 0, "N"
    for edit in audit:
        role, text = rows[at][1:] if edit != "I" else ("", "")
        at += edit != "I"
        if edit == "D":
            continue
        role = role if edit == "K" else {"U": "assistant"}.get(state, "user")
        told.append(f"{role}:{text}")
        state = role[0].upper()
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, _sha("\n".join(told))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _repaired(rows):
    plans = repair.plans(rows)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.repaired_digests(rows, plans).collect()}
    found = {r.conv_id: (*[r[c] for c in COUNTS], digests[r.conv_id]) for r in plans.collect()}
    assert len(found) == plans.count()
    return found


def _conversations(count, most, seed):
    pick, rows = random.Random(seed), []
    for conv in range(count):
        for turn in range(pick.randrange(1, most)):
            text = pick.choice(["Yes.", "No!", "cut off", "", " \n", f"T{turn}?", f"t{turn}", "long " * 50 + "."])
            row = (conv if conv else None, None if pick.random() < 0.05 else turn + pick.randrange(2), pick.choice(["user", "assistant", "user", "assistant", "system", "tool", " "]), text)
            rows += [row] * (1 + (pick.random() < 0.1))
    return rows


def _in_order(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in by.items()}


@pytest.mark.parametrize("size", [3, 1024])
def test_repair_is_that_of_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "SLICE", size)
    rows = _conversations(40, 12, 3) + [(99, None, None, None), (98, 5, "user", None), (98, 5, None, "Hm.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
    assert _repaired(df) == {c: _plan(r) for c, r in _in_order(rows).items()}
    assert repair.plans(df.limit(0)).count() == 0


def test_a_conversation_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "SLICE", 16)
    rows = [(1, t, "user" if t % 3 else "assistant", f"{t}." if t % 5 else "cut") for t in range(700)] + _conversations(5, 6, 8)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = repair._faulty(df).repartitionByRange(*repair._order())
        assert ordered.filter("conv_id = 1").select(F.spark_partition_id()).distinct().count() > 2
        assert _repaired(df) == {c: _plan(r) for c, r in _in_order(rows).items()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repaired_rows_alternate(spark, small):
    rows = queries.damaged(spark.read.parquet(f"{small}/conversations.parquet"))
    found = collections.defaultdict(list)
    for r in repair.repaired(rows, repair.plans(rows)).collect():
        found[r.conv_id].append((r.place, r.role))
    for turns in found.values():
        roles = "".join(role[0] for _, role in sorted(turns))
        assert roles.removeprefix("s") == "ua" * (len(roles) // 2) and len(roles.removeprefix("s")) > 1


def test_repair_query_by_sql_on_odd_conversations(spark, tmp_path):
    rows = _conversations(60, 9, 11) + [(7, 4, None, None), (None, None, "user", "Hm.")]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(path)
    got = queries.op13_conversation_repair(spark, str(tmp_path)).toArrow()
    import duckdb

    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert differences(got, db.sql(queries.ORACLES["op13_conversation_repair"]).to_arrow_table()) is None
    assert got.num_rows == len({r[0] for r in rows})

