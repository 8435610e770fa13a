"""What the byte-level encoder does once only: merges of a token, the first bytes of a piece."""

import random

import pytest

from loadcycle.llm import bpe, queries


def odd_ranks():
    """Ranks that no merge list gives: longer tokens may come before their parts, some parts are not there at all."""
    pick = random.Random(7)
    tokens = {bytes([b]) for b in range(256)}
    tokens |= {bytes(pick.choice(b"abc") for _ in range(pick.randint(2, 6))) for _ in range(300)}
    return {token: rank for rank, token in enumerate(pick.sample(sorted(tokens), len(tokens)))}


@pytest.mark.parametrize("make", [odd_ranks, lambda: bpe.read_ranks(queries.VOCABULARY)])
def test_pairs_are_told_apart_as_merging_their_bytes_does(make):
    ranks = make()
    own, pick = bpe.Transducer(ranks), random.Random(3)
    whole = [t for t in own.token_at if t >= 0]
    near = [t for t in whole if len(own.tokens[t]) > 1 and set(own.tokens[t]) <= set(b"abcdenrst ")] or whole
    found = set()
    for _ in range(20_000):
        left, right = pick.choice(near), pick.choice(near)
        told = own._apart(left, right)
        assert told == (bpe.merge_by_rank(own.tokens[left] + own.tokens[right], ranks) == [left, right])
        found.add(told)
    assert found == {False, True}


def test_a_token_is_merged_once_whatever_its_neighbours(monkeypatch):
    own = bpe.Transducer(bpe.read_ranks(queries.VOCABULARY))
    some = [t for t in own.token_at if t >= 0][1000:1060]
    seen, merges = [], bpe.merges
    monkeypatch.setattr(bpe, "merges", lambda parts, ranks: seen.append(b"".join(parts)) or merges(parts, ranks))
    for left in some:
        for right in some:
            own._neighbours(left, right)
    assert len(seen) == len(set(seen)) <= len(some)


def test_first_bytes_of_a_piece_are_followed_once(monkeypatch):
    own = bpe.Codec(queries.VOCABULARY, queries.PATTERN)
    words = [" therhanderon", " therhandulat", " therhandique", " therh"]
    steps, follow = [], bpe.Transducer._follow
    monkeypatch.setattr(bpe.Transducer, "_follow", lambda self, state, data: steps.append((state, data)) or follow(self, state, data))
    got = [own.encode(word) for word in words]
    assert [data for state, data in steps if state == 0] == [words[0][: bpe.HEAD].encode()]
    assert got == [bpe.merge_by_rank(w.encode(), own.transducer.ranks) for w in words]


def test_pieces_in_use_come_back_and_the_table_before_goes(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 2)
    own = bpe.Codec(queries.VOCABULARY, queries.PATTERN)
    texts = [" therhander ulation", " therhander", " quelque ulation", " chose à"] * 3
    for text in texts:
        assert own.decode_bytes(own.encode(text)) == text.encode()
        assert not getattr(own._pieces._older, "_older", None)  # two tables at the most


def test_the_last_byte_of_a_piece_makes_no_state():
    own = bpe.Transducer(bpe.read_ranks(queries.VOCABULARY))
    known = b" therhanderulatio"
    own.encode_piece(known + b"n")  # its last byte is met for the first time
    states = len(own._states)
    for last in (b"n", b"z", b"q", b"\xc3"):
        assert list(own.encode_piece(known + last)) == bpe.merge_by_rank(known + last, own.ranks)
    assert len(own._states) == states


def test_a_token_without_a_rival_needs_no_pair_test(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256}
    own, asked, apart = bpe.Transducer(ranks), [], bpe.Transducer._neighbours
    monkeypatch.setattr(bpe.Transducer, "_neighbours", lambda self, left, right: asked.append((left, right)) or apart(self, left, right))
    assert list(own.encode_piece(b"cdcdcdcdcd")) == bpe.merge_by_rank(b"cdcdcdcdcd", ranks)
    assert not asked  # each prefix can end in one token only
    assert list(own.encode_piece(b"cabdcabdcab")) == bpe.merge_by_rank(b"cabdcabdcab", ranks)
    assert asked and all(right == 256 for _, right in asked)


def test_odd_ranks_give_what_merging_gives():
    ranks, pick = odd_ranks(), random.Random(11)
    own = bpe.Transducer(ranks)
    for _ in range(3000):
        piece = bytes(pick.choice(b"abcd") for _ in range(pick.randint(1, 24)))
        got = list(own.encode_piece(piece))
        assert got == ([ranks[piece]] if piece in ranks else bpe.merge_by_rank(piece, ranks))
