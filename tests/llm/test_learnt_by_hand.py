"""The learnt operators against plain versions of each of their parts, and of their whole queries."""

import collections
import math

import numpy as np
import pytest
import zstandard

from loadcycle.llm import language, quality, queries
from loadcycle.llm.common import fold

WRAP = (1 << 32) - 1


def _cells(text):
    """Cells of all character n-grams of a text, one n-gram at a time."""
    found, text = collections.Counter(), text.lower()
    for n in language.LENGTHS:
        for at in range(len(text) - n + 1):
            mixed = ord(text[at + n - 1])
            for c in reversed(text[at : at + n - 1]):
                mixed = (mixed * 0x9E3779B1 & WRAP) ^ (ord(c) * 0x85EBCA77 & WRAP)
            salted = (mixed * 0xC2B2AE3D + (n * 0x27D4EB2F & WRAP)) & WRAP
            salted ^= salted >> 15
            found[(salted * 0x2C1B3C6D & WRAP) >> 18] += 1
    return found


TEXTS = ["", "a", "Ab", "the quick brown fox", "ÄÖÜ straße 日本語 \U0001F600!", "x" * 50, "İ ı ſ"]


@pytest.mark.parametrize("size", [7, 1 << 18])
def test_n_grams_one_at_a_time(monkeypatch, size):
    monkeypatch.setattr(language, "_SLICE", size)
    for text in TEXTS:
        counts = language.term_counts(text)
        assert {int(i): int(counts[i]) for i in np.flatnonzero(counts)} == _cells(text)


def _weights_of(cells, idf):
    values = {c: (1 + math.log(n)) * idf[c] for c, n in cells.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {c: v / length for c, v in values.items()} if length else values


def _softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def _leader(samples, classes, alpha=0.5, beta=1.0, l1=0.02, l2=0.01, rounds=3):
    """Follow the regularised leader with dictionaries, one weight at a time."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(key):
        if abs(z[key]) <= l1:
            return 0.0
        return (math.copysign(l1, z[key]) - z[key]) / ((beta + math.sqrt(n[key])) / alpha + l2)

    for _ in range(rounds):
        for values, label in samples:
            features = [*values.items(), (language.BUCKETS, 1.0)]
            w = {(c, k): weight((c, k)) for c, _ in features for k in range(classes)}
            chances = _softmax([sum(x * w[c, k] for c, x in features) for k in range(classes)])
            for c, x in features:
                for k in range(classes):
                    g = x * (chances[k] - (k == label))
                    after = n[c, k] + g * g
                    z[c, k] += g - (math.sqrt(after) - math.sqrt(n[c, k])) / alpha * w[c, k]
                    n[c, k] = after
    return {key: weight(key) for key in list(z)}


def test_language_query_by_hand(spark, small, monkeypatch):
    """Frequencies, weights, temperature and predictions of the whole query."""
    seen, follow, fit = {}, language.follow_leader, language.fit_temperature
    monkeypatch.setattr(language, "follow_leader", lambda samples, classes: seen.update(s=samples, k=classes) or follow(samples, classes))
    monkeypatch.setattr(language, "fit_temperature", lambda logits, labels: seen.update(logits=logits, labels=labels) or fit(logits, labels))
    got = {r.doc_id: r for r in queries.op6_language_id(spark, small).collect()}
    docs = [(r.doc_id, r.text, r.lang, r.held) for r in
            queries.tables(spark, small, "documents").withColumn("held", fold("doc_id", 3) == 1).collect()]
    teach = [(i, t, lang) for i, t, lang, held in docs if not held and lang is not None and t is not None]
    cells = {t: _cells(t) for _, t, _, _ in docs if t}
    found = collections.Counter(c for _, t, _ in teach for c in cells.get(t, ()))
    idf = [math.log((1 + len(teach)) / (1 + found[c])) + 1 for c in range(language.BUCKETS)]
    languages = sorted({lang for *_, lang in teach})
    assert seen["k"] == len(languages) and len(seen["s"]) + len(seen["labels"]) <= len(teach)
    known = {tuple(sorted(_weights_of(cells.get(t, {}), idf))): (t, languages.index(lang)) for _, t, lang in teach}
    samples = []
    for terms, values, label in seen["s"]:
        text, own = known[tuple(sorted(int(c) for c in terms))]
        want = _weights_of(cells.get(text, {}), idf)
        assert own == label and all(abs(want[int(c)] - v) < 1e-6 for c, v in zip(terms, values))
        samples.append((want, label))
    weights = _leader(samples, len(languages))
    grid = [0.02 * 1000 ** (i / 2000) for i in range(2001)]
    losses = [-sum(math.log(_softmax([x / t for x in row])[y] + 1e-12) for row, y in zip(seen["logits"], seen["labels"])) for t in grid]
    finest, temperature = grid[losses.index(min(losses))], fit(seen["logits"], seen["labels"])
    assert abs(math.log(temperature / finest)) < 0.04
    far = 0
    for doc_id, text, _, _ in docs:
        if not text or not any(c.isalpha() for c in text):
            assert got[doc_id].lang_pred == "und"
            continue
        x = _weights_of(cells[text], idf)
        logits = [sum(v * weights.get((c, k), 0.0) for c, v in x.items()) + weights.get((language.BUCKETS, k), 0.0) for k in range(len(languages))]
        chances = _softmax([v / temperature for v in logits])
        assert got[doc_id].lang_pred == languages[chances.index(max(chances))]
        far = max(far, abs(got[doc_id].score - max(chances)))
    assert far < 1e-3 and len(got) == len(docs)


def _size(text, dictionary):
    """Compressed size, a fresh compressor for each chunk."""
    total = 0
    for at in range(0, len(text), quality.CHUNK):
        pack = zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_checksum=False,
            write_dict_id=False,
        )
        total += len(pack.compress(text[at : at + quality.CHUNK]))
    return total


def test_quality_query_by_hand(spark, small, monkeypatch):
    """Sizes, calibration and scores of the whole query."""
    seen, fit, train = {}, quality.fit_sigmoid, quality.train
    monkeypatch.setattr(quality, "fit_sigmoid", lambda x, y: seen.update(x=x, y=y) or fit(x, y))
    monkeypatch.setattr(quality, "train", lambda *a, **k: seen.setdefault("model", train(*a, **k)))
    got = {r.doc_id: r for r in queries.op7_quality_classifier(spark, small).collect()}
    model = seen["model"]
    slope, offset = model.slope, model.offset

    def loss(a, b):
        p = 1 / (1 + np.exp(-np.clip(a * seen["x"] + b, -30, 30)))
        return -(seen["y"] * np.log(p) + (1 - seen["y"]) * np.log(1 - p)).sum() + 5e-3 * ((a / 100) ** 2 + b**2)

    least = loss(slope, offset)
    assert all(least <= loss(slope + da, offset + db) + 1e-9 for da in (-5, -0.5, 0, 0.5, 5) for db in (-0.3, -0.01, 0, 0.01, 0.3))
    docs = queries.tables(spark, small, "documents").withColumn("held", fold("doc_id", 4) == 2).collect()
    assert len(got) == len(docs)
    for r in docs:
        text = (r.text or "").encode()
        good, bad = _size(text, model.good), _size(text, model.bad)
        x = (bad - good) / (bad + good) if text else 0.0
        want = 1 / (1 + math.exp(-min(30, max(-30, slope * x + offset))))
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].held_out == r.held
        assert got[r.doc_id].predicted == int(want >= 0.7)
