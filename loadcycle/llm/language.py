"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training rows. The weights are learnt by follow-the-regularised-leader with
an elastic net on a bounded sample of labelled rows, then a temperature is fitted on the part of the sample that was
kept back, so that scores are probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.llm.common import ROW_HASH, per_text, row_hash, sampled, small_batches

#: Hashed n-grams, their lengths, and labelled rows per language in the sample at the most.
BUCKETS, LENGTHS, PER_LANGUAGE = 1 << 14, (1, 2, 3), 600
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_SLICE = 1 << 18


def term_counts(text: str) -> np.ndarray:
    """How often each hashed character n-gram occurs in the whole text, in lower case."""
    counts = np.zeros(BUCKETS, np.int64)
    text = text.lower()
    for start in range(0, len(text), _SLICE):  # slices overlap by what an n-gram needs, so none is lost or repeated
        codes = np.frombuffer(text[max(0, start - max(LENGTHS) + 1) : start + _SLICE].encode("utf-32-le"), "<u4")
        skip = min(start, max(LENGTHS) - 1)
        mixed = codes.astype(np.uint32)
        for n in range(1, max(LENGTHS) + 1):
            if n > 1:
                mixed = mixed[1:] * np.uint32(0x9E3779B1) ^ codes[: len(codes) - n + 1] * np.uint32(0x85EBCA77)
            if n in LENGTHS and len(mixed):
                salted = mixed * np.uint32(0xC2B2AE3D) + np.uint32(n * 0x27D4EB2F)
                salted ^= salted >> np.uint32(15)
                cells = salted[max(0, skip - n + 1) :] * np.uint32(0x2C1B3C6D) >> np.uint32(32 - 14)
                counts += np.bincount(cells, minlength=BUCKETS)
    return counts


def document_frequencies(df: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """For each n-gram the number of texts that hold it, and the number of texts. Sums per task, then per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, texts = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found += term_counts((text.as_py() or b"").decode("utf-8", "replace")) > 0
                texts += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, BUCKETS), pa.int64()), pa.array(np.concatenate(([texts], found)), pa.int64())],
            names=["bucket", "n"],
        )

    small_batches(df.sparkSession)
    rows = df.select(F.col(text_col).cast("binary")).mapInArrow(run, "bucket long, n long")
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row per bucket
    found = np.zeros(BUCKETS + 1, np.int64)
    for row in sums:
        found[row["bucket"]] = row["n"]
    return found[:-1], int(found[-1])


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a text, of length 1."""
    terms = np.flatnonzero(counts)
    values = (1.0 + np.log(counts[terms])) * idf[terms]
    length = np.sqrt((values**2).sum())
    return terms, values / length if length else values


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        terms, values = tf_idf(term_counts(text), self.idf)
        return values @ self.weights[terms] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        chances = softmax(self.logits(text) / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_leader(
    samples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, *, alpha: float = 0.5, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.01, rounds: int = 3,
) -> np.ndarray:
    """Weights (terms + bias by classes) of multinomial logistic regression, one sample after the other.

    Each weight is the minimiser of all gradients so far plus the elastic net, so the L1 part sets many to zero.
    """
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(rounds):
        for terms, values, label in samples:
            at = np.append(terms, BUCKETS)
            x = np.append(values, 1.0)
            z_at, n_at = z[at], n[at]
            w = weights(z_at, n_at)
            error = softmax(x @ w)
            error[label] -= 1.0
            g = x[:, None] * error[None, :]
            after = n_at + g * g
            z[at] = z_at + g - (np.sqrt(after) - np.sqrt(n_at)) / alpha * w
            n[at] = after
    return weights(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes the labels kept back most likely."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> LanguageModel:
    """Learn from the labelled rows of ``df``; those without a label or a text are passed over.

    Document frequencies cover all labelled rows. The weights come from ``per_language`` rows of each language at
    the most, chosen by the hash of id and text (see ``sampled``); a fifth of them is kept back for the temperature.
    """
    labelled = df.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"),
        row_hash(text_col).alias(ROW_HASH),
    )
    found, texts = document_frequencies(labelled, "text")
    idf = np.log((1 + texts) / (1 + found)) + 1.0
    hashed = labelled.select("doc_id", "label", ROW_HASH, F.xxhash64("doc_id", ROW_HASH).alias("h"))
    chosen = sampled(hashed, "label", F.col("h"), per_language)
    chosen = chosen.groupBy("h").agg(F.min(F.struct("place", "label")).alias("one")).select("h", "one.place", "one.label")
    rows = labelled.withColumn("h", F.xxhash64("doc_id", ROW_HASH)).join(
        F.broadcast(chosen), ["h", "label"]  # per_language rows of each language at the most
    ).dropDuplicates(["h"])  # a text with several labels counts with one

    def make():
        def one(text: bytes) -> tuple:
            terms, values = tf_idf(term_counts(text.decode("utf-8", "replace")), idf)
            return terms.astype("<i4").tobytes(), values.astype("<f4").tobytes()

        return one

    table = per_text(
        rows.select("h", "label", "place", "text"), make, "terms binary, weights binary",
        id_col="h", text_col="text", keep=["label", "place"],
    ).drop("doc_id")
    sample = sorted(table.collect(), key=lambda r: (r["place"], r["label"]))
    languages = sorted({r["label"] for r in sample})
    index = {name: i for i, name in enumerate(languages)}
    data = [
        (np.frombuffer(r["terms"], "<i4"), np.frombuffer(r["weights"], "<f4").astype(float), index[r["label"]], r["place"])
        for r in sample
    ]
    weights = follow_leader([d[:3] for d in data if d[3] % 5], len(languages)) if languages else np.zeros((BUCKETS + 1, 0))
    kept = [d for d in data if d[3] % 5 == 0]
    logits = np.array([d[1] @ weights[d[0]] + weights[-1] for d in kept]).reshape(len(kept), len(languages))
    temperature = fit_temperature(logits, np.array([d[2] for d in kept], int))
    return LanguageModel(languages, idf, weights.astype(np.float32), temperature)


def identify(
    df: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """doc_id, the ``keep`` columns, lang_pred and score of each whole text.

    ``und`` with score 0 where the text is null or has no letter, or if no language was learnt. Languages of equal chance go to the
    first in order. Rows are judged by themselves, so repeated rows come out as they are and an empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # buckets x languages, whatever the input

    def make():
        own = shared.value
        return lambda text: own.predict(None if text is None else text.decode("utf-8", "replace"))

    return per_text(df, make, "lang_pred string, score double", id_col=id_col, text_col=text_col, keep=keep)


def filter_by_language(
    df: DataFrame, model: LanguageModel, *, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``df`` whose language is told with a score of ``least`` or more; nothing is shuffled.

    Rows pass as they are, with all their columns, so repeated rows and null ids need no key.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            told = [own.predict(text.as_py()) for text in batch.column(at)]
            yield batch.filter(pa.array([name != UNDETERMINED and score >= least for name, score in told], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def told_languages(df: DataFrame, model: LanguageModel, *, text_col: str = "text", into: str = "lang") -> DataFrame:
    """The rows of ``df`` whose language can be told, with the told language in ``into`` where it has none; nothing is shuffled.

    Null texts and texts without a letter go, and all rows if no language was learnt. Labels stay, and so do other columns.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at, to = df.columns.index(text_col), df.columns.index(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            told = pa.array([own.predict(text.as_py())[0] for text in batch.column(at)], pa.string())
            label = batch.column(to)
            filled = batch.set_column(to, batch.schema.field(to), pc.coalesce(label, told.cast(label.type)))
            yield filled.filter(pa.array([name.as_py() != UNDETERMINED for name in told], pa.bool_()))

    return df.mapInArrow(run, df.schema)
