"""Quality by compression: zstandard dictionaries of good and of bad text, and the size difference as a score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.llm.common import ROW_HASH, SAMPLE_SALTS, columns, cut, per_text, row_hash, sampled, small_batches, to_arrow

#: Labelled texts per class in the sample at the most, bytes of a dictionary, bytes compressed at a time.
PER_CLASS, DICTIONARY, CHUNK, LEVEL = 1500, 1 << 16, 1 << 12, 3
#: Bytes that the texts of a class and salt give to the driver; of more, a dictionary of this size is built where they are.
PART = 1 << 18


def chunks(text: bytes) -> list[bytes]:
    return [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]


def build_dictionary(pieces: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary trained on the pieces; where they are too few to train one, their own bytes."""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


class SizeDifference:
    """How much better one dictionary packs a text than the other."""

    def __init__(self, good: bytes, bad: bytes):
        self._pack = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=False,
                write_checksum=False, write_dict_id=False,
            ).compress
            for d in (good, bad)
        ]

    def __call__(self, text: bytes) -> float:
        """(bad - good) / (bad + good) of the compressed sizes of all chunks; 0 for an empty text."""
        good, bad = (sum(len(pack(c)) for c in chunks(text)) for pack in self._pack)
        return (bad - good) / (bad + good) if text else 0.0


def fit_sigmoid(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic regression with a little ridge, by Newton steps."""
    if not len(y):
        return 0.0, 0.0
    data = np.column_stack((x * 100, np.ones(len(x))))
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(data @ beta, -30, 30)))
        hessian = (data * (p * (1 - p))[:, None]).T @ data + 1e-2 * np.eye(2)
        beta += np.clip(np.linalg.solve(hessian, data.T @ (y - p) - 1e-2 * beta), -5, 5)
    return float(beta[0] * 100), float(beta[1])


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def scorer(self):
        difference = SizeDifference(self.good, self.bad)

        def score(text: bytes) -> float:
            logit = self.slope * difference(text) + self.offset
            return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))

        return score


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
    label_col: str = "quality", per_class: int = PER_CLASS,
) -> QualityModel:
    """Dictionaries and calibration from at most ``per_class`` labelled texts of each class (see ``sampled``).

    Two thirds of the sample build the dictionaries, from all their chunks; the rest, which these have not seen, fits the
    calibration. The sample is chosen by the hash of the id among the labelled ids of ``docs``. Labels other than 0 and 1
    are passed over, null texts count as empty; an id with several labels counts with the largest, one with several texts
    with that of the smallest hash. No text comes to the
    driver: texts of a class and salt that hold more than ``PART`` bytes are first put into a dictionary of that size.
    """
    small_batches(docs.sparkSession)
    marks = labels.filter(F.col(label_col).isin(0, 1) & F.col(label_id).isNotNull()).groupBy(
        F.col(label_id).cast("long").alias("__label_id")
    ).agg(F.max(label_col).alias("label"))
    present = docs.select(F.col(id_col).cast("long").alias("__label_id"))
    marks = sampled(marks.join(present, "__label_id", "left_semi"), "label", F.col("__label_id"), per_class)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_hash(text_col).alias(ROW_HASH)).join(
        F.broadcast(marks), F.col("doc_id") == F.col("__label_id")  # per_class rows of each class at the most
    )
    rows = rows.groupBy("doc_id", F.col("label").cast("int").alias("label"), "place").agg(
        F.min_by(F.struct("text"), ROW_HASH).alias("one")
    ).select("doc_id", "label", "place", "one.text")
    rows = cut(rows, "quality-sample")
    teach = rows.filter("place % 3 <> 0").select(
        "label", "place", F.pmod("place", F.lit(SAMPLE_SALTS)).alias("salt"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    found = teach.groupBy("label", "salt").applyInArrow(_pieces, _PIECES).collect()  # PART bytes for each class and salt
    found.sort(key=lambda r: (r["place"], r["at"]))
    good, bad = (build_dictionary([bytes(r["piece"]) for r in found if r["label"] == k]) for k in (1, 0))

    def make():
        difference = SizeDifference(good, bad)
        return lambda text: (difference(text or b""),)

    rest = per_text(rows.filter("place % 3 = 0"), make, "x double", id_col="doc_id", text_col="text", keep=["label", "place"])
    rest = sorted(rest.select("place", "label", "x").collect())  # numbers only
    x, y = np.array([r["x"] for r in rest], float), np.array([r["label"] for r in rest], float)
    return QualityModel(good, bad, *fit_sigmoid(x, y))


_PIECES = columns("label int, place int, at int, piece binary")


def _pieces(group: pa.Table) -> pa.Table:
    """All chunks of the texts of a class and salt, or those of a dictionary trained on them if they are many."""
    rows = sorted(group.to_pylist(), key=lambda r: r["place"])
    parts = [(r["place"], i, c) for r in rows for i, c in enumerate(chunks(r["text"]))]
    if sum(len(p) for _, _, p in parts) > PART:
        held = build_dictionary([p for _, _, p in parts], PART)
        parts = [(rows[0]["place"], i, c) for i, c in enumerate(chunks(held))]
    arrow = to_arrow(_PIECES)
    values = [[rows[0]["label"]] * len(parts), *(list(c) for c in zip(*parts))] if parts else [[]] * 4
    return pa.table([pa.array(v, f.type) for v, f in zip(values, arrow)], schema=arrow)


def quality(
    df: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
    threshold: float = 0.7,
) -> DataFrame:
    """doc_id, the ``keep`` columns, score and predicted (1 from ``threshold`` on) of each whole text.

    Null and empty texts have no size difference and get the score of a difference of 0. Rows are judged by
    themselves, so repeated rows and ids come out as they are; other columns, of any name, are passed over; an empty table
    gives an empty result.
    """

    def make():
        score = model.scorer()

        def one(text: bytes | None) -> tuple:
            value = score(text or b"")
            return value, int(value >= threshold)

        return one

    return per_text(df, make, "score double, predicted int", id_col=id_col, text_col=text_col, keep=keep)
