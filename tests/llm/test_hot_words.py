"""No shard of the language model grows with the share of a hot word."""

import glob
import os

from loadcycle.llm import arrays, kneser_ney


def test_shards_of_a_hot_word_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD", 600)
    docs = spark.createDataFrame([(i, " ".join(f"a w{i}x{j} v{i}x{j}" for j in range(100))) for i in range(200)], "doc_id long, text string")
    model = kneser_ney.train(docs, order=2)
    files = glob.glob(f"{model.folder.removeprefix('file:')}/2-*")
    sizes = [len(arrays.mapped(model.folder, os.path.basename(f))["keys"]) for f in files]
    assert model.shards > 90 and sum(sizes) > 60_000 and max(sizes) < 2 * 600
