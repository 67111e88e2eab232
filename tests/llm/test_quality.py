import numpy as np
import pyarrow as pa

from harvestline.llm import quality
from harvestline.llm.common import buffers


def sample(n=300, seed=0):
    rng = np.random.default_rng(seed)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "table", "green", "quiet"]
    good = [" ".join(rng.choice(words, rng.integers(20, 200))) + "." for _ in range(n)]
    bad = [" ".join(w.upper() + "!!" for w in rng.choice(words, rng.integers(20, 200))) for _ in range(n)]
    return good + bad, np.r_[np.ones(n), np.zeros(n)]


def test_learns_and_holds_on_unseen_texts():
    net = quality.train(pa.array(sample()[0]), sample()[1], passes=4)
    texts, y = sample(100, 7)
    p = quality.score_texts(net, *buffers(pa.array(texts)))
    assert ((p >= 0.3) == y).mean() > 0.97


def test_chunks_cover_the_whole_text():
    sizes = np.array([0, 1, 255, 256, 257, 480, 481, 5000])
    doc, first, end = quality.chunk_starts(np.r_[0, np.cumsum(sizes)])
    for d, size in enumerate(sizes):
        own, base = doc == d, np.r_[0, np.cumsum(sizes)][d]
        seen = np.zeros(size, bool)
        for a in first[own] - base:
            seen[a:a + quality.CHUNK] = True
        assert seen.all() and own.sum() >= 1
        assert own.sum() == 1 or first[own][-1] + quality.OVERLAP < end[own][-1]


def test_score_does_not_depend_on_blocks(monkeypatch):
    net = quality.new_network(np.random.default_rng(0))
    data = buffers(pa.array(["a" * 10_000, "", None, "b c d"]))
    whole = quality.score_texts(net, *data)
    monkeypatch.setattr(quality, "BLOCK_CHUNKS", 3)
    assert np.allclose(whole, quality.score_texts(net, *data))


def test_gradient_step_lowers_the_loss_and_edge_cases(docs):
    assert quality.train(pa.array([], pa.string()), np.array([])) == 0.5
    assert quality.train(pa.array(["a", "b"]), np.array([1, 1])) == 1.0
    net = quality.new_network(np.random.default_rng(0))
    rows = quality.score(docs(["", None, "x" * 200_000, "same", "same"]).withColumnRenamed("lang", "score"), net).collect()
    by = {r.doc_id: r.score for r in rows}
    assert by[0] == by[1] and by[3] == by[4] and all(0 <= s <= 1 for s in by.values())
    assert quality.score(docs([]), net).count() == 0


def test_fit_uses_the_given_rows_only(docs, spark):
    texts, y = sample(60)
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, label int")
    net = quality.fit(docs(texts), labels.withColumn("label", F.when(F.col("doc_id") % 7 != 0, F.col("label"))), max_docs=80)
    assert isinstance(net, quality.Network)
    assert quality.fit(docs(texts), labels.limit(0)) == 0.5
    assert quality.fit(docs([(None, "a"), (1, None)]), labels.where("doc_id < 2")) == 1.0
