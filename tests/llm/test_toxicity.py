import numpy as np
import pyarrow as pa

from harvestline.llm import toxicity as T
from harvestline.llm.common import buffers


def texts(n, toxic, rng):
    words = [f"{a}{b}" for a in "bcdfgklm" for b in ("ana", "olo", "iri", "udu", "ete")]
    out = []
    for _ in range(n):
        w = list(rng.choice(words, rng.integers(10, 300)))
        if toxic:
            for _ in range(3):
                w.insert(int(rng.integers(0, len(w))), str(rng.choice(["Wretch", "scoundrel", "vermin"])))
        out.append(" " + " ".join(w) + " ")
    return out


def test_learns_from_positive_and_unlabelled_texts():
    rng = np.random.default_rng(0)
    unlabelled = texts(450, False, rng) + texts(50, True, rng)
    model = T.train(pa.array(texts(150, True, rng)), pa.array(unlabelled), 0.1)
    toxic = T.score_texts(model, *buffers(pa.array(texts(200, True, rng))))
    clean = T.score_texts(model, *buffers(pa.array(texts(400, False, rng))))
    assert (toxic >= 0.3).mean() > 0.97 and (clean >= 0.3).mean() < 0.01


def test_features_equal_plain_search_over_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    rows = pa.array(["".join(rng.choice(list("ab "), rng.integers(0, 80))) for _ in range(50)])
    grams = np.unique(T.gram_keys(np.frombuffer(b"ab ab baabba bbbb", np.uint8)))
    monkeypatch.setattr(T, "BLOCK_BYTES", 37)
    doc, gram = T.features(*buffers(rows), grams, T._filter(grams))
    want = {(d, g) for d, t in enumerate(rows.to_pylist()) for g, key in enumerate(grams)
            if int(key).to_bytes(6, "big").decode() in t}
    assert set(zip(doc.tolist(), gram.tolist(), strict=True)) == want


def test_edge_cases(docs):
    model = T.train(pa.array([], pa.string()), pa.array([" a "]), 0.1)
    got = [r.score for r in T.score(docs(["", None, "x" * 300_000, "idiot"]).withColumnRenamed("lang", "score"), model).collect()]
    assert got == [0.0] * 4
    model = T.Model(np.sort(T.gram_keys(np.frombuffer(b" idiot ", np.uint8))), np.array([2.0, 2.0]), -3.0)
    got = {r.doc_id: r.score for r in T.score(docs(["", None, "idiot", "Idiot!", "idiotic", "idiot"]), model).collect()}
    assert got[0] == got[1] < got[4] < got[2] == got[3] == got[5]
    assert T.score(docs([]), model).count() == 0
