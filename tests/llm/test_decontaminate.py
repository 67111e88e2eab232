import random

import numpy as np
import pytest

from harvestline.llm import decontaminate as D


def corpus(seed=0, n=60):
    random.seed(seed)
    words = [f"w{k}" for k in range(300)]
    common = ["the", "of", "and", "in"]
    sentence = lambda n: " ".join(random.choice(common if random.random() < 0.4 else words) for _ in range(n))
    items = [(k, f"{sentence(random.randint(6, 25))}. {sentence(random.randint(3, 8))}.") for k in range(20)]
    docs = []
    for k in range(n):
        text = sentence(random.randint(0, 250))
        if k % 3 == 0:
            text = f"{sentence(random.randint(0, 90))} {random.choice(items)[1].upper()} {text}"
        docs.append((k, text))
    return docs, items


def naive(index, text, least_overlap):
    """Hits by scoring every passage against every item."""
    words, L, best = D.hash_words(text.lower()), index.length, {}
    for low in range(0, max(1, len(words)), L):
        part = words[low:low + 2 * L]
        have = set(part.tolist())
        for i in range(len(index.ids)):
            score = sum(index.gain[p] for t in range(len(index.terms)) if int(index.terms[t]) in have
                        for p in range(index.first[t], index.first[t + 1]) if index.item[p] == i)
            if score >= index.least - 1e-9:
                q, a = (D.overlap(x, part) for x in index.parts[i])
                if min(q, a) >= least_overlap:
                    best[int(index.ids[i])] = max(best.get(int(index.ids[i]), 0), min(q, a))
    return best


@pytest.mark.parametrize("shard", [20_000, 7])
def test_equals_scoring_everything(spark, docs, shard):
    rows, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: {h.item_id: min(h.question_overlap, h.answer_overlap) for h in r.hits}
           for r in D.find_hits(docs(rows), table, shard_items=shard).collect()}
    index = D.Index([i for i, _ in items], [t.lower() for _, t in items], 0.5)
    for k, text in rows:
        want = naive(index, text, 0.8)
        assert got[k].keys() == want.keys()
        assert all(got[k][i] == pytest.approx(want[i]) for i in want)
    assert sum(map(len, got.values())) >= 20


@pytest.mark.parametrize("least", [0.3, 0.8])
def test_shards_change_no_score(spark, docs, least):
    rows, items = corpus(3, 40)
    items += [(100 + k, f"{t} and more of it") for k, t in items[:7]] + [(200, None), (201, "")]
    table = spark.createDataFrame(items, "item_id long, text string")
    df = docs([*rows, rows[0], (500, None)])

    def hits(shard):
        out = D.find_hits(df, table, least_score=least, least_overlap=0.0, shard_items=shard).collect()
        return sorted((r.doc_id, sorted((h.item_id, round(h.score, 9), round(h.question_overlap, 9), round(h.answer_overlap, 9)) for h in r.hits)) for r in out)

    assert hits(5) == hits(20_000)
    assert sum(len(h) for _, h in hits(5)) > 10
    empty = spark.createDataFrame([(k, None) for k in range(30)], "item_id long, text string")
    assert all(r.hits == [] for r in D.find_hits(df, empty, shard_items=7).collect())


def test_block_bounds_lose_nothing():
    rows, items = corpus(5, 120)
    for least in (0.2, 0.5, 0.9):
        index = D.Index([i for i, _ in items], [t.lower() for _, t in items], least)
        data, starts = D.buffers(__import__("pyarrow").array([t.lower() for _, t in rows]))
        got = index.query(data, starts)
        for (_, text), hits in zip(rows, got, strict=True):
            assert {h["item_id"] for h in hits} == set(naive(index, text, -1.0))


def test_edge_cases(spark, docs):
    items = spark.createDataFrame([(1, "alpha beta gamma delta. epsilon"), (2, None), (3, "alpha beta gamma delta. epsilon"), (4, "...")],
                                  "item_id long, text string")
    rows = ["", None, "x " * 50_000 + "alpha beta gamma delta epsilon", "alpha beta gamma delta", "Alpha, beta gamma! DELTA epsilon", "ünï ß"]
    df = docs(rows + [rows[-2]]).withColumnRenamed("lang", "hits")
    got = {r.doc_id: [h.item_id for h in r.hits] for r in D.find_hits(df, items).collect()}
    assert got == {0: [], 1: [], 2: [1, 3], 3: [], 4: [1, 3], 5: [], 6: [1, 3]}
    assert all(r.hits == [] for r in D.find_hits(docs(rows), items.limit(0)).collect())
    assert D.find_hits(docs([]), items).count() == 0
    assert len(D.word_hashes(np.zeros(0, np.uint8))[0]) == 0
