import random
import re

import numpy as np

from harvestline.llm import jaccard_join as J


def shingles(text):
    w = re.findall(r"[^ \t\n\v\f\r]+", (text or "").lower())
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    """The least id of the connected component of every document."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    return {i: find(i) for i, _ in sets}


def corpus(seed=0):
    random.seed(seed)
    words = [f"w{k}" for k in range(400)]
    text = lambda n: [random.choice(words) for _ in range(n)]
    passage = text(40)
    docs = [text(random.randint(0, 120)) for _ in range(40)]
    for base in docs[:12]:
        for _ in range(random.randint(1, 6)):
            copy = list(base)
            for _ in range(random.randint(0, 4)):
                if copy:
                    copy[random.randrange(len(copy))] = random.choice(words)
            docs.append(copy)
    docs += [passage + text(random.randint(5, 60)) for _ in range(30)]
    rows = [" ".join(d) for d in docs] + ["", "one two", "One  TWO", "one two three"]
    return list(enumerate(rows + rows[:5]))


def test_classes_equal_brute_force(docs):
    for seed, wide in ((0, 64), (1, 3)):
        rows = corpus(seed)
        got = {r.id: r.class_id for r in J.near_duplicates(docs(rows), wide=wide).collect()}
        assert got == brute(rows)


def test_large_group_keeps_few_links(docs):
    random.seed(4)
    base = [f"w{random.randrange(1000)}" for _ in range(150)]
    rows = []
    for k in range(150):
        copy = list(base)
        copy[random.randrange(150)] = f"x{k}"
        rows.append(" ".join(copy))
    got = J.near_duplicates(docs(rows)).collect()
    assert {r.class_id for r in got} == {0} and {r.class_size for r in got} == {150}
    assert all(r.n_links > 0 for r in got)
    assert sum(r.n_links for r in got) / 2 < 150 * 25


def test_pruning_follows_the_posterior():
    least = J.least_matches(1e-5)
    assert (np.diff(least) > 0).all() and least[-1] < 0.8 * J.VALUES
    rng = np.random.default_rng(0)
    draws = rng.beta(least[-1] + 1, J.VALUES - least[-1] + 1, 400_000)
    assert (draws >= 0.8).mean() < 1e-3


def test_keep_one_and_edge_cases(docs):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b c d e f"), (None, None), (9, ""), (7, "z " * 30_000), (8, "z " * 29_000), (1, "q")]
    df = docs(rows).withColumnRenamed("lang", "vertex").withColumnRenamed("source", "id")
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 7, None]
    assert J.near_duplicates(docs([])).count() == 0 and J.keep_one(docs([])).count() == 0


def test_minhash_estimates_similarity():
    import pyarrow as pa

    a, b = " ".join(f"w{k}" for k in range(400)), " ".join(f"w{k}" for k in range(40, 440))
    data, starts = J.buffers(pa.array([a, b]))
    m, keys = J.min_hashes(*J.shingle_sets(data, starts))
    assert keys.shape == (2, J.BANDS) and (keys[0] == keys[1]).any()
    assert abs((m[0] == m[1]).mean() - len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))) < 0.15


def linked_texts(rows):
    """For every document, the different shingle sets at 0.8 or more."""
    sets = {frozenset(shingles(t)) for _, t in rows}
    n = {a: sum(a != b and 5 * len(a & b) >= 4 * len(a | b) for b in sets) for a in sets}
    return {i: n[frozenset(shingles(t))] for i, t in rows}


def test_n_similar_equals_brute_force(docs, monkeypatch):
    rows = corpus(2)
    assert {r.id: r.n_similar for r in J.near_duplicates(docs(rows), wide=3).collect()} == linked_texts(rows)
    # groups of edited copies: all within 0.1 of the text, and up to 0.3 from it, so that many lie out of the core
    monkeypatch.setattr(J, "LEAST_BLOCK", 16)
    random.seed(4)
    for edits in (1, 4):
        base = [f"w{random.randrange(1000)}" for _ in range(150)]
        rows = []
        for k in range(150):
            copy = list(base)
            for e in range(random.randint(1, edits)):
                copy[random.randrange(150)] = f"x{k}_{e}"
            rows.append((k, " ".join(copy)))
        want = linked_texts(rows)
        got = {r.id: r.n_similar for r in J.near_duplicates(docs(rows)).collect()}
        assert got == want and sum(want.values()) > (22_000 if edits == 1 else 2000)


def test_all_pruning_steps_together_keep_the_bound():
    least, p, lost = J.least_matches(1e-5), np.eye(1, J.VALUES + 1)[0], 0.0
    for k in range(1, J.VALUES + 1):
        p = 0.2 * p + 0.8 * np.r_[0, p[:-1]]
        if k % J.STEP == 0:
            need = least[k // J.STEP - 1]
            lost += p[:need].sum()
            p[:need] = 0
    assert 0 < lost <= 1e-5


def test_result_does_not_depend_on_wide(docs):
    """Pairs near the threshold that share one band alone: with a small ``wide`` they were lost."""
    random.seed(11)
    base = [f"w{random.randrange(4000)}" for _ in range(90)]
    rows = []
    for k in range(40):
        copy = list(base)
        for e in range(2):
            copy[(k * 7 + e * 41) % 90] = f"x{k}_{e}"
        rows.append((k, " ".join(copy)))
    assert {r.id: r.class_id for r in J.near_duplicates(docs(rows), wide=3, count_all=False).collect()} == brute(rows)


def test_each_vertex_first_meets_one_hub(docs, monkeypatch):
    """In a group of edited copies the pairs that are compared grow with the members, not with members times bands."""
    random.seed(4)
    base = [f"w{random.randrange(1000)}" for _ in range(150)]
    rows, asked, real = [], [], J.verified
    for k in range(150):
        copy = list(base)
        copy[random.randrange(150)] = f"x{k}"
        rows.append((k, " ".join(copy)))

    def counted(pairs, *rest):
        asked.append(pairs.distinct().count())
        return real(pairs, *rest)

    monkeypatch.setattr(J, "verified", counted)
    assert {r.class_id for r in J.near_duplicates(docs(rows), count_all=False).collect()} == {0}
    assert sum(asked) < 2 * 150


def test_cells_hold_each_pair_of_different_classes_once(spark):
    """The largest class of a band is sent once for each part of the others, however many parts it has itself."""
    for inner, outer, wide in ((60, 3, 4), (5, 30, 4), (7, 1, 4096)):
        band = [(1, v, 0 if v < inner else v, inner + outer) for v in range(inner + outer)]
        cells = J.dealt(spark.createDataFrame(band, "band long, vertex long, class long, n long"), wide).collect()
        met = [tuple(sorted((x.vertex, y.vertex))) for k, x in enumerate(cells) for y in cells[:k]
               if (x.i, x.j) == (y.i, y.j) and {x.side, y.side} in ({0, 2}, {1}) and x["class"] != y["class"]]
        assert len(met) == len(set(met)) == inner * outer + outer * (outer - 1) // 2
        assert sum(c.vertex < inner for c in cells) == inner * -(-outer // wide)


def test_pairs_just_under_the_threshold_stay_in_their_cells(docs, monkeypatch):
    """All pairs of the group are at 0.76, so most share a band and pass the pruning: they are not joined one by one."""
    random.seed(5)
    base = [f"w{k}" for k in range(150)]
    rows, asked, real = [], [], J.verified
    for k in range(120):
        copy = list(base)
        for e, at in enumerate(random.sample(range(5, 145), 2)):
            copy[at] = f"x{k}_{e}"
        rows.append((k, " ".join(copy)))

    def counted(pairs, *rest):
        asked.append(pairs.distinct().count())
        return real(pairs, *rest)

    monkeypatch.setattr(J, "verified", counted)
    assert {r.id: r.class_id for r in J.near_duplicates(docs(rows), count_all=False).collect()} == brute(rows)
    assert sum(asked) < 120 * 25


def test_a_cell_returns_links_that_connect():
    import pyarrow as pa

    sets = [np.array([*range(100), 1000 + v], np.uint64).tobytes() for v in range(6)] + [np.arange(5000, 5100, dtype=np.uint64).tobytes()]
    table = pa.table({"vertex": pa.array(range(7), pa.int64()), "others": pa.array([list(range(v + 1, 7)) for v in range(7)], pa.list_(pa.int64())),
                      "shingles": pa.array(sets, pa.binary())})
    links = J._link_cell(table).to_pylist()
    assert len(links) == 5 and {v for x in links for v in (x["a"], x["b"])} == set(range(6)) and {x["near"] for x in links} == {2}
    assert J._link_cell(table.slice(0, 0)).num_rows == 0
