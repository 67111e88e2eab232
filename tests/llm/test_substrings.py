import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from harvestline.llm import substrings as S


def brute(rows, length):
    """(n_bytes, n_removed, n_spans, digest of the rest) of every text."""
    texts = [(t or "").encode() for t in rows]
    count = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = True
        gone = gone[:len(t)]
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed, n=60):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdeé") for _ in range(random.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(random.randint(12, 60)) for _ in range(4)]
    rows = []
    for _ in range(n):
        parts = [text(random.randint(0, 40))]
        for _ in range(random.randint(0, 3)):
            parts += [random.choice(passages)[random.randint(0, 30):], text(random.randint(0, 30))]
        rows.append(" ".join(parts))
    for k in range(12):
        t = list(rows[k])
        for _ in range(random.randint(0, 3)):
            if t:
                t[random.randrange(len(t))] = "x"
        rows.append("".join(t))
    return rows + ["ab" * 300, "ab" * 200, "abc" * 90, "", None, rows[3], rows[3], "z" * 79, "z" * 80, "z" * 81]


@pytest.mark.parametrize(("seed", "wide"), [(0, 256), (1, 3), (2, 0)])
def test_equals_brute_force(docs, seed, wide):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in S.remove_repeats(docs(rows), length=80, wide=wide).collect()}
    want = brute(rows, 80)
    assert [got[k] for k in range(len(rows))] == want
    assert sum(w[1] > 0 for w in want) > 20


def test_real_length_blocks_and_clashing_names(docs, monkeypatch):
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(5))
    shared = " ".join(word() for _ in range(90))
    rows = [f"{word()} {shared} {word()}", f"{shared[:399]}", f"{word()} {shared[10:430]}", " ".join(word() for _ in range(2000))]
    df = docs(rows).withColumnRenamed("lang", "n_bytes").withColumnRenamed("source", "h1")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(df).collect()}
    assert [got[k] for k in range(4)] == brute(rows, 400)
    long = rows[3].encode()
    whole = S.anchors(long, 400)
    monkeypatch.setattr(S, "BLOCK_BYTES", 701)
    assert S.anchors(long, 400) == whole
    assert S.remove_repeats(docs([])).count() == 0


def test_deep_shallow_order_and_trie():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(0, 2, 30, dtype=np.uint8)) for _ in range(400)]
    trie = S.BlindTrie()
    for k, t in enumerate(texts):
        trie.insert(t[:9], k)
    leaves = [[texts[k][:9] for k in leaf] for leaf in trie.ordered()]
    assert all(len(set(x)) == 1 for x in leaves)
    assert [x[0] for x in leaves] == sorted({t[:9] for t in texts})
    assert S.common_prefix(b"abcd", b"abxd") == 2 and S.common_prefix(b"ab", b"ab") == 2


def test_equal_windows_have_equal_anchors():
    random.seed(1)
    shared = "".join(random.choice("abcd ") for _ in range(700)).encode()
    a, b = S.anchors(b"x" * 50 + shared + b"y" * 60, 400), S.anchors(b"q" * 91 + shared + b"r" * 10, 400)
    of = lambda rows, shift: {s - shift: p - shift for _, p, lo, hi, _, _ in rows for s in range(lo, hi + 1)}
    x, y = of(a, 50), of(b, 91)
    assert all(x[s] == y[s] for s in range(301))
