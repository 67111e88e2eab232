import hashlib
import random

import pytest

from harvestline.llm import iblt


def brute(rows):
    """n_chars, digest of the edited text, and the two likenesses, in the order of the ids."""
    rows = sorted(rows)
    out = {}
    like = lambda a, b: len(a & b) / len(a | b)
    for k, (key, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        new = text[:len(text) - q] + other[:q]
        own = set(text.split("\n"))
        out[key] = (len(text), hashlib.sha256(new.encode()).hexdigest(), like(own, set(new.split("\n"))), like(own, set(other.split("\n"))))
    return out


def corpus(seed):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcé😀") for _ in range(random.randint(0, 3)))
    rows = []
    for k in range(50):
        text = "\n".join(word() for _ in range(random.choice([1, 2, 8, 30, 90])))
        rows.append((k * random.choice([1, 37, 5000]) + k, text))
    rows = list({k: (k, t) for k, t in rows}.values())
    top = max(k for k, _ in rows)
    return [*rows, (top + 1, rows[3][1]), (top + 2, rows[3][1]), (top + 3_000_000, ""), (top + 9_000_000, "x\n" * 3000 + "\n".join(map(str, range(1500))))]


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(docs, seed):
    rows = corpus(seed)
    got = {r.id: r for r in iblt.fingerprints(docs(rows)).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for key, (n, sha, edited, nxt) in want.items():
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(nxt)
        assert len(r.fingerprint) == iblt.CELLS * 40
    assert {r.retried for r in got.values()} == {True, False}
    by_text = {}
    for key, text in rows:
        assert by_text.setdefault(text, got[key].fingerprint) == got[key].fingerprint


def test_failing_pairs_fall_back_to_the_sets(docs, monkeypatch):
    monkeypatch.setattr(iblt, "ROUNDS", 1)
    monkeypatch.setattr(iblt, "TRIALS", 1)
    rows = corpus(2)[:12]
    got = {r.id: r for r in iblt.fingerprints(docs(rows)).collect()}
    for key, (_, _, edited, nxt) in brute(rows).items():
        assert got[key].near_edited == pytest.approx(edited) and got[key].near_next == pytest.approx(nxt)


def test_edge_cases(docs):
    only = iblt.fingerprints(docs([(7, "abcd\nefgh")])).collect()
    assert len(only) == 1 and only[0].near_next == 1.0
    assert only[0].edited_sha256 == hashlib.sha256(b"abcd\nef" + b"ab").hexdigest()
    got = iblt.fingerprints(docs([(None, None), (None, "q"), (5, "same"), (5, "same")]).withColumnRenamed("lang", "pair").withColumnRenamed("source", "id2")).collect()
    assert len(got) == 4 and {r.id for r in got} == {None, 5}
    assert len({r.fingerprint for r in got if r.id == 5}) == 1
    assert iblt.fingerprints(docs([])).count() == 0


def test_no_python_in_the_plan(docs):
    assert "Python" not in iblt.fingerprints(docs(["a\nb", "c"]))._jdf.queryExecution().executedPlan().toString()
