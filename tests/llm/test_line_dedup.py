import random

import pytest

from harvestline.llm.line_dedup import dedup_lines


def brute(rows, window):
    """Kept text, lines and removed lines of (doc_id, text) rows."""
    order = sorted(set(rows), key=lambda r: r[0])
    seen, out = set(), {}
    for key, text in order:
        lines = text.split("\n")
        gone = set()
        for s in range(len(lines) - window + 1):
            w = tuple(lines[s:s + window])
            if w in seen:
                gone.update(range(s, s + window))
            seen.add(w)
        out[key] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


@pytest.mark.parametrize("window", [1, 2, 3])
def test_equals_brute_force(docs, window):
    random.seed(window)
    rows = [(i, "\n".join(random.choice(["a", "b", "c", "d", ""]) for _ in range(random.randint(1, 9)))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, "x\n" * 300), (201, "")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(docs(rows), window=window).collect()}
    assert got == brute(rows, window)


def test_edge_cases(docs, spark):
    rows = [(None, "p\nq\nr"), (1, None), (2, "p\nq\nr"), (2, "p\nq\nr"), (3, "one line")]
    df = docs(rows).withColumnRenamed("lang", "n_removed").withColumnRenamed("source", "id")
    got = sorted(((r.doc_id is not None, r.doc_id, r.text, r.n_removed) for r in dedup_lines(df).collect()), key=str)
    assert got == sorted([(False, None, "p\nq\nr", 0), (True, 1, "", 0), (True, 2, "", 3), (True, 2, "", 3), (True, 3, "one line", 0)], key=str)
    assert dedup_lines(docs([])).count() == 0


def test_many_separate_runs_take_linear_time(docs):
    """A document with 20,000 runs that repeat between lines of its own; folding them one by one took minutes."""
    import time

    rows = [(0, "\n".join(f"a{k}\nb{k}" for k in range(20_000))), (1, "\n".join(f"a{k}\nb{k}\nown {k}" for k in range(20_000)))]
    began = time.time()
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(docs(rows)).collect()}
    assert got == {0: (rows[0][1], 0), 1: ("\n".join(f"own {k}" for k in range(20_000)), 40_000)}
    assert time.time() - began < 60


def test_no_python_in_the_plan(docs):
    df = dedup_lines(docs(["a\nb", "a\nb"]))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def brute_long(rows, window, words):
    """As brute, and a line of ``words`` words or more is a window of its own."""
    seen, out = set(), {}
    for key, text in sorted(set(rows), key=lambda r: r[0]):
        lines = text.split("\n")
        gone = set()
        spans = {(s, window) for s in range(len(lines) - window + 1)} | {(s, 1) for s, x in enumerate(lines) if len(x.split()) >= words}
        for s, n in sorted(spans):
            w = tuple(lines[s:s + n])
            if (n, w) in seen:
                gone.update(range(s, s + n))
            seen.add((n, w))
        out[key] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def test_long_line_between_unique_lines(docs):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(i, f"head {i}\n{passage}\ntail {i}") for i in range(4)] + [(9, passage), (10, "short\nof 10"), (11, "short\nof 11")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(docs(rows), long_words=50).collect()}
    assert got == brute_long(rows, 2, 50)
    assert got[0][0] == rows[0][1] and got[1] == ("head 1\ntail 1", 3, 1) and got[9] == ("", 1, 1) and got[11][2] == 0


@pytest.mark.parametrize("window", [1, 2, 3])
def test_long_lines_equal_brute_force(docs, window):
    random.seed(window)
    words = ["a", "b", "c d e", " c\td  e ", "c d", "f g h i", ""]
    rows = [(i, "\n".join(random.choice(words) for _ in range(random.randint(1, 9)))) for i in range(40)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(docs(rows), window=window, long_words=3).collect()}
    assert got == brute_long(rows, window, 3)
