import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from harvestline.llm import periodic
from harvestline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """All maximal stretches by comparing words at every distance; the least period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(24, 3 * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def random_texts(rng, n):
    for k in range(n):
        letters = "ab" if k % 2 else "abcdefgh"
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        base = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        words += base * rng.randint(1, 9) + words[:rng.randint(0, 30)] * rng.randint(1, 4)
        for _ in range(rng.randint(0, 2)):
            if words:
                words[rng.randrange(len(words))] = "x"
        yield " ".join(words)


def test_runs_equal_plain_comparison():
    texts = [t.encode().split() for t in random_texts(random.Random(7), 300)]
    found = periodic.find_runs(texts)
    assert [[tuple(map(int, r)) for r in f] for f in found] == [plain_runs(t) for t in texts]
    assert sum(map(len, found)) > 100


@pytest.mark.parametrize("period", [1, 2, 999, 10_000])
def test_long_periodic_text(period):
    rng = random.Random(period)
    base = [b"%d" % rng.randrange(10**6) for _ in range(period)]
    [found] = periodic.find_runs([base * (60_000 // period)])
    assert [tuple(map(int, r)) for r in found] == [(0, 60_000 // period * period, period)]


def test_query_equals_plain_version(spark):
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, SF).collect()))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(plain_row(*d) for d in docs)
    assert any(r[1] for r in got)


def test_cases(spark, docs):
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 24), (4, "a " * 24), (5, "a " * 23), (None, "b\x0bc " * 12), (6, "é ü " * 30 + "end")]
    df = docs(texts).withColumn("runs", F.lit("clash")).withColumn("extra", F.lit(1))
    got = periodic.collapse_runs(df)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "runs", "collapsed"]
    rows = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
    assert rows == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 24, 1)], "a"), (4, [(0, 24, 1)], "a"),
                           (5, [], " ".join("a" * 23)), (None, [(0, 24, 2)], "b c"), (6, [(0, 60, 2)], "é ü end")], key=str)
    assert periodic.collapse_runs(df.limit(0)).count() == 0
    assert periodic.planted(df).where("doc_id is null").first().text == "b\x0bc " * 12


def test_strongest_run_is_exact(spark):
    runs = [(0, 24, 8), (5, 3_000_000_001, 1_000_000_000), (9, 27, 9), (40, 3_000_000_001, 1_000_000_000)]
    df = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start:bigint,length:bigint,period:bigint>>")
    got = [r.best and tuple(r.best) for r in df.select(periodic.strongest(F.col("runs")).alias("best")).collect()]
    assert got == [(5, 3_000_000_001, 1_000_000_000), None]
