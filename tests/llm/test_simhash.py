import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from harvestline.llm import simhash
from harvestline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(ids))]


def flipped(x, rng, n):
    for b in rng.sample(range(64), n):
        x ^= 1 << b
    return x


def test_golay_code_is_perfect():
    words = np.arange(1 << 23)
    errors, number = simhash.ERRORS[simhash.syndrome(words)], simhash.NUMBER[simhash.syndrome(words)]
    assert not simhash.syndrome(words ^ errors[:, 0]).any()
    assert (np.bitwise_count(errors[:, 0]) <= 3).all()
    assert ((number == 6) == (np.bitwise_count(errors[:, 0]) == 3)).all()
    far = errors[number == 6][:100_000, 1:]
    assert (np.bitwise_count(far) == 4).all() and all(len(set(r)) == 5 for r in far[:1000].tolist())


def test_four_errors_always_share_a_key():
    rng = random.Random(3)
    a = [rng.getrandbits(64) for _ in range(4000)]
    b = [flipped(x, rng, rng.randint(0, 4)) for x in a]
    # errors close together are as likely to be missed as those far apart
    b += [x ^ sum(1 << k for k in rng.sample(range(c, min(64, c + 9)), 4)) for x in a for c in (rng.randrange(0, 55),)]
    a += a
    split = lambda x: np.split((k := simhash.keys(np.array(x, np.uint64)))[0], np.cumsum(k[1])[:-1])
    assert all(set(x.tolist()) & set(y.tolist()) for x, y in zip(split(a), split(b), strict=True))


def test_query_equals_brute_force(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op12_simhash"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    parts = plain_components([d.doc_id for d in docs], prints)
    assert got == {d.doc_id: (f"{p:016x}", c) for d, p, c in zip(docs, prints, parts, strict=True)}
    assert any(d != c for d, (_, c) in got.items())


def test_chains_and_dense_groups_are_connected(spark):
    rng = random.Random(5)
    prints = [0, rng.getrandbits(64)]
    for _ in range(25):  # a chain, each within 4 bits of the one before
        prints.append(flipped(prints[-1], rng, 4))
    centre = rng.getrandbits(64)
    bits = rng.sample(range(64), 14)
    for _ in range(400):  # a dense group, most of it farther than 4 bits from any one member
        x = centre
        for b in rng.sample(bits, rng.randint(2, 7)):
            x ^= 1 << b
        prints.append(x)
    prints += [rng.getrandbits(64) for _ in range(300)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.connected(spark.createDataFrame([(v,) for v in signed], "vertex long"))
    classes = {r.vertex: r["class"] for r in found.collect()}
    assert len(classes) == found.count()
    got = [classes.get(v, v) for v in signed]
    want = plain_components(signed, prints)
    assert [x == y for x, y in itertools.combinations(got, 2)] == [x == y for x, y in itertools.combinations(want, 2)]
    assert set(got) <= set(signed) and len(set(want)) < len(want) - 300


def test_cases(spark, docs):
    long = " ".join(f"w{k}" for k in range(200_000))
    texts = [(3, None), (1, ""), (2, " \t"), (9, "A b C"), (8, "a B c"), (8, "a B c"), (None, "x y"), (7, long), (6, long + " more")]
    df = docs(texts).withColumn("fingerprint", F.lit("clash")).withColumn("component_id", F.lit(0))
    out = simhash.near_duplicates(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "fingerprint", "component_id"]
    got = {(r.doc_id, r.text): (r.fingerprint, r.component_id) for r in out.collect()}
    assert out.count() == len(texts)
    assert got == {(d, t): (f"{plain_fingerprint(t):016x}", c) for (d, t), c in zip(texts, [1, 1, 1, 8, 8, 8, None, 6, 6], strict=True)}
    assert simhash.near_duplicates(df.limit(0)).count() == 0
