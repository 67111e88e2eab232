"""Near duplicates by SimHash, found with keys from the binary Golay code.

Words are what stands between ASCII white space in the text with A-Z lowered; a document's shingles are its runs of
``SHINGLE`` words (repeats count; a text of fewer words is one shingle). A bit of the 64-bit fingerprint is 1 if it is set in
over half the XXH64 hashes of the shingles; a text without words has fingerprint zero. Fingerprints that differ in
``MOST_BITS`` = 4 bits or fewer are linked, and a component is what links connect.

* The fingerprint is cut into segments of 23, 23 and 18 bits (the last is filled up with zeros). The (23, 12) Golay code is
  perfect: each word of 23 bits has one codeword within 3 bits. The keys of a segment are the codewords that it or one of its
  neighbours decodes to: one if it lies within 2 bits of its codeword, else six. Two words that differ in 2 bits or fewer
  share a key, since the word between them decodes to a key of both.
* Pigeonhole: of up to 4 errors in three segments, either one segment has none and another 2 or fewer (six families of keys:
  one segment as it is, with the Golay keys of another), or two segments have one each and the third 2 or fewer (twelve
  families: halves of two segments as they are, of which one half each is free of errors, with the Golay keys of the third).
  All keys are 33 to 36 bits wide, so chance meetings stay rare in large tables.
* Equal fingerprints are one node. The nodes of a key are compared with one of them, the hub, which takes in large groups of
  near copies with one row each; what is found joins classes, so that later rounds search only classes. For keys whose nodes are not in one component yet, another hub is drawn, in a fixed number
  of rounds; then the nodes of different components that still share a key meet in a join that passes on only those within 4
  bits. So components are exact, and the rows made follow the nodes, not the pairs.

Cases: a null or empty text has fingerprint zero and is linked like any other; a null ``doc_id`` counts only where a component has
no other (its id is null then); repeated rows and ids get a row each; ``fingerprint`` and ``component_id`` replace columns of these
names; an empty table gives an empty one.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from harvestline.llm.common import blocks, buffers, reachable, stored, text_of

SHINGLE = 4
SEED = 42
MOST_BITS = 4
CUTS = (0, 23, 46, 64)
HALF = 12
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the generator polynomial of the binary Golay code of 23 bits (fixed value)
GENERATOR = 0xC75
BITS, CHECK_BITS = 23, 11
BLOCK_BYTES = 2 << 20
BLOCK_HASHES = 1 << 17
#: Rounds of drawn hubs before what is left meets directly.
ROUNDS = 2


def _remainders() -> np.ndarray:
    """Remainders modulo the generator of the bytes at the three places of a word."""
    bit = [1]
    for _ in range(BITS - 1):
        x = bit[-1] << 1
        bit.append(x ^ GENERATOR if x >> CHECK_BITS else x)
    out = np.zeros((3, 256), np.int32)
    for place, value in itertools.product(range(3), range(256)):
        for k in range(8):
            if value >> k & 1 and 8 * place + k < BITS:
                out[place, value] ^= bit[8 * place + k]
    return out


REMAINDERS = _remainders()


def syndrome(words: np.ndarray) -> np.ndarray:
    return REMAINDERS[0][words & 255] ^ REMAINDERS[1][words >> 8 & 255] ^ REMAINDERS[2][words >> 16]


def _errors() -> tuple[np.ndarray, np.ndarray]:
    """For every syndrome the errors that lead to the codewords of the keys, and how many they are: 1 or 6."""
    of_weight = lambda w: np.array([sum(1 << k for k in c) for c in itertools.combinations(range(BITS), w)], np.int64)
    errors, number = np.zeros((1 << CHECK_BITS, 6), np.int64), np.ones(1 << CHECK_BITS, np.int64)
    for w in range(4):
        patterns = of_weight(w)
        errors[syndrome(patterns)] = patterns[:, None]
    far = syndrome(of_weight(3))
    number[far] = 6
    fours = of_weight(4)
    s = syndrome(fours)
    order = np.argsort(s, kind="stable")
    fours, s = fours[order], s[order]
    fours = fours[number[s] == 6].reshape(-1, 5)  # five errors of weight 4 for each syndrome of weight 3
    errors[np.sort(far), 1:] = fours
    return errors, number


ERRORS, NUMBER = _errors()


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (12 bits) of the codewords that each word or a neighbour of it decodes to; and which of the six hold."""
    s = syndrome(words)
    return (words[:, None] ^ ERRORS[s]) >> CHECK_BITS, np.arange(6) < NUMBER[s][:, None]


def keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all fingerprints in their order, and how many each has."""
    x = fingerprints.astype(np.uint64)
    segments = [((x >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64) for a, b in itertools.pairwise(CUTS)]
    low = lambda s: s & ((1 << HALF) - 1) if s is not segments[2] else s & 0x1FF
    high = lambda s: s >> HALF if s is not segments[2] else s >> 9
    table, holds = [], []
    for k in range(3):
        code, valid = codewords(segments[k])
        others = [segments[j] for j in range(3) if j != k]
        exact = [*others, *[a << HALF | b for a, b in itertools.product(*((low(s), high(s)) for s in others))]]
        for n, part in enumerate(exact):
            table.append((6 * k + n) << 48 | part[:, None] << 12 | code)
            holds.append(valid)
    table, holds = np.concatenate(table, axis=1), np.concatenate(holds, axis=1)
    return table[holds], holds.sum(axis=1)


def _keys(fingerprints: pa.Array) -> pa.Array:
    values, sizes = keys(fingerprints.to_numpy(zero_copy_only=False).view(np.uint64))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values, pa.int64()))


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text, given in UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(SHINGLE, len(words))
    begin, end = np.r_[0, ends[:-size]], ends[size - 1:] - 1
    n, ones = len(begin), np.zeros(64, np.int64)
    for k in range(0, n, BLOCK_HASHES):
        h = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin[k:k + BLOCK_HASHES].tolist(), end[k:k + BLOCK_HASHES].tolist(), strict=True)]
        ones += np.unpackbits(np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    data, starts = buffers(texts)
    out = np.zeros(len(texts), np.uint64)
    for low, high in blocks(starts, BLOCK_BYTES):
        raw = data[starts[low]:starts[high]].tobytes()
        bounds = (starts[low:high + 1] - starts[low]).tolist()
        out[low:high] = [fingerprint(raw[a:b]) for a, b in itertools.pairwise(bounds)]
    return pa.array(out.view(np.int64), pa.int64())


def near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= MOST_BITS


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The rows with their fingerprint as a 64-bit integer."""
    reachable(df.sparkSession)
    return df.withColumn(name, F.arrow_udf(_fingerprints, "bigint")(text_of(df, text)))


def components(edges: DataFrame, label: str) -> DataFrame:
    """``vertex, class`` of all vertices of ``a, b`` rows: the least vertex that edges lead to.

    A round gives each vertex the least class among itself, its neighbours and the vertex that its class names, so paths
    halve; it is one job that writes the next state. Groups are aggregated before the shuffle and never gathered.
    """
    both = stored(edges.select(F.col("a").alias("vertex"), F.col("b").alias("other")).union(edges.select("b", "a")), f"{label}-edges")
    state = both.groupBy("vertex").agg(F.least(F.min("other"), F.first("vertex")).alias("class"))
    state = stored(state.withColumn("old", F.col("vertex")), f"{label}-classes")
    while not state.where("old <> class").isEmpty():
        known = state.select(F.col("vertex").alias("other"), F.col("class").alias("near"))
        near = both.join(known, "other").groupBy("vertex").agg(F.min("near").alias("near"))
        up = known.select(F.col("other").alias("class"), F.col("near").alias("up"))
        step = state.select("vertex", "class").join(near, "vertex").join(up, "class", "left")
        state = stored(step.select("vertex", F.least("class", "near", F.coalesce("up", "class")).alias("class"), F.col("class").alias("old")), f"{label}-classes")
    return state.select("vertex", "class")


def merged(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``vertex, class`` after the classes of ``a, b`` rows are joined: only these are searched for components."""
    up = components(pairs, "simhash-merge").select(F.col("vertex").alias("class"), F.col("class").alias("up"))
    return stored(classes.join(up, "class", "left").select("vertex", F.coalesce("up", "class").alias("class")), "simhash-merged")


def _open(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, vertex, class`` for the keys whose vertices lie in different components."""
    placed = stored(members.join(classes, "vertex"), "simhash-placed")
    spans = placed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    return stored(placed.join(stored(spans.select("key"), "simhash-spans"), "key", "left_semi"), "simhash-open")


def connected(nodes: DataFrame) -> DataFrame:
    """``vertex, class`` of the distinct fingerprints ``vertex`` that share a key with another: the least one of their component."""
    keyed = nodes.select("vertex", F.explode(F.arrow_udf(_keys, "array<bigint>")("vertex")).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("vertex").alias("hub")).where("n > 1")
    shared = stored(shared.select("key", "hub"), "simhash-shared")
    # the same plan at every size: the keys that chance or copies share grow with the table
    members = stored(keyed.join(shared.hint("merge"), "key"), "simhash-members")
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    links = members.where((F.col("hub") != F.col("vertex")) & near(F.col("hub"), F.col("vertex"))).select(*ordered("hub", "vertex"))
    first = components(links.distinct(), "simhash-first")
    members = members.select("key", "vertex")
    classes = members.select("vertex").distinct().join(first, "vertex", "left").select("vertex", F.coalesce("class", "vertex").alias("class"))
    classes = stored(classes, "simhash-merged")
    rest = _open(members, classes)
    for k in range(ROUNDS):
        drawn = F.min(F.struct(F.xxhash64("vertex", "key", F.lit(k)).alias("h"), F.col("vertex").alias("hub"), F.col("class").alias("of_hub")))
        hubs = stored(rest.groupBy("key").agg(drawn.alias("d")).select("key", "d.hub", "d.of_hub"), "simhash-hubs")
        met = rest.join(hubs, "key").where((F.col("class") != F.col("of_hub")) & near(F.col("hub"), F.col("vertex")))
        found = stored(met.select(*ordered("class", "of_hub")).distinct(), "simhash-found")
        if found.isEmpty():
            break
        classes = merged(classes, found)
        rest = _open(rest.select("key", "vertex"), classes)
    left, right = (rest.select("key", F.col("vertex").alias(side), F.col("class").alias(f"class_{side}")) for side in "xy")
    meet = (F.col("class_x") < F.col("class_y")) & near(F.col("x"), F.col("y"))
    across = left.join(right, (left["key"] == right["key"]) & meet).select(F.col("class_x").alias("a"), F.col("class_y").alias("b")).distinct()
    return merged(classes, stored(across, "simhash-across"))


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``fingerprint`` (16 lowercase hexadecimal digits) and ``component_id``, the least id that links lead to.

    ``keep`` names the columns to return beside these; by default all. They are written once, with the fingerprints.
    """
    keep = [c for c in keep or df.columns if c not in ("fingerprint", "component_id")]
    marked = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)], F.col(doc_id).alias("id"), text_of(df, text).alias("body"))
    marked = stored(with_fingerprint(marked, "body", "vertex").drop("body"), "simhash-rows")
    nodes = stored(marked.groupBy("vertex").agg(F.min("id").alias("least")), "simhash-nodes")
    classes = connected(nodes)
    known = stored(nodes.join(classes, "vertex", "left").select("vertex", "least", F.coalesce("class", "vertex").alias("class")), "simhash-known")
    top = stored(known.groupBy("class").agg(F.min("least").alias("component_id")), "simhash-top")
    found = stored(known.join(top, "class").select("vertex", "component_id"), "simhash-found")
    return marked.join(found, "vertex").select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(keep)],
                                               F.lower(F.lpad(F.hex("vertex"), 16, "0")).alias("fingerprint"), "component_id")
