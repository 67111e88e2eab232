"""Similarity join on word shingles with Bayesian pruning of candidates.

Words are what stands between ASCII white space in the lowered text; a document is the set of its runs of five words (a
text of fewer words is one run), and two documents are linked if the Jaccard similarity of their sets is 0.8 or more.

* Documents with equal sets are one vertex, told by a 64-bit digest of the set, so copies meet in an aggregation only.
* Every vertex has MinHash values, the first 88 of 800 cut into bands; vertices that agree in a band are candidates. With
  22 bands of 4 values a pair at 0.8 shares a band with probability 1 - 1e-5, at 0.9 with 1 - 1e-10.
* Candidates compare their MinHash values eight at a time. With a uniform prior and m matches among n values, the
  similarity has the posterior Beta(m + 1, n - m + 1); a pair is dropped as soon as the probability that it reaches the
  threshold is under ``tolerance`` divided by the number of steps, so all steps together drop no more of the pairs at 0.8.
* The rest is verified exactly on the sets of shingle hashes.

Groups of copies are not expanded into pairs. The hub of a band is its vertex that shares most bands with others (in a group
of edited copies, the one that was edited least). First each vertex is compared with the best hub of its bands alone; verified
links join vertices into classes. Then only bands that hold vertices of different classes are looked at again: each band's own
hub meets its vertices of other classes. At last the vertices of different classes that are left meet: a pair is looked at only
at the first band that the two share, compared exactly there if their MinHash values leave it a chance, and passed on if it is a
link between vertices that the links of its cell do not connect yet. The vertices of a band are dealt to cells of ``wide`` by ``wide`` at most, each pair to
one cell, so a band of any size is spread over tasks and the result does not depend on ``wide``. So the classes are the
connected components of all links, while the links kept in a large group grow with its members. What is compared there
still grows with the members times those that lie over 0.2 from the hub; no cap is set on it, since each of them may be
linked to any other.

``near_duplicates`` returns for every row its class (the least ``doc_id`` in it, with the text hash that goes with it), the
size of the class, the copies with the same set, ``n_links``, the verified links of its vertex that the join kept, and
``n_similar``, the number of all vertices of its class that it is linked to. These are counted without pairs where they can
be: Jaccard distance is a metric, so vertices within 0.1 of one vertex of the class, its centre, are all linked to each
other. The others are compared exactly with the whole class, in blocks that return counts.

Cases: null and empty texts have the same empty set and are one class; a null doc_id counts as the least; rows that agree
in doc_id and text are one document that is listed as often as it stands; further columns are kept.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from harvestline.llm.common import SOLID_BYTE, blocks, buffers, runs, stored, text_of, word_hashes

WORDS = 5
THRESHOLD = (4, 5)  # 0.8 as a fraction
BANDS, ROWS = 22, 4
VALUES = 800
CHECKS = (64, 160, 400, VALUES)  # after so many values a pair is given up within the join
STEP = 8
BLOCK_BYTES = 1 << 20
LEAST_BLOCK, MOST_BLOCK = 64, 512  # vertices on a side of a block of comparisons
LEAST_PART = 256  # vertices of a band that meet others together
_RNG = np.random.default_rng(20_240_501)
FACTORS = _RNG.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)
EMPTY = np.uint64(0x1234567)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def shingle_sets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the lowered texts, sorted within each text, and where each text begins (and the end)."""
    base = int(starts[0])
    words, begin = word_hashes(data[base:int(starts[-1])], starts - base, SOLID_BYTE)
    doc = np.searchsorted(starts, begin + base, "right") - 1
    first = np.searchsorted(doc, np.arange(len(starts)))
    all_runs = runs(words, WORDS)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            sets.append(np.unique(all_runs[a:b - WORDS + 1]))
        else:
            sets.append(runs(words[a:b], b - a) if b > a else np.array([EMPTY]))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum([0, *map(len, sets)])


def min_hashes(shingles: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of every hash function over each set (sets x VALUES, of which 8 bits are kept: two unlike values agree
    with probability 1/256, which can only keep a pair), and the keys of the bands, made of whole values."""
    out = np.empty((len(first) - 1, VALUES), np.uint8)
    keys = np.zeros((len(first) - 1, BANDS), np.uint64)
    x = mixed(shingles)
    for k in range(VALUES):
        v = ((x * FACTORS[k] + SHIFTS[k]) >> np.uint64(32)).astype(np.uint32)
        least = np.minimum.reduceat(v, first[:-1])
        out[:, k] = least & np.uint32(0xFF)
        if k < BANDS * ROWS:
            band = k // ROWS
            keys[:, band] = mixed((keys[:, band] ^ (least.astype(np.uint64) + np.uint64(band + 1))) * np.uint64(0x9E3779B97F4A7C15))
    return out, keys.view(np.int64)


def _sketch(texts: pa.Array) -> pa.Array:
    data, starts = buffers(texts)
    vertex, size, sig, keys = [], [], [], [np.zeros((0, BANDS), np.int64)]
    for low, high in blocks(starts, BLOCK_BYTES):
        shingles, first = shingle_sets(data, starts[low:high + 1])
        vertex.append(mixed(np.add.reduceat(mixed(shingles), first[:-1]) + np.diff(first).astype(np.uint64)).view(np.int64))
        size.append(np.diff(first))
        values, bands = min_hashes(shingles, first)
        sig += [row.tobytes() for row in values]
        keys.append(bands)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * BANDS, pa.int32()), pa.array(np.concatenate(keys).ravel()))
    return pa.StructArray.from_arrays([pa.array(join(vertex), pa.int64()), pa.array(join(size), pa.int64()), pa.array(sig, pa.binary()), lists],
                                      ["vertex", "n_shingles", "sig", "bands"])


def _shingles(texts: pa.Array) -> pa.Array:
    data, starts = buffers(texts)
    out: list[bytes] = []
    for low, high in blocks(starts, BLOCK_BYTES):
        shingles, first = shingle_sets(data, starts[low:high + 1])
        out += [shingles[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
    return pa.array(out, pa.binary())


def least_matches(tolerance: float) -> np.ndarray:
    """After STEP, 2 STEP, ... values, the fewest matches with which a pair may still reach the threshold.

    P(s >= t | m of n) = P(Binomial(n + 1, t) <= m) under a uniform prior. P(Binomial(n, t) <= m), the share of pairs at the
    threshold that are dropped there, is not less than that; it is held to an equal part of ``tolerance`` at every step.
    """
    t, out = THRESHOLD[0] / THRESHOLD[1], []
    part = tolerance * STEP / VALUES
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < part:
            m += 1
            total += comb(n, m) * t**m * (1 - t) ** (n - m)
        out.append(m)
    return np.array(out)


def _pruner(tolerance: float):
    least = least_matches(tolerance)

    def may_reach(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(-1, VALUES) for s in (a, b))
        alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
        for step, need in enumerate(least):
            part = slice(step * STEP, (step + 1) * STEP)
            matches[alive] += (x[alive, part] == y[alive, part]).sum(axis=1)
            alive = alive[matches[alive] >= need]
        out = np.zeros(len(x), bool)
        out[alive] = True
        return pa.array(out)

    return F.arrow_udf(may_reach, "boolean")


def _near(s: pa.Scalar, t: pa.Scalar) -> int:
    """2 for sets within half the distance of the threshold, 1 for other links, 0 for the rest."""
    up, down = THRESHOLD
    x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
    if min(len(x), len(y)) * down < up * max(len(x), len(y)):
        return 0
    common = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
    union = len(x) + len(y) - common
    return int(common * down >= up * union) + int(2 * common * down >= (up + down) * union)


def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([_near(s, t) for s, t in zip(a, b, strict=True)], pa.int32())


def _count_block(rows: pa.Table) -> pa.Table:
    """Links between the left and the right rows of a block: all of a left row, and those of a right row in the core."""
    up, down = THRESHOLD
    left, core, vertex = (rows[c].to_numpy() for c in ("left", "core", "vertex"))
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows["shingles"].combine_chunks()]
    size = np.array([len(s) for s in sets], np.int64)
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    first = np.r_[0, np.cumsum(size)]
    xs, ys = np.flatnonzero(left), np.flatnonzero(~left)
    counts = np.zeros(len(sets), np.int64)
    if len(xs) and len(ys):
        flat = np.concatenate([ids[first[y]:first[y + 1]] for y in ys])
        begin = np.r_[0, np.cumsum(size[ys])[:-1]]
        mark = np.zeros(int(ids.max()) + 1, np.int64)
        for x in xs:
            mark[ids[first[x]:first[x + 1]]] = 1
            common = np.add.reduceat(mark[flat], begin)
            mark[ids[first[x]:first[x + 1]]] = 0
            hit = (common * down >= up * (size[x] + size[ys] - common)) & (vertex[ys] != vertex[x])
            counts[x] += hit.sum()
            counts[ys] += hit & core[ys]
    return pa.table({"vertex": pa.array(vertex, pa.int64()), "n": pa.array(counts, pa.int64())}).filter(pa.array(counts > 0))


def all_links(found: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``vertex, n_similar`` for the vertices of classes: how many vertices of its class each is linked to."""
    both = found.where("near = 2").select(F.col("a").alias("vertex"), F.col("b").alias("other"))
    both = stored(both.union(both.select("other", "vertex")), "join-tight")
    weights = classes.join(both.groupBy("vertex").agg(F.count("*").alias("w")), "vertex", "left").select("class", "vertex", F.coalesce("w", F.lit(0)).alias("w"))
    centres = weights.groupBy("class").agg(F.max(F.struct("w", (-F.col("vertex")).alias("v"))).alias("c"))
    centres = stored(centres.select((-F.col("c.v")).alias("vertex")), "join-centres")
    core = centres.union(both.join(centres, "vertex").select("other")).withColumn("core", F.lit(True))
    marked = stored(classes.join(stored(core, "join-core"), "vertex", "left").select("class", "vertex", F.coalesce("core", F.lit(False)).alias("core")), "join-marked")
    sizes = marked.groupBy("class").agg(F.count("*").alias("members"), F.count_if("core").alias("inner"))
    marked = stored(marked.join(stored(sizes, "join-sizes"), "class"), "join-sized")
    # in a class of two, the one link that makes it is known
    known = marked.select("vertex", F.when(F.col("members") == 2, 1).when(F.col("core"), F.col("inner") - 1).otherwise(0).alias("n"))
    outer = F.col("members") - F.col("inner")
    block = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.ceil(outer / 16)))
    rows = marked.where((F.col("members") > 2) & (outer > 0)).join(sets, "vertex")
    rows = rows.withColumns({"across": F.ceil(outer / block), "down": F.ceil(F.col("members") / block)})
    salt = lambda n: F.pmod(F.xxhash64("vertex", F.lit(n)), F.col(n))
    left = rows.where("not core").select("class", salt("across").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("j"),
                                         F.lit(True).alias("left"), "core", "vertex", "shingles")
    right = rows.select("class", F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("i"), salt("down").alias("j"),
                        F.lit(False).alias("left"), "core", "vertex", "shingles")
    more = left.union(right).groupBy("class", "i", "j").applyInArrow(_count_block, "vertex long, n long")
    return stored(known.union(more).groupBy("vertex").agg(F.sum("n").alias("n_similar")), "join-similar")


def _meet(tolerance: float):
    """The vertices of a cell that may be linked to others there, one row each with its ``others``: of different classes, at the
    first band they share, pruned by their values. A pair is named by one of its ends."""
    least = least_matches(tolerance)

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        band, n = key[0].as_py(), rows.num_rows
        vertex, cls, side = (rows[c].to_numpy() for c in ("vertex", "class", "side"))
        flat = lambda c: b"".join(rows[c].combine_chunks().to_pylist())
        sig = np.frombuffer(flat("sig"), np.uint8).reshape(n, VALUES)
        bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(n, BANDS)
        earlier = bands[:, :int(np.argmax(bands[0] == band))]
        others: dict[int, list[int]] = {}
        for x in np.flatnonzero(side < 2):  # sides 0 and 2 meet, and rows of side 1 meet each other
            ys = np.flatnonzero(side == 2) if side[x] == 0 else x + 1 + np.flatnonzero(side[x + 1:] == 1)
            ys = ys[cls[ys] != cls[x]]
            ys = ys[~(earlier[ys] == earlier[x]).any(axis=1)]
            low, matches = 0, np.zeros(len(ys), np.int64)
            for high in CHECKS:
                matches += (sig[ys, low:high] == sig[x, low:high]).sum(axis=1)
                alive = matches >= least[high // STEP - 1]
                ys, matches, low = ys[alive], matches[alive], high
                if not len(ys):
                    break
            if len(ys):
                others.setdefault(int(vertex[x]), []).extend(vertex[ys].tolist())
                for y in vertex[ys].tolist():
                    others.setdefault(y, [])
        cell = [pa.array([k.as_py()] * len(others), pa.int64()) for k in key]
        return pa.table([*cell, pa.array(list(others), pa.int64()), pa.array(list(others.values()), pa.list_(pa.int64()))],
                        ["band", "i", "j", "vertex", "others"])

    return meet


def _link_cell(rows: pa.Table) -> pa.Table:
    """Links ``a, b, near`` among the named pairs of a cell that connect what they connect; pairs that links connect already
    are not compared, so a cell returns fewer links than it has vertices."""
    vertex = rows["vertex"].to_pylist()
    sets = dict(zip(vertex, rows["shingles"].combine_chunks(), strict=True))
    up = {v: v for v in vertex}

    def top(v: int) -> int:
        while up[v] != v:
            up[v] = v = up[up[v]]
        return v

    out: list[tuple[int, int, int]] = []
    for x, others in sorted(zip(vertex, rows["others"].to_pylist(), strict=True)):
        for y in sorted(others):
            if top(x) == top(y):
                continue
            near = _near(sets[x], sets[y])
            if near:
                up[top(y)] = top(x)
                out.append((min(x, y), max(x, y), near))
    return pa.table([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], ["a", "b", "near"])


def dealt(open_rows: DataFrame, wide: int) -> DataFrame:
    """``band, vertex, class`` with the cells ``i, j`` where a vertex meets others, and its ``side`` there.

    The largest class of a band needs no pairs of its own, so it is one side and the other vertices are the other; both are dealt
    to parts of an eighth of the band, LEAST_PART at least and ``wide`` at most. A part of the one meets each part of the other,
    and the others' parts meet each other, so two vertices of different classes meet in one cell of each band they share.
    """
    sizes = open_rows.groupBy("band", "class").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("band").agg(F.max(F.struct("m", "class")).alias("l"))
    width = F.least(F.lit(wide), F.greatest(F.lit(LEAST_PART), F.ceil(F.col("n") / 8)))
    rows = open_rows.join(stored(largest, "join-largest"), "band").select(
        "band", "vertex", "class", (F.col("class") == F.col("l.class")).alias("inner"), F.ceil(F.col("l.m") / width).alias("inners"),
        F.ceil((F.col("n") - F.col("l.m")) / width).alias("outers"))
    part = F.pmod(F.xxhash64("vertex", "band"), F.when(F.col("inner"), F.col("inners")).otherwise(F.col("outers")))
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    cell = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    among = F.transform(each("outers"), lambda k: F.when(k == F.col("part"), cell(k, -k - 1, 1)).otherwise(
        cell(F.least("part", k), -F.greatest("part", k) - 1, 0).withField("side", F.when(F.col("part") < k, 0).otherwise(2))))
    cells = F.when(F.col("inner"), F.transform(each("outers"), lambda k: cell(k, F.col("part"), 2))).otherwise(
        F.concat(F.transform(each("inners"), lambda k: cell(F.col("part"), k, 0)), among))
    return rows.withColumn("part", part).select("band", "vertex", "class", F.inline(cells))


def left_to_meet(open_rows: DataFrame, near: DataFrame, sets: DataFrame, tolerance: float, wide: int) -> DataFrame:
    """``a, b, near``: links that connect the vertices of different classes that share a band; each pair is looked at once.

    Pairs stay in their cell. Most of those that the MinHash values leave a chance lie just under the threshold, and in a large
    group they grow with the square of its size; what is shuffled is one row for each vertex of a cell, with its set.
    """
    cells = dealt(open_rows, wide).join(near.select("vertex", "sig", "bands"), "vertex").groupBy("band", "i", "j")
    likely = stored(cells.applyInArrow(_meet(tolerance), "band long, i long, j long, vertex long, others array<long>"), "join-likely")
    return likely.join(sets, "vertex").groupBy("band", "i", "j").applyInArrow(_link_cell, "a long, b long, near int")


def components(edges: DataFrame, label: str) -> DataFrame:
    """``vertex, class`` for the vertices of ``a, b`` rows: the least vertex that links lead to.

    Each round takes the least class among the neighbours and then the class of that class, so paths halve; the state is
    a stored table, and a round is a join of two stored tables and an aggregation that combines before its shuffle.
    """
    both = stored(edges.select(F.col("a").alias("vertex"), F.col("b").alias("other")).union(edges.select("b", "a")), f"{label}-edges")
    state = stored(both.groupBy("vertex").agg(F.least(F.min("other"), F.first("vertex")).alias("class")), f"{label}-classes")
    while True:
        seen = state.select(F.col("vertex").alias("other"), F.col("class").alias("near"))
        near = both.join(seen, "other").groupBy("vertex").agg(F.min("near").alias("near"))
        step = stored(state.join(near, "vertex").select("vertex", F.col("class").alias("old"), F.least("class", "near").alias("class")),
                      f"{label}-step")
        jump = step.select(F.col("vertex").alias("class"), F.col("class").alias("up"))
        new = stored(step.join(jump, "class", "left").select("vertex", "old", F.least("class", F.coalesce("up", "class")).alias("class")),
                     f"{label}-classes")
        state = new.select("vertex", "class")
        if new.where("old <> class").isEmpty():
            return state


def verified(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, tolerance: float, label: str) -> DataFrame:
    """The ``a, b`` rows that are links, and how ``near`` they are: pruned by their signatures, then compared exactly."""
    pairs = stored(pairs.distinct(), f"{label}-pairs")
    side = lambda df, n: df.select(F.col("vertex").alias(n), df.columns[1]).withColumnRenamed(df.columns[1], f"of_{n}")
    likely = pairs.join(side(signatures, "a"), "a").join(side(signatures, "b"), "b")
    likely = stored(likely.where(_pruner(tolerance)("of_a", "of_b")).select("a", "b"), f"{label}-likely")
    check = likely.join(side(sets, "a"), "a").join(side(sets, "b"), "b")
    return stored(check.select("a", "b", F.arrow_udf(_linked, "int")("of_a", "of_b").alias("near")), f"{label}-links").where("near > 0")


def still_open(members: DataFrame, found: DataFrame) -> DataFrame:
    """``band, vertex, class, n`` of the bands whose ``n`` vertices lie in different classes."""
    classes = components(found, "join-first")
    placed = members.join(classes, "vertex", "left").select("band", "vertex", F.coalesce("class", "vertex").alias("class"))
    placed = stored(placed, "join-placed")
    mixed_bands = placed.groupBy("band").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    mixed_bands = stored(mixed_bands.where("low < high").select("band", "n"), "join-mixed")
    return stored(placed.join(mixed_bands, "band"), "join-open")


def links(documents: DataFrame, tolerance: float, wide: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of ``id, text_hash, body`` rows, links ``a, b`` that connect every class of vertices, and their shingle sets."""
    sketch = documents.withColumn("s", F.arrow_udf(_sketch, "vertex long, n_shingles long, sig binary, bands array<long>")(F.lower("body")))
    sketch = stored(sketch.select("id", "text_hash", "s.*"), "join-sketch")
    vertices = sketch.groupBy("vertex").agg(F.min(F.struct("id", "text_hash")).alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    vertices = stored(vertices, "join-vertices")
    keyed = vertices.select("vertex", F.explode("bands").alias("band"))
    shared = stored(keyed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "join-shared")
    members = stored(keyed.join(shared, "band"), "join-members")
    weights = members.groupBy("vertex").agg(F.sum(F.col("n") - 1).alias("weight"))
    heaviest = F.max(F.struct("weight", (-F.col("vertex")).alias("v")))
    hubs = members.join(stored(weights, "join-weights"), "vertex").groupBy("band").agg(heaviest.alias("h"))
    hubs = stored(hubs.select("band", (-F.col("h.v")).alias("hub"), F.col("h.weight").alias("weight")), "join-hubs")
    members = stored(members.join(hubs, "band").select("band", "hub", "vertex", "weight"), "join-hubbed")
    inside = stored(members.select("vertex").distinct(), "join-inside")
    near = stored(vertices.join(inside, "vertex", "left_semi"), "join-near")
    reps = near.select(F.col("rep.id").alias("r_id"), F.col("rep.text_hash").alias("r_hash"), "vertex")
    texts = documents.join(reps, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")))
    sets = texts.select("vertex", F.arrow_udf(_shingles, "binary")(F.lower("body")).alias("shingles")).dropDuplicates(["vertex"])
    sets, signatures = stored(sets, "join-sets"), near.select("vertex", "sig")

    pair = (F.least("hub", "vertex").alias("a"), F.greatest("hub", "vertex").alias("b"))
    best = members.groupBy("vertex").agg(F.max(F.struct("weight", (-F.col("hub")).alias("v"))).alias("h")).select("vertex", (-F.col("h.v")).alias("hub"))
    first = verified(best.where("hub <> vertex").select(*pair), signatures, sets, tolerance, "join-first")
    open_rows = still_open(members.select("band", "vertex"), first)
    # each band's own hub meets the vertices of other classes
    drawn = open_rows.join(hubs.select("band", F.col("hub").alias("vertex")), ["band", "vertex"]).select("band", F.col("vertex").alias("hub"), F.col("class").alias("of_hub"))
    pairs = open_rows.join(stored(drawn, "join-drawn"), "band").where(F.col("class") != F.col("of_hub")).select(*pair)
    found = verified(pairs, signatures, sets, tolerance, "join-round")
    if not found.isEmpty():
        first = stored(first.union(found).distinct(), "join-linked")
        open_rows = still_open(open_rows.select("band", "vertex"), first)
    later = left_to_meet(open_rows, near, sets, tolerance, wide)
    return sketch, stored(first.union(later), "join-links"), sets


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", tolerance: float = 1e-5, wide: int = 4096,
                    count_all: bool = True) -> DataFrame:
    """``id, text_hash`` of every row with ``class_id, class_hash, class_size, n_copies, n_links`` and, with ``count_all``, ``n_similar``."""
    body = text_of(df, text)
    documents = df.select(df[doc_id].alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    sketch, found, sets = links(documents, tolerance, wide)
    classes = components(found, "join-all")
    degree = found.select(F.col("a").alias("vertex")).union(found.select("b")).groupBy("vertex").agg(F.count("*").alias("n_links"))
    copies = sketch.groupBy("vertex").agg(F.count("*").alias("n_copies"), F.min(F.struct("id", "text_hash")).alias("least"))
    vertices = copies.join(classes, "vertex", "left").join(degree, "vertex", "left")
    counted = ["n_similar"] if count_all else []
    if count_all:
        vertices = vertices.join(all_links(found, classes, sets), "vertex", "left")
    vertices = stored(vertices.select("vertex", "n_copies", "least", F.coalesce("class", "vertex").alias("class"),
                                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", *counted)]), "join-known")
    tops = vertices.groupBy("class").agg(F.min("least").alias("top"), F.sum("n_copies").alias("class_size"))
    known = stored(vertices.join(stored(tops, "join-tops"), "class"), "join-vertices-known")
    known = known.select("vertex", "n_copies", "n_links", *counted, "class_size", F.col("top.id").alias("class_id"), F.col("top.text_hash").alias("class_hash"))
    return sketch.select("id", "text_hash", "vertex").join(known, "vertex").select(
        "id", "text_hash", "class_id", "class_hash", "class_size", "n_copies", "n_links", *counted)


def keep_one(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each class: the one with the least ``doc_id``."""
    kept = near_duplicates(df, text, doc_id, count_all=False).where(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash")))
    kept = stored(kept.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "join-kept")
    own = df.withColumn("__own", F.xxhash64(text_of(df, text)))
    out = own.join(kept, own[doc_id].eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left_semi")
    return out.dropDuplicates([doc_id, "__own"]).drop("__own")
