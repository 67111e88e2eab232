"""Removal of repeated byte strings by sparse suffix sorting.

A byte goes if a string of ``length`` (400) bytes covers it that also starts anywhere else, in the same document or
another. To sort all suffixes of a corpus would move many times its size, so only suffixes that can matter are sorted:

1. Every ``length``-byte string (window) has an anchor: the 32-byte string in it with the least hash, the first of equals.
   Equal windows have equal anchors at equal places, so windows are compared only below one anchor. The windows of a
   document that share an anchor begin at consecutive bytes; together they are the anchor's context.
2. Contexts are counted by a 128-bit digest. In a context that occurs more often than once, every window is repeated. An
   anchor with a single context has no other repeats. What is left are the edges of repeats: anchors with several
   contexts. Only one copy of each context and only of one copy of each text is looked at.
3. The windows of those contexts are suffixes cut off at ``length`` bytes, and are ordered by deep-shallow sorting: a
   multikey quicksort splits them by eight bytes at a time down to a shallow depth, then a blind trie orders each group that
   still has a common prefix; neighbours that agree to full length are repeats.
4. Spans go back to all places of a context, are merged for each text, and cut out of every document that has the text.

Groups of any size: an anchor with more than ``wide`` contexts (a passage that a large part of the corpus shares) is not
sorted in one task. Its contexts are cut at fixed places into pieces of 16 windows; a piece whose common middle part occurs
once has no repeat, one whose whole string occurs twice is repeated, and the windows of the others are counted one by one.
That is exact as well, and no group of rows is ever gathered. Documents with equal text share one analysis.

Cases: null and empty texts have no bytes; texts under ``length`` bytes keep everything; equal texts (also repeated rows)
are removed as a whole from ``length`` bytes on; a null doc_id is an id like any other; columns named like outputs are
replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harvestline.llm.common import buffers, sha256, stored, text_of

LENGTH = 400
GRAM = 32
WIDE = 256
PIECE = 16
SHALLOW = 64
BLOCK_BYTES = 1 << 20
LOW = np.uint64((1 << 24) - 1)
OUTPUTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes that begin at each place, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    size = 1
    while size < GRAM:
        left, right = h[:-size], h[size:]
        h = left * np.uint64(0xD6E8FEB86659FD93 + 2 * size) + (right ^ (right >> np.uint64(29)))
        size *= 2
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def digest(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def anchors(text: bytes, length: int) -> list[tuple[int, int, int, int, int, int]]:
    """(anchor hash, anchor, first window, last window, digest of the context) of a text, in order."""
    out: list[tuple[int, int, int, int, int, int]] = []
    width = length - GRAM + 1
    # a block holds the windows that begin in it; blocks overlap by a window, and a context cut at a border is joined
    for base in range(0, len(text) - length + 1, BLOCK_BYTES):
        h = gram_hashes(np.frombuffer(text, np.uint8, min(len(text), base + BLOCK_BYTES + length - 1) - base, base))
        key = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
        least, size = key, 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        count = len(key) - width + 1
        own = (np.minimum(least[:count], least[width - size:width - size + count]) & LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        last = np.r_[first[1:] - 1, count - 1]
        for a, p, s, e in zip(h[own[first]].view(np.int64).tolist(), own[first].tolist(), first.tolist(), last.tolist(), strict=True):
            if out and out[-1][1] == p + base:
                s = out.pop()[2] - base
            out.append((a, p + base, s + base, e + base, 0, 0))
    return [(a, p, s, e, *digest(text[s:e + length])) for a, p, s, e, _, _ in out]


ANCHOR = "anchor:long,place:int,first:int,last:int,c1:long,c2:long"


def _anchors(length: int):
    names = ["anchor", "place", "first", "last", "c1", "c2"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def run(texts: pa.Array) -> pa.Array:
        data, starts = buffers(texts)
        rows = [anchors(data[a:b].tobytes(), length) if b - a >= length else [] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        flat = list(zip(*[r for own in rows for r in own], strict=True)) or [[]] * len(names)
        values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(flat, kinds, strict=True)], names)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), values)

    return F.arrow_udf(run, f"array<struct<{ANCHOR}>>")


def _slices(length: int):
    def run(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        data, starts = buffers(texts)
        out = []
        for a, spans in zip(starts[:-1], wanted.to_pylist(), strict=True):
            out.append([data[a + s["first"]:a + s["last"] + length].tobytes() for s in spans])
        return pa.array(out, pa.list_(pa.binary()))

    return F.arrow_udf(run, "array<binary>")


# Deep-shallow sorting of windows


def common_prefix(x: bytes, y: bytes) -> int:
    """Length of the common prefix of two strings of equal length."""
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return len(x) - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Strings of equal length by the places where they branch; equal strings share a leaf.

    A node is [place, {byte: child}], a leaf is [-1, string, members]. An insertion goes down by the branching bytes alone,
    compares the string once with the leaf it meets, and puts in a branch where they differ.
    """

    def __init__(self):
        self.root: list | None = None

    def insert(self, text: bytes, member: int) -> None:
        if self.root is None:
            self.root = [-1, text, [member]]
            return
        node = self.root
        while node[0] >= 0:
            child = node[1].get(text[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        if node[1] == text:
            node[2].append(member)
            return
        at = common_prefix(text, node[1])
        leaf, above, node_text = [-1, text, [member]], None, node[1]
        node = self.root
        while 0 <= node[0] < at:
            above, node = node, node[1][text[node[0]]]
        if node[0] == at:
            node[1][text[at]] = leaf
            return
        branch = [at, {text[at]: leaf, node_text[at]: node}]
        if above is None:
            self.root = branch
        else:
            above[1][text[above[0]]] = branch

    def ordered(self) -> Iterator[list[int]]:
        """Members of the leaves in the order of their strings."""
        waiting = [self.root] if self.root is not None else []
        while waiting:
            node = waiting.pop()
            if node[0] < 0:
                yield node[2]
            else:
                waiting += [node[1][b] for b in sorted(node[1], reverse=True)]


def sort_windows(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Sets of equal windows with two members or more, from suffixes that begin at ``at``; groups are kept apart.

    ``data`` has at least ``length + 8`` bytes after the last suffix.
    """
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    order, rank = np.arange(len(at)), group
    depth = 0
    while len(order) and depth < min(SHALLOW, length):
        size = min(8, length - depth)
        word = np.ascontiguousarray(words[at[order] + depth]).view(">u8").ravel().astype(np.uint64) >> np.uint64(8 * (8 - size))
        by = np.lexsort((word, rank))
        order, rank, word = order[by], rank[by], word[by]
        fresh = np.r_[True, (rank[1:] != rank[:-1]) | (word[1:] != word[:-1])]
        rank = np.cumsum(fresh) - 1
        tied = np.bincount(rank)[rank] > 1  # a suffix alone in its group is in place
        order, rank = order[tied], rank[tied]
        depth += 8
    if not len(order):
        return
    cuts = np.r_[0, np.flatnonzero(rank[1:] != rank[:-1]) + 1, len(order)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        trie = BlindTrie()
        for k in order[a:b].tolist():
            s = int(at[k])
            trie.insert(data[s + depth:s + length].tobytes(), k)
        for same in trie.ordered():
            if len(same) > 1:
                yield np.array(same)


def repeated_ranges(contexts: list[bytes], before: list[int], groups: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For every context, the ranges (first, last) of windows that another context of its group has at the same place.

    ``before``: the bytes of the context before the anchor.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    base = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(contexts) + b"\0" * (length + 8), np.uint8)
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(contexts)), counts)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    place = within - np.asarray(before, np.int64)[owner]
    _, group = np.unique(np.asarray(groups, np.int64)[owner] * (2 * length + 1) + place, return_inverse=True)
    hit = np.zeros(len(owner), bool)
    for same in sort_windows(data, base[owner] + within, group, length):
        hit[same] = True
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    ends = np.cumsum(counts)
    for k, (a, b) in enumerate(zip(ends - counts, ends, strict=True)):
        edge = np.flatnonzero(np.diff(np.r_[False, hit[a:b], False].astype(np.int8)))
        out[k] = [(int(x), int(y) - 1) for x, y in zip(edge[::2], edge[1::2], strict=True)]
    return out


RANGES = "array<struct<a:int,b:int>>"


def _sorter(length: int, least_bytes: int = 1 << 20):
    kind = pa.schema([("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()),
                      ("ranges", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def solve(rows: list[dict]) -> pa.RecordBatch:
            ids = {a: k for k, a in enumerate(dict.fromkeys(r["anchor"] for r in rows))}
            found = repeated_ranges([r["bytes"] for r in rows], [r["before"] for r in rows], [ids[r["anchor"]] for r in rows], length)
            keep = [(r, f) for r, f in zip(rows, found, strict=True) if f]
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r, _ in keep], pa.int64()) for n in ("anchor", "c1", "c2")]
                                              + [pa.array([[{"a": x, "b": y} for x, y in f] for _, f in keep], kind.field("ranges").type)],
                                              schema=kind)

        for batch in batches:
            for row in batch.to_pylist():
                # rows come by anchor; a block ends between two anchors
                if size >= least_bytes and held[-1]["anchor"] != row["anchor"]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield solve(held)

    return run


def _pieces(length: int):
    """Pieces of a context: number, whether it has all its windows, digests of its middle and of the whole."""
    kind = pa.struct([("piece", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("m1", pa.int64()), ("m2", pa.int64()),
                      ("w1", pa.int64()), ("w2", pa.int64())])

    def run(contexts: pa.Array, before: pa.Array) -> pa.Array:
        out = []
        for text, pre in zip(contexts.to_pylist(), before.to_pylist(), strict=True):
            count, own = len(text) - length + 1, []
            for piece in range(-pre // PIECE, (count - 1 - pre) // PIECE + 1):
                low, high = piece * PIECE + pre, piece * PIECE + PIECE - 1 + pre
                a, b = max(0, low), min(count - 1, high)
                middle = digest(text[high:low + length])
                whole = digest(text[low:high + length]) if (a, b) == (low, high) else (None, None)
                own.append({"piece": piece, "a": a, "b": b, "m1": middle[0], "m2": middle[1], "w1": whole[0], "w2": whole[1]})
            out.append(own)
        return pa.array(out, pa.list_(kind))

    return F.arrow_udf(run, "array<struct<piece:int,a:int,b:int,m1:long,m2:long,w1:long,w2:long>>")


def _windows(length: int):
    kind = pa.struct([("a", pa.int32()), ("place", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])

    def run(contexts: pa.Array, before: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
        out = []
        for text, pre, a, b in zip(contexts.to_pylist(), before.to_pylist(), first.to_pylist(), last.to_pylist(), strict=True):
            own = []
            for k in range(a, b + 1):
                d = digest(text[k:k + length])
                own.append({"a": k, "place": k - pre, "w1": d[0], "w2": d[1]})
            out.append(own)
        return pa.array(out, pa.list_(kind))

    return F.arrow_udf(run, "array<struct<a:int,place:int,w1:long,w2:long>>")


def count_apart(contexts: DataFrame, length: int) -> DataFrame:
    """``anchor, c1, c2, ranges`` for contexts of anchors that have too many of them for one task."""
    key = ["anchor", "c1", "c2"]
    cut = contexts.select(*key, "before", "bytes", F.explode(_pieces(length)("bytes", "before")).alias("p"))
    cut = stored(cut.select(*key, "before", "bytes", "p.*"), "bytes-pieces")
    whole = cut.where("w1 is not null").groupBy("anchor", "piece", "w1", "w2").count().where("count > 1")
    whole = stored(whole.select("anchor", "piece", "w1", "w2", F.lit(True).alias("twice")), "bytes-whole")
    middle = stored(cut.groupBy("anchor", "piece", "m1", "m2").count().where("count > 1").select("anchor", "piece", "m1", "m2"), "bytes-middle")
    seen = stored(cut.join(whole, ["anchor", "piece", "w1", "w2"], "left"), "bytes-seen")
    full = seen.where("twice").select(*key, F.array(F.struct("a", "b")).alias("ranges"))
    unsure = seen.where("twice is null").join(middle, ["anchor", "piece", "m1", "m2"], "left_semi")
    # whole pieces take part, since the others may agree with some of their windows
    sources = seen.where("twice").dropDuplicates(["anchor", "piece", "w1", "w2"]).join(
        stored(unsure.select("anchor", "piece", "m1", "m2").distinct(), "bytes-open"), ["anchor", "piece", "m1", "m2"], "left_semi")
    both = unsure.select(*key, "before", "bytes", "a", "b").union(sources.select(*key, "before", "bytes", "a", "b"))
    each = both.select(*key, F.explode(_windows(length)("bytes", "before", "a", "b")).alias("w"))
    each = stored(each.select(*key, "w.*"), "bytes-windows")
    twice = each.groupBy("anchor", "place", "w1", "w2").count().where("count > 1").select("anchor", "place", "w1", "w2")
    single = each.join(stored(twice, "bytes-twice"), ["anchor", "place", "w1", "w2"], "left_semi")
    return full.union(single.select(*key, F.array(F.struct("a", F.col("a").alias("b"))).alias("ranges")))


def repeated_spans(docs: DataFrame, length: int, wide: int) -> DataFrame:
    """``h1, h2, copies, spans``: for every distinct text its copies and the (from, to) byte spans that are repeated."""
    found = docs.select("id", "h1", "h2", _anchors(length)("body").alias("anchors"))
    found = stored(found, "bytes-anchors")
    texts = stored(found.groupBy("h1", "h2").agg(F.min(F.struct("id")).alias("rep"), F.count("*").alias("copies")), "bytes-texts")
    rows = found.join(texts.drop("copies"), ["h1", "h2"]).where(F.col("id").eqNullSafe(F.col("rep.id"))).dropDuplicates(["h1", "h2"])
    places = stored(rows.select("h1", "h2", F.explode("anchors").alias("x")).select("h1", "h2", "x.*"), "bytes-places")
    key = ["anchor", "c1", "c2"]
    seen = places.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("h1", "h2", "place", "first", "last")).alias("at"))
    seen = stored(seen, "bytes-contexts")
    several = stored(seen.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1"), "bytes-several")
    edges = stored(seen.join(several, "anchor"), "bytes-edges")
    wanted = edges.select("at.h1", "at.h2", F.struct(*key, "n", "m", "at.place", "at.first", "at.last").alias("w"))
    wanted = stored(wanted.groupBy("h1", "h2").agg(F.collect_list("w").alias("wanted")).join(texts.drop("copies"), ["h1", "h2"]), "bytes-wanted")
    held = docs.join(wanted, ["h1", "h2"]).where(F.col("id").eqNullSafe(F.col("rep.id"))).select("wanted", "body")
    held = held.select(F.explode(F.arrays_zip("wanted", _slices(length)("body", "wanted").alias("bytes"))).alias("z"))
    contexts = held.select("z.wanted.*", F.col("z.bytes").alias("bytes")).withColumn("before", F.col("place") - F.col("first"))
    contexts = stored(contexts.dropDuplicates(key).select(*key, "n", "m", "before", "bytes"), "bytes-held")
    few = contexts.where(F.col("m") <= wide).select(*key, "before", "bytes")
    few = few.repartition("anchor").sortWithinPartitions("anchor")
    partial = few.mapInArrow(_sorter(length), f"anchor long, c1 long, c2 long, ranges {RANGES}")
    partial = partial.union(count_apart(contexts.where(F.col("m") > wide), length))
    # a context that occurs more often is repeated as a whole; each context has one row, so its places are met once
    lone = stored(contexts.where("n = 1").select(*key), "bytes-lone")
    partial = partial.join(lone, key, "left_semi").groupBy(*key).agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    full = seen.where("n > 1").select(*key, F.array(F.struct(F.lit(0).alias("a"), (F.col("at.last") - F.col("at.first")).alias("b"))).alias("ranges"))
    marks = stored(partial.union(full), "bytes-marks")
    spans = places.join(marks, key).select("h1", "h2", F.transform("ranges", lambda r: F.struct(
        (F.col("first") + r["a"]).alias("a"), (F.col("first") + r["b"] + length).alias("b"))).alias("s"))
    spans = stored(spans.groupBy("h1", "h2").agg(F.flatten(F.collect_list("s")).alias("spans")), "bytes-spans")
    return texts.drop("rep").join(spans, ["h1", "h2"], "left")


def _cut(length: int):
    def run(texts: pa.Array, copies: pa.Array, spans: pa.Array) -> pa.Array:
        data, starts = buffers(texts)
        out = []
        for k, (n, own) in enumerate(zip(copies.to_pylist(), spans.to_pylist(), strict=True)):
            text = data[starts[k]:starts[k + 1]]
            gone = [(0, len(text))] if n > 1 and len(text) >= length else [(s["a"], s["b"]) for s in own or []]
            merged: list[list[int]] = []
            for a, b in sorted(gone):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            at, kept = 0, []
            for a, b in merged:
                kept.append(text[at:a].tobytes())
                at = b
            kept.append(text[at:].tobytes())
            rest = b"".join(kept)
            out.append({"n_bytes": len(text), "n_removed": len(text) - len(rest), "n_spans": len(merged), "kept_sha256": sha256(rest),
                        "kept": rest, "removed": [{"a": a, "b": b} for a, b in merged]})
        return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                                        ("kept_sha256", pa.string()), ("kept", pa.binary()),
                                        ("removed", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))]))

    return F.arrow_udf(run, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, removed array<struct<a:long,b:long>>")


def remove_repeats(df: DataFrame, text: str = "text", length: int = LENGTH, wide: int = WIDE, outputs: tuple[str, ...] = OUTPUTS) -> DataFrame:
    """The rows with ``outputs`` added, of ``n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes that stay, as binary:
    a cut may fall inside a character) and ``removed`` (the spans)."""
    body = text_of(df, text)
    own = df.drop(*outputs).withColumns({"__body": body, "__h1": F.xxhash64(body), "__h2": F.xxhash64(F.lit(7), body)})
    docs = df.select((F.col("doc_id") if "doc_id" in df.columns else F.lit(None)).cast("string").alias("id"), body.alias("body"),
                     F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(7), body).alias("h2"))
    spans = repeated_spans(docs, length, wide)
    spans = stored(spans.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("copies").alias("__copies"),
                                F.col("spans").alias("__spans")), "bytes-known")
    out = own.join(spans, ["__h1", "__h2"]).withColumn("__r", _cut(length)("__body", "__copies", "__spans"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in outputs], *[F.col("__r")[n].alias(n) for n in outputs])
