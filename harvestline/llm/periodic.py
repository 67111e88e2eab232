"""Periodic runs of words in texts, found on an enhanced suffix array, and texts with the repetition taken out.

Words are what stands between ASCII white space. A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are identical) that no neighbouring word extends, ``max(LEAST, TIMES * q)`` words long or more.

* Many documents make one suffix array: a word is told by its document and its text, so no suffix of one document is ever
  equal to one of another. Ranks double their reach each round, and only suffixes that are not told apart yet take part.
* A run makes two suffixes of its document agree in ``LEAST_SHARED`` words, so documents without such a pair hold no run and
  leave after four rounds; this drops nothing.
* Longest common prefixes come from the irreducible ones, whose sum is at most 2 n log n.
* Branching tandem test: for each interval of suffixes with a common prefix of ``depth`` words, every suffix i outside the
  largest child looks whether i + depth or i - depth lies in the interval, by its place in the suffix array (ISA), and whether
  the square that the two make is not continued by its first word. No tree nodes are made.
* Squares that end together are rotated to the left as far as they go, least period first. A longer period that is a multiple,
  and whose square lies inside the run found, is the same run. So each run is found once, with its smallest period.

Cases: a null or empty text has no words and no runs; a null ``doc_id`` is kept; repeated rows get equal results, each its own;
runs may overlap, and all of them count; ``runs`` and ``collapsed`` replace columns of these names. A document is worked on in
one task, with memory in proportion to its words; blocks of many documents are bounded by their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from harvestline.llm.common import blocks, buffers, reachable, text_of, with_struct

LEAST, TIMES = 24, 3
#: Words that the suffixes s and s + q of a run share at least: max(24, 3q) - q, least at q = 8.
LEAST_SHARED = 16
BLOCK_BYTES = 4 << 20
WIDTH, CELLS = 8, 1 << 21
RESULT = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def agreement(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 1) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` onward (``step`` -1: backward). Ends of the array agree with nothing."""
    n, out = len(words), np.zeros(len(a), np.int64)
    alive, width = np.arange(len(a)), WIDTH
    while len(alive):
        rest = []
        for part in np.array_split(alive, max(1, len(alive) * width // CELLS)):
            at = out[part][:, None] + np.arange(width)
            x, y = a[part][:, None] + step * at, b[part][:, None] + step * at
            same = (x >= 0) & (y >= 0) & (x < n) & (y < n)
            same &= words[np.clip(x, 0, n - 1)] == words[np.clip(y, 0, n - 1)]
            whole = same.all(axis=1)
            out[part] += np.where(whole, width, same.argmin(axis=1))
            rest.append(part[whole])
        alive, width = np.concatenate(rest), min(2 * width, CELLS)
    return out


def doubled(rank: np.ndarray, alive: np.ndarray, reach: int) -> np.ndarray:
    """One round: ``rank`` (of the first ``reach`` words: where the group begins) becomes that of twice as many words.

    Returns the positions that still share their rank. Suffixes that end sooner come first.
    """
    n = len(rank)
    nxt = np.where(alive + reach < n, rank[np.minimum(alive + reach, n - 1)] + 1, 0)
    order = np.lexsort((nxt, rank[alive]))
    alive, nxt = alive[order], nxt[order]
    old = rank[alive]
    group = np.r_[True, old[1:] != old[:-1]]
    fresh = group | np.r_[True, nxt[1:] != nxt[:-1]]
    place = np.arange(len(alive))
    begin, own = np.maximum.accumulate(np.where(group, place, 0)), np.maximum.accumulate(np.where(fresh, place, 0))
    rank[alive] = old + own - begin
    last = np.r_[fresh[1:], True]
    return alive[~(fresh & last)]


def first_ranks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    fresh = np.r_[True, sorted_words[1:] != sorted_words[:-1]]
    rank = np.empty(len(words), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(words)), 0))
    return rank, np.sort(order[~(fresh & np.r_[fresh[1:], True])])


def prefixes(words: np.ndarray, isa: np.ndarray) -> np.ndarray:
    """LCP of each suffix in the suffix array with the one before it (0 for the first)."""
    n = len(words)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    reducible = (place > 0) & (before > 0) & (words[place - 1] == words[before - 1])
    roots = np.flatnonzero(~reducible & (before >= 0))
    ends = np.zeros(n, np.int64)
    ends[roots] = roots + agreement(words, roots, before[roots])
    # a reducible value is one less than that of the position before it
    plcp = np.maximum(np.maximum.accumulate(ends) - place, 0)
    plcp[before < 0] = 0
    return plcp[sa]


def small_children(lcp: np.ndarray) -> np.ndarray:
    """``depth, low, high, from, to`` of all children but the largest, for the LCP intervals that can hold a run of that period."""
    out: list[tuple[int, int, int, int, int]] = []
    stack: list[tuple[int, int, list[int]]] = []

    def close(depth: int, low: int, cuts: list[int], high: int) -> None:
        if high - low + 1 < max(TIMES, LEAST // depth):
            return
        bounds = [low, *cuts, high + 1]
        sizes = [b - a for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        largest = sizes.index(max(sizes))
        out.extend((depth, low, high, bounds[k], bounds[k + 1]) for k in range(len(sizes)) if k != largest)

    for r, value in enumerate([*lcp[1:].tolist(), 0], 1):
        low = r - 1
        while stack and stack[-1][0] > value:
            depth, low, cuts = stack.pop()
            close(depth, low, cuts, r - 1)
        if value:
            if stack and stack[-1][0] == value:
                stack[-1][2].append(r)
            else:
                stack.append((value, low, [r]))
    return np.array(out, np.int64).reshape(-1, 5)


def branching_squares(words: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """``end, period`` of all squares that their first word does not continue, each once."""
    n = len(words)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    found = small_children(lcp)
    if not len(found):
        return np.zeros((0, 2), np.int64)
    sizes = found[:, 4] - found[:, 3]
    depth, low, high, begin = (np.repeat(found[:, k], sizes) for k in range(4))
    i = sa[begin + np.arange(len(begin)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]

    def squares(start: np.ndarray, other: np.ndarray) -> np.ndarray:
        inside = (other >= 0) & (other < n)
        where = isa[np.clip(other, 0, n - 1)]
        end = start + 2 * depth
        inside &= (where >= low) & (where <= high)
        inside &= (end >= n) | (words[np.clip(start + depth, 0, n - 1)] != words[np.minimum(end, n - 1)])
        return np.stack((end[inside], depth[inside]), axis=1)

    return np.unique(np.concatenate((squares(i, i + depth), squares(i - depth, i - depth))), axis=0)


def runs(words: np.ndarray, isa: np.ndarray) -> np.ndarray:
    """``start, length, period`` of the runs, by start and period. ``words`` differ between documents."""
    open_ = branching_squares(words, isa, prefixes(words, isa))
    found = []
    while len(open_):  # the least period of every end; rows are sorted by end and period
        first = np.r_[True, open_[1:, 0] != open_[:-1, 0]]
        end, period = open_[first].T
        start = end - 2 * period
        start = start - agreement(words, start - 1, start - 1 + period, -1)
        found.append(np.stack((start, end - start, period), axis=1))
        group = np.cumsum(first) - 1
        same = (open_[:, 1] % period[group] == 0) & (2 * open_[:, 1] <= (end - start)[group])
        open_ = open_[~first & ~same]
    out = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    out = out[out[:, 1] >= np.maximum(LEAST, TIMES * out[:, 2])]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def repeating(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The documents in which two suffixes agree in LEAST_SHARED words."""
    rank, alive = first_ranks(words)
    reach = 1
    while reach < LEAST_SHARED and len(alive):
        alive = doubled(rank, alive, reach)
        reach *= 2
    return np.unique(doc[alive])


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words its runs."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = [w for t in texts for w in t]
    if not flat:
        return out
    ids = pa.array(flat, pa.binary()).dictionary_encode()
    doc = np.repeat(np.arange(len(texts)), sizes)
    words = doc * len(ids.dictionary) + ids.indices.to_numpy()
    busy = np.zeros(len(texts), bool)
    busy[repeating(words, doc)] = True
    keep = busy[doc]
    words, doc = words[keep], doc[keep]
    if not len(words):
        return out
    rank, alive = first_ranks(words)
    reach = 1
    while len(alive):
        alive = doubled(rank, alive, reach)
        reach *= 2
    found = runs(words, rank)
    first = np.searchsorted(doc, np.arange(len(texts)))
    owner = doc[found[:, 0]]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for d in np.unique(owner):
        own = found[cuts[d]:cuts[d + 1]].copy()
        own[:, 0] -= first[d]
        out[d] = own
    return out


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which words lie in no run after that run's first period."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    return np.cumsum(cover)[:n] == 0


def _collapse(texts: pa.Array) -> pa.Array:
    data, starts = buffers(texts)
    raw = data.tobytes() if len(data) else b""
    found: list[np.ndarray] = []
    collapsed: list[bytes] = []
    for low, high in blocks(starts, BLOCK_BYTES):
        split = [raw[a:b].split() for a, b in zip(starts[low:high], starts[low + 1:high + 1], strict=True)]
        for words, own in zip(split, part := find_runs(split), strict=True):
            if len(own):
                words = [w for w, kept in zip(words, kept_words(len(words), own).tolist(), strict=True) if kept]
            collapsed.append(b" ".join(words))
        found += part
    flat = np.concatenate([*found, np.zeros((0, 3), np.int64)])
    cells = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), cells)
    return pa.StructArray.from_arrays([lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def collapse_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``runs`` (start, length and period in words, by start and period) and ``collapsed``, the words joined by
    one space without those that repeat in a run after its first period."""
    reachable(df.sparkSession)
    return with_struct(df, F.arrow_udf(_collapse, RESULT)(text_of(df, text)), ["runs", "collapsed"])


def strongest(found: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period. Null if there is none."""
    def better(best: Column, r: Column) -> Column:
        ahead, behind = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (ahead > behind), r).otherwise(best)  # the runs are sorted by start and period

    return F.aggregate(found, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def _planted(keys: pa.Array, texts: pa.Array) -> pa.Array:
    out = []
    for h, text in zip(keys.to_pylist(), texts.to_pylist(), strict=True):
        words = (text or "").encode().split()
        if h is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            words = [*words[:a], *[words[a + (i - a) % period] for i in range(a, n)]]
        out.append(None if text is None else b" ".join(words).decode())
    return pa.array(out, pa.string())


def planted(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows with a periodic end put into every text whose crc32 of the id, as decimal text, ends in 0.

    With g the crc32 without its last digit, the words from number a = g mod n on repeat with the period
    1 + floor((n - a) / (3 + g mod 8)). Other texts, and those of a null id, stay as they are.
    """
    reachable(df.sparkSession)
    h = F.crc32(df[doc_id].cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    changed = F.arrow_udf(_planted, "string")(F.when(chosen, h), F.when(chosen, text_of(df, text)))
    return df.withColumn("__changed", changed).withColumn(text, F.coalesce("__changed", F.col(f"`{text}`"))).drop("__changed")
