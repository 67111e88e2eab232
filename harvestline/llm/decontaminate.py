"""Benchmark decontamination: a BM25 inverted index of test items, queried with every passage of every document.

Texts are lowered and cut into words (ASCII letters and digits, and all other characters beyond ASCII). A passage is
``2 L`` words long and begins every ``L`` words, ``L`` being the length of the longest item, so every place where an item
can stand lies wholly inside a passage. A passage's score for an item is the BM25 sum over their common words, divided by
the score that the item gives itself; items from ``least_score`` on are retrieved.

Retrieval is block-max WAND. Postings are cut into blocks of items, and every word has a maximum for each block. Words so
common that they cannot reach the threshold together for any item are not looked for; a block is opened for a passage
only if the maxima of the rarer words found in it, and the most that common words can add there, reach the threshold. The
bounds are taken for many passages at once in numpy. Nothing over the threshold is lost.

What is retrieved is verified: the share of the item's five-word runs that the passage has must reach ``least_overlap``
both for the question (the item without its last sentence) and for the answer (its last sentence; the second half of an
item with one sentence; runs are shorter where a part is).

The index has a bounded size: items beyond ``shard_items`` or ``shard_chars`` go to further shards, which are built and queried
with every passage one at a time; their hits are a table of the texts that have any. The number of items, their mean length, the
length of passages and the document frequencies are those of all items, so shards change no score.

Cases: null and empty texts hit nothing; items without words are left out; equal items are all reported; repeated rows
get equal results; an empty table of items or documents gives no hits; columns of the input named ``hits`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harvestline.llm.common import blocks, buffers, reachable, runs, stored, word_hashes

K1, B = 1.2, 0.75
RUN = 5
BLOCK_ITEMS = 8
BLOCK_BYTES = 1 << 20
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
HITS = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"


def hash_words(text: str) -> np.ndarray:
    return word_hashes(np.frombuffer(text.encode(), np.uint8))[0]


def overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """The share of the runs of a part that a passage has."""
    size = min(RUN, len(part))
    return float(np.isin(runs(part, size), runs(passage, size)).mean()) if size else 1.0


def question_and_answer(text: str) -> tuple[np.ndarray, np.ndarray]:
    parts = [w for s in SENTENCE.split(text) if len(w := hash_words(s))]
    if len(parts) > 1:
        return np.concatenate(parts[:-1]), parts[-1]
    words = parts[0] if parts else np.zeros(0, np.uint64)
    return words[:len(words) // 2], words[len(words) // 2:]


@dataclass
class Statistics:
    """What scores need to know of all items: their number, words of the mean and of the longest, and in how many a term occurs."""

    items: int
    mean: float
    longest: int
    terms: np.ndarray
    frequency: np.ndarray


class Index:
    """Inverted index of a bounded number of items; scores are shares of an item's own score.

    ``of_all`` has the statistics of all items, where these are only some; its sorted terms are those of these items.
    """

    def __init__(self, ids: list[int], texts: list[str], least_score: float, of_all: Statistics | None = None):
        words = [hash_words(t) for t in texts]
        kept = [k for k, w in enumerate(words) if len(w)]
        self.ids = np.array([ids[k] for k in kept], np.int64)
        self.parts = [question_and_answer(texts[k]) for k in kept]
        words = [words[k] for k in kept]
        n = len(words)
        self.length = of_all.longest if of_all else max(map(len, words), default=1)
        self.least = least_score
        each = [np.unique(w, return_counts=True) for w in words]
        self.terms, term = np.unique(np.concatenate([t for t, _ in each] or [np.zeros(0, np.uint64)]), return_inverse=True)
        item = np.repeat(np.arange(n), [len(t) for t, _ in each])
        tf = np.concatenate([c for _, c in each] or [np.zeros(0)]).astype(float)
        df = of_all.frequency[np.searchsorted(of_all.terms, self.terms)] if of_all else np.bincount(term, minlength=len(self.terms))
        sizes = np.array([len(w) for w in words], float)
        idf = np.log1p(((of_all.items if of_all else n) - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes[item] / (of_all.mean if of_all else sizes.mean())) if n else 0
        gain = idf[term] * tf * (K1 + 1) / (tf + norm)
        gain = gain / np.bincount(item, gain, n)[item] if n else gain
        order = np.lexsort((item, term))
        self.item, self.gain, term = item[order], gain[order], term[order]
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))
        # block maxima: one entry for each word and block of items that has it
        self.n_blocks = -(-n // BLOCK_ITEMS)
        block = self.item // BLOCK_ITEMS
        key = term * max(1, self.n_blocks) + block
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.block, self.block_max = block[heads], np.maximum.reduceat(self.gain, heads) if len(heads) else np.zeros(0)
        self.block_key, self.block_at = key[heads], np.r_[heads, len(key)]
        self.block_first = np.searchsorted(term[heads], np.arange(len(self.terms) + 1))
        # common words, as long as they stay under the threshold for every item
        common, mass = np.zeros(len(self.terms), bool), np.zeros(n)
        for t in np.argsort(-df, kind="stable"):
            own = slice(self.first[t], self.first[t + 1])
            if (mass[self.item[own]] + self.gain[own] < 0.5 * least_score).all():
                common[t] = True
                mass[self.item[own]] += self.gain[own]
        self.rare = ~common
        self.common_bound = np.array([mass[k * BLOCK_ITEMS:(k + 1) * BLOCK_ITEMS].max() for k in range(self.n_blocks)])
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.terms >> np.uint64(44)).astype(np.int64)] = True

    def lookup(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that the index has, and their terms."""
        at = np.flatnonzero(self.table[(words >> np.uint64(44)).astype(np.int64)])
        t = np.minimum(np.searchsorted(self.terms, words[at]), len(self.terms) - 1)
        ok = self.terms[t] == words[at]
        return at[ok], t[ok]

    def open_blocks(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages and blocks whose upper bound reaches the threshold; given the rare words of each passage, each once."""
        count = self.block_first[term + 1] - self.block_first[term]
        entry = np.repeat(self.block_first[term] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        key, slot = np.unique(np.repeat(passage, count) * self.n_blocks + self.block[entry], return_inverse=True)
        bound = np.bincount(slot, self.block_max[entry], len(key))
        keep = bound + self.common_bound[key % self.n_blocks] >= self.least - 1e-9
        return key[keep] // self.n_blocks, key[keep] % self.n_blocks

    def scores(self, terms: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Items of a block and their scores for a passage with the given words."""
        low, high = block * BLOCK_ITEMS, min((block + 1) * BLOCK_ITEMS, len(self.ids))
        want = terms * self.n_blocks + block
        entry = np.minimum(np.searchsorted(self.block_key, want), len(self.block_key) - 1)
        entry = entry[self.block_key[entry] == want]
        first, size = self.block_at[entry], self.block_at[entry + 1] - self.block_at[entry]
        posting = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        total = np.bincount(self.item[posting] - low, self.gain[posting], high - low)
        return np.arange(low, high), total

    def query(self, data: np.ndarray, starts: np.ndarray) -> list[list[dict]]:
        """Verified hits of every document in some bytes; the best passage of an item counts."""
        n_docs, L = len(starts) - 1, self.length
        out: list[dict[int, tuple]] = [{} for _ in range(n_docs)]
        if not len(self.ids):
            return [[] for _ in range(n_docs)]
        base = int(starts[0])
        words, begin = word_hashes(data[base:int(starts[-1])], starts - base)
        doc = np.searchsorted(starts, begin + base, "right") - 1
        doc_first = np.searchsorted(doc, np.arange(n_docs + 1))
        segments = -(-np.diff(doc_first) // L)
        segment_first = np.r_[0, np.cumsum(segments)]
        at, term = self.lookup(words)
        segment = segment_first[doc[at]] + (at - doc_first[doc[at]]) // L
        rare = self.rare[term]
        # a segment belongs to the passage that begins with it and to the one before
        owner = np.repeat(np.arange(n_docs), segments)
        before = segment > segment_first[doc[at]]
        n_terms = len(self.terms)
        pairs = np.unique(np.r_[segment[rare] * n_terms + term[rare], (segment[rare & before] - 1) * n_terms + term[rare & before]])
        for passage, block in zip(*self.open_blocks(pairs // n_terms, pairs % n_terms), strict=True):
            a, b = np.searchsorted(segment, (passage, passage + 2))
            d = owner[passage]
            b = min(b, int(np.searchsorted(at, doc_first[d + 1])))
            items, score = self.scores(np.unique(term[a:b]), block)
            low = doc_first[d] + (passage - segment_first[d]) * L
            inside = words[low:min(low + 2 * L, doc_first[d + 1])]
            for k in np.flatnonzero(score >= self.least - 1e-9):
                question, answer = self.parts[items[k]]
                hit = (float(min(1.0, score[k])), overlap(question, inside), overlap(answer, inside))
                out[d][int(items[k])] = max(out[d].get(int(items[k]), (0.0, 0.0, 0.0)), hit, key=lambda h: (min(h[1:]), h))
        return [[{"item_id": int(self.ids[k]), "score": h[0], "question_overlap": h[1], "answer_overlap": h[2]}
                 for k, h in sorted(found.items())] for found in out]


def _searcher(index: Index, least_overlap: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()),
                               ("answer_overlap", pa.float64())]))

    def search(texts: pa.Array) -> pa.Array:
        data, starts = buffers(texts)
        found: list[list[dict]] = []
        for low, high in blocks(starts, BLOCK_BYTES):
            found += index.query(data, starts[low:high + 1])
        return pa.array([[h for h in hits if min(h["question_overlap"], h["answer_overlap"]) >= least_overlap] for hits in found], kind)

    return F.arrow_udf(search, HITS)


def _item_terms(texts: pa.Array) -> pa.Array:
    words = [hash_words(t or "") for t in texts.to_pylist()]
    return pa.array([{"n": len(w), "terms": np.unique(w).view(np.int64).tolist()} for w in words],
                    pa.struct([("n", pa.int64()), ("terms", pa.list_(pa.int64()))]))


def _shards(rows: DataFrame, shards: int, least_score: float) -> Iterator[Index]:
    """The indices of all shards, one at a time, with the statistics of all items."""
    items = rows.withColumn("w", F.arrow_udf(_item_terms, "n long, terms array<long>")("t")).select("i", "t", "w.*")
    items = stored(items.where("n > 0").withColumn("shard", F.pmod(F.xxhash64("i", "t"), F.lit(shards))), "items")
    total = items.agg(F.count("*").alias("items"), F.avg("n").alias("mean"), F.max("n").alias("longest")).first()
    postings = items.select("shard", F.explode("terms").alias("term"))
    frequency = stored(postings.groupBy("term").agg(F.count("*").alias("df")), "item-terms")
    for k in range(shards if total["items"] else 0):
        held = items.where(F.col("shard") == k).orderBy("i", "t").select("i", "t").toArrow().to_pydict()
        own = postings.where(F.col("shard") == k).select("term").distinct().join(frequency, "term").toArrow()
        terms = own["term"].to_numpy().view(np.uint64)
        order = np.argsort(terms)
        yield Index(held["i"], held["t"], least_score, Statistics(total["items"], total["mean"], total["longest"], terms[order], own["df"].to_numpy()[order]))


def find_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
              least_score: float = 0.5, least_overlap: float = 0.8, shard_items: int = 20_000, shard_chars: int = 20_000_000) -> DataFrame:
    """Add ``hits``: the test items that a document contains, with score and overlaps of the best passage."""
    reachable(docs.sparkSession)
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.lower(F.coalesce(F.col(item_text), F.lit(""))).alias("t"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("c")).first()
    shards = max(1, -(-size["n"] // shard_items), -(-size["c"] // shard_chars))
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    if shards == 1:
        held = rows.orderBy("i", "t").toArrow().to_pydict()
        return docs.withColumn("hits", _searcher(Index(held["i"], held["t"], least_score), least_overlap)(F.lower(body)))
    keys = [F.xxhash64(body).alias("__h1"), F.xxhash64(F.lit(7), body).alias("__h2")]  # the hits of a document depend on its text alone
    found = []
    for index in _shards(rows, shards, least_score):
        hits = docs.select(*keys, _searcher(index, least_overlap)(F.lower(body)).alias("h")).where(F.size("h") > 0)
        found.append(stored(hits.dropDuplicates(["__h1", "__h2"]), "item-hits"))
    if not found:
        return docs.withColumn("hits", F.array().cast(HITS))
    all_hits = reduce(DataFrame.union, found).groupBy("__h1", "__h2").agg(F.array_sort(F.flatten(F.collect_list("h"))).alias("__hits"))
    own = docs.drop("hits").withColumns({"__h1": keys[0], "__h2": keys[1]}).join(stored(all_hits, "item-found"), ["__h1", "__h2"], "left")
    return own.withColumn("hits", F.coalesce("__hits", F.array().cast(HITS))).drop("__h1", "__h2", "__hits")
