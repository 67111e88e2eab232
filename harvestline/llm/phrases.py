"""Collocations of two and three words, mined on a weighted de Bruijn graph.

Texts, with A-Z lowered, are cut into pieces at ``.,;:!?`` and the ASCII line breaks, and pieces into words at space and tab. All
counts are per language; a null language is ``und``. Nodes of the graph are pairs of words, and an edge joins the two pairs
of three consecutive words; its weight is the number of times that the three stand in a piece.

* Only the longest grams are counted: every word of a piece begins one gram, of three words or of as many as the piece has left.
  Those shortened by the end of a piece are the corrections. The count of a pair is the weight that flows out of its node plus
  the pieces that end in it; the count of a word is what flows out of the nodes that begin with it plus the pieces that end in it.
* Grams are combined within blocks of text, then dealt out by the shortest prefix (one word, two, all three) that is not
  common, so a word, or a pair, that makes up a large part of the corpus is divided by what follows it. Which prefixes are
  common is read off a share of the documents; it decides where rows go, never what is counted. Sums of pairs and words
  need no further shuffle of all grams: only what was divided, and what reaches ``least``, is summed again.
* Unary paths: where all the weight of a node leaves by one edge, or comes in by one, the node is contracted into the edge: its
  pair lies inside a phrase that is as frequent, and is never looked up or scored. The same holds for any pair of which an edge
  at either side has ``share`` percent. Phrases have three words at most, so the texts of longer paths are not put together.

Candidates are phrases of two or three words with ``least`` occurrences. A phrase of count a, cut after its first k words into
parts of counts l and r, scores floor(1000000 a a / (l r)); the cut with the lowest score counts, the first of equals.

Cases: a null or empty text has no words; a language may be any string; repeated rows count each time; columns beside text and
language are not read; a very long text is counted in parts of whole pieces; counts may reach 10^16 (products are decimals of 38 digits); an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from harvestline.llm.common import buffers, reachable, stored, text_of

LEAST = 10
SHARE = 50
TOP = 2000
SCALE = 1_000_000
#: Separates the language and the words of a gram; no word holds it.
SEP = "\n"
BLOCK_BYTES, MOST_BYTES = 4 << 20, 32 << 20
#: One document in so many is read to find common prefixes, and a prefix is common from this share of the grams on, so
#: there are at most 2 / COMMON_SHARE of them.
SAMPLE = 50
COMMON_SHARE, COMMON_LEAST = 1e-4, 5
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
TABLE = bytes.maketrans(bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" ")
GRAMS = "part int, gram string, n bigint"


def grams(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts (after a line break and an empty word), the distinct grams as rows of three word numbers
    (1, the empty word, where a gram is shorter), and how often each occurs."""
    tokens = b"\n".join(texts).translate(TABLE).replace(b"\n", b" \n ").split(b" ")
    coded = pa.array([b"\n", b"", *tokens, b"\n", b"\n"], pa.binary()).dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)[2:]
    ids = np.maximum(ids[ids != 1], 1)  # a line break becomes the empty word
    a, b, c = ids[:-2], ids[1:-1], np.where(ids[1:-1] == 1, 1, ids[2:])
    begins, n = a != 1, len(coded.dictionary)
    pairs, pair = np.unique(a[begins] * n + b[begins], return_inverse=True)
    whole, counts = np.unique(pair * n + c[begins], return_counts=True)
    first = pairs[whole // n] if len(pairs) else whole
    return coded.dictionary.cast(pa.string()), np.stack((first // n, first % n, whole % n), axis=1), counts


def _gram_rows(lang: str, texts: list[bytes], common: frozenset[str]) -> pa.RecordBatch:
    """``part, gram, n``: the two low bits of ``part`` tell how many words, less one, the prefix has that the gram is dealt by."""
    words, rows, counts = grams(texts)
    gram = pc.binary_join_element_wise(pa.scalar(lang), *(words.take(pa.array(rows[:, k])) for k in range(3)), SEP)
    own = words.to_pylist()
    code = np.array([zlib.crc32(w.encode()) for w in own], np.int64)
    level = np.zeros(len(rows), np.int64)
    if common:
        hot = np.array([f"{lang}{SEP}{w}" in common for w in own])
        wide = np.flatnonzero(hot[rows[:, 0]])
        pairs, where = np.unique(rows[wide, 0] * len(own) + rows[wide, 1], return_inverse=True)
        hot_pair = np.array([f"{lang}{SEP}{own[p // len(own)]}{SEP}{own[p % len(own)]}" in common for p in pairs.tolist()], np.int64)
        level[wide] = 1 + hot_pair[where]
    deal = code[rows[:, 0]] ^ zlib.crc32(lang.encode())
    for k in (1, 2):
        deal = np.where(level >= k, deal * 0x01000193 & 0xFFFFFFFF ^ code[rows[:, k]], deal)
    part = (deal & 0x0FFFFFFF) << 2 | level
    return pa.record_batch([pa.array(part.astype(np.int32)), gram, pa.array(counts.astype(np.int64))], names=["part", "gram", "n"])


def parts(text: bytes) -> Iterator[bytes]:
    """A text cut into parts of whole pieces, of about BLOCK_BYTES unless a piece is longer."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        cut = max(text.rfind(b, at, at + BLOCK_BYTES) for b in BREAKS)
        if cut < 0:
            cut = min((k for b in BREAKS if (k := text.find(b, at + BLOCK_BYTES)) >= 0), default=-1)
        if cut < 0:
            break
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def _counter(common: frozenset[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(langs: list[str]) -> Iterator[pa.RecordBatch]:
            for lang in langs:
                del size[lang]
                yield _gram_rows(lang, held.pop(lang), common)

        for batch in batches:
            data, starts = buffers(batch["body"])
            for k, lang in enumerate(batch["lang"].to_pylist()):
                for text in parts(data[starts[k]:starts[k + 1]].tobytes()):
                    held.setdefault(lang, []).append(text)
                    size[lang] = size.get(lang, 0) + len(text)
                    if size[lang] >= BLOCK_BYTES:
                        yield from flush([lang])
            if sum(size.values()) >= MOST_BYTES:  # many languages
                yield from flush(list(held))
        yield from flush(list(held))

    return count


def without_last(fields: int) -> Column:
    """The gram without its last fields, whatever the language is made of."""
    return F.left(F.col("gram"), F.length("gram") - F.length(F.substring_index("gram", SEP, -fields)) - 1)


def common_prefixes(texts: DataFrame) -> frozenset[str]:
    """Words and pairs, with their language, that begin a large share of the grams: a bounded number."""
    some = texts.where(F.pmod(F.xxhash64("lang", "body"), F.lit(SAMPLE)) == 0).mapInArrow(_counter(frozenset()), GRAMS)
    some = stored(some.groupBy("gram").agg(F.sum("n").alias("n")), "phrase-sample")
    total = some.agg(F.sum("n")).first()[0] or 0
    least = max(COMMON_LEAST, COMMON_SHARE * total)
    out: set[str] = set()
    for fields in (2, 1):
        counts = some.groupBy(without_last(fields).alias("prefix")).agg(F.sum("n").alias("n"))
        out |= {r.prefix for r in counts.where(F.col("n") >= least).select("prefix").collect()}
    return frozenset(out)


def graph(texts: DataFrame, least: int) -> DataFrame:
    """``size, gram, n``: all edges (3), pairs (2) and words (1) that occur ``least`` times, and the words of each language (0)."""
    rows = texts.mapInArrow(_counter(common_prefixes(texts)), GRAMS).repartition("part")
    level = F.col("part").bitwiseAND(F.lit(3))
    edges = rows.groupBy("part", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)

    def flow(size: int) -> DataFrame:
        """Weight that leaves the prefixes of so many words. It is whole unless the prefix was divided."""
        return rows.groupBy("part", without_last(3 - size).alias("gram")).agg(F.sum("n").alias("n"))

    pairs = flow(2).where((level == 2) | (F.col("n") >= least))
    # no condition on grams alone before this table: it would move below the shuffle and make it another one for each branch
    sized = lambda df, size: df.select(F.lit(size).alias("size"), level.alias("level"), "gram", "n")
    found = stored(sized(edges, 3).union(sized(pairs, 2)).union(sized(flow(1), 1)), "phrase-grams")
    total = found.where("size = 1").select(F.lit(0).alias("size"), without_last(1).alias("gram"), "n")
    whole = F.when(F.col("size") == 1, (F.col("level") >= 1) | (F.col("n") >= least)).otherwise(~F.col("gram").endswith(SEP))
    small = found.where(whole).select("size", "gram", "n")  # a shorter gram is no edge, and its first words no pair
    summed = small.union(total).groupBy("size", "gram").agg(F.sum("n").alias("n"))
    return stored(summed.where((F.col("size") == 0) | (F.col("n") >= least)), "phrase-graph")


def part_of(size: int, begin: int, end: int) -> Column:
    """The words ``begin`` to ``end`` of a gram of ``size`` words, with its language, as a gram of their own."""
    words = F.substring_index(F.substring_index("gram", SEP, begin - size), SEP, end - begin)
    return F.concat(without_last(size), F.lit(SEP), words)


def contracted(pairs: DataFrame, edges: DataFrame, share: int) -> DataFrame:
    """The pairs of which no edge at either side has ``share`` percent of their count.

    A node within a unary path gives all its weight to one edge, so it is among those that go.
    """
    ends = edges.select(part_of(3, 0, 2).alias("gram"), "n").union(edges.select(part_of(3, 1, 3).alias("gram"), "n"))
    heaviest = stored(ends.groupBy("gram").agg(F.max("n").alias("top")), "phrase-heaviest")
    joined = pairs.join(heaviest, "gram", "left")
    return joined.where(F.col("top").isNull() | (100 * F.col("top") < share * F.col("n"))).select("gram", "n")


def _score(a: str, left: str, right: str) -> Column:
    square = f"cast({a} as decimal(16, 0)) * cast({a} as decimal(16, 0))"
    return F.expr(f"({SCALE} * ({square})) div (cast({left} as decimal(18, 0)) * cast({right} as decimal(18, 0)))")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language."""
    reachable(df.sparkSession)
    texts = df.select(F.coalesce(df[lang].cast("string"), F.lit("und")).alias("lang"), text_of(df, text).alias("body")).where("body <> ''")
    counts = graph(texts, least)
    counted = {k: counts.where(F.col("size") == k).select("gram", "n") for k in range(4)}

    def with_counts(phrases: DataFrame, size: int, cut: int) -> DataFrame:
        """``l`` and ``r`` of the cut after so many words, and its score."""
        for name, begin, end in (("l", 0, cut), ("r", cut, size)):
            parts = counted[end - begin].select(F.col("gram").alias("__part"), F.col("n").alias(f"{name}{cut}"))
            phrases = phrases.join(parts, part_of(size, begin, end) == F.col("__part")).drop("__part")
        return phrases.withColumn(f"score{cut}", _score("a", f"l{cut}", f"r{cut}"))

    def finished(phrases: DataFrame, size: int, k: Column) -> DataFrame:
        words = F.translate(F.substring_index("gram", SEP, -size), SEP, " ")
        picked = [F.when(k == 1, F.col(f"{c}1")).otherwise(F.col(f"{c}{size - 1}")).alias(c) for c in ("l", "r", "score")]
        return phrases.select(without_last(size).alias("lang"), words.alias("phrase"), "a", *picked)

    two = with_counts(stored(contracted(counted[2], counted[3], share), "phrase-pairs").withColumnRenamed("n", "a"), 2, 1)
    three = with_counts(with_counts(counted[3].withColumnRenamed("n", "a"), 3, 1), 3, 2)
    scored = finished(two, 2, F.lit(1)).union(finished(three, 3, F.when(F.col("score1") <= F.col("score2"), 1).otherwise(2)))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    totals = counted[0].select(F.col("gram").alias("lang"), "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])
