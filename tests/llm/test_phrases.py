import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from harvestline.llm import phrases
from harvestline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def plain(rows, least=10, share=50, top=2000):
    """Every phrase counted by itself."""
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, words[i:i + size]) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    dropped = {(lang, w[i:i + 2]) for (lang, w), a in candidates.items() if len(w) == 3 for i in (0, 1)
               if 100 * a >= share * counts[lang, w[i:i + 2]]}
    out = []
    for (lang, w), a in candidates.items():
        if (lang, w) in dropped:
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], n[lang], score))
    ranked, place = [], Counter()
    for r in sorted(out, key=lambda r: (-r[6], -r[2], r[1].encode())):
        place[r[0]] += 1
        if place[r[0]] <= top:
            ranked.append((r[0], place[r[0]], *r[1:]))
    return sorted(ranked)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_plain_counts(spark, size):
    sf = SF.replace("sf0.001", size)
    out = QUERIES["op11_collocations"](spark, sf)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert dict(out.dtypes) == {"lang": "string", "phrase": "string"} | dict.fromkeys(["rank", "a", "l", "r", "n", "score"], "bigint")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    want = plain(rows)
    assert collected(out) == want and len(want) > 100


@pytest.fixture
def texts():
    odd = ["a b\x01 c", "a b c", "A\x1cB x", "é É", "a\x00 b"]
    rows = [("en", "The cat sat. the cat sat, on the\tmat!\n the cat  sat")] * 12 + [("en", "the dog sat; the the the the")] * 11
    rows += [("de", "x y z x y z x y"), (None, "x y z"), ("", "x y z"), ("a\nb", "x y z q")] * 10
    return rows + [("fr", t) for t in odd for _ in range(10)] + [("en", None), ("en", ""), ("en", " .,; ")]


@pytest.mark.parametrize("share,top,least", [(50, 2000, 10), (10, 2000, 10), (100, 3, 10), (50, 5, 1)])
def test_odd_texts_languages_and_limits(spark, texts, share, top, least):
    df = spark.createDataFrame(texts, "lang string, text string").withColumns({"n": F.lit("clash"), "gram": F.lit(0), "part": F.lit(1)})
    assert collected(phrases.collocations(df, share=share, top=top, least=least)) == plain(texts, least, share, top)


def test_long_texts_are_cut_between_pieces(texts, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 9)
    for _, text in texts:
        raw = (text or "").encode()
        cut = list(phrases.parts(raw))
        assert b"".join(cut) == raw and all(p[-1] in phrases.BREAKS for p in cut[:-1])
        count = lambda parts: sorted(x for p in parts for x in re.split(b"[.,;:!?\x0a-\x0d]", p) if x)
        assert count(cut) == count([raw])
    assert len(list(phrases.parts(b"a b, c d, e f g h i j k l m n, o"))) == 3


def test_division_of_common_prefixes_changes_nothing(spark, texts, monkeypatch):
    df = spark.createDataFrame(texts, "lang string, text string")
    for common in ([], ["en\nthe"], ["en\nthe", "en\nthe\ncat", "de\nx", "de\nx\ny", "en\nsat", "en\nsat\n"]):
        monkeypatch.setattr(phrases, "common_prefixes", lambda _, c=common: frozenset(c))
        assert collected(phrases.collocations(df)) == plain(texts)


def test_common_prefixes_are_found_and_few(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SAMPLE", 1)
    df = spark.createDataFrame([("en", f"of the w{k} x{k} y{k}") for k in range(400)], "lang string, body string")
    found = phrases.common_prefixes(df)
    assert found == {"en\nof", "en\nthe", "en\nof\nthe"}


def test_counts_beyond_64_bit_products(spark):
    df = spark.createDataFrame([(4 * 10**9, 5 * 10**9, 6 * 10**9)], "a long, l long, r long")
    assert df.select(phrases._score("a", "l", "r").alias("s")).first().s == 10**6 * (4 * 10**9) ** 2 // (30 * 10**18)


def test_grams_are_made_and_shuffled_once(spark, texts, monkeypatch):
    """The counts of edges, pairs and words read one shuffle."""
    plans = {}
    monkeypatch.setattr(phrases, "common_prefixes", lambda _: frozenset())
    monkeypatch.setattr(phrases, "stored", lambda df, label: plans.update({label: df._jdf.queryExecution().executedPlan().toString()}) or df)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        phrases.graph(spark.createDataFrame(texts, "lang string, body string"), 10)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plans["phrase-grams"].count("MapInArrow") == 1 and plans["phrase-grams"].count("ReusedExchange") == 2


def test_empty_table(spark):
    assert spark.createDataFrame([], "lang string, text string").transform(phrases.collocations).count() == 0
