import os
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402
import test_jaccard_join as near  # noqa: E402
import test_line_dedup as lines  # noqa: E402
from harvestline.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF, "documents").toPandas()]
    docs = table(spark, SF, "documents")
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).toArrow())
        out.append(docs.toPandas())
    return out


def test_each_stage_against_a_plain_version(stages, spark):
    raw, good, short, single, clean, tokens = stages
    assert all(list(s.columns) == list(P.COLUMNS) for s in stages[:-1])
    labels = table(spark, SF, "labels").toPandas()
    kept = labels[labels.doc_id.isin(good.doc_id)]
    assert (kept.quality == 1).mean() > 0.9 and kept.quality.sum() >= 0.95 * labels.quality.sum()

    want = lines.brute_long([(r.doc_id, r.text) for r in good.itertuples()], 2, 50)
    assert {r.doc_id: r.text for r in short.itertuples()} == {k: v[0] for k, v in want.items()}
    assert (short.n_chars == short.text.str.len()).all()

    classes = near.brute([(r.doc_id, r.text) for r in short.itertuples()])
    assert sorted(single.doc_id) == sorted(set(classes.values()))

    words = lambda t: " " + " ".join(__import__("re").findall(r"[^\W_]+", t.lower())) + " "
    items = [words(t) for t in table(spark, SF, "benchmark").toPandas().text]
    leaked = {r.doc_id for r in single.itertuples() if any(i in words(r.text) for i in items)}
    assert set(clean.doc_id) == set(single.doc_id) - leaked and leaked

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_padding()
    library.no_truncation()
    by = dict(zip(clean.doc_id, clean.text, strict=True))
    for r in tokens.itertuples():
        assert np.frombuffer(r.token_ids, "<u4").tolist() == library.encode(by[r.doc_id], add_special_tokens=False).ids
    assert sorted(tokens.doc_id) == sorted(by)


def test_stages_take_empty_tables_and_nulls(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, "s", 0)], docs.schema)
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, odd.withColumn("score", F.lit(1)), SF).count() <= 2
