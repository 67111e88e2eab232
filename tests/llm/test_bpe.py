import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from harvestline.llm import bpe


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_padding()
    t.no_truncation()
    return t


def texts():
    random.seed(1)
    pool = "aeinTHΣσς İßİé é  \x1c\x85\t\n'stvd 12३'ll're中文ﬁ😀🏽‍_-.,!!"
    out = ["".join(random.choice(pool) for _ in range(random.randint(0, 60))) for _ in range(400)]
    return out + ["a<|endoftext|>B <|startoftext|><|endoftext|>", "", "ΟΔΟΣ ΣΑΣ", "x" * 5000, "th" * 3000, "the cat's 100% DON'T", "  \n "]


def test_equals_the_library(docs, library):
    rows = texts()
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs(rows))).collect()}
    for i, t in enumerate(rows):
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(got[i].token_ids, "<u4").tolist() == ids, t
        assert got[i].n_tokens == len(ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_digests_nulls_and_clashing_names(docs, library):
    import hashlib

    df = docs(["Hello there", None, "Hello there"]).withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "ids_sha256")
    got = sorted(bpe.digests(df).collect(), key=lambda r: r.doc_id)
    ids = library.encode("Hello there", add_special_tokens=False).ids
    assert [r.n_tokens for r in got] == [len(ids), 0, len(ids)]
    assert got[0].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.digests(docs([])).count() == 0


def test_memory_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 2 * bpe.ENTRY_BYTES + 1)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 2)
    v = bpe.Vocabulary(bpe.read_spec())
    text = "one two three four five six one two"
    assert v.encode(text) == bpe.vocabulary(bpe.read_spec()).encode(text)
    assert len(v.runs) <= 3
    assert len(v.fits) <= 2


def test_frequent_pieces_stay_when_the_memory_is_full(monkeypatch):
    """A piece that comes again and again is encoded once, however many others are met once in between."""
    monkeypatch.setattr(bpe, "CACHED_BYTES", 8 * (bpe.ENTRY_BYTES + 16))
    asked = []
    memory = bpe.Memory(lambda piece: asked.append(piece) or piece.encode())
    for k in range(60):
        assert memory["the"] == b"the" and memory[f"once{k}"] == f"once{k}".encode()
        assert len(memory) + len(memory.before) <= 2 * 6
    assert asked.count("the") == 1 and len(asked) == 61
