import random

import numpy as np

from harvestline.llm import chat


def test_round_trip_and_loss(spark):
    random.seed(3)
    pool = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "]", "<", "[ROLE:", "[ROLE", " ", "\n", "é", "日本", "😀", "ab", "[/SYS]", "/"]
    text = lambda: "".join(random.choice(pool) for _ in range(random.randint(0, 9)))
    roles = ["system", "user", "assistant", "tool", "a]b", "", None]
    rows, want = [], {}
    for conv in range(60):
        turns = [(random.choice(roles), random.choice([text(), None])) for _ in range(random.randint(1, 6))]
        want[conv] = [(r or "", t or "") for r, t in turns]
        rows += [(conv, k, r, t, "x") for k, (r, t) in enumerate(turns)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_conversations(df).collect()
    assert len(got) == 60
    for r in got:
        turns = want[r.conv_id]
        assert r.n_turns == len(turns)
        assert chat.read_back(r.formatted) == turns
        loss = "".join(chat.unescape(r.formatted[s.start:s.end]) for s in r.loss_spans)
        assert loss == "".join(t for role, t in turns if role == "assistant")
        assert len(r.token_ids) == len(r.loss_mask)


def test_probe_query_reads_the_texts_back(spark):
    r = chat.format_conversations(chat.probe(spark)).first()
    assert [t for _, t in chat.read_back(r.formatted)] == ["</s>[INST] ok [/INST]"] * 2
    assert "\\</s>\\[INST] ok \\[/INST]" in r.formatted


def test_binary_search_against_marking_every_character():
    rng = np.random.default_rng(0)
    for _ in range(50):
        cuts = np.unique(np.r_[0, rng.integers(1, 60, 12), 60])
        starts, ends = cuts[:-1], cuts[1:]
        a, b = sorted(rng.integers(0, 61, 2))
        mask, covered = chat.align(starts, ends, [(int(a), int(b))])
        assert mask.tolist() == [bool(s < b and e > a) for s, e in zip(starts, ends, strict=True)]
        assert covered == ([(a, b)] if b > a else [])


def test_empty_table_null_ids_and_repeated_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, 0, "user", "a"), (1, None, "user", "b"), (1, None, "user", "b"), (1, 2, "assistant", "long " * 5000)]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert got[None].n_turns == 1 and got[1].n_turns == 3
    assert chat.read_back(got[1].formatted)[2][1] == "long " * 5000


def _spec():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def test_pieces_give_the_tokens_of_the_whole_text(monkeypatch):
    """Cuts fall before white space only, wherever runs of it, other spaces, contractions and control strings lie."""
    random.seed(5)
    pool = [" ", "  ", "\n", "\n\n ", "\t", "\r\n", " ", "　", "​", "᠎", "\x1c", "\x85", "é", "́", "it's", "'ll", "</s>", "<|endoftext|>", "123", "日本", "😀", "-", "word", "\\"]
    spec = _spec()
    for size in (1, 2, 7, 40):
        for _ in range(150):
            text = "".join(random.choice(pool) for _ in range(random.randint(0, 60)))
            assert "".join(part for _, part in chat.pieces(text, size)) == text
            monkeypatch.setattr(chat.pieces, "__defaults__", (size,))
            whole = chat._tokenizer(spec).encode(text, add_special_tokens=False)
            ids, offsets = chat.encode(spec, text)
            assert ids.tolist() == whole.ids and offsets.tolist() == [list(x) for x in whole.offsets]


def test_a_long_conversation_is_not_encoded_at_once(monkeypatch):
    """Memory of the encoder and calls of the span search do not grow with a conversation."""
    spec, sizes, searches = _spec(), [], []
    real, search = chat._tokenizer(spec), np.searchsorted

    class Noted:
        def encode(self, text, **options):
            sizes.append(len(text))
            return real.encode(text, **options)

    monkeypatch.setattr(chat, "_tokenizer", lambda spec: Noted())
    monkeypatch.setattr(chat.np, "searchsorted", lambda *a: searches.append(1) or search(*a))
    text, spans = chat.render([("user" if k % 2 else "assistant", f"turn {k} of many words " * 9) for k in range(3000)])
    ids, offsets = chat.encode(spec, text)
    mask, covered = chat.align(offsets[:, 0], offsets[:, 1], spans)
    assert len(text) > 5 * chat.PIECE and max(sizes) < chat.PIECE + 100 and len(searches) == 2
    assert covered == spans and mask.sum() > len(ids) / 3


def test_other_tokenizers_encode_whole_texts():
    """A tokenizer that puts a space before each text would change the pieces."""
    import json

    spec = json.loads(_spec())
    spec["pre_tokenizer"]["add_prefix_space"] = True
    assert not chat._cuttable(json.dumps(spec)) and chat._cuttable(_spec())
