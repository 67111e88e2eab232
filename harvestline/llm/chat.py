"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by a template, encoded once with character offsets, and the loss mask follows from
intersecting the sorted spans of assistant texts with the sorted spans of tokens by binary search.

Template, by role: ``<s>[SYS] text [/SYS]``, ``[INST] text [/INST]``, `` text </s>`` for the assistant, and
``[ROLE:name] text [/ROLE]`` for any other role. A backslash, and a bracket that begins a control string inside a text or
a role name, gets a backslash before it; reading back takes it away.

Cases: null texts and roles are empty; a null conversation id is a conversation of its own; turns are put in order by
turn (null first), then role, then text, and repeated rows stay; further columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harvestline.llm.common import sha256

LOSS_ROLE = "assistant"
FRAMES = {"system": ("<s>[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), LOSS_ROLE: (" ", " </s>")}
OTHER_END = " [/ROLE]"
NEEDS_ESCAPE = re.compile(r"\\|[<\[](?=/?(?:s>|INST\]|SYS\]|ROLE[:\]]))")
ESCAPED = re.compile(r"\\(.)", re.S)
OPENING = re.compile(r"<s>\[SYS\] |\[INST\] |\[ROLE:((?:\\.|[^\]\\])*)\] | ", re.S)
CLOSING = re.compile(r"(?:\\.|[^\\])*?( \[/SYS\]| \[/INST\]| </s>| \[/ROLE\])", re.S)
FORMATTED = ("conv_id", "n_turns", "formatted", "token_ids", "loss_mask", "loss_spans")
#: Characters encoded at once: the encoder holds over a hundred bytes for each, and its time grows faster than a text's length.
PIECE = 1 << 16
#: Characters of the conversations that are put out as one array.
OUTPUT = 1 << 21
#: A pre-tokenizer that splits by the default expression never joins white space to a character before it that is none.
CUT = re.compile(r"(?<=[^\s\u180e])[ \n]")


def escape(text: str) -> str:
    return NEEDS_ESCAPE.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, tail = FRAMES.get(role) or (f"[ROLE:{escape(role).replace(']', chr(92) + ']')}] ", OTHER_END)
        body = escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, tail)
        at += len(head) + len(body) + len(tail)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    roles = {tail: role for role, (_, tail) in FRAMES.items()}
    while at < len(formatted):
        head = OPENING.match(formatted, at)
        end = CLOSING.match(formatted, head.end())
        tail = end.group(1)
        role = unescape(head.group(1) or "") if tail == OTHER_END else roles[tail]
        turns.append((role, unescape(formatted[head.end():end.end() - len(tail)])))
        at = end.end()
    return turns


def align(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The tokens that overlap a span, and the parts of the spans that tokens cover, merged.

    Token spans are sorted, and tokens that share one character bear the same offsets. Two binary searches per span give
    the tokens that overlap it.
    """
    mask, covered = np.zeros(len(starts), bool), []
    low, high = np.asarray(spans, np.int32).reshape(-1, 2).T
    # All spans in one call: each call may copy the tokens, which takes quadratic time in a long conversation.
    firsts, lasts = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
    for (a, b), first, last in zip(spans, firsts, lasts, strict=True):
        mask[first:last] = True
        lows, highs = np.maximum(starts[first:last], a), np.minimum(ends[first:last], b)
        if not len(lows):
            continue
        reach = np.maximum.accumulate(highs)
        cuts = np.flatnonzero(lows[1:] > reach[:-1]) + 1
        for i, k in zip([0, *cuts], [*cuts, len(lows)], strict=True):
            covered.append((int(lows[i]), int(reach[k - 1])))
    return mask, covered


@lru_cache(maxsize=2)
def _tokenizer(spec: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.encode_special_tokens = True
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def _cuttable(spec: str) -> bool:
    """Whether a text may be encoded in pieces: nothing in the tokenizer looks beyond the words of its pre-tokenizer."""
    t = json.loads(spec)
    before = t.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    return plain and not (t.get("normalizer") or t.get("post_processor")) and all(x["special"] for x in t.get("added_tokens") or [])


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[int, str]]:
    """Parts of ``size`` characters or a little more, with their offsets, cut before white space that follows something else."""
    low = 0
    while low < len(text):
        cut = CUT.search(text, low + size)
        high = cut.start() if cut else len(text)
        yield low, text[low:high]
        low = high


def encode(spec: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and the offsets (start, end) of the tokens, as one encoding of the whole text gives them."""
    tokenizer, ids, offsets = _tokenizer(spec), [np.zeros(0, np.int32)], [np.zeros((0, 2), np.int32)]
    for at, part in pieces(text) if _cuttable(spec) else [(0, text)]:
        encoded = tokenizer.encode(part, add_special_tokens=False)
        ids.append(np.asarray(encoded.ids, np.int32))
        offsets.append(np.asarray(encoded.offsets, np.int32).reshape(-1, 2) + np.int32(at))
    return np.concatenate(ids), np.concatenate(offsets)


def _formatter(spec: str):
    schema = "n_turns long, formatted string, token_ids array<int>, loss_mask array<boolean>, loss_spans array<struct<start:int,end:int>>"

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for conversations in batches:
            count, texts, ids, masks, spans_of, size = [], [], [], [], [], 0
            for turns in conversations:
                turns = turns.as_py()
                text, spans = render([(t["role"] or "", t["text"] or "") for t in turns])
                tokens, offsets = encode(spec, text)
                mask, covered = align(offsets[:, 0], offsets[:, 1], spans)
                count.append(len(turns))
                texts.append(text)
                ids.append(tokens)
                masks.append(mask)
                spans_of.append(np.asarray(covered, np.int32).reshape(-1, 2))
                size += len(text)
                if size >= OUTPUT:
                    yield arrays(count, texts, ids, masks, spans_of)
                    count, texts, ids, masks, spans_of, size = [], [], [], [], [], 0
            yield arrays(count, texts, ids, masks, spans_of)

    def arrays(count: list, texts: list, ids: list, masks: list, spans_of: list) -> pa.Array:
        joined = lambda parts, empty: np.concatenate(parts) if parts else empty
        ends = lambda parts: pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
        pairs = joined(spans_of, np.zeros((0, 2), np.int32))
        spans = pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["start", "end"])
        return pa.StructArray.from_arrays(
            [pa.array(count, pa.int64()), pa.array(texts, pa.string()),
             pa.ListArray.from_arrays(ends(ids), pa.array(joined(ids, np.zeros(0, np.int32)))),
             pa.ListArray.from_arrays(ends(masks), pa.array(joined(masks, np.zeros(0, bool)))),
             pa.ListArray.from_arrays(ends(spans_of), spans)], list(FORMATTED[1:]))

    return F.arrow_udf(run, schema)


def format_conversations(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per conversation of a table ``conv_id, turn, role, text``.

    Returns ``conv_id, n_turns, formatted, token_ids, loss_mask, loss_spans``; a token has loss if it overlaps an
    assistant text, and the spans are the characters of ``formatted`` under the mask that belong to assistant texts.
    ``tokenizer`` is the path of a byte-level tokenizers file.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows = turns.select("conv_id", F.struct("turn", "role", "text").alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    out = grouped.select("conv_id", _formatter(spec)(F.col("turns")).alias("r"))
    return out.select("conv_id", *[F.col("r")[n].alias(n) for n in FORMATTED[1:]])


def _read_digests(formatted: pa.Array, spans: pa.Array) -> pa.Array:
    """Digests of what a formatted conversation and its loss spans say when they are read back, one conversation at a time."""
    out = []
    for text, parts in zip(formatted, spans, strict=True):
        text, parts = text.as_py(), parts.as_py()
        turns = read_back(text)
        loss = "".join(unescape(text[s["start"]:s["end"]]) for s in parts)
        out.append({"turns_sha256": sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()), "loss_chars": len(loss),
                    "loss_sha256": sha256(loss.encode()), "n_read": len(turns)})
    return pa.array(out, pa.struct([("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                                    ("n_read", pa.int64())]))


def read_digests(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """``turns_sha256, loss_chars, loss_sha256, n_read`` of formatted rows, read back from them."""
    run = F.arrow_udf(_read_digests, "turns_sha256 string, loss_chars long, loss_sha256 string, n_read long")
    return run(F.col(formatted), F.col(spans))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", text), (-1, 1, LOSS_ROLE, text)], "conv_id long, turn long, role string, text string")
