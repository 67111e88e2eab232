"""Exact BPE encoding in linear time, and decoding through an offset table.

A word is encoded without a merge loop. An Aho-Corasick automaton over the vocabulary gives the longest token at every
position. Going left to right, a token is accepted if it fits the token before it; two tokens fit when merging their
joined text by rank would leave exactly those two. If no token fits, the last one is taken back and a shorter prefix is
tried; a position found to lead nowhere is not entered again, so every position is visited a bounded number of times.

Cases: a null or empty text has no tokens and decodes to the empty text. Strings of special tokens inside a text become
those tokens, as the tokenizer file asks for. Columns of the input that bear an output's name are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from harvestline.llm.common import buffers, sha256, with_struct

END = "\0"
#: Bytes that a memory of encoded pieces may take, by an estimate of ENTRY_BYTES for an entry beside its texts.
CACHED_BYTES, ENTRY_BYTES = 32 << 20, 200
CACHED_LENGTH = 48
CACHED_PAIRS = 100_000
PAIR = 1 << 32
NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shown = set(plain)
    rest = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return [rest.get(b, chr(b)) for b in range(256)]


class Memory(dict):
    """Encoded pieces by their text: a bounded memory in two halves.

    When the newer half is full it becomes the older one, and what is asked for again comes over from there; pieces that are
    met once go, and frequent ones stay.
    """

    def __init__(self, encode):
        self.encode, self.size, self.before = encode, 0, {}

    def __missing__(self, piece: str) -> bytes:
        got = self.before.get(piece)
        if got is None:
            got = self.encode(piece)
        if len(piece) <= CACHED_LENGTH:
            if 2 * self.size >= CACHED_BYTES:
                self.before = dict(self)
                self.clear()
                self.size = 0
            self.size += ENTRY_BYTES + len(piece) + len(got)
            self[piece] = got
        return got


class Vocabulary:
    """Tables for encoding and decoding, made from a tokenizers file of byte-level BPE with word ends."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE model with word ends is expected")
        suffix = model["end_of_word_suffix"]
        kinds = [n["type"] for n in j["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalizer {kinds}")
        pattern = j["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.space = regex.compile(r"\p{White_Space}+")
        self.specials = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        inner = lambda t: t[: -len(suffix)] + END if t.endswith(suffix) else t
        vocab = model["vocab"]
        self.ids = {inner(t): i for t, i in vocab.items()}
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(pairs):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank.setdefault((left, right), r)
            self.made.setdefault(whole, (r, left, right))
        born = lambda t: self.made[t][0] if t in self.made else -1
        if any(r <= max(born(a), born(b)) for r, a, b in self.made.values()):
            raise ValueError("a token is merged before its parts exist")
        text = {i: t for t, i in self.ids.items()}
        self.length = {i: len(t) for i, t in text.items()}
        # a token that merging alone never yields is not usable
        usable = [i for t, i in self.ids.items() if i in self.made or len(t.replace(END, "")) == 1]
        self.machine = ahocorasick.Automaton()
        for i in usable:
            self.machine.add_word(text[i], i)
        self.machine.make_automaton()
        known = {text[i]: i for i in usable}
        self.shorter = {i: next((known[text[i][:k]] for k in range(len(text[i]) - 1, 0, -1) if text[i][:k] in known), None)
                        for i in usable}
        self.alphabet = byte_alphabet()
        self.fits: dict[int, bool] = {}  # by left * PAIR + right
        self.known_words = Memory(self.encode_word)
        self.runs = Memory(self.encode_piece)
        whole = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.specials.items()}}
        parts = [whole.get(i, "").encode() + b" " for i in range(max(whole) + 1)]
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(whole) + 1)]
        self.offsets = np.cumsum([0, *map(len, parts)])
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols at one edge of a token while it is merged, each with the rank that ends it."""
        out, until = [], NEVER
        while True:
            out.append((token, until))
            if token not in self.made:
                return out[::-1]
            until, *parts = self.made[token]
            token = parts[side]

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the merges inside the two tokens."""
        a, b, i, k, ok = self.spine(left, 1), self.spine(right, 0), 0, 0, True
        while True:
            (x, end_x), (y, end_y) = a[i], b[k]
            r = self.rank.get((x, y), NEVER)
            if r < NEVER and r < end_x and r <= end_y:
                ok = False
                break
            if end_x == NEVER and end_y == NEVER:
                break
            if end_x <= end_y:
                i += 1
            else:
                k += 1
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        self.fits[left * PAIR + right] = ok
        return ok

    def encode_word(self, word: str) -> bytes:
        """Ids of one word, given without its end mark."""
        if word.isascii() and word.isprintable() and " " not in word:  # these bytes stand for themselves
            text = word + END
        else:
            alphabet = self.alphabet
            text = "".join([alphabet[b] for b in word.encode()]) + END
        n = len(text)
        longest: list[int | None] = [None] * n
        length, shorter = self.length, self.shorter
        for end, token in self.machine.iter(text):  # by end, so the last one that begins at a place is the longest
            longest[end + 1 - length[token]] = token
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token, last, fits = 0, longest[0], None, self.fits
        while at < n:
            while token is not None:
                if alive[at + length[token]]:
                    if last is None:
                        break
                    ok = fits.get(last * PAIR + token)
                    if self.pair_fits(last, token) if ok is None else ok:
                        break
                token = shorter[token]
            if token is None:
                alive[at] = 0
                if not out:
                    raise ValueError("a word that the vocabulary cannot spell")
                token = out.pop()
                at -= length[token]
                token, last = shorter[token], out[-1] if out else None
                continue
            out.append(token)
            last = token
            at += length[token]
            token = longest[at] if at < n else None
        return b"".join([self.id_bytes[t] for t in out])

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a piece of text that holds no special token."""
        if piece.isascii():
            piece = piece.lower()
            if piece.isalpha():
                return self.known_words[piece]
        else:
            if not unicodedata.is_normalized("NFC", piece):
                piece = unicodedata.normalize("NFC", piece)
            piece = piece.replace("Σ", "σ").lower()  # one character at a time: no final sigma
            if piece.isascii() and piece.isalpha():
                return self.known_words[piece]
        return b"".join([self.known_words[w] for w in self.words.findall(piece)])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        No word, and nothing that normalisation joins, crosses white space, so the runs between white space are encoded
        one by one and remembered. A run with a special token, or a text with the four control characters that Python
        alone splits at, is taken as a whole.
        """
        if self.special is not None and self.special.search(text):
            return b"".join(self.specials[p].to_bytes(4, "little") if k % 2 else self.encode(p)
                            for k, p in enumerate(self.special.split(text)))
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.encode_piece(self.space.sub(" ", unicodedata.normalize("NFC", text)))
        return b"".join(map(self.runs.__getitem__, text.split()))

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens joined by spaces, gathered through the offset table."""
        if not len(ids):
            return b""
        out = []
        for low in range(0, len(ids), 1 << 16):
            part = ids[low:low + (1 << 16)].astype(np.int64)
            first, size = self.offsets[part], self.offsets[part + 1] - self.offsets[part]
            place = np.cumsum(size) - size
            out.append(self.bytes[np.repeat(first - place, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=2)
def vocabulary(spec: str) -> Vocabulary:
    return Vocabulary(spec)


def _encoder(spec: str):
    def encode(texts: pa.Array) -> pa.Array:
        v, tokens = vocabulary(spec), []
        data, starts = buffers(texts)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            tokens.append(v.encode(data[a:b].tobytes().decode()))
        return pa.StructArray.from_arrays([pa.array([len(t) // 4 for t in tokens], pa.int64()), pa.array(tokens, pa.binary())],
                                          ["n_tokens", "token_ids"])

    return F.arrow_udf(encode, "n_tokens long, token_ids binary")


def _decoder(spec: str):
    def decode(tokens: pa.Array) -> pa.Array:
        v = vocabulary(spec)
        return pa.array([v.decode(np.frombuffer(t.as_py() or b"", "<u4")).decode() for t in tokens], pa.string())

    return F.arrow_udf(decode, "string")


def _digests(spec: str):
    def digest(texts: pa.Array) -> pa.Array:
        v, rows = vocabulary(spec), []
        data, starts = buffers(texts)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            ids = v.encode(data[a:b].tobytes().decode())
            rows.append((len(ids) // 4, sha256(ids), sha256(v.decode(np.frombuffer(ids, "<u4")))))
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
                                          if rows else [pa.array([], pa.int64()), pa.array([], pa.string()), pa.array([], pa.string())],
                                          ["n_tokens", "ids_sha256", "decoded_sha256"])

    return F.arrow_udf(digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def read_spec(path: str | None = None) -> str:
    """Text of a tokenizer file; by default the public vocabulary with word ends."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(df: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Add ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit integers)."""
    return with_struct(df, _encoder(read_spec(tokenizer))(F.col(text)), ["n_tokens", "token_ids"])


def decode(df: DataFrame, tokens: str = "token_ids", output: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """Add the text of encoded rows."""
    return df.withColumn(output, _decoder(read_spec(tokenizer))(F.col(tokens)))


def digests(df: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: encode, decode and hash without keeping the tokens."""
    return with_struct(df, _digests(read_spec(tokenizer))(F.col(text)), ["n_tokens", "ids_sha256", "decoded_sha256"])
