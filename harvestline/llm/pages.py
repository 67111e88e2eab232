"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks, in page order. A block is described by the names on its tag path (tags, and the words of
their class, id and role attributes), the words of its text, its length, and how much of it is link text; names and words
are hashed to learned vectors. A bidirectional LSTM in numpy reads the whole sequence and labels each block, so a block is
judged by all that surrounds it. The blocks labelled as main text are the result.

Training needs no labelled pages. On up to ``max_pages`` pages with an ``article`` or ``main`` element, what stands in it
and not in an element for other ends is main text. Each such page is also rebuilt in other frames: the same main blocks in
containers of other names, among menus, sidebars, notices, adverts, forms and comments made of texts of the sample, so
that the labels follow from path, words and neighbours, whatever a site calls its elements.

Blocks: block elements end a block, ``br`` is white space; contents of script, style and similar elements, comments and
declarations are no text. Unclosed elements are tolerated: an end tag closes what stands open in its element, and a new
block closes an open paragraph. Character references are decoded, white space becomes one space.

Cases: null, empty or unparsable pages have the text ''; repeated rows get the same text; columns named like outputs are
replaced; without a page to learn from, the names of main elements decide the labels alone.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harvestline.llm.common import sample_keys, with_struct

NAMES, WORDS, NAME_DIM, WORD_DIM, HIDDEN = 2048, 2048, 16, 6, 20
BATCH = 64
OUTPUTS = ("text", "n_chars")

# Element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object select option datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
MAIN = frozenset("article main".split())
OTHER = frozenset("nav header footer aside form button menu dialog".split())
PARAGRAPH_ENDS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                           "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt tr td th".split())

# A tag goes on over quoted values; a quote that nothing closes is a character like any other, so the tag ends at the next ">".
# Nothing that was matched is given back: the time is in proportion to the page.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    link_share: float


def parse(page: str) -> list[Block]:
    """The leaf blocks of a page."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = [0]

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            path = tuple(n for tag, names in stack if tag not in INLINE for n in names)
            blocks.append(Block(path, text, min(1.0, linked[0] / len(text))))
        parts.clear()
        linked[0] = 0

    at, raw = 0, None
    while at <= len(page):
        if raw is not None:
            end = re.compile(rf"</{re.escape(raw)}[\s/>]", re.I).search(page, at)
            at, raw = (end.start() if end else len(page) + 1), None
            continue
        m = TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece:
            parts.append(piece)
            if any(tag == "a" for tag, _ in stack):
                linked[0] += len(piece)
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break  # an inline end tag closes nothing outside its block
            continue
        if tag in RAW:
            raw = None if m.group(0).endswith("/>") else tag
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if tag in PARAGRAPH_ENDS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag not in VOID:
            names = [tag]
            if "=" in m.group(3):
                for kind, *values in ATTRIBUTE.findall(m.group(3)):
                    names += [f".{w.lower()}" for w in NAME.findall("".join(values))]
            stack.append((tag, tuple(names)))
    flush()
    return blocks


def weak_labels(blocks: list[Block]) -> np.ndarray | None:
    """Whether blocks stand in an element for main text and in none for other ends; ``None`` for a page without one."""
    out = np.array([any(n in MAIN for n in b.path) and not any(n in OTHER for n in b.path) for b in blocks], bool)
    return out if out.any() else None


# Features


def hashed(name: str, size: int) -> int:
    return zlib.crc32(name.encode()) % size


def features(blocks: list[Block]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """All hashed path names, all hashed words and numbers for each block."""
    names, words = [], []
    numbers = np.zeros((len(blocks), 3), np.float32)
    for k, b in enumerate(blocks):
        w = b.text.lower().split()
        names.append(np.array([hashed(n, NAMES) for n in (*b.path, f"leaf:{b.path[-1] if b.path else ''}")], np.int32))
        words.append(np.array([hashed(x, WORDS) for x in w], np.int32))
        numbers[k] = np.log1p(len(b.text)) / 8, b.link_share, 1 / (1 + len(w))
    return names, words, numbers


# The network


@dataclass
class Labeller:
    names: np.ndarray
    words: np.ndarray
    forward_x: np.ndarray
    forward_h: np.ndarray
    forward_b: np.ndarray
    back_x: np.ndarray
    back_h: np.ndarray
    back_b: np.ndarray
    out: np.ndarray
    out_b: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]


def new_labeller(rng: np.random.Generator) -> Labeller:
    size = NAME_DIM + WORD_DIM + 3
    f = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    bias = lambda: np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype(np.float32)
    return Labeller(f(NAMES, NAME_DIM, scale=0.3), f(WORDS, WORD_DIM, scale=0.1), f(size, 4 * HIDDEN, scale=size**-0.5),
                    f(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5), bias(), f(size, 4 * HIDDEN, scale=size**-0.5),
                    f(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5), bias(), f(2 * HIDDEN, scale=0.2), np.zeros(1, np.float32))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


Ids = tuple[np.ndarray, np.ndarray]  # the ids of all places one after another, and how many each place has


def padded(rows: list[tuple[list[np.ndarray], list[np.ndarray], np.ndarray]]) -> tuple[tuple[Ids, Ids, np.ndarray], np.ndarray]:
    """Sequences side by side: time x page; and which places are filled."""
    longest, none = max(len(r[2]) for r in rows), np.zeros(0, np.int32)
    ids = []
    for k in (0, 1):
        own = [r[k][t] if t < len(r[k]) else none for t in range(longest) for r in rows]
        ids.append((np.concatenate(own), np.array([len(x) for x in own])))
    numbers = np.zeros((longest, len(rows), 3), np.float32)
    mask = np.zeros((longest, len(rows), 1), np.float32)
    for j, r in enumerate(rows):
        numbers[:len(r[2]), j] = r[2]
        mask[:len(r[2]), j] = 1
    return (*ids, numbers), mask


def summed(table: np.ndarray, ids: Ids) -> np.ndarray:
    """The sum of the vectors of each place."""
    flat, sizes = ids
    out, filled = np.zeros((len(sizes), table.shape[1]), np.float32), np.flatnonzero(sizes)
    if len(filled):
        out[filled] = np.add.reduceat(table[flat], np.r_[0, np.cumsum(sizes[filled])[:-1]])
    return out


def embed(net: Labeller, parts: tuple[Ids, Ids, np.ndarray]) -> np.ndarray:
    names, words, numbers = parts
    n, w = summed(net.names, names), summed(net.words, words) / np.maximum(1, words[1])[:, None]
    at = lambda v: v.reshape(*numbers.shape[:2], -1)
    return np.concatenate([at(n), at(w), numbers], axis=2).astype(np.float32)


def lstm(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states, and what the backward pass needs. Padded steps carry the state on."""
    h, c = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
    zx, states, tape = x @ wx + b, np.empty((*x.shape[:2], HIDDEN), np.float32), []
    for t in range(len(x)):
        z = zx[t] + h @ wh
        gates = sigmoid(z[:, :3 * HIDDEN])
        i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
        inner = f * c + i * g
        squashed = np.tanh(inner)
        tape.append((h, c, i, f, o, g, squashed))
        m = mask[t]
        h, c = m * (o * squashed) + (1 - m) * h, m * inner + (1 - m) * c
        states[t] = h
    return states, tape


def lstm_back(d_states: np.ndarray, x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, tape: list) -> tuple:
    dh, dc = np.zeros_like(d_states[0]), np.zeros_like(d_states[0])
    dz = np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
    d_wh = np.zeros_like(wh)
    for t in range(len(x) - 1, -1, -1):
        h, c, i, f, o, g, squashed = tape[t]
        m = mask[t]
        dh = dh + d_states[t]
        new_h, new_c = m * dh, m * dc
        inner = new_c + new_h * o * (1 - squashed**2)
        dz[t] = np.concatenate([inner * g * i * (1 - i), inner * c * f * (1 - f), new_h * squashed * o * (1 - o), inner * i * (1 - g**2)], axis=1)
        d_wh += h.T @ dz[t]
        dh = (1 - m) * dh + dz[t] @ wh.T
        dc = (1 - m) * dc + inner * f
    flat = dz.reshape(-1, 4 * HIDDEN)
    return dz @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, d_wh, flat.sum(0)


def run(net: Labeller, parts: tuple[Ids, Ids, np.ndarray], mask: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logits of the blocks. The backward direction reads the padding first, which leaves its state as it is."""
    x = embed(net, parts)
    ahead, tape_a = lstm(x, mask, net.forward_x, net.forward_h, net.forward_b)
    back, tape_b = lstm(x[::-1], mask[::-1], net.back_x, net.back_h, net.back_b)
    both = np.concatenate([ahead, back[::-1]], axis=2)
    return both @ net.out + net.out_b[0], (x, both, tape_a, tape_b)


def label(net: Labeller | None, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks are main text."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    if net is None:
        for k, blocks in enumerate(pages):
            found = weak_labels(blocks)
            out[k] = found if found is not None else np.zeros(len(blocks), bool)
        return out
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    low = 0
    while low < len(order):
        # pages of like length together; very long ones in small groups
        high = low + 1
        while high < len(order) and high - low < BATCH and len(pages[order[high]]) * (high - low + 1) <= 16_384:
            high += 1
        own = order[low:high]
        logits, _ = run(net, *padded([features(pages[k]) for k in own]))
        for j, k in enumerate(own):
            out[k] = logits[:len(pages[k]), j] > 0
        low = high
    return out


# Training

# Common names of containers on public web pages
MAIN_FRAMES = (("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", ".body"), ("div", ".entry", ".content"),
               ("div", ".article", ".body"), ("section", ".story"), ("div", ".main", "article", ".post"), ("div", ".text"), ("td", ".content"),
               ("div", ".page", ".content"))
OTHER_FRAMES = (("nav",), ("header",), ("footer",), ("aside",), ("div", ".nav"), ("div", ".menu"), ("ul", ".menu"), ("div", ".sidebar"), ("aside", ".sidebar"),
                ("div", ".footer"), ("div", ".header"), ("div", ".ad"), ("div", ".ads"), ("div", ".advert"), ("div", ".advertisement"), ("div", ".banner"),
                ("div", ".cookie", ".notice"), ("div", ".cookie", ".banner"), ("div", ".notice"), ("div", ".consent"), ("div", ".popup"), ("form",), ("form", ".search"), ("form", ".newsletter"),
                ("div", ".newsletter"), ("div", ".subscribe"), ("section", ".comments"), ("div", ".comments"), ("div", ".comment"), ("ol", ".comment", ".list"),
                ("div", ".reader", ".comments"), ("div", ".related"), ("div", ".share"), ("div", ".social"), ("div", ".breadcrumb"), ("div", ".promo"), ("div", ".sponsored"),
                ("div", ".copyright"), ("div", ".widget"), ("div", ".pagination"), ("div", ".tags"), ("div", ".author", ".bio"))


def reframed(blocks: list[Block], truth: np.ndarray, texts: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The main blocks of a page in another frame, among other blocks made of the given texts."""
    pick = lambda seq: seq[int(rng.integers(len(seq)))]
    frame = ("html", "body", *pick(MAIN_FRAMES))
    main = [Block((*frame, b.path[-1] if b.path and b.path[-1] in PARAGRAPH_ENDS - MAIN - OTHER else "p"), b.text, b.link_share)
            for b, t in zip(blocks, truth, strict=True) if t]

    def others() -> list[Block]:
        names, out = pick(OTHER_FRAMES), []
        linked = names[-1] in ("nav", ".nav", ".menu", ".related", ".share", ".social", ".breadcrumb", ".tags", ".pagination") or rng.random() < 0.2
        leaf = ("ul", "li") if linked else (pick((("p",), ("div",), (), ("li",), ("span",), ("p",))))
        for _ in range(int(rng.integers(1, 8)) if linked or "comment" in "".join(names) else int(rng.integers(1, 3))):
            words = pick(texts).split()
            size = int(rng.integers(1, 4)) if linked else int(rng.integers(2, 40))
            first = int(rng.integers(max(1, len(words) - size)))
            out.append(Block(("html", "body", *names, *(n for n in leaf if n != "span")), " ".join(words[first:first + size]), float(linked)))
        return out

    page, flags = [], []
    def put(rows: list[Block], flag: bool) -> None:
        page.extend(rows)
        flags.extend([flag] * len(rows))

    for _ in range(int(rng.integers(1, 5))):
        put(others(), False)
    cut = int(rng.integers(len(main) + 1)) if rng.random() < 0.4 else len(main)
    put(main[:cut], True)
    if cut < len(main):  # something stands between the paragraphs, in the frame of the main text
        put([Block((*frame, *b.path[2:]), b.text, b.link_share) for b in others()], False)
        put(main[cut:], True)
    for _ in range(int(rng.integers(1, 5))):
        put(others(), False)
    return page, np.array(flags)


def train(pages: list[str], seed: int = 3, frames: int = 4, passes: int = 5, batch: int = 16, rate: float = 8e-3, most_blocks: int = 160) -> Labeller | None:
    """Fit a labeller; of training pages with more than ``most_blocks`` blocks, a run of so many is used in a pass."""
    rng = np.random.default_rng(seed)
    known = [(b, t) for b in map(parse, pages) if b and (t := weak_labels(b)) is not None]
    if not known:
        return None
    texts = [b.text for blocks, _ in known for b in blocks if len(b.text) > 1]
    rows = list(known)
    for _ in range(frames):
        rows += [reframed(b, t, texts, rng) for b, t in known]
    data = [(features(b), t) for b, t in rows]
    net = new_labeller(rng)
    params = net.parameters()
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    passes = max(passes, -(-300 // -(-len(data) // batch)))
    total = passes * -(-len(data) // batch)
    for _ in range(passes):
        # batches of pages of like length, in any order
        order = sorted(range(len(data)), key=lambda k: len(data[k][1]) + rng.integers(0, 10))
        batches = [order[k:k + batch] for k in range(0, len(order), batch)]
        rng.shuffle(batches)
        for own in batches:
            picked, truth = [], []
            for k in own:
                f, t = data[k]
                a = int(rng.integers(max(1, len(t) - most_blocks + 1)))
                picked.append(tuple(x[a:a + most_blocks] for x in f))
                truth.append(t[a:a + most_blocks])
            parts, mask = padded(picked)
            logits, (x, both, tape_a, tape_b) = run(net, parts, mask)
            target = np.zeros_like(logits)
            for j, t in enumerate(truth):
                target[:len(t), j] = t
            d = ((sigmoid(logits) - target) * mask[..., 0] / mask.sum()).astype(np.float32)
            d_both = d[..., None] * net.out
            da, *ga = lstm_back(d_both[..., :HIDDEN], x, mask, net.forward_x, net.forward_h, tape_a)
            db, *gb = lstm_back(d_both[::-1, :, HIDDEN:], x[::-1], mask[::-1], net.back_x, net.back_h, tape_b)
            dx = da + db[::-1]
            names, words, _ = parts
            d_names, d_words = np.zeros_like(net.names), np.zeros_like(net.words)
            rows_of = lambda v, ids: np.repeat(v.reshape(len(ids[1]), -1), ids[1], axis=0)
            np.add.at(d_names, names[0], rows_of(dx[..., :NAME_DIM], names))
            share = dx[..., NAME_DIM:NAME_DIM + WORD_DIM].reshape(-1, WORD_DIM) / np.maximum(1, words[1])[:, None]
            np.add.at(d_words, words[0], rows_of(share, words))
            grads = [d_names, d_words, *ga, *gb, np.einsum("tb,tbh->h", d, both), np.array([d.sum()], np.float32)]
            step += 1
            now = rate * min(1.0, 2 * (1 - step / (total + 1)))
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
            for p, g, a, b in zip(params, grads, m, v, strict=True):
                g = g * min(1.0, 1 / max(norm, 1e-9))
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def main_text(net: Labeller | None, pages: list[str]) -> list[str]:
    parsed = [parse(p) for p in pages]
    return ["\n\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)
            for blocks, kept in zip(parsed, label(net, parsed), strict=True)]


def fit(df: DataFrame, page: str = "html", key: str = "page_id", max_pages: int = 240) -> Labeller | None:
    """Train on up to ``max_pages`` pages, taken by a hash of their key."""
    rows = df.select(F.col(key), F.coalesce(F.col(page), F.lit("")).alias("h")).join(sample_keys(df, key, max_pages, 6), key)
    return train(rows.orderBy(key, "h").limit(max_pages).select("h").toArrow()["h"].to_pylist())


def extract(df: DataFrame, net: Labeller | None, page: str = "html") -> DataFrame:
    """Add ``text`` (the blocks of main text, joined by empty lines) and ``n_chars`` (its code points)."""
    def work(pages: pa.Array) -> pa.Array:
        out: list[str] = []
        for low in range(0, len(pages), 512):
            out += main_text(net, [p or "" for p in pages.slice(low, 512).to_pylist()])
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())], list(OUTPUTS))

    return with_struct(df, F.arrow_udf(work, "text string, n_chars long")(F.col(page)), list(OUTPUTS))
