"""Toxicity by non-negative positive-unlabelled learning.

A numpy classifier learns from confirmed toxic texts (P) and unlabelled texts (U) alone. With the class prior p, the risk
of a scorer f under the logistic loss l is estimated as

    p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])

and where the second part, an estimate of the risk on clean texts, falls below zero, the step goes against it instead.

Features are the six-byte strings of the folded text (ASCII letters lowered, other ASCII characters as spaces) whose
count in P is improbable at the rate of clean texts, and whose share in P over that in U is at least half of what a string
seen in toxic texts only would have (1 / p). A text has a feature or has not, so its length and the place of a toxic
passage do not matter. Strings are compared exactly.

The classifier learns on the driver from bounded samples (``max_positive``, ``max_unlabelled``); every document is scored
over its whole text in Arrow batches, a bounded block of bytes at a time.

Cases: null and empty texts have no feature and get the score of such a text; repeated rows get the same score; nulls in
other columns and further columns do not matter; without a confirmed example the score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from harvestline.llm.common import blocks, buffers, sample_keys

WIDTH = 6
BLOCK_BYTES = 1 << 20
FOLD = np.full(256, ord(" "), np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass
class Model:
    grams: np.ndarray  # sorted keys of the features
    weights: np.ndarray
    bias: float


def gram_keys(data: np.ndarray) -> np.ndarray:
    """The key of the string that begins at each byte."""
    codes = FOLD[data].astype(np.int64)
    n = len(codes) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    keys = codes[:n].copy()
    for k in range(1, WIDTH):
        keys <<= 8
        keys |= codes[k:n + k]
    return keys


def framed(text: Column) -> Column:
    """The text between spaces, so that its first and last words have edges."""
    return F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))


def _filter(grams: np.ndarray) -> np.ndarray:
    """A table of hash values that some feature has."""
    table = np.zeros(1 << 20, bool)
    table[_place(grams)] = True
    return table


def _place(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def features(data: np.ndarray, starts: np.ndarray, grams: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a document and a feature that it has, each once."""
    base, end = int(starts[0]), int(starts[-1])
    found_doc, found_gram = [], []
    for low in range(base, end, BLOCK_BYTES):
        keys = gram_keys(data[low:min(end, low + BLOCK_BYTES + WIDTH - 1)])
        at = np.flatnonzero(table[_place(keys)])
        k = np.searchsorted(grams, keys[at])
        ok = grams[np.minimum(k, len(grams) - 1)] == keys[at]
        at, k = at[ok] + low, k[ok]
        doc = np.searchsorted(starts, at, "right") - 1
        inside = at + WIDTH <= starts[doc + 1]
        found_doc.append(doc[inside])
        found_gram.append(k[inside])
    if not found_doc:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.concatenate(found_doc) * len(grams) + np.concatenate(found_gram))
    return pair // len(grams), pair % len(grams)


def document_frequency(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, starts = buffers(texts)
    each = [np.unique(gram_keys(data[a:b])) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return np.unique(np.concatenate(each) if each else np.zeros(0, np.int64), return_counts=True)


def choose(positive: pa.Array, unlabelled: pa.Array, prior: float, least: float = 0.005, most: int = 600, chance: float = 0.01) -> np.ndarray:
    """The strings that stand out in the confirmed examples.

    The share on clean texts is the one in U less the part that toxic texts explain. A string is kept if its count in P
    is improbable at that rate, with regard to how much longer the texts in P are: a Chernoff bound of the Poisson tail, times the number of strings tried,
    under ``chance``. ``least``: the share of P that has it, three texts at least.
    """
    positive, unlabelled = positive.unique(), unlabelled.unique()
    p_keys, p_n = document_frequency(positive)
    u_keys, u_n = document_frequency(unlabelled)
    tried, longer = max(1, len(p_keys)), max(1.0, p_n.sum() / len(positive) / max(1.0, u_n.sum() / len(unlabelled)))
    enough = p_n >= max(3, least * len(positive))
    p_keys, p_n = p_keys[enough], p_n[enough]
    at = np.minimum(np.searchsorted(u_keys, p_keys), max(0, len(u_keys) - 1))
    in_u = np.where(u_keys[at] == p_keys, u_n[at], 0) if len(u_keys) else np.zeros(len(p_keys))
    p_share, u_share = p_n / len(positive), in_u / len(unlabelled)
    clean = np.maximum((u_share - prior * p_share) / (1 - prior), 0.5 / len(unlabelled))
    expected = clean * len(positive) * longer
    tail = np.where(p_n > expected, p_n - expected + p_n * np.log(expected / p_n), 0)
    keep = (tail <= np.log(chance / tried)) & (p_share >= u_share * 0.5 / prior)
    order = np.argsort(tail[keep], kind="stable")[:most]
    return np.sort(p_keys[keep][order])


def class_prior(xp: np.ndarray, xu: np.ndarray, given: float, strongest: int = 20) -> float:
    """The share of toxic texts in U: how much rarer features that only toxic texts have are there than in P."""
    in_p, in_u = xp.mean(0), xu.mean(0)
    top = np.argsort(-in_p, kind="stable")[:strongest]
    return float(np.clip(np.median(in_u[top] / np.maximum(in_p[top], 1e-9)), 0.05 * given, given))


def train(positive: pa.Array, unlabelled: pa.Array, prior: float, rounds: int = 400, rate: float = 0.05, decay: float = 2e-3) -> Model:
    if not len(positive) or not len(unlabelled) or not 0 < prior < 1:
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf if not len(positive) else np.inf if prior >= 1 else 0.0)
    grams = choose(positive, unlabelled, prior)
    x = []
    for texts in (positive, unlabelled):
        m = np.zeros((len(texts), len(grams)), np.float32)
        if len(grams):
            doc, gram = features(*buffers(texts), grams, _filter(grams))
            m[doc, gram] = 1
        x.append(m)
    xp, xu = x
    if len(grams):
        prior = class_prior(xp, xu, prior)
    w, b = np.zeros(len(grams), np.float32), np.float32(np.log(prior / (1 - prior)))
    state = [np.zeros_like(w), np.zeros_like(w), 0.0, 0.0]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    softplus = lambda z: np.logaddexp(0, z)
    for step in range(1, rounds + 1):
        fp, fu = xp @ w + b, xu @ w + b
        clean = softplus(fu).mean() - prior * softplus(fp).mean()
        gp_clean, gu_clean = -prior * sigmoid(fp) / len(fp), sigmoid(fu) / len(fu)
        if clean >= 0:
            gp, gu = -prior * sigmoid(-fp) / len(fp) + gp_clean, gu_clean
        else:
            gp, gu = -gp_clean, -gu_clean
        gw, gb = gp @ xp + gu @ xu + decay * w / max(1, len(w)) ** 0.5, float(gp.sum() + gu.sum())
        state[0] = 0.9 * state[0] + 0.1 * gw
        state[1] = 0.99 * state[1] + 0.01 * gw * gw
        state[2] = 0.9 * state[2] + 0.1 * gb
        state[3] = 0.99 * state[3] + 0.01 * gb * gb
        fix1, fix2 = 1 - 0.9**step, 1 - 0.99**step
        w = (w - rate * (state[0] / fix1) / (np.sqrt(state[1] / fix2) + 1e-8)).astype(np.float32)
        b = np.float32(b - rate * (state[2] / fix1) / (np.sqrt(state[3] / fix2) + 1e-8))
    return Model(grams, w.astype(np.float64), float(b))


def score_texts(model: Model, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Scores of framed texts."""
    n = len(starts) - 1
    total = np.full(n, model.bias, np.float64)
    if len(model.grams):
        table = _filter(model.grams)
        for low, high in blocks(starts, 8 * BLOCK_BYTES):
            doc, gram = features(data, starts[low:high + 1], model.grams, table)
            total[low:high] += np.bincount(doc, model.weights[gram], high - low)
    return np.where(np.isneginf(total), 0.0, 1 / (1 + np.exp(-np.clip(total, -700, 700))))


def fit(docs: DataFrame, confirmed: DataFrame, prior: float, text: str = "text", key: str = "doc_id", max_positive: int = 1500,
        max_unlabelled: int = 4000) -> Model:
    """Train on up to so many rows of either kind, taken by a hash of their key.

    ``confirmed`` has the keys of toxic texts. ``prior``: the most that the share of toxic texts can be; within it, the
    share is estimated from the two samples.
    """
    def sample(keys: DataFrame, most: int) -> pa.Array:
        rows = docs.select(F.col(key), framed(F.col(text)).alias("t")).join(sample_keys(keys, key, most, 3), key)
        return rows.orderBy(key, "t").limit(most).select("t").toArrow()["t"].combine_chunks()

    return train(sample(confirmed, max_positive), sample(docs, max_unlabelled), prior)


def score(df: DataFrame, model: Model, text: str = "text", output: str = "score") -> DataFrame:
    """Add the probability that a text is toxic."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(model, *buffers(texts)))

    return df.withColumn(output, F.arrow_udf(run, "double")(framed(F.col(text))))
