"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks of bytes that cover all of it. Each byte has a learned vector; learned filters
run over the chunk, their outputs are max-pooled over the chunk, and a linear layer makes a logit of the pooled values.
The document's probability is the logistic function of the mean of its chunks' logits.

The network learns on the driver from a bounded sample (``max_docs`` labelled documents, ``train_chunks`` chunks of each
in a pass); every document is scored over its whole text in Arrow batches, a bounded block of bytes at a time.

Cases: a null or empty text is one chunk of padding and has the score that the network gives it; nulls in other columns
and further columns do not matter; repeated rows get the same score; without a labelled row, or with one label only, the
score is the share of that label (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harvestline.llm.common import buffers, sample_keys

CHUNK, OVERLAP = 256, 32
KERNEL, STRIDE, DIM, FILTERS = 8, 4, 8, 48
BLOCK_CHUNKS = 1500


@dataclass
class Network:
    embedding: np.ndarray  # 257 x DIM; the last row stands for padding
    filters: np.ndarray  # KERNEL * DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray  # FILTERS
    out_bias: np.ndarray  # 1

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.out, self.out_bias]


def new_network(rng: np.random.Generator) -> Network:
    f = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    net = Network(f(257, DIM, scale=0.5), f(KERNEL * DIM, FILTERS, scale=(KERNEL * DIM) ** -0.5), np.zeros(FILTERS, np.float32),
                  f(FILTERS, scale=0.1), np.zeros(1, np.float32))
    net.embedding[256] = 0
    return net


def chunk_starts(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first byte and end of document for every chunk; an empty text has one chunk."""
    sizes = np.diff(starts)
    step = CHUNK - OVERLAP
    counts = np.maximum(1, -(-np.maximum(sizes - OVERLAP, 0) // step))
    doc = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return doc, starts[:-1][doc] + within * step, starts[1:][doc]


def chunk_matrix(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bytes of the chunks, one row each; 256 after the end of the document."""
    place = first[:, None] + np.arange(CHUNK)
    inside = place < end[:, None]
    if not len(data):
        return np.full(place.shape, 256, np.int64)
    return np.where(inside, data[np.minimum(place, len(data) - 1)], 256)


def windows(net: Network, codes: np.ndarray) -> np.ndarray:
    """Embedded bytes under the filter at each of its places: chunks x places x KERNEL * DIM."""
    vectors = net.embedding[codes].reshape(len(codes), CHUNK * DIM)
    view = np.lib.stride_tricks.sliding_window_view(vectors, KERNEL * DIM, axis=1)[:, :: STRIDE * DIM]
    return np.ascontiguousarray(view)


def chunk_logits(net: Network, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(first), np.float32)
    for low in range(0, len(first), BLOCK_CHUNKS):
        part = slice(low, low + BLOCK_CHUNKS)
        pooled = (windows(net, chunk_matrix(data, first[part], end[part])) @ net.filters).max(axis=1) + net.bias
        out[part] = np.maximum(pooled, 0) @ net.out + net.out_bias
    return out


def score_texts(net: Network, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    doc, first, end = chunk_starts(starts)
    logits = chunk_logits(net, data, first, end).astype(np.float64)
    n = len(starts) - 1
    mean = np.bincount(doc, logits, n) / np.bincount(doc, minlength=n)
    return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def train(texts: pa.Array, labels: np.ndarray, seed: int = 1, passes: int = 8, batch: int = 48, train_chunks: int = 6,
          rate: float = 4e-3, least_steps: int = 400) -> Network | float:
    """Fit the network by Adam on the logistic loss; a share instead if the labels do not differ.

    Few texts are passed over more often than ``passes`` says, until there were ``least_steps`` steps.
    """
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return float(labels.mean()) if len(labels) else 0.5
    rng = np.random.default_rng(seed)
    net = new_network(rng)
    data, starts = buffers(texts)
    doc, first, end = chunk_starts(starts)
    by_doc = np.searchsorted(doc, np.arange(len(labels) + 1))
    params = net.parameters()
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    each = -(-len(labels) // batch)
    passes = max(passes, -(-least_steps // each))
    total = passes * each
    for _ in range(passes):
        order = rng.permutation(len(labels))
        for low in range(0, len(order), batch):
            docs = order[low:low + batch]
            picked, owner = [], []
            for k, d in enumerate(docs):
                own = np.arange(by_doc[d], by_doc[d + 1])
                own = rng.choice(own, train_chunks, replace=False) if len(own) > train_chunks else own
                picked.append(own)
                owner.append(np.full(len(own), k))
            picked, owner = np.concatenate(picked), np.concatenate(owner)
            codes = chunk_matrix(data, first[picked], end[picked])
            x = windows(net, codes)
            z = x @ net.filters
            best = z.argmax(axis=1)
            pooled = np.take_along_axis(z, best[:, None, :], 1)[:, 0] + net.bias
            active = np.maximum(pooled, 0)
            share = 1 / np.bincount(owner, minlength=len(docs)).astype(np.float32)
            logit = np.bincount(owner, (active @ net.out + net.out_bias) * share[owner], len(docs))
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[docs]).astype(np.float32) / len(docs)
            g = (error * share)[owner]  # gradient of each chunk's logit
            d_pooled = np.outer(g, net.out).astype(np.float32) * (pooled > 0)
            rows = np.arange(len(picked))[:, None]
            at_best = x[rows, best]  # chunks x FILTERS x KERNEL * DIM
            d_filters = np.einsum("cfk,cf->kf", at_best, d_pooled, optimize=True)
            d_x = d_pooled[:, :, None] * net.filters.T  # chunks x FILTERS x KERNEL * DIM
            place = best[:, :, None] * STRIDE + np.arange(KERNEL)
            d_embedding = np.zeros_like(net.embedding)
            np.add.at(d_embedding, codes[rows[:, :, None], place].ravel(), d_x.reshape(-1, DIM))
            d_embedding[256] = 0
            grads = [d_embedding, d_filters, d_pooled.sum(0), g @ active, np.array([g.sum()], np.float32)]
            step += 1
            now = rate * min(1.0, 2 * (1 - step / (total + 1)))
            for p, d, a, b in zip(params, grads, m, v, strict=True):
                d = d + 1e-5 * p
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= (now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _scorer(net: Network | float):
    def score(texts: pa.Array) -> pa.Array:
        if isinstance(net, float):
            return pa.array(np.full(len(texts), net))
        data, starts = buffers(texts)
        return pa.array(score_texts(net, data, starts))

    return F.arrow_udf(score, "double")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id",
        max_docs: int = 4000) -> Network | float:
    """Train on up to ``max_docs`` labelled rows, taken by a hash of their key."""
    known = sample_keys(labels.where(F.col(label).isNotNull()), key, max_docs, 8, label)
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t")).join(known, key)
    sample = rows.orderBy(key, "t").limit(max_docs).select("t", F.col(label).cast("int").alias("y")).toArrow()
    return train(sample["t"], np.asarray(sample["y"]))


def score(df: DataFrame, model: Network | float, text: str = "text", output: str = "score") -> DataFrame:
    """Add the probability that a text is of good quality."""
    return df.withColumn(output, _scorer(model)(F.col(text)))


