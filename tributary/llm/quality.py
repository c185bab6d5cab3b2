"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover all of it. In each chunk learned filters run over the
embedded bytes, rectified and max-pooled, beside one fixed input: how far the chunk repeats itself, the
greatest share of bytes that equal the byte some distance before. The chunks' values are max-pooled and
averaged over the document and combined by a small layer into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tributary.llm.common import in_lots, least_by_hash

CHUNK, STRIDE = 256, 224
DEPTH, REACH, FILTERS, HIDDEN = 6, 6, 16, 12
#: Distances at which a chunk is held against itself.
LAGS = tuple(range(2, 100))
#: Chunks that go through the network together.
TOGETHER = 64
#: Bound of the training sample: documents per label, each with its whole text.
SAMPLE_DOCS = 600
THRESHOLD = 0.3


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts, the last of a text filled up with zeros, and the bounds of each text. An empty
    text is one chunk of zeros."""
    bounds, rows = [0], []
    for text in texts:
        n = max(1, -(-(len(text) - (CHUNK - STRIDE)) // STRIDE))
        padded = np.zeros((n - 1) * STRIDE + CHUNK, np.uint8)
        padded[:len(text)] = np.frombuffer(text, np.uint8)
        rows.append(np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STRIDE])
        bounds.append(bounds[-1] + n)
    return np.concatenate(rows) if rows else np.zeros((0, CHUNK), np.uint8), np.array(bounds)


def self_match(chunks: np.ndarray) -> np.ndarray:
    """For each chunk the greatest share, over the distances, of bytes that equal the byte that far before."""
    best = np.zeros(len(chunks), np.float32)
    filled = np.maximum((chunks != 0).sum(axis=1), 1)
    shown = np.where(chunks == 0, np.arange(256, 256 + CHUNK, dtype=np.uint16), chunks)  # zeros match nothing
    for lag in LAGS:
        same = (shown[:, lag:] == shown[:, :-lag]).sum(axis=1, dtype=np.uint16)
        np.maximum(best, same / np.maximum(filled - lag, 32), out=best)
    return np.minimum(best, 1.0)


class Network:
    def __init__(self, seed: int = 5) -> None:
        draw = np.random.default_rng(seed)
        self.w = {
            "embed": draw.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
            "filters": draw.normal(0, (DEPTH * REACH) ** -0.5, (DEPTH * REACH, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": draw.normal(0, 0.3, (2 * (FILTERS + 1), HIDDEN)).astype(np.float32),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": draw.normal(0, 0.3, HIDDEN).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }
        self.w["embed"][0] = 0

    def _spread(self, chunks: np.ndarray) -> np.ndarray:
        """The bytes that each filter position sees, embedded: (chunk * position, DEPTH * REACH)."""
        seen = self.w["embed"][chunks].reshape(len(chunks), CHUNK * DEPTH)
        seen = np.lib.stride_tricks.sliding_window_view(seen, DEPTH * REACH, axis=1)[:, ::DEPTH]
        return seen.reshape(-1, DEPTH * REACH)

    def _ran(self, chunks: np.ndarray) -> Iterator[np.ndarray]:
        """Each filter's value at each position, some chunks at a time: (chunk, position, FILTERS)."""
        for i in range(0, len(chunks), TOGETHER):
            some = chunks[i:i + TOGETHER]
            yield (self._spread(some) @ self.w["filters"]).reshape(len(some), -1, FILTERS)

    def chunk_values(self, chunks: np.ndarray) -> np.ndarray:
        """Filters pooled over the positions of each chunk, and its self match."""
        parts = [np.maximum(ran.max(axis=1) + self.w["bias"], 0) for ran in self._ran(chunks)]
        values = np.concatenate(parts) if parts else np.zeros((0, FILTERS), np.float32)
        return np.hstack([values, self_match(chunks)[:, None]])

    def _pooled(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        most = np.maximum.reduceat(values, bounds[:-1])
        mean = np.add.reduceat(values, bounds[:-1]) / np.diff(bounds)[:, None]
        return np.hstack([most, mean])

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        chunks, bounds = chunked(texts)
        hidden = np.tanh(self._pooled(self.chunk_values(chunks), bounds) @ self.w["hidden"] + self.w["hidden_bias"])
        return 1 / (1 + np.exp(-(hidden @ self.w["out"] + self.w["out_bias"][0]).astype(np.float64)))

    def step(self, texts: list[np.ndarray], truth: np.ndarray, matches: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients over documents given as all their chunks. A pooled value comes from one position of its
        chunk, so only those positions are gone through backwards, some chunks at a time."""
        w, g = self.w, {}
        chunks = np.concatenate(texts)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        tops, places = [], []
        for ran in self._ran(chunks):
            places.append(ran.argmax(axis=1))
            tops.append(np.take_along_axis(ran, places[-1][:, None], 1)[:, 0])
        top, at = np.concatenate(tops) + w["bias"], np.concatenate(places)
        values = np.hstack([np.maximum(top, 0), matches[:, None]])
        pooled = self._pooled(values, bounds)
        hidden = np.tanh(pooled @ w["hidden"] + w["hidden_bias"])
        score = 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0])))
        loss = -np.mean(np.where(truth == 1, np.log(score + 1e-9), np.log(1 - score + 1e-9)))
        d = (score - truth) / len(truth)
        g["out"], g["out_bias"] = hidden.T @ d, d.sum(keepdims=True)
        d = np.outer(d, w["out"]) * (1 - hidden**2)
        g["hidden"], g["hidden_bias"] = pooled.T @ d, d.sum(axis=0)
        d = d @ w["hidden"].T
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        n = FILTERS + 1
        d_values = d[owner, n:] / np.diff(bounds)[owner][:, None]
        leads = values == pooled[owner, :n]
        d_values += d[owner, :n] * leads / np.maximum(np.add.reduceat(leads, bounds[:-1], dtype=np.int64)[owner], 1)
        d_top = d_values[:, :FILTERS] * (top > 0)
        g["bias"] = d_top.sum(axis=0)
        g["filters"], g["embed"] = np.zeros_like(w["filters"]), np.zeros_like(w["embed"])
        for i in range(0, len(chunks), TOGETHER):
            some, back = chunks[i:i + TOGETHER], d_top[i:i + TOGETHER]
            read = some[np.arange(len(some))[:, None, None], at[i:i + TOGETHER, :, None] + np.arange(REACH)]
            seen = w["embed"][read].reshape(len(some), FILTERS, REACH * DEPTH)
            g["filters"] += np.einsum("ckr,ck->rk", seen, back)
            d_seen = (back[:, :, None] * w["filters"].T[None]).reshape(len(some), FILTERS, REACH, DEPTH)
            np.add.at(g["embed"], read, d_seen)
        g["embed"][0] = 0
        return float(loss), g

    def train(self, texts: list[bytes], truth: np.ndarray, steps: int = 1200, batch: int = 32, seed: int = 2) -> None:
        """Adam over whole documents, drawn in a new order each time all have been seen."""
        draw = np.random.default_rng(seed)
        chunks, bounds = chunked(texts)
        matches = self_match(chunks)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        steps, done = min(steps, 24 * max(1, len(texts) // batch)), 0
        while done < steps:
            order = draw.permutation(len(texts))
            for i in range(0, max(1, len(texts) - batch + 1), batch):
                some = order[i:i + batch]
                picks = [np.arange(bounds[j], bounds[j + 1]) for j in some]
                _, grads = self.step([chunks[p] for p in picks], truth[some].astype(np.float32), matches[np.concatenate(picks)])
                done += 1
                rate = 0.01 * (1 - 0.95 * min(1.0, done / steps))
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.005 * (g**2 - second[k])
                    self.w[k] -= (rate * first[k] / (1 - 0.9**done) / (np.sqrt(second[k] / (1 - 0.995**done)) + 1e-8)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """A network from documents with a quality label of 0 or 1. Of each label the ``sample_docs`` rows least by a hash of
    the doc_id are taken, each as one document with its whole text, so the join broadcasts at most twice as many ids. Only text
    and label reach the network. Where a label has no document there is no network."""
    hashed = F.xxhash64(F.col("doc_id"), F.lit("sample")).alias("h")
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality", hashed).distinct()
    chosen = least_by_hash(known, "quality", "h", sample_docs, "doc_id").drop("n")
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # a doc_id may have any number of rows: the least text stands for it
    taken = found.groupBy("quality", "h", "doc_id").agg(F.min("text").alias("text")).collect()
    rows = [(r.quality, r.h, r.text) for r in sorted(taken, key=lambda r: (r.quality, r.h, r.doc_id))]
    if len({quality for quality, _, _ in rows}) < 2:
        return None
    network = Network()
    network.train([text.encode() for _, _, text in rows], np.array([quality for quality, _, _ in rows]))
    return network


def scored(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, score, predicted for every document, from its whole text. A null text counts as empty, which has the
    score of one empty chunk; without a network every score is 0.5; an empty table gives no rows."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [
                network.score([x.encode() for x in some]) if network else np.full(len(some), 0.5) for some in in_lots(texts)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    rows = docs.select("doc_id", score(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
