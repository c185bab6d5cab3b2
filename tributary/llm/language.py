"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``SPAN`` bytes, forwards and backwards, labels every position of every window,
and the mean of a document's position probabilities is its probability of each language. It is trained in
numpy by backpropagation through time on a bounded sample of labelled documents, on the driver; its few
thousand weights go to the executors, which read whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tributary.llm.common import in_lots, least_by_hash

SPAN, UNITS = 64, 12
#: Windows that go through the network together.
TOGETHER = 1024
#: Bound of the training sample: documents per language, each with its whole text.
SAMPLE_DOCS = 200
UNKNOWN = "und"


class Network:
    """Gates in one table: columns of update, reset and candidate for each byte, and the recurrent weights."""

    def __init__(self, labels: int, units: int = UNITS, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        self.units = units
        self.weights = {}
        for side in "fb":
            self.weights[f"{side}_in"] = draw.normal(0, 0.3, (256, 3 * units)).astype(np.float32)
            self.weights[f"{side}_re"] = draw.normal(0, units**-0.5, (units, 3 * units)).astype(np.float32)
        self.weights["out"] = draw.normal(0, 0.1, (2 * units + 1, labels)).astype(np.float32)

    def _run(self, side: str, data: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each of the rows of ``data`` (one row per position), as (position, unit, window)."""
        n, h = self.units, np.zeros((self.units, data.shape[1]), np.float32)
        table, inner = np.ascontiguousarray(self.weights[f"{side}_in"].T), np.ascontiguousarray(self.weights[f"{side}_re"].T)
        states, kept = np.empty((len(data), n, data.shape[1]), np.float32), []
        order = range(len(data)) if side == "f" else range(len(data) - 1, -1, -1)
        for t in order:
            given, past = table.take(data[t], axis=1, mode="clip"), inner @ h
            gates = given[:2 * n] + past[:2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)  # a sigmoid is half a tanh of the half, plus a half
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:n], gates[n:]
            candidate = np.tanh(given[2 * n:] + reset * past[2 * n:])
            if keep:
                kept.append((t, h, update, reset, candidate, past[2 * n:]))
            h = h + update * (candidate - h)
            states[t] = h
        return states, kept

    def _logits(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        out, n = self.weights["out"].T, self.units
        return out[:, :n] @ forward + out[:, n:2 * n] @ backward + out[:, 2 * n:]

    def position_sums(self, data: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Sum of the label probabilities of each window's valid positions: (label, window)."""
        forward, _ = self._run("f", data, False)
        backward, _ = self._run("b", data, False)
        total = np.zeros((self.weights["out"].shape[1], data.shape[1]), np.float32)
        for t in range(len(data)):
            share = np.exp(self._logits(forward[t], backward[t]))
            share /= share.sum(axis=0)
            share *= valid > t
            total += share
        return total

    def step(self, data: np.ndarray, valid: np.ndarray, truth: np.ndarray) -> tuple[float, dict]:
        """Mean loss over the valid positions and its gradients."""
        n, w = self.units, self.weights
        forward, seen_f = self._run("f", data, True)
        backward, seen_b = self._run("b", data, True)
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        d_forward, d_backward = np.zeros_like(forward), np.zeros_like(backward)
        loss, count, columns = 0.0, float(valid.sum()), np.arange(data.shape[1])
        for t in range(len(data)):
            logits = self._logits(forward[t], backward[t])
            share = np.exp(logits - logits.max(axis=0))
            share /= share.sum(axis=0)
            on = (valid > t).astype(np.float32)
            loss -= float((np.log(share[truth, columns] + 1e-9) * on).sum())
            share[truth, columns] -= 1
            share *= on / count
            grads["out"][:n] += forward[t] @ share.T
            grads["out"][n:2 * n] += backward[t] @ share.T
            grads["out"][2 * n] += share.sum(axis=1)
            d_forward[t], d_backward[t] = w["out"][:n] @ share, w["out"][n:2 * n] @ share
        for side, seen, given in (("f", seen_f, d_forward), ("b", seen_b, d_backward)):
            inner, carried = w[f"{side}_re"], np.zeros_like(forward[0])
            for t, h, update, reset, candidate, past in reversed(seen):
                d = carried + given[t]
                d_candidate = d * update * (1 - candidate**2)
                d_update = d * (candidate - h) * update * (1 - update)
                d_reset = d_candidate * past * reset * (1 - reset)
                outer = np.concatenate([d_update, d_reset, d_candidate])
                np.add.at(grads[f"{side}_in"], data[t], outer.T)
                through = np.concatenate([d_update, d_reset, d_candidate * reset])
                grads[f"{side}_re"] += h @ through.T
                carried = d * (1 - update) + inner @ through
        return loss / count, grads

    def train(self, data: np.ndarray, valid: np.ndarray, truth: np.ndarray, steps: int = 240, batch: int = 192, seed: int = 3) -> None:
        """Adam over random batches of windows; ``data`` has one row per window."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        by_label = [np.flatnonzero(truth == k) for k in range(truth.max() + 1)]
        for i in range(1, steps + 1):
            pick = np.concatenate([draw.choice(x, batch // len(by_label) + 1) for x in by_label])
            _, grads = self.step(np.ascontiguousarray(data[pick].T), valid[pick], truth[pick])
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g**2 - second[k])
                step = first[k] / (1 - 0.9**i) / (np.sqrt(second[k] / (1 - 0.99**i)) + 1e-8)
                self.weights[k] -= (0.02 * (1 - 0.9 * i / steps) * step).astype(np.float32)


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the texts in rows of SPAN, the last of a text filled up with zeros; how many bytes of
    a row are valid; and which text it is from."""
    sizes = np.array([len(x) for x in texts], np.int64)
    rows = -(-sizes // SPAN)
    owner = np.repeat(np.arange(len(texts)), rows)
    data = np.frombuffer(b"".join(x.ljust(int(r) * SPAN, b"\0") for x, r in zip(texts, rows)), np.uint8).reshape(-1, SPAN)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(rows) - rows, rows)
    return data, np.minimum(SPAN, sizes[owner] - place * SPAN), owner


def probabilities(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean position probabilities of each text, zeros for an empty one: (text, label)."""
    data, valid, owner = windows(texts)
    labels = network.weights["out"].shape[1]
    total, size = np.zeros((len(texts), labels)), np.zeros(len(texts))
    for i in range(0, len(data), TOGETHER):
        part = slice(i, i + TOGETHER)
        sums = network.position_sums(np.ascontiguousarray(data[part].T), valid[part])
        np.add.at(total, owner[part], sums.T)
        np.add.at(size, owner[part], valid[part])
    return total / np.maximum(size, 1)[:, None]


def id_crc32(mod: int) -> Column:
    """crc32 of the doc_id as text, modulo ``mod``; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[Network | None, list[str]]:
    """A network and its labels, from documents with a language. Of each language the ``sample_docs`` documents least by a
    hash of doc_id and text are taken, with their whole texts; rows that agree in both are one document, so neither repeated
    nor null ids keep a language from being learned. Only text and lang reach the network. Without any labelled text there is
    no network."""
    letters = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("sample")).alias("h")
    )
    chosen = least_by_hash(letters.select("lang", "h").distinct(), "lang", "h", sample_docs)
    # no more rows than languages times sample_docs
    taken = letters.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    rows = sorted((r.lang, r.n, r.text) for r in taken.collect())
    labels = sorted({lang for lang, _, _ in rows})
    if not rows:
        return None, []
    data, valid, owner = windows([text.encode() for _, _, text in rows])
    truth = np.array([labels.index(lang) for lang, _, _ in rows])[owner]
    network = Network(len(labels))
    network.train(data, valid, truth)
    return network, labels


def predicted(docs: DataFrame, network: Network | None, labels: list[str]) -> DataFrame:
    """doc_id, lang_pred, score for every document, from its whole text. ``und`` with score 0 where the text is null
    or has no letter, or nothing was learned; equal texts get equal predictions; an empty table gives no rows."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for some in in_lots(texts):
                known = [bool(labels) and any(map(str.isalpha, x)) for x in some]
                share = probabilities(network, [x.encode() if k else b"" for x, k in zip(some, known)]) if any(known) else None
                for i, k in enumerate(known):
                    best = int(share[i].argmax()) if k else 0
                    out.append((labels[best], min(1.0, float(share[i][best]))) if k else (UNKNOWN, 0.0))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return docs.select("doc_id", label(F.col("text")).alias("p")).select("doc_id", "p.*")
