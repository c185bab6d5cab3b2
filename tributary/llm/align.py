"""Alignment of two tokenizers' tokens by interval coalescing, and how often their ids go together.

Both tokenizers tile the same bytes. The tokens of both, as intervals of bytes, are sorted by where they start; where a
start reaches the greatest end so far, a new group begins. Inside a group every token of the one is linked with
every token of the other. A lot of documents is aligned at once, end to end, as no interval crosses two documents.

An id pair counts once for each document that holds it linked. The counts are a table of id pairs, whose size depends
on the vocabularies; documents meet it in blocks of bounded size, which go to the tasks one after the other.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tributary.llm.bpe import byte_letters
from tributary.llm.common import in_lots, written

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Longer texts are encoded in parts that end before a blank between letters, where neither vocabulary has a token.
LONG, BORDER = 1 << 20, re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Characters of a lot, links above which a group is expanded by its distinct ids, and id pairs of a block.
LOT, WIDE, BLOCK = 1 << 18, 1 << 12, 1 << 22


class Vocabulary:
    """Bytes of the ids, and decimal texts of them followed by a separator."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.size = len(tokens)
        self.lengths = np.array([len(x) for x in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text that a blank stands before."""
        raise NotImplementedError

    def whole(self, text: str) -> np.ndarray:
        """As ``encode``, for a text of any length."""
        ids, at = [], 0
        while len(text) - at > LONG and (border := BORDER.search(text, at + LONG)):
            ids.append(self.encode(text[at:border.start()]))
            at = border.end()
        return np.concatenate([*ids, self.encode(text[at:])]).astype(np.int64)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        size = self.lengths[ids]
        ends = np.cumsum(size)
        return self.letters[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + size, size)].tobytes()


class ByteTokens(Vocabulary):
    """A byte-level BPE as the ``tokenizers`` library stores it, special tokens' strings being plain text.

    Its ids rise with the merges, so they serve as ranks; a vocabulary of another kind is refused.
    """

    def __init__(self, spec: str) -> None:
        spec = json.loads(spec)
        model, split = spec["model"], spec["pre_tokenizer"]
        made = [model["vocab"]["".join(x)] for x in model["merges"]]
        plain = not (spec["normalizer"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"])
        if not plain or made != sorted(made) or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("the vocabulary is not a plain byte-level BPE with ids in the order of its merges")
        byte = {letter: k for k, letter in enumerate(byte_letters())}
        ranks = {bytes(byte[x] for x in token): number for token, number in model["vocab"].items()}
        tokens = [b""] * (max([*ranks.values(), *(x["id"] for x in spec["added_tokens"])]) + 1)
        for token, number in ranks.items():
            tokens[number] = token
        super().__init__(tokens)
        self.model = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return self.model.encode_to_numpy(" " + text, disallowed_special=())


class PieceTokens(Vocabulary):
    """A sentencepiece model, which puts a blank before a text."""

    def __init__(self, model: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        super().__init__([
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in enumerate(pieces)
        ])

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


@lru_cache(maxsize=2)
def byte_tokens(spec: str) -> ByteTokens:
    return ByteTokens(spec)


@lru_cache(maxsize=2)
def piece_tokens(model: bytes) -> PieceTokens:
    return PieceTokens(model)


def coalesced(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> np.ndarray:
    """The group of each interval: a group ends where the next start reaches the greatest end so far."""
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.concatenate([[0], np.cumsum(starts[order][1:] >= reach[:-1])]) if len(order) else 0
    return group


def expanded(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """All links inside groups as (id of a, id of b, group, times). Tokens come group after group."""
    n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    wide = n_a * n_b > WIDE
    begin_b = np.cumsum(n_b) - n_b
    some = np.flatnonzero(~wide[of_a])
    partners = n_b[of_a[some]]
    left = np.repeat(some, partners)
    right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners) + begin_b[of_a[left]]
    out = [(a[left], b[right], of_a[left], np.ones(len(left), np.int64))]
    for g in np.flatnonzero(wide):  # distinct ids stand for their repeats
        x, of_x = np.unique(a[slice(*np.searchsorted(of_a, [g, g + 1]))], return_counts=True)
        y, of_y = np.unique(b[slice(*np.searchsorted(of_b, [g, g + 1]))], return_counts=True)
        out.append((np.repeat(x, len(y)), np.tile(y, len(x)), np.full(len(x) * len(y), g), np.outer(of_x, of_y).ravel()))
    return tuple(np.concatenate(x) for x in zip(*out))


SEPARATORS = (",", "|", ";", "")


@lru_cache(maxsize=1)
def _decimals(size: int) -> list[str]:
    return [f"{k}{separator}" for k in range(size) for separator in SEPARATORS]


def aligned_lot(texts: list[str], a: Vocabulary, b: Vocabulary) -> pd.DataFrame:
    """One row per text: n_a, n_b, n_groups, n_links, groups_sha256, pairs (packed, rising), times (packed)."""
    ids = ([], [])
    none = np.zeros(0, np.int64)
    for text in texts:
        raw = b" " + text.encode()
        mine, yours = (a.whole(text), b.whole(text)) if text else (none, none)
        if not text or a.bytes_of(mine) != raw or b.bytes_of(yours) != raw:
            mine = yours = none
        ids[0].append(mine)
        ids[1].append(yours)
    n = len(texts)
    sizes = [np.array([len(x) for x in some]) for some in ids]
    docs = np.concatenate([np.repeat(np.arange(n), size) for size in sizes])
    tokens = np.concatenate([*ids[0], *ids[1]])
    side = np.repeat([0, 1], [sizes[0].sum(), sizes[1].sum()])
    at_b = int(sizes[0].sum())
    length = np.concatenate([a.lengths[tokens[:at_b]], b.lengths[tokens[at_b:]]])
    ends = np.concatenate([np.cumsum(length[:at_b]), np.cumsum(length[at_b:])])
    group = coalesced(ends - length, ends, side)
    groups = int(group.max(initial=-1)) + 1
    doc_of = np.zeros(groups, np.int64)
    doc_of[group] = docs
    links = np.bincount(group[:at_b], minlength=groups) * np.bincount(group[at_b:], minlength=groups)
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, doc_of, links)

    x, y, of, times = expanded(tokens[:at_b], tokens[at_b:], group[:at_b], group[at_b:], groups)
    keys = doc_of[of] * (a.size * b.size) + x * b.size + y
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.add.reduceat(times[order], first) if len(first) else times
    owner, pairs = np.divmod(keys[first], a.size * b.size)
    bounds = np.searchsorted(owner, np.arange(n + 1))

    order = np.lexsort((side, group))  # stable, so tokens keep their order
    kind = np.full(len(order), 0)
    later = np.diff(group[order], append=groups) > 0
    kind[np.flatnonzero(np.diff(side[order], append=1) > 0)] = 1
    kind[later] = 2
    last = np.flatnonzero(np.diff(docs[order], append=n) > 0)
    kind[last] = 3
    tokens = tokens[order] * len(SEPARATORS) + kind
    decimals = _decimals(max(a.size, b.size))
    total = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])])
    told = [
        hashlib.sha256("".join([decimals[k] for k in tokens[total[i]:total[i + 1]].tolist()]).encode()).hexdigest()
        if total[i] < total[i + 1] else "" for i in range(n)
    ]
    return pd.DataFrame({
        "n_a": sizes[0], "n_b": sizes[1], "n_groups": np.bincount(doc_of, minlength=n), "n_links": n_links, "groups_sha256": told,
        "pairs": [pairs[bounds[i]:bounds[i + 1]].astype("<u8").tobytes() for i in range(n)],
        "times": [times[bounds[i]:bounds[i + 1]].astype("<u4").tobytes() for i in range(n)],
    })


_ALIGNED = T.StructType([
    *(T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")),
    T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType()),
])


def aligned(docs: DataFrame, byte_path: str = BYTE_VOCABULARY, piece_path: str = PIECE_VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked id pairs as ``pairs``
    (id of a times the size of b plus id of b, packed as rising 64-bit integers) with how often each is linked, ``times``.

    A text that is null or empty, or whose tokens of either kind don't give the bytes of a blank and the text, has no
    tokens: zeros, no pairs and an empty ``groups_sha256``. Texts are read whole, equal ones alike; an empty table gives no rows.
    """
    with open(byte_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    with open(piece_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf(_ALIGNED)
    def align(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a, b = byte_tokens(spec.value), piece_tokens(model.value)
        for series in batches:
            for texts in in_lots(series, LOT):
                yield aligned_lot(texts, a, b)

    return docs.select("doc_id", align(F.col("text")).alias("t")).select("doc_id", "t.*")


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Id pairs and in how many rows each is, a batch at a time."""
    for frame in frames:
        pairs, n = np.unique(np.frombuffer(b"".join(frame["pairs"]), "<u8"), return_counts=True)
        yield pd.DataFrame({"pair": pairs.astype(np.int64), "n": n})


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """pair, a, n (documents that hold the pair linked), best (whether no pair of the same a has more).

    The pairs of an id of a are as many as the other vocabulary's ids at most.
    """
    counts = rows.select("pairs").mapInPandas(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    a = F.expr(f"pair div {size_b}")
    rows = counts.withColumn("a", a)
    return rows.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def _blocks(counts: DataFrame, size: int) -> list[tuple[int, int]]:
    """Ranges of ids of a whose pairs make about ``size`` rows at most; one row per id comes to the driver."""
    out, first, held = [], 0, 0
    for row in counts.groupBy("a").agg(F.count("*").alias("n")).orderBy("a").collect():
        if held and held + row["n"] > size:
            out.append((first, row["a"]))
            first, held = row["a"], 0
        held += row["n"]
    return [*out, (first, 1 << 62)]


def _sums(shared):
    """Of packed pairs and times n_best and count_sum, by one block of counts."""

    @F.pandas_udf(T.StructType([T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]))
    def sums(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        keys, n, best = shared.value
        for packed, often in batches:
            pairs = np.frombuffer(b"".join(packed), "<u8").astype(np.int64)
            times = np.frombuffer(b"".join(often), "<u4").astype(np.int64)
            found = np.zeros((2, len(pairs) + 1), np.int64)
            if len(keys):
                place = np.searchsorted(keys, pairs).clip(0, len(keys) - 1)
                held = keys[place] == pairs
                found[0, 1:] = np.cumsum(times * (held & best[place]))
                found[1, 1:] = np.cumsum(times * n[place] * held)
            ends = np.cumsum(packed.str.len().to_numpy(np.int64)) // 8
            begins = np.concatenate([[0], ends[:-1]])
            yield pd.DataFrame((found[:, ends] - found[:, begins]).T, columns=["n_best", "count_sum"])

    return sums


def alignment(
    docs: DataFrame, byte_path: str = BYTE_VOCABULARY, piece_path: str = PIECE_VOCABULARY, block: int = BLOCK
) -> DataFrame:
    """``aligned`` without the pairs, with n_best (links whose pair no other of their a id surpasses) and count_sum (the
    pair's documents, summed over links). Each block of counts is read by all documents, so there is no join of rows."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    rows = written(aligned(docs, byte_path, piece_path), "align-rows")
    counts = written(pair_counts(rows, size_b), "align-counts")
    context = docs.sparkSession.sparkContext
    out = rows.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    blocks = _blocks(counts, block)
    for number, (low, high) in enumerate(blocks):
        part = counts.filter((F.col("a") >= low) & (F.col("a") < high)).orderBy("pair").select("pair", "n", "best").toArrow()
        shared = context.broadcast([part[name].to_numpy() for name in ("pair", "n", "best")])
        out = out.withColumn("s", _sums(shared)("pairs", "times")).withColumns(
            {"n_best": F.col("n_best") + F.col("s.n_best"), "count_sum": F.col("count_sum") + F.col("s.count_sum")}
        ).drop("s")
        if number + 1 < len(blocks):
            out = written(out, "align-sums")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
