"""BPE encoding by backtracking over longest token matches, decoding by an offset table.

An Aho-Corasick automaton finds, in one pass over a piece of text, all tokens that start at each place.
The encoder takes the longest one that is compatible with the token before it, and steps back when none
is. Two tokens are compatible when the merges that build them never merge across their border; a row of
tokens that are pairwise compatible is exactly what the merges give, so no merge is ever replayed on a
text. A place from which no way led on is never tried again, which keeps the work linear.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tributary.llm.common import in_lots, strings

#: Name of the vocabulary that the queries use, in the installed package of public tokenizers.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Distinct pieces and pairs a worker remembers; beyond it starts afresh, with the same results.
PIECES_KNOWN, PAIRS_KNOWN, LONG_PIECE = 120_000, 250_000, 64
NEVER = 1 << 60
BLANK = r"\t-\r \x85\xa0  -     　"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the
    others for the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """A vocabulary with merges and a word end, as the ``tokenizers`` library stores it.

    A piece is written as one character per byte, the last one moved up by 256: the word end belongs to it.
    """

    def __init__(self, spec: str) -> None:
        spec = json.loads(spec)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.birth, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        symbols: dict[int, str] = {}
        for byte, letter in enumerate(byte_letters()):
            symbols[vocab[letter]], symbols[vocab[letter + suffix]] = chr(byte), chr(byte + 256)
        self.merged = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            self.merged[x, y] = rank
            if made not in symbols:
                symbols[made] = symbols[x] + symbols[y]
                self.birth[made], self.left[made], self.right[made] = rank, x, y
        self.length = [0] * size
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, text in symbols.items():
            self.length[token] = len(text)
            # a token that its own merges would not give never occurs
            if len(text) == 1 or self._apart(self.left[token], self.right[token], top=False):
                self.automaton.add_word(text, token)
        self.automaton.make_automaton()
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

        words = [""] * size
        for text, token in (*vocab.items(), *special.items()):
            words[token] = text
        told = [f"{x} ".encode() for x in words]
        self.offsets = np.cumsum([0, *map(len, told)])
        self.letters = np.frombuffer(b"".join(told), np.uint8)
        self.known: dict[str, bytes] = {}

    def _apart(self, x: int, y: int, top: bool = True) -> bool:
        """Whether no merge joins the end of token x with the begin of token y while both are built.

        Goes back in time: of the two tokens at the border, the one made later is replaced by its part at
        the border, which was there until that merge. A merge of the two before it, or for the left one's
        sake at the same rank, would have come first.
        """
        until = NEVER  # the pair at the border stood until the merge of this rank
        by_left = True  # that merge consumed the left one
        while True:
            rank = self.merged.get((x, y), NEVER)
            if top and rank < NEVER and (rank < until or rank == until and not by_left):
                return False
            top = True
            if self.birth[x] < 0 and self.birth[y] < 0:
                return True
            if self.birth[x] > self.birth[y]:  # of two equal tokens the right one was made later
                until, by_left, x = self.birth[x], True, self.right[x]
            else:
                until, by_left, y = self.birth[y], False, self.left[y]

    def compatible(self, x: int, y: int) -> bool:
        key = x << 20 | y
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KNOWN:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(x, y)
        return known

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        text = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        n, length = len(text), self.length
        starts: list[list[int]] = [[] for _ in range(n)]
        for end, token in self.automaton.iter(text):
            starts[end + 1 - length[token]].append(token)  # the longest of a place comes last
        dead = bytearray(n + 1)
        out: list[int] = []
        chosen: list[int] = []
        at, place = len(starts[0]) - 1, 0
        while place < n:
            options = starts[place]
            while at >= 0:
                token = options[at]
                if not dead[place + length[token]] and (not out or self.compatible(out[-1], token)):
                    break
                at -= 1
            if at >= 0:
                out.append(token)
                chosen.append(at)
                place += length[token]
                at = len(starts[place]) - 1 if place < n else 0
            else:
                dead[place] = 1
                place -= length[out.pop()]
                at = chosen.pop() - 1
        return out

    def _packed(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, each as four bytes, the lowest first."""
        parts = self.split_special.split(text) if self.split_special else [text]
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if i % 2 else self._plain(part) for i, part in enumerate(parts)
        )

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            pieces = ASCII_PIECES.findall(text.lower())
        else:
            # letter by letter: a sigma at the end of a word is no special case
            pieces = PIECES.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        if len(self.known) >= PIECES_KNOWN:
            self.known.clear()
        known = self.known
        try:
            return b"".join([known[piece] for piece in pieces])
        except KeyError:
            pass
        out = []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = self._packed(piece)
                if len(piece) <= LONG_PIECE:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes, step: int = 1 << 18) -> str:
        """The tokens of the ids with a blank between them, copied out of one table by their offsets."""
        numbers, out = np.frombuffer(ids, "<u4"), []
        for i in range(0, len(numbers), step):
            some = numbers[i:i + step]
            begin = self.offsets[some]
            size = self.offsets[some + 1] - begin
            ends = np.cumsum(size)
            out.append(self.letters[np.arange(ends[-1]) + np.repeat(begin - ends + size, size)].tobytes())
        return b"".join(out)[:-1].decode()


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """One per worker process."""
    return Encoder(spec)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Columns doc_id, ids, decoded, one row per document. ``ids`` packs the token ids as little-endian unsigned
    32-bit integers; ``decoded`` is the text they stand for. A null text counts as empty, an empty one has no
    ids; every row is encoded, equal ones alike; an empty table gives no rows.

    ``path``: the vocabulary file, read by the driver and sent to the executors; its size does not depend
    on the documents.
    """
    with open(path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.arrow_udf(T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]))
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(spec.value)
        for batch in batches:
            for texts in in_lots(strings(batch)):  # results leave lot by lot, so that a batch's are never held together
                ids = [coder.encode(text) for text in texts]
                told = pa.array([coder.decode(x) for x in ids], pa.string())
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), told], ["ids", "decoded"])

    return docs.select("doc_id", both(F.col("text")).alias("b")).select("doc_id", "b.*")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Column ``ids`` (packed) decoded as ``decoded``, the other columns as they are; null counts as no ids."""
    with open(path, encoding="utf-8") as file:
        spec = rows.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf(T.StringType())
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoder(spec.value)
        for ids in batches:
            yield pd.Series([coder.decode(x or b"") for x in ids], dtype=object)

    return rows.withColumn("decoded", text_of(F.col("ids")))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``encoded`` rows."""
    return rows.select("doc_id", *digest_columns())


def digest_columns() -> list[Column]:
    return [
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
