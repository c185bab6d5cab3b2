"""Phrase collocations by best-first branch-and-bound growth.

Phrases grow word by word. A phrase p that occurs f times and begins with a word that occurs f1 times bounds the
score of every phrase that begins with p: the cut after the first word has a first part of f1 and a rest of at least a
occurrences, a is at most f, and a / (f1 + a) rises with a, so no such phrase scores above 2000000 f / (f1 + f).

All pairs of frequent words are counted first. Then each language has a level: the score that its K-th best known
phrase has. All phrases whose bound reaches the level are grown, so every phrase that scores as much is counted; and
those that score as much themselves are grown on both sides, which tells whether a longer phrase swallows them (one
that does so with two words more has one in between that does so too). Where enough phrases survive at the level, ties
included, the language is settled; the others go on with K four times as large, at last with level 0.

Counting reads the texts; what to count comes as bit filters of bounded size. A filter may let more through, which
is then counted exactly as well, and never less.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.llm.common import spread_join, stretches, written

LONGEST, LEAST, TOP, SHARE = 4, 30, 2000, 80
SCALE = 2_000_000
UNKNOWN = "und"
#: Words that are counted together by one task.
TOGETHER = 1 << 20
#: Bits for each phrase in a filter, and its bits at most: 8 MB, which the driver and each task hold.
BITS_EACH, BITS_MOST = 16, 26
SHIFTS = (0, 19, 38)
#: Bits by which the hash of a word is turned for each place in a phrase.
TURN = 13
#: Rows that one task ranks at first.
RANKED = 100_000

_ENDS = b".,;:!?\n\x0b\x0c\r"
_LETTERS = bytes(range(65, 91))
_PLAIN = bytes.maketrans(_LETTERS + _ENDS + b"\t", _LETTERS.lower() + b"\n" * len(_ENDS) + b" ")
_COUNTS = "lang string, phrase string, n long"


class Filter(NamedTuple):
    """Bits that are set for each phrase in it; the size is a power of two."""

    bits: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        mask, found = np.uint64(len(self.bits) * 64 - 1), np.ones(len(hashes), bool)
        for shift in SHIFTS:
            place = (hashes >> np.uint64(shift)) & mask
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def _turned(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of words, turned by their place k in the phrase, so that a phrase's hash is their exclusive or."""
    bits = np.uint64(TURN * k)
    return hashes if k == 0 else (hashes << bits) | (hashes >> (np.uint64(64) - bits))


def _phrase_hash(lang: str, phrase: str) -> Column:
    """The same hash for Spark's rows: each word's own, seeded by the language."""
    words, key = F.split(phrase, " "), None
    for k in range(LONGEST):
        word = F.xxhash64(lang, F.get(words, F.lit(k)))
        if k:
            turned = F.shiftleft(word, TURN * k).bitwiseOR(F.shiftrightunsigned(word, 64 - TURN * k))
            word = F.when(F.size(words) > k, turned).otherwise(F.lit(0).cast("long"))
        key = word if key is None else key.bitwiseXOR(word)
    return key


def phrase_filter(phrases: DataFrame) -> Filter:
    """Of rows lang, phrase. Its words of 64 bits are put together by tasks."""
    size = 1 << min(BITS_MOST, max(10, math.ceil(math.log2(max(1, phrases.count()) * BITS_EACH))))
    phrases = phrases.select(_phrase_hash("lang", "phrase").alias("key"))
    key = F.col("key")
    places = F.explode(F.array(*(F.shiftrightunsigned(key, s).bitwiseAND(F.lit(size - 1).cast("long")) for s in SHIFTS)))
    words = phrases.select(places.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")
    )
    found = words.toPandas()
    bits = np.zeros(size // 64, np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Filter(bits)


class Wanted(NamedTuple):
    """What a pass counts: phrases of the ``widths``; ``alive`` has the words and pairs that may be in them. Longer ones
    than pairs only where the words before the last are in ``right``, or those after the first in ``left``."""

    widths: tuple[int, ...]
    alive: Filter | None = None
    right: Filter | None = None
    left: Filter | None = None


class _Ids(dict):
    """Numbers words as they come; 0 is the end of a piece, 1 what stands between two blanks."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Held:
    """Words of one language that are counted together."""

    def __init__(self) -> None:
        self.ids, self.runs, self.size = _Ids({b"\n": 0, b"": 1}), [np.zeros(1, np.int64)], 0

    def add(self, text: bytes) -> None:
        for part in stretches(text.translate(_PLAIN)):  # a piece may go on in the next part
            words = part.replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
            self.runs.append(ids[ids != 1])
            self.size += len(words)
        self.runs.append(np.zeros(1, np.int64))


def _count(held: _Held, lang: str, wanted: Wanted) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Phrases of the widths wanted and how often each occurs."""
    ids, words = np.concatenate(held.runs), list(held.ids)
    if 1 in wanted.widths:
        counts = np.bincount(ids, minlength=len(words))
        yield words[2:], counts[2:]
    longest = max(wanted.widths)
    if longest == 1:
        return
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)

    def longer(names: list[bytes], codes: np.ndarray) -> list[bytes]:
        first, last = np.divmod(codes, len(words))
        return list(map(b" ".join, zip(map(names.__getitem__, first.tolist()), map(words.__getitem__, last.tolist()))))

    def told(places: np.ndarray, width: int) -> tuple[list[bytes], np.ndarray]:
        """The distinct phrases that begin there; only these get a name."""
        names, codes = words, ids[places]
        for k in range(1, width - 1):
            found, codes = np.unique(codes * len(words) + ids[places + k], return_inverse=True)
            names = longer(names, found)
        found, counts = np.unique(codes * len(words) + ids[places + width - 1], return_counts=True)
        return longer(names, found), counts

    own = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), np.uint64, len(words))
    known = wanted.alive.has(own)
    known[:2] = False
    # where a phrase of one word less begins, and those of them that may be grown on the right or left
    at = np.flatnonzero(known[ids])
    begins = right = left = known[ids]
    hashes = own[ids]
    for width in range(2, longest + 1):
        at = at[begins[at + 1]]  # ids end with the end of a piece, where nothing begins
        if width in wanted.widths:
            yield told(at[right[at] | left[at + 1]], width)
        if width == longest:
            return
        hashed = hashes[at] ^ _turned(own[ids[at + width - 1]], width - 1)
        if width == 2:
            alive = wanted.alive.has(hashed)
            at, hashed = at[alive], hashed[alive]
        begins, right, left = (np.zeros(len(ids), bool) for _ in range(3))
        begins[at], right[at], left[at] = True, wanted.right.has(hashed), wanted.left.has(hashed)
        hashes = np.zeros(len(ids), np.uint64)
        hashes[at] = hashed


def _totals(docs: DataFrame, wanted: Wanted) -> DataFrame:
    """lang, phrase, f: how often each phrase wanted occurs in all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def told(held: dict[str, _Held]) -> Iterator[pa.RecordBatch]:
        for lang, some in held.items():
            for phrases, counts in _count(some, lang, shared.value):
                for at in range(0, len(phrases), 1 << 16):
                    part = phrases[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                         pa.array(counts[at:at + len(part)], pa.int64())], ["lang", "phrase", "n"],
                    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Held] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                some = held.get(lang) or held.setdefault(lang, _Held())
                before = some.size
                some.add(text.as_py())
                size += some.size - before
                if size >= TOGETHER:
                    yield from told(held)
                    held, size = {}, 0
        yield from told(held)

    return docs.mapInArrow(counted, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _frequent(docs: DataFrame, wanted: Wanted, least: int, label: str) -> DataFrame:
    return written(_totals(docs, wanted).filter(F.col("f") >= least), label)


def _words(phrase: str, n: int) -> Column:
    """The first n words of a phrase, or the last -n."""
    return F.substring_index(phrase, " ", n)


def _scored(counts: DataFrame, shorter: DataFrame, width: int, label: str) -> DataFrame:
    """Phrases with the counts of all they begin and end with, their score and the bound of what they begin.

    ``shorter``: the phrases of one word less. A phrase whose beginning or end isn't among them drops out.
    """
    rows = counts.withColumns({"head": _words("phrase", width - 1), "tail": _words("phrase", 1 - width)})
    heads = shorter.select("lang", F.col("phrase").alias("head"), "heads")
    tails = shorter.select("lang", F.col("phrase").alias("tail"), "tails")
    with_heads = written(spread_join(rows, heads, ["lang", "head"]), f"{label}-heads")
    both = spread_join(with_heads, tails, ["lang", "tail"])

    def ratio(below: Column) -> Column:
        """floor(SCALE f / below) in whole numbers of up to 38 digits."""
        above = F.col("f").cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(8,0)")
        return F.call_function("div", above, below.cast("decimal(21,0)"))

    cuts = []
    for k in range(1, width):
        first, rest = F.col("heads")[k - 1], F.col("tails")[width - k - 1]
        cuts.append(F.struct(ratio(first + rest).alias("score"), F.lit(k).alias("k"), first.alias("l"), rest.alias("r")))
    cut = F.array_min(F.array(*cuts))
    told = both.select("lang", "phrase", "f", "heads", "tails", cut.alias("cut")).select(
        "lang", "phrase", F.lit(width).alias("width"), "f", "cut.l", "cut.r", "cut.score",
        ratio(F.col("heads")[0] + F.col("f")).alias("bound"), F.concat("heads", F.array("f")).alias("heads"),
        F.concat("tails", F.array("f")).alias("tails"),
    )
    return written(told, label)


def _levels(known: DataFrame, langs: DataFrame, k: int) -> DataFrame:
    """lang, level: the score that k of its known phrases reach, 0 where there are fewer.

    Phrases are counted by score first, so that a language has at most half of SCALE rows to be ordered.
    """
    counts = known.groupBy("lang", "score").agg(F.count("*").alias("n"))
    reached = counts.withColumn("n", F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))).filter(F.col("n") >= k)
    best = reached.groupBy("lang").agg(F.max("score").alias("level"))
    return langs.join(best, "lang", "left").select("lang", F.coalesce("level", F.lit(0)).cast("long").alias("level"))


def _at_level(rows: DataFrame, levels: DataFrame, by: str) -> DataFrame:
    """Rows of the languages that reach their level. Languages are many rows' key, so the levels go along."""
    return _by_lang(rows, levels).filter(F.col(by) >= F.col("level"))


def _by_lang(rows: DataFrame, per_lang: DataFrame) -> DataFrame:
    if per_lang.count() <= 10_000:
        return rows.join(F.broadcast(per_lang), "lang")
    return spread_join(rows, per_lang, ["lang"])


def _survivors(rows: DataFrame, counts: DataFrame, least_share: int, width: int) -> DataFrame:
    """Of rows of a width those without a longer phrase around them that occurs nearly as often."""
    ends = counts.select("lang", "f", F.explode(F.array(_words("phrase", width), _words("phrase", -width))).alias("phrase"))
    around = ends.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    swallowed = F.coalesce(F.col("around").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * least_share, F.lit(False))
    return rows.filter(F.col("width") == width).join(around, ["lang", "phrase"], "left").filter(~swallowed).drop("around")


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their rank; where one has many rows, salts are ranked first."""
    order = [F.desc("score"), F.desc("f"), F.col("phrase")]
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    salts = math.ceil(most / RANKED)
    if salts > 1:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
        inner = Window.partitionBy("lang", "salt").orderBy(*order)
        rows = salted.withColumn("rank", F.row_number().over(inner)).filter(F.col("rank") <= top).drop("rank", "salt")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """The ``top`` phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score.

    Words are runs without blank or tab in the pieces between ``. , ; : ! ?`` and line ends, A-Z in lower case. ``a`` is
    how often the phrase occurs (``least`` at least), ``l`` and ``r`` how often the two parts of its worst cut do, ``n`` all words of
    the language, ``score`` 2000000 a / (l + r) rounded down. A phrase inside a longer one that occurs ``share`` percent as
    often or more is left out. Order: score, then a, both falling, then the phrase by its UTF-8 bytes, so ties are
    settled. A null lang is ``und``; null and empty texts have no words; repeated rows count as often as they stand
    there; an empty table, or a language without such a phrase, gives no rows.
    """
    texts = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text")
    ).filter("text IS NOT NULL")
    words = written(_totals(texts, Wanted((1,))), "phrase-words")
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    single = words.filter(F.col("f") >= least).select("lang", "phrase", "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
    pair_counts = _frequent(texts, Wanted((2,), phrase_filter(single)), least, "phrase-pairs")
    pairs = _scored(pair_counts, single, 2, "phrase-scored2")
    alive = phrase_filter(single.select("lang", "phrase").union(pairs.select("lang", "phrase")))

    open_langs, known, done, k = totals.select("lang"), pairs, None, 2 * top
    while True:
        levels = written(_levels(known, open_langs, k), "phrase-levels")
        right, left = (phrase_filter(_at_level(pairs, levels, by)) for by in ("bound", "score"))
        triple_counts = _frequent(texts, Wanted((3,), alive, right, left), least, "phrase-triples")
        triples = _scored(triple_counts, pairs, 3, "phrase-scored3")
        grown = _at_level(triples, levels, "bound").select("lang", "phrase")
        # the ends of phrases of four words are counted with them
        right = phrase_filter(grown.union(grown.select("lang", _words("phrase", -2).alias("phrase"))))
        left = phrase_filter(_at_level(triples, levels, "score"))
        further = _frequent(texts, Wanted((3, 4), alive, right, left), least, "phrase-further")
        width = F.size(F.split("phrase", " "))
        triple_counts = written(
            triple_counts.union(further.filter(width == 3)).dropDuplicates(["lang", "phrase"]), "phrase-triples"
        )
        triples = _scored(triple_counts, pairs, 3, "phrase-scored3")
        four_counts = further.filter(width == 4)
        fours = _scored(four_counts, triples, 4, "phrase-scored4")

        known = pairs.union(triples).union(fours)
        found = _at_level(known.drop("heads", "tails", "bound"), levels, "score")
        kept = written(_survivors(found, triple_counts, share, 2).union(_survivors(found, four_counts, share, 3)).union(
            found.filter(F.col("width") == LONGEST)), "phrase-kept")
        counts = kept.groupBy("lang").agg(F.count("*").alias("n"))
        settled = written(levels.join(counts, "lang", "left").select(
            "lang", ((F.col("level") == 0) | (F.coalesce("n", F.lit(0)) >= top)).alias("settled")
        ), "phrase-settled")
        part = _by_lang(kept, settled.filter("settled")).drop("settled")
        done = part if done is None else done.union(part)
        open_langs = settled.filter("NOT settled").select("lang")
        if open_langs.isEmpty():
            break
        # only the texts and phrases of open languages are read again
        texts, pairs, known = (_by_lang(x, open_langs) for x in (texts, pairs, known))
        k *= 4
    ranked = _best(written(done, "phrase-done"), top).join(totals, "lang")
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score"
    )
