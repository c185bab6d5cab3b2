"""Quality rules as a ledger: every rule is evaluated once, policies are applied to the stored bits.

``ledger`` reads each text once and keeps measurements and one bit per failed rule. A policy is a
versioned mask of the bits that reject. Changing a policy, or asking what it would do without one of
its rules, reads the ledger and never the texts again.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tributary.llm.common import WORD, strings, unused

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_upper_words",
)
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_WORDS = re.compile(WORD)

#: Name, and the failing condition over the measurements; a rule's bit is its place.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("shouting", "100 * n_upper_words > 60 * n_letter_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
)
BIT = {name: 1 << place for place, (name, _) in enumerate(RULES)}

#: Version of a policy and the rules that reject under it.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "shouting", "long_words"),
    "v2": ("few_words", "repeated_words", "symbols", "shouting", "long_words", "repeated_lines"),
}
DEFAULT = "v1"


def mask(version: str) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def repeat_words(words: list) -> int:
    """Words that stand in a window of three words found twice or more."""
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) == max(0, len(words) - 2):
        return 0
    covered, end = 0, 0  # end: of the words counted so far
    for start, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = _WORDS.findall(text)  # no other blanks than the six of ASCII end a word
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    letters = [x for x in words if x.upper() != x.lower()]
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines),
        len(lines) - len(set(lines)), repeat_words(words), len(letters), sum(map(str.isupper, letters)),
    )


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = np.array([measure(x) for x in strings(texts)], np.int64).reshape(-1, len(MEASURES))
        yield pa.StructArray.from_arrays([pa.array(column) for column in rows.T.copy()], list(MEASURES))


def failed_bits(struct: str = "") -> Column:
    """One bit per failed rule, from the measurement columns or from a struct of them."""
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        fails = _within(struct, fails) if struct else fails
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements, ``failed``. Null and empty texts have no words,
    so they fail ``few_words``; repeated rows each get their own row; an empty table gives none."""
    measured = docs.select("doc_id", _measured(F.col("text")).alias("m")).select("doc_id", "m.*")
    return measured.withColumn("failed", failed_bits())


def judged(rows: DataFrame, version: str = DEFAULT) -> DataFrame:
    """A ledger with ``base_failed`` and ``kept`` under a policy."""
    base, policy = F.lit(mask("base")), F.lit(mask(version) | mask("base"))
    return rows.withColumns({
        "base_failed": F.col("failed").bitwiseAND(base) != 0, "kept": F.col("failed").bitwiseAND(policy) == 0,
    })


def ablations(rows: DataFrame, version: str = DEFAULT) -> DataFrame:
    """One row per rule of the policy: documents that fail it, and those that only it rejects (``freed``:
    a policy without the rule keeps them). One aggregation over the bits; its groups are bit patterns,
    so no more than 2 ** (number of rules) rows leave it, whatever the input."""
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(version))).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long").alias("bit")) for name in POLICIES[version]
    ))).alias("r")
    per = patterns.select("bits", "n", rules).select("bits", "n", "r.*")
    return per.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("freed"),
    )


def passing(docs: DataFrame, version: str = DEFAULT) -> DataFrame:
    """The documents that a policy keeps, all their columns as they are: each row with its entry of the ledger, of which
    the policy reads the bits. Texts are read once."""
    (held,) = unused(docs.columns, "m")
    entries = docs.withColumn(held, _measured(F.col("text")))
    policy = F.lit(mask(version) | mask("base"))
    return entries.filter(failed_bits(held).bitwiseAND(policy) == 0).drop(held)


def _within(struct: str, condition: str) -> str:
    return " ".join(f"`{struct}`.{word}" if word in MEASURES else word for word in condition.split())
