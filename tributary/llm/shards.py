"""Shards of equal bytes by histogram sort.

The sort key is an integer: leading bits from the text, so equal texts stand together, then bits from the
doc_id and from the row's place in the table, so a text with very many copies can still be cut, even where
they all have one doc_id or none. Splitters are found by counting: a
first histogram of the key's leading bits gives the exact bytes below each of its boundaries; where a
splitter falls into a bucket wider than the tolerance, only the rows of that bucket are counted again
by further bits, and so on. Then every row's shard is known and rows are exchanged once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.llm.common import written

SHARDS = 16
TEXT_BITS, ID_BITS, ROW_BITS = 30, 16, 16
KEY_BITS = TEXT_BITS + ID_BITS + ROW_BITS
FIRST_BITS, NEXT_BITS = 12, 6


def sort_keys(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, key; a null text counts as empty.

    Which of several equal rows has which place doesn't show in the result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    upper, middle, lower = (
        F.pmod(F.xxhash64(c), F.lit(1 << bits))
        for c, bits in ((text, TEXT_BITS), (F.col("doc_id"), ID_BITS), (F.monotonically_increasing_id(), ROW_BITS))
    )
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        ((upper * F.lit(1 << ID_BITS) + middle) * F.lit(1 << ROW_BITS) + lower).cast("long").alias("key"),
    )


def splitters(keys: DataFrame, parts: int, tolerance: float) -> list[int]:
    """``parts - 1`` keys; the bytes below the i-th are within ``tolerance`` bytes of i / parts of all bytes,
    or as near as a row with a key of its own allows.

    A probe's count is exact, over all rows. What comes to the driver are histograms: 2 ** FIRST_BITS
    buckets, then 2 ** NEXT_BITS for each splitter not yet settled, never rows.
    """
    def histogram(rows: DataFrame, bits: int) -> list[tuple[int, int]]:
        bucket = F.shiftright("key", KEY_BITS - bits).alias("bucket")
        return sorted((r.bucket, r.bytes) for r in rows.groupBy(bucket).agg(F.sum("size").alias("bytes")).collect())

    bits, below = FIRST_BITS, 0
    counted = {}  # bucket: bytes before it, bytes in it
    for bucket, size in histogram(keys, bits):
        counted[bucket] = (below, size)
        below += size
    targets = [below * i / parts for i in range(1, parts)]
    found: dict[int, int] = {}
    open_in = {}
    for i, target in enumerate(targets):
        bucket = next((b for b, (before, size) in counted.items() if before + size >= target), None)
        if bucket is not None:
            open_in[i] = bucket
    while open_in:
        left = {}
        for i, bucket in open_in.items():
            before, size = counted[bucket]
            low, high = abs(targets[i] - before), abs(before + size - targets[i])
            if min(low, high) <= tolerance or bits >= KEY_BITS:
                found[i] = (bucket if low < high else bucket + 1) << (KEY_BITS - bits)
            else:
                left[i] = bucket
        if not left:
            break
        more = min(NEXT_BITS, KEY_BITS - bits)
        narrow = keys.filter(F.shiftright("key", KEY_BITS - bits).isin(sorted(set(left.values()))))
        inside: dict[int, list[tuple[int, int]]] = {}
        for bucket, size in histogram(narrow, bits + more):
            inside.setdefault(bucket >> more, []).append((bucket, size))
        finer = {}
        for parent in set(left.values()):
            before = counted[parent][0]
            for bucket, size in inside[parent]:
                finer[bucket] = (before, size)
                before += size
        open_in = {
            i: next(b for b, _ in inside[parent] if sum(finer[b]) >= targets[i] or b == inside[parent][-1][0])
            for i, parent in left.items()
        }
        counted, bits = finer, bits + more
    return [found.get(i, 1 << KEY_BITS) for i in range(parts - 1)]


def _place(key: Column, bounds: list[int]) -> Column:
    """How many of the bounds are at or below the key."""
    held = F.array(*(F.lit(b).cast("long") for b in bounds)) if bounds else F.array().cast("array<long>")
    return F.size(F.filter(held, lambda b: b <= key))


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = 0.001, rows_per_task: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Shards are key ranges of equal bytes, within ``tolerance`` of a shard or one document. A shard is cut by
    more splitters of the same kind into parts of about ``rows_per_task`` rows, eight at least; a row's slot is the
    rows of the parts before its own plus its place there, so no task holds a whole shard. Null texts are
    empty; rows that agree in text stand side by side, those that agree in doc_id too are cut like others; an empty table
    gives none.
    """
    keys = written(sort_keys(docs), "shard-keys")
    total = keys.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    parts = max(8, math.ceil(total.rows / shards / rows_per_task))
    bounds = splitters(keys, shards * parts, tolerance * (total.bytes or 0) / shards)
    placed = keys.withColumn("shard", _place(F.col("key"), bounds[parts - 1::parts]))
    within = F.array(*(
        F.array(*(F.lit(b).cast("long") for b in bounds[s * parts:s * parts + parts - 1])) for s in range(shards)
    ))
    placed = placed.withColumn("part", F.size(F.filter(F.element_at(within, F.col("shard") + 1), lambda b: b <= F.col("key"))))
    # at most shards * parts rows
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "part", F.coalesce(before, F.lit(0)).alias("start"))
    turn = F.row_number().over(Window.partitionBy("shard", "part").orderBy("key", "doc_id", "text_crc32", "size"))
    return placed.withColumn("turn", turn).join(F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.col("turn") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
