"""What the operators of this package share: words, tables, intermediate results, row keys."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tributary.session import scratch_dir

#: A word: a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the folder that all executors share: its lineage ends there."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores before it until no column has it in any letter case."""
    taken, free = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def text_key(text: Column) -> Column:
    """64-bit key of a text, null as its own value."""
    return F.when(text.isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(text))


def kept_rows(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``groups`` (doc_id, key, kept: a row for each row of a group) does not keep.

    Rows are known by doc_id and text key. Those of no group pass one anti join; of rows that agree in both
    and are kept, one stays, by a partial aggregation, so a row repeated very often is no large group in
    one task.
    """
    per = groups.groupBy("doc_id", "key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone, repeated = per.filter("n > 1 OR NOT kept"), per.filter("n > 1 AND kept")
    key, mark = unused(docs.columns, "key", "mark")
    keyed = docs.withColumn(key, text_key(F.col("text")))

    def same(other: DataFrame) -> Column:
        return keyed["doc_id"].eqNullSafe(other["doc_id"]) & (keyed[key] == other["key"])

    once = keyed.join(gone, same(gone), "left_anti").drop(key)
    again = keyed.join(repeated, same(repeated), "left_semi").withColumn(mark, F.col("doc_id"))
    return once.unionByName(again.dropDuplicates([mark, key]).drop(mark, key))


def least_by_hash(rows: DataFrame, by: str, hashed: str, n: int, *ties: str) -> DataFrame:
    """Of each value of ``by`` (labels, few) the ``n`` rows with the least hash, with their place ``n``.

    The values are counted first, and only rows below the hash by which several times ``n`` are to be expected are
    ranked, so what the ranking gathers does not grow with the rows.
    """
    keep = F.lit(False)
    for r in rows.groupBy(by).agg(F.count("*").alias("n")).collect():
        share = min(1.0, (4 * n + 100) / r["n"])
        bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
        keep = keep | (F.col(by).eqNullSafe(F.lit(r[by])) & (F.col(hashed) <= F.lit(bound)))
    order = Window.partitionBy(by).orderBy(hashed, *ties)
    return rows.filter(keep).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= n)


def spread_join(rows: DataFrame, by_key: DataFrame, on: list[str], how: str = "inner", share: float = 0.25) -> DataFrame:
    """``rows`` joined with ``by_key``, which has each key once; keys are not null.

    A key with more of the rows than ``share`` of a mean partition is dealt over salts, by chance with a fixed seed,
    so that no task gets many more rows than the others, be they all alike. ``rows`` is read several times and should
    be a table. How often ``by_key`` rows are repeated is bounded by the number of partitions, and so is the
    broadcast of the hot keys, whatever the data.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fill = max(64, math.ceil(share * rows.count() / parts))
    salt, salts = unused([*rows.columns, *by_key.columns], "salt", "salts")
    hot = rows.groupBy(*on).agg(F.count("*").alias(salts)).filter(F.col(salts) > fill)
    hot = F.broadcast(hot.withColumn(salts, F.ceil(F.col(salts) / fill)))  # at most parts / share rows
    dealt = rows.join(hot, on, "left").withColumn(salt, F.floor(F.rand(17) * F.coalesce(salts, F.lit(1))).cast("long"))
    copies = by_key.join(hot, on, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(salts, F.lit(1)).cast("long") - 1))
    )
    return dealt.drop(salts).join(copies.drop(salts), [*on, salt], how).drop(salt)


def stretches(raw: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """The bytes in parts of about ``size`` that end between words."""
    at = 0
    while len(raw) - at > size:
        end = max(raw.rfind(blank, at, at + size) for blank in (b" ", b"\n", b"\t"))
        if end <= at:  # a word longer than a part
            ends = [x for x in (raw.find(blank, at + size) for blank in (b" ", b"\n", b"\t")) if x >= 0]
            end = min(ends, default=len(raw))
        yield raw[at:end]
        at = end
    yield raw[at:]


def strings(texts: pa.Array, step: int = 64) -> Iterator[str | None]:
    """The texts one by one: of an Arrow batch only ``step`` rows are Python strings at a time."""
    for at in range(0, len(texts), step):
        yield from texts.slice(at, step).to_pylist()


def in_lots(texts: Iterable[str | None], size: int = 1 << 19) -> Iterator[list[str]]:
    """The texts in lists of about ``size`` characters, null as empty."""
    held, total = [], 0
    for text in texts:
        held.append(text or "")
        total += len(held[-1])
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held
