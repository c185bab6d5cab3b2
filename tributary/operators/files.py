"""Operators over the files of a batch: inventory, numbering, drift, routing.

Rows carry ``_input_file_path``; ``_fn`` is its last segment, the name that is logged.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.functions.scalars import basename, is_delete_name, steady

PATH, NAME, SID, POS, RESCUED = "_input_file_path", "_fn", "_sid", "_pos", "_rescued_data"

# A file list up to this many rows (a few hundred bytes each) may be broadcast.
BROADCAST_FILES = 100_000

# Files that one task numbers, and names sampled for each such range.
NUMBERED_TOGETHER, SAMPLED = 20_000, 50


def with_filename(rows: DataFrame) -> DataFrame:
    return rows.withColumn(NAME, basename(F.col(PATH)))


def file_inventory(rows: DataFrame) -> DataFrame:
    """One row per file: its record count and whether any record is off-schema."""
    return rows.groupBy(PATH, NAME).agg(
        F.count(POS).alias("file_rows"),
        F.max(F.col(RESCUED).isNotNull()).alias("drifted"),
    )


def name_splitters(files: DataFrame, together: int = NUMBERED_TOGETHER, n: int | None = None) -> list[str]:
    """Where to cut a file list by name, so that a range has about ``together`` files; nothing where one range does.

    Names sampled by their hash give the places. At most ``SAMPLED`` or so for each shuffle partition reach the
    driver, however many files there are. ``files`` is read twice, once if their number ``n`` is known, and should be a table.
    """
    n = files.count() if n is None else n
    ranges = min(ceil(n / together), int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if ranges < 2:
        return []
    share = min(1.0, SAMPLED * ranges / n)
    hashed = F.pmod(F.xxhash64("_at"), F.lit(1 << 30))
    sample = files.select(_in_order().alias("_at")).filter(hashed < int(share * (1 << 30)))
    found = sorted(r["_at"] for r in sample.collect())
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []


def assign_source_ids(files: DataFrame, last_id: int = 0, splitters: Sequence[str] = ()) -> DataFrame:
    """Number files ``last_id + 1 ...`` in byte order of their names.

    The ranges between ``splitters`` (``name_splitters``) are numbered side by side, each after the counts of those before
    it; without them one task sees one row per file, never data rows.
    """
    return _numbered(files, F.lit(True), last_id, splitters)


def number_files(inventory: DataFrame, last_id: int = 0, splitters: Sequence[str] = ()) -> DataFrame:
    """The files of a batch (``file_inventory``); the clean ones with a source id, the drifted ones without."""
    return _numbered(inventory, ~F.col("drifted"), last_id, splitters)


def _in_order() -> Column:
    """A text that sorts as name, then path."""
    return F.concat(NAME, F.lit("\0"), PATH)


def _numbered(files: DataFrame, counted: Column, last_id: int, splitters: Sequence[str]) -> DataFrame:
    one, start = F.when(counted, F.lit(1).cast("long")), steady(last_id, F.col(PATH)).cast("long")
    if not splitters:
        running = F.count(one).over(Window.orderBy(NAME, PATH).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return files.withColumn(SID, F.when(counted, running + start))
    cuts = F.array(*[F.lit(s) for s in splitters])
    ranged = files.withColumn("_range", F.size(F.filter(cuts, lambda cut: cut <= _in_order())))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count(one).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_range").orderBy(NAME, PATH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.withColumn("_running", F.count(one).over(within))
    placed = running.join(F.broadcast(starts), "_range")  # a row for each range
    return placed.withColumn(SID, F.when(counted, F.col("_running") + F.col("_before") + start)).drop("_range", "_running", "_before")


def tag_rows(rows: DataFrame, ids: DataFrame, file_count: int | None = None) -> DataFrame:
    """Put each file's source id on its rows.

    ``file_count`` is the measured size of ``ids``; a list known to be small is
    broadcast, any other is left to the planner, whose skew join splits a hot file.
    """
    lookup = ids.select(PATH, SID)
    if file_count is not None and file_count <= BROADCAST_FILES:
        lookup = F.broadcast(lookup)
    return rows.join(lookup, PATH, "left")


def drift_files(rows: DataFrame) -> DataFrame:
    """Files with at least one off-schema record."""
    return rows.filter(F.col(RESCUED).isNotNull()).select(PATH, NAME).distinct()


def split_drift(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of clean files, drifted files): one bad record rejects its whole file."""
    drifted = drift_files(rows)
    return rows.join(drifted.select(PATH), PATH, "left_anti"), drifted


def mark_route(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_is_delete", is_delete_name(F.col(NAME)))


def route(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(regular rows, delete rows) by filename."""
    marked = mark_route(rows)
    deletes = F.col("_is_delete")
    return marked.filter(~deletes).drop("_is_delete"), marked.filter(deletes).drop("_is_delete")
