"""The plan of one batch: numbered files, staged rows, delete keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tributary.operators import files as ops
from tributary.operators.files import POS, SID
from tributary.operators.mapping import MappedColumn, add_audit, map_columns
from tributary.operators.merge import delete_keys, latest_per_key
from tributary.operators.spec import MergeSpec


class Changes(NamedTuple):
    staged: DataFrame
    deletes: DataFrame


def tagged(records: DataFrame, files: DataFrame, file_count: int | None = None) -> DataFrame:
    """Records of the numbered files with their source id; those of other files drop out."""
    present = records.filter(F.col(POS).isNotNull())
    return ops.tag_rows(present, files, file_count).filter(F.col(SID).isNotNull())


def plan_staged(rows: DataFrame, mapping: Sequence[MappedColumn], at: Column, spec: MergeSpec = MergeSpec()) -> DataFrame:
    """Newest regular row per key, in the target's columns."""
    regular, _ = ops.route(rows)
    mapped = add_audit(map_columns(regular, mapping, SID, POS), at)
    return latest_per_key(mapped, spec.key, spec.newest_first(POS)).drop(POS)


def plan_deletes(rows: DataFrame, sources: str | Mapping[str, str]) -> DataFrame:
    """Newest delete per key."""
    _, deletes = ops.route(rows)
    return delete_keys(deletes, sources)


def plan_changes(
    records: DataFrame, files: DataFrame, mapping: Sequence[MappedColumn], sources: str | Mapping[str, str], at: Column,
    spec: MergeSpec = MergeSpec(),
) -> Changes:
    rows = tagged(records, files)
    return Changes(plan_staged(rows, mapping, at, spec), plan_deletes(rows, sources))


def merge_once(staged: DataFrame, deletes: DataFrame) -> DataFrame:
    """State of a target that was empty before: staged rows, later deletes marked."""
    marks = deletes.select(F.col("id").alias("_key"), F.col("sourceid").alias("_deleted_by"))
    joined = staged.join(marks, F.col("id").cast("string") == F.col("_key"), "left")
    dead = F.coalesce(F.col("_deleted_by") > F.col("sourceid"), F.lit(False))
    return joined.withColumns(
        {
            "deleted_flag": F.when(dead, F.lit("Y")).otherwise(F.lit("N")),
            "date_deleted": F.when(dead, F.col("loaddtm")),
            "sourceid": F.when(dead, F.col("_deleted_by")).otherwise(F.col("sourceid")),
        }
    ).drop("_key", "_deleted_by")
