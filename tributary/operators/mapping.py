"""Projection of source records onto the target's columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tributary.functions.rescue import quoted
from tributary.functions.scalars import as_text_list


class MappedColumn(NamedTuple):
    source: str
    sink: str
    type: T.DataType | None = None


class MappingError(ValueError):
    """A mapping that cannot be applied."""


def map_columns(rows: DataFrame, mapping: Sequence[MappedColumn], *extra: str | Column) -> DataFrame:
    """Source columns renamed and typed for the sink; absent ones are skipped."""
    present = {f.name: f.dataType for f in rows.schema}
    columns = []
    for m in mapping:
        if m.source not in present:
            continue
        dtype = present[m.source]
        out = as_text_list(F.col(quoted(m.source)), dtype)
        held = T.StringType() if isinstance(dtype, T.ArrayType) else dtype
        if m.type is not None and m.type != held:
            out = out.try_cast(m.type)
        columns.append(out.alias(m.sink))
    if not columns:
        raise MappingError("the records have none of the mapped fields")
    return rows.select(*columns, *extra)


def add_audit(rows: DataFrame, at: Column, sid: str = "_sid") -> DataFrame:
    """Audit columns of a freshly loaded row."""
    return rows.withColumnRenamed(sid, "sourceid").withColumns(
        {
            "loaddtm": at.cast("timestamp"),
            "deleted_flag": F.lit("N"),
            "date_deleted": F.lit(None).cast("timestamp"),
        }
    )


def record_schema(
    source: T.StructType, mapping: Sequence[MappedColumn], target: T.StructType | None = None
) -> T.StructType:
    """Types in which the records are read.

    A mapped scalar takes its sink type, so a value that does not fit shows as
    off-schema. Arrays stay arrays, nested objects stay JSON text.
    """
    wanted = {m.source: m.type for m in sink_types(mapping, target)}
    fields = []
    for f in source:
        dtype = f.dataType
        if not isinstance(dtype, T.ArrayType):
            sink = wanted.get(f.name)
            dtype = T.StringType() if sink is None else sink
        fields.append(T.StructField(f.name, dtype))
    return T.StructType(fields)


def sink_types(mapping: Sequence[MappedColumn], target: T.StructType | None) -> tuple[MappedColumn, ...]:
    """The mapping with the type each sink is written in: the target's, where there is one."""
    out = []
    for m in mapping:
        dtype = target[m.sink].dataType if target is not None and m.sink in target.names else m.type
        out.append(m._replace(type=None if isinstance(dtype, _NESTED) else dtype))
    return tuple(out)


_NESTED = (T.ArrayType, T.StructType, T.MapType)
