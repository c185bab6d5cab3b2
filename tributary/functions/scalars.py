"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# These must equal what existing log and control tables hold.
MANUAL_RUN = "manual_run"
MAX_MESSAGE_CHARS = 4000
DELETE_WORD = "delete"


def basename(path: Column) -> Column:
    """Last segment of a path."""
    return F.substring_index(path, "/", -1)


def is_delete_name(filename: Column) -> Column:
    """True for a file that carries deletions: its name has ``delete`` in any letter case."""
    return F.lower(filename).contains(DELETE_WORD)


def mapping_source(path: Column) -> Column:
    """Source field named by ``$['x']``, ``$[x]`` or plain ``x``; first segment only."""
    return (
        F.when(path.startswith("$['"), F.regexp_extract(path, r"(?s)^\$\['(.*?)('\]|\$\['|$)", 1))
        .when(path.startswith("$["), F.regexp_extract(path, r"(?s)^\$\[(.*?)(\]|\$\[|$)", 1))
        .otherwise(path)
    )


def as_text_list(column: Column, dtype: T.DataType) -> Column:
    """Arrays of scalars as comma-separated text, arrays of nested values as JSON."""
    if not isinstance(dtype, T.ArrayType):
        return column
    if isinstance(dtype.elementType, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(column)
    return F.concat_ws(",", column)


def message(text: Column) -> Column:
    """Error text as stored in the logs."""
    return F.substring(text, 1, MAX_MESSAGE_CHARS)


def run_id(job: str | None = None, task: str | None = None) -> str:
    """Name of a run from its scheduler ids; a run started by hand has none."""
    if job and task:
        return f"{job}_{task}"
    return str(task) if task else MANUAL_RUN


def run_label(run: Column, batch_id: Column) -> Column:
    """``<run>_<batch>``, with the manual-run default."""
    return F.concat_ws("_", F.coalesce(run, F.lit(MANUAL_RUN)), batch_id.cast("string"))


def flag(text: Column) -> Column:
    """Yes/no setting: y, yes, true or 1 in any case, blanks ignored."""
    return F.coalesce(F.lower(F.trim(text)).isin("y", "yes", "true", "1"), F.lit(False))


def steady(value, beside: Column) -> Column:
    """A constant that differs from batch to batch, as a row's own value: ``beside`` is any column of the rows.

    Numbers and times stand as they are in the code that Spark generates, so each batch's would be compiled anew. An
    element of a constant array is held beside that code, if its place, here always the first, depends on a row.
    """
    return F.get(F.array(F.lit(value)), F.pmod(F.hash(beside), F.lit(1)))
