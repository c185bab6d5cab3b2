"""Merge specs: how staged rows meet the target's, as settings instead of stored SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.rescue import quoted

AUDIT_COLUMNS = ("sourceid", "loaddtm", "deleted_flag", "date_deleted")
#: Audit columns that a staged key always resets.
CLEARED = ("deleted_flag", "date_deleted")

_SPEC = "struct<key:array<string>,order_col:string,update_cols:array<string>>"


class SpecError(ValueError):
    """A merge spec that cannot be used."""


@dataclass(frozen=True)
class MergeSpec:
    """``key``: the columns that match a staged row with a target's; ``order_col``: of two rows of a key the one with the
    greater value is newer, a missing value being the least; ``update_cols``: what a matched row takes, all if None."""

    key: tuple[str, ...] = ("id",)
    order_col: str = "sourceid"
    update_cols: tuple[str, ...] | None = None

    def updates(self, column: str) -> bool:
        return self.update_cols is None or column in self.update_cols or column in AUDIT_COLUMNS

    def newest_first(self, position: str) -> list[Column]:
        """Order of staged rows of one key. The position in the file settles what is left."""
        order = [F.col("sourceid").desc(), F.col(position).desc()]
        return order if self.order_col == "sourceid" else [F.col(quoted(self.order_col)).desc_nulls_last(), *order]

    def checked(self, sinks: set[str]) -> MergeSpec:
        """The spec, if the mapping provides its columns."""
        missing = [c for c in (*self.key, *(self.update_cols or ())) if c not in sinks]
        if self.order_col not in sinks and self.order_col != "sourceid":
            missing.append(self.order_col)
        if missing or not self.key:
            raise SpecError(f"the merge spec names columns that no field is mapped to: {', '.join(missing) or 'no key'}")
        if len(set(self.key)) < len(self.key):
            raise SpecError("the merge spec names a key column twice")
        return self


def parse_merge_specs(repository: DataFrame) -> DataFrame:
    """(query_name, key, order_col, update_cols) of each stored merge.

    Its ``query_text`` is a JSON object; what it leaves out has the defaults, and a text that is no such object has no
    key, so that it can be told.
    """
    spec = F.from_json("query_text", _SPEC)
    usable = F.get_json_object("query_text", "$").startswith("{")
    default = MergeSpec()
    key = F.coalesce(spec["key"], F.when(usable & F.get_json_object("query_text", "$.key").isNull(), F.array(*map(F.lit, default.key))))
    return repository.filter(F.col("query_type") == "merge").select(
        "query_name", key.alias("key"), F.coalesce(spec["order_col"], F.lit(default.order_col)).alias("order_col"),
        spec["update_cols"].alias("update_cols"),
    )


def load_spec(repository: DataFrame, name: str) -> MergeSpec:
    """The stored merge of one source; several, or one that can't be read, are an error."""
    rows = parse_merge_specs(repository.filter(F.col("query_name") == name)).take(2)
    if not rows:
        raise SpecError(f"no stored merge for '{name}'")
    if len(rows) > 1:
        raise SpecError(f"several stored merges for '{name}'")
    row = rows[0]
    if not row["key"]:
        raise SpecError(f"the stored merge of '{name}' is no object with a list of key columns")
    columns = row["update_cols"]
    return MergeSpec(tuple(row["key"]), row["order_col"], None if columns is None else tuple(columns))
