"""Keyed merge operators. A NULL key equals no other, so such rows are never matched."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tributary.functions.rescue import quoted
from tributary.operators.spec import CLEARED, MergeSpec
from tributary.session import kept


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number = 1`` is planned with a group limit below the shuffle, so a hot
    key sends one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def delete_keys(rows: DataFrame, sources: str | Mapping[str, str], sid: str = "_sid") -> DataFrame:
    """Newest delete per key: key as text, NULL keys dropped, none if a field of the key is absent.

    ``sources`` names the source field of each key column, or that of the only one, ``id``.
    """
    by_column = {"id": sources} if isinstance(sources, str) else dict(sources)
    absent = [s for s in by_column.values() if s not in rows.columns]
    if absent:
        rows = rows.withColumns({s: F.lit(None).cast("string") for s in absent}).limit(0)
    keys = [F.col(quoted(s)).cast("string").alias(c) for c, s in by_column.items()]
    found = rows.select(*keys, F.col(sid).alias("sourceid")).dropna(subset=list(by_column))
    return found.groupBy(*map(quoted, by_column)).agg(F.max("sourceid").alias("sourceid"))


def upsert(state: DataFrame, staged: DataFrame, key: str = "id") -> DataFrame:
    """Replace matched rows with their staged columns and add the unmatched staged rows.

    Columns that ``staged`` lacks keep the old value, NULL on insert. ``staged``
    holds a key once.
    """
    hit = F.col("g._staged").isNotNull()
    columns = []
    for name in state.columns:
        old = F.col(f"s.{quoted(name)}")
        new = F.col(f"g.{quoted(name)}") if name in staged.columns else old
        columns.append(F.when(hit, new).otherwise(old).alias(name))
    keyed, keyless = _by_key(state, key)
    joined = keyed.alias("s").join(
        staged.withColumn("_staged", F.lit(True)).alias("g"), F.col(f"s.{quoted(key)}") == F.col(f"g.{quoted(key)}"), "full"
    )
    return joined.select(*columns).unionByName(keyless)


def clear_deletes(state: DataFrame, staged: DataFrame, key: str = "id") -> DataFrame:
    """Take the deletion mark off rows whose key was staged again."""
    keyed, keyless = _by_key(state, key)
    again = staged.select(F.col(quoted(key)).alias("_key")).dropna().distinct().withColumn("_again", F.lit(True))
    joined = keyed.join(again, F.col(quoted(key)) == F.col("_key"), "left")
    cleared = F.col("_again").isNotNull() & (F.col("deleted_flag") == "Y")
    rows = joined.withColumns(
        {
            "date_deleted": F.when(~F.coalesce(cleared, F.lit(False)), F.col("date_deleted")),
            "deleted_flag": F.when(cleared, F.lit("N")).otherwise(F.col("deleted_flag")),
        }
    )
    return rows.select(*state.columns).unionByName(keyless)


def soft_delete(state: DataFrame, keys: DataFrame, at: Column, key: str = "id") -> DataFrame:
    """Mark rows older than their newest delete; unknown keys change nothing."""
    keyed, keyless = _by_key(state, key)
    marks = keys.select(F.col("id").alias("_key"), F.col("sourceid").alias("_deleted_by"))
    joined = keyed.join(marks, F.col(quoted(key)).cast("string") == F.col("_key"), "left")
    return _mark(joined, at).select(*state.columns).unionByName(keyless)


def _by_key(rows: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with and without a key: the latter go around a join, not into one task of it."""
    held, absent = _held(key)
    return rows.filter(held), rows.filter(absent)


@kept
def _held(key: tuple[str, ...]) -> tuple[Column, Column]:
    held = reduce(and_, [F.col(quoted(k)).isNotNull() for k in key])
    return held, ~held


def _mark(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows with their mark; ``at``: the time of the delete, ``_deleted_at`` if not given."""
    dead, columns = _mark_columns_at() if at is None else _mark_columns(at)
    return rows.withColumn("_dead", dead).withColumns(columns)


@kept
def _mark_columns_at() -> tuple[Column, dict[str, Column]]:
    return _mark_columns(F.col("_deleted_at"))


def _mark_columns(at: Column) -> tuple[Column, dict[str, Column]]:
    dead = F.coalesce(F.col("sourceid"), F.lit(0)) < F.col("_deleted_by")
    return F.coalesce(dead, F.lit(False)), {
        "deleted_flag": F.when(F.col("_dead"), F.lit("Y")).otherwise(F.col("deleted_flag")),
        "date_deleted": F.when(F.col("_dead"), at).otherwise(F.col("date_deleted")),
        "loaddtm": F.when(F.col("_dead"), at).otherwise(F.col("loaddtm")),
        "sourceid": F.when(F.col("_dead"), F.col("_deleted_by")).otherwise(F.col("sourceid")),
    }


def newest_upserts(upserts: DataFrame) -> DataFrame:
    """Staged rows of many batches, the newest per key.

    A keyless row is an insert of its own batch and stays.
    """
    own_row = F.when(F.col("id").isNull(), F.col("sourceid"))
    kept = latest_per_key(upserts.withColumn("_own", own_row), ["id", "_own"], [F.col("sourceid").desc()])
    return kept.drop("_own")


def newest_marks(
    deletes: DataFrame, key_types: T.DataType | Sequence[T.DataType], spec: MergeSpec = MergeSpec(), once: bool = False
) -> DataFrame:
    """Delete keys of many batches, the newest per key, with the key in the target's types.

    Keys compare as text: one that does not read back as the same text matches
    no row and is left out. ``loaddtm`` is the time of the delete's batch. ``once``: a key comes once, as in one batch.
    """
    types = (key_types,) if isinstance(key_types, T.DataType) else tuple(key_types)
    keys, totals, own, typed, same = _mark_sources(types, spec)
    newest = deletes.select(*keys, *own) if once else deletes.groupBy(*keys).agg(*totals)
    return newest.withColumns(typed).filter(same).drop(*_texts(spec))


@kept
def _mark_sources(types: tuple[T.DataType, ...], spec: MergeSpec) -> tuple[list[Column], list[Column], list[Column], dict[str, Column], Column]:
    texts, marks = _texts(spec), _marks(spec)
    at = F.max_by("loaddtm", "sourceid").alias("_deleted_at")
    return (
        [F.col(quoted(k)).alias(t) for k, t in zip(spec.key, texts)],
        [F.max("sourceid").alias("_deleted_by"), at],
        [F.col("sourceid").alias("_deleted_by"), F.col("loaddtm").alias("_deleted_at")],
        {mark: F.col(t).try_cast(kind) for mark, t, kind in zip(marks, texts, types)},
        reduce(and_, [F.col(mark).cast("string") == F.col(t) for mark, t in zip(marks, texts)]),
    )


def _texts(spec: MergeSpec) -> list[str]:
    return [f"_text_{i}" for i in range(len(spec.key))]


@kept
def _same_mark(spec: MergeSpec) -> Column:
    return reduce(and_, [F.col(quoted(k)) == F.col(m) for k, m in zip(spec.key, _marks(spec))])


def _marks(spec: MergeSpec) -> list[str]:
    return [f"_key_{i}" for i in range(len(spec.key))]


def apply_changes(state: DataFrame, upserts: DataFrame, marks: DataFrame, spec: MergeSpec = MergeSpec()) -> DataFrame:
    """Merge the newest staged rows and marks into the state: upsert, cleared marks, guarded soft delete.

    What happens to a column follows from the spec: a matched row takes the staged values of ``update_cols`` and of the
    audit columns, unless the state's ``order_col`` is greater; a new row takes all staged columns; a column that the
    staged rows lack keeps its value. A staged key is no longer deleted, whatever its order. The marks join each side
    first: a left join keeps its side's partitioning, so each side is shuffled by key once at most.
    """

    def marked(rows: DataFrame) -> DataFrame:
        return rows.join(marks, _same_mark(spec), "left").drop(*_marks(spec))

    with_key, keyless = _by_key(state, *spec.key)
    new, new_keyless = _by_key(upserts, *spec.key)
    same, columns = _merged_columns(tuple(state.columns), tuple(upserts.columns), spec)
    held = marked(with_key.withColumn("_held", F.lit(True)))
    joined = held.alias("s").join(marked(new.withColumn("_staged", F.lit(True))).alias("g"), same, "full")
    merged = _mark(joined.select(*columns))
    kept_rows = merged.select(*state.columns, F.col("_dead"))
    absent = {c: F.lit(None).cast(state.schema[c].dataType) for c in state.columns if c not in upserts.columns}
    added = new_keyless.withColumns(absent).select(*state.columns) if absent else new_keyless.select(*state.columns)
    alive = F.lit(False)
    return kept_rows.unionByName(keyless.withColumn("_dead", alive)).unionByName(added.withColumn("_dead", alive))


@kept
def _merged_columns(state: tuple[str, ...], upserts: tuple[str, ...], spec: MergeSpec) -> tuple[Column, list[Column]]:
    """Which state row ``s`` and staged row ``g`` meet, and the columns of what comes of them, with the newest delete's."""
    same = reduce(and_, [F.col(f"s.{quoted(k)}") == F.col(f"g.{quoted(k)}") for k in spec.key])
    staged, inserted = F.col("g._staged").isNotNull(), F.col("s._held").isNull()
    newer = staged
    if spec.order_col in state and spec.order_col in upserts:
        order = quoted(spec.order_col)
        newer = staged & F.coalesce(F.col(f"s.{order}") <= F.col(f"g.{order}"), F.col(f"s.{order}").isNull())
    columns = []
    for name in state:
        old, out = F.col(f"s.{quoted(name)}"), F.col(f"s.{quoted(name)}")
        if name in upserts:
            takes = newer if spec.updates(name) else inserted
            if name in spec.key or name in CLEARED:
                takes = staged
            out = F.when(takes | (inserted & staged), F.col(f"g.{quoted(name)}")).otherwise(old)
        columns.append(out.alias(name))
    return same, [*columns, *[F.coalesce(f"g.{c}", f"s.{c}").alias(c) for c in ("_deleted_by", "_deleted_at")]]


def newly_deleted() -> Column:
    """How many rows of ``apply_changes`` were marked by it."""
    return F.count_if("_dead")
