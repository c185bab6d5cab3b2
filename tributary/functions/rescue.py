"""Records out of JSON text, and the off-schema data they carry.

A record is first read as ``map<string,string>``: unlike a struct it keeps the
fields the schema does not know, and the raw text of those it does.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

BLANKS = " \t\r\n\ufeff"
RECORDS = "array<map<string,string>>"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parsed(text: Column) -> Column:
    """One file's text, parsed as the first of two arrays.

    The parser stops at the end of a value and ignores the rest; the second array
    is only reached when the text is one value. It holds an empty record where the
    text is a single object.
    """
    body = F.ltrim(text, F.lit(BLANKS))
    pair = (
        F.when(body == "", F.lit("[[],[]]"))
        .when(body.startswith("{"), F.concat(F.lit("[["), body, F.lit("],[{}]]")))
        .otherwise(F.concat(F.lit("["), body, F.lit(",[]]")))
    )
    return F.from_json(pair, f"array<{RECORDS}>")


def records(pair: Column) -> Column:
    """The records of a parsed text, NULL when the text is not one array of objects.

    A single object counts as an array of one; blank text as an empty array.
    """
    whole = (F.size(pair) == 2) & ((F.size(pair[1]) == 0) | (F.size(pair[0]) == 1))
    return F.when(whole, pair[0])


def last_values(record: Column, known: Column) -> Column:
    """The record with the last value of each field that it repeats.

    Parsing keeps every pair. A record with ``only_known`` fields repeats none, and passes as it is.
    """
    names = F.array_distinct(F.map_keys(record))
    pairs = F.map_entries(record)
    last = F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda pair: pair["key"] == n), -1)["value"])
    return F.when(known, record).otherwise(F.map_from_arrays(names, last))


def only_known(record: Column, schema: T.StructType) -> Column:
    """Whether a record has as many pairs as known fields: none is unknown, none comes twice."""
    known = [F.map_contains_key(record, f.name).cast("int") for f in schema]
    return F.size(record) == reduce(add, known, F.lit(0))


def typed(raw: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.ArrayType):
        return F.from_json(raw, dtype.simpleString())
    return raw.try_cast(dtype)


def rescued(record: Column, schema: T.StructType, known: Column, raw: dict[str, Column], read: dict[str, Column]) -> Column:
    """Fields unknown to the schema, or not of their type, as JSON; NULL for a clean record.

    Names match by exact letters. The clean test compares what was made before: ``known`` (``only_known``), each field's
    ``raw`` text and the value ``read`` from it; the higher-order filter that names the fields runs for the others only.
    A record that only repeats a field names none.
    """
    checked = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    fits = [raw[f.name].isNull() | read[f.name].isNotNull() for f in checked]
    clean = reduce(and_, fits, known)

    def off_schema(key: Column, text: Column) -> Column:
        bad = ~key.isin(*schema.names) if schema.names else F.lit(True)
        for f in checked:
            bad = bad | ((key == f.name) & text.isNotNull() & typed(text, f.dataType).isNull())
        return bad

    named = F.map_filter(record, off_schema)
    return F.when(record.isNull(), F.lit('{"_record":null}')).when(
        ~clean, F.when(F.size(named) > 0, F.to_json(named, {"ignoreNullFields": "false"}))
    )
