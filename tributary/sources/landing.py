"""JSON landing folders: file discovery, schema, records.

A file is one JSON array, read by one task, or, in a source declared as lines, one record a line, which Spark's text
reader splits however large the file is. Discovery streams the files' names and sizes only; a batch then reads exactly its files.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from math import ceil
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tributary.functions import rescue
from tributary.operators.files import NAME, PATH, POS, RESCUED, SID, with_filename
from tributary.session import exists, folder_bytes, kept, literal_path

GLOB = "*.json"
RESERVED = (PATH, NAME, POS, RESCUED, SID)
LISTING = "path string, modificationTime timestamp, length long, content binary"

SPLIT, NTH = "_split", "_nth"

#: How many tasks list the files of a batch, at most.
LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

#: Bytes of lines that one task reads at least, though its splits be smaller.
TOGETHER = 32 << 20

_MALFORMED = '{"_file":"not an array of objects"}'
_BAD_LINE = '{"_line":"not an object"}'


class LandedFile(NamedTuple):
    path: str
    length: int


def stream_files(
    spark: SparkSession,
    source_path: str,
    max_files: int | str = 1000,
    max_bytes: int | str | None = None,
    archive_directory: str | None = None,
) -> DataFrame:
    """Unseen files of the folder, existing ones included, as (path, _input_file_path, length).

    The two caps exclude each other; the byte cap wins when set. File age never
    hides a late file, and ``content`` is pruned, so nothing is read here.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("pathGlobFilter", GLOB)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", "36500d")
    )
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    else:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archive_directory:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_directory)
    return reader.load(source_path).select("path", F.col("_metadata.file_path").alias(PATH), "length")


def landed_files(batch: DataFrame) -> list[LandedFile]:
    """File names of one batch, bounded by the trigger's cap.

    Distinct, because a name with glob characters in a batch makes the file
    source list the batch's other files twice.
    """
    return sorted({LandedFile(r["path"], r["length"]) for r in batch.select("path", "length").collect()})


def listed_together(spark: SparkSession) -> SparkSession:
    """The session, in which no more tasks list files than there are cores: Spark by itself gives each of more than 32 files
    a task of its own."""
    cores = spark.sparkContext.defaultParallelism
    if int(spark.conf.get(LISTERS)) > cores:
        spark.conf.set(LISTERS, cores)
    return spark


def decoded(uri: str) -> str:
    """The plain path of a file whose metadata gives ``uri``."""
    return unquote(uri)


def read_texts(spark: SparkSession, files: Sequence[LandedFile], lines: bool = False) -> DataFrame:
    """(path, value) with a file's whole text, or (path, split, nth, value) with a line, in the order of split and nth."""
    paths, path = [literal_path(f.path) for f in files], F.col("_metadata.file_path").alias(PATH)
    if not lines:
        return spark.read.text(paths, wholetext=True).select(path, "value")
    lines_of = spark.read.text(paths).select(
        path, F.col("_metadata.file_block_start").alias(SPLIT), F.monotonically_increasing_id().alias(NTH), "value"
    )
    return together(lines_of, sum(f.length for f in files))


def together(lines: DataFrame, length: int) -> DataFrame:
    """Lines of so many bytes in all, read by no more tasks than that many bytes or the cores are worth: a task reads its
    splits one after the other, and what it writes is one file, not one for each split."""
    return lines.coalesce(max(lines.sparkSession.sparkContext.defaultParallelism, ceil(length / TOGETHER)))


def parse(texts: DataFrame, schema: T.StructType, keys: Collection[str] = ()) -> DataFrame:
    """Records of ``read_texts``: path, name, position, off-schema data, then the schema's columns.

    The ``keys`` fields are checked against their types but kept as their text: deletes
    compare keys as text.
    """
    return parse_lines(texts, schema, keys) if SPLIT in texts.columns else parse_texts(texts, schema, keys)


def parse_texts(texts: DataFrame, schema: T.StructType, keys: Collection[str] = ()) -> DataFrame:
    """Records of whole-file texts ``(_input_file_path, value)``.

    A file without records keeps one row with no position, so it is still seen.
    """
    pair, records, at, position, bad = _text_columns()
    parsed = texts.select(PATH, pair).select(PATH, records)
    # The flag is set below the explode, so that no exploded row carries the whole array.
    rows = parsed.select(PATH, bad, "_records").select(PATH, "_malformed", at).withColumn(POS, position)
    return _fields(with_filename(rows), _unread(_MALFORMED, "_malformed"), schema, keys)


@kept
def _text_columns() -> tuple[Column, ...]:
    return (
        rescue.parsed(F.col("value")).alias("_pair"), rescue.records(F.col("_pair")).alias("_records"),
        F.posexplode_outer("_records").alias("_at", "_record"), F.col("_at").cast("long"),
        F.col("_records").isNull().alias("_malformed"),
    )


@kept
def _unread(text: str, when: str) -> Column:
    return F.when(F.expr(when), F.lit(text))


def parse_lines(texts: DataFrame, schema: T.StructType, keys: Collection[str] = ()) -> DataFrame:
    """Records of lines ``(_input_file_path, _split, _nth, value)``. The position is the pair of split and line; a
    blank line has none. A line must be one object."""
    position, several, record, single = _line_columns()
    rows = texts.select(PATH, position, several).select(PATH, POS, record, single)
    return _fields(with_filename(rows), _unread(_BAD_LINE, f"{POS} IS NOT NULL AND NOT _single"), schema, keys)


@kept
def _line_columns() -> tuple[Column, ...]:
    body = F.trim(F.col("value"), F.lit(rescue.BLANKS))
    several = F.from_json(F.concat(F.lit("["), body, F.lit("]")), rescue.RECORDS)
    single = F.size("_several") == 1
    return (
        F.when(body != "", F.struct(SPLIT, NTH)).alias(POS), several.alias("_several"),
        F.when(single, F.col("_several")[0]).alias("_record"), F.coalesce(single, F.lit(False)).alias("_single"),
    )


def _fields(rows: DataFrame, unread: Column, schema: T.StructType, keys: Collection[str]) -> DataFrame:
    """Path, name, position, off-schema data and the schema's columns, from rows with a ``_record``;
    ``unread`` tells what was wrong where there is none.

    Each step stands in a projection of its own, so that a field is looked up once and typed once.
    """
    known, last, raw, read, told = _field_columns(schema, frozenset(keys))
    rows = rows.select(PATH, NAME, POS, unread.alias("_unread"), "_record")
    rows = rows.withColumn("_known", known).withColumn("_record", last)
    return rows.select("*", *raw).select("*", *read).select(PATH, NAME, POS, *told)


@kept
def _field_columns(schema: T.StructType, keys: frozenset[str]) -> tuple[Column, Column, list[Column], list[Column], list[Column]]:
    record, known = F.col("_record"), F.col("_known")
    raw = {f.name: F.col(f"_raw_{i}") for i, f in enumerate(schema)}
    read = {f.name: F.col(f"_read_{i}") for i, f in enumerate(schema)}
    off_schema = F.when(F.col("_unread").isNotNull(), F.col("_unread")).when(
        F.col(POS).isNotNull(), rescue.rescued(record, schema, known, raw, read)
    )
    values = [(raw if f.name in keys else read)[f.name].alias(f.name) for f in schema]
    return (
        rescue.only_known(record, schema), rescue.last_values(record, known),
        [record.getItem(f.name).alias(f"_raw_{i}") for i, f in enumerate(schema)],
        [rescue.typed(raw[f.name], f.dataType).alias(f"_read_{i}") for i, f in enumerate(schema)],
        [off_schema.alias(RESCUED), *values],
    )


def typed_schema(texts: DataFrame) -> T.StructType:
    """The fields of all records of ``read_texts`` with their types, nested ones too, from one aggregation.

    Types are merged over all records: numbers to the wider one, what has nothing in common to a variant. Records that are
    no objects, or name a field twice, take no part. Only the merged type reaches the driver.
    """
    body = F.trim(F.col("value"), F.lit(rescue.BLANKS))
    if SPLIT in texts.columns:
        # what a line is shows in its first letter, so its type is not made for that
        objects = texts.filter(body.startswith("{")).select(F.try_parse_json(body).alias("v")).filter("v IS NOT NULL")
    else:
        whole = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
        records = texts.select(F.explode(F.from_json(whole, "array<variant>")).alias("v"))
        objects = records.filter(F.schema_of_variant("v").startswith("OBJECT"))
    found = objects.agg(F.schema_of_variant_agg("v").alias("type")).first()["type"]
    return _struct(found or "VOID")


_NAME = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def _struct(text: str) -> T.StructType:
    """The type that a variant's schema text names."""
    if not text.startswith("OBJECT"):
        return T.StructType()
    return T.DataType.fromDDL(_NAME.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text))


def infer_schema(spark: SparkSession, source_path: str, lines: bool = False) -> T.StructType:
    """Fields of all files in the folder as they are read: arrays of texts, and all else as text."""
    reader = spark.read.option("pathGlobFilter", GLOB).option("recursiveFileLookup", "true")
    texts = reader.text(source_path, wholetext=not lines)
    if lines:
        texts = together(texts, folder_bytes(spark, source_path)).withColumn(SPLIT, F.lit(0))
    array = T.ArrayType(T.StringType())
    fields = typed_schema(texts).fields
    return T.StructType([
        T.StructField(f.name, array if isinstance(f.dataType, T.ArrayType) else T.StringType())
        for f in sorted(fields, key=lambda f: f.name)
    ])


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    if not exists(spark, location):
        return None
    rows = spark.read.text(location, wholetext=True).take(1)
    return T._parse_datatype_json_string(rows[0]["value"]) if rows else None


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    clash = sorted(set(schema.names) & set(RESERVED))
    if clash:
        raise ValueError(f"Source fields with reserved names: {', '.join(clash)}")
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(location)


def source_schema(
    spark: SparkSession, source_path: str, location: str, lines: bool = False
) -> T.StructType:
    """The persisted schema; inferred and persisted on the first run."""
    known = load_schema(spark, location)
    if known is None:
        known = infer_schema(spark, source_path, lines)
        if known.fields:
            save_schema(spark, known, location)
    return known
