"""Control-table operators: newest settings, mappings, target check."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from tributary.functions.scalars import mapping_source
from tributary.operators.merge import latest_per_key
from tributary.operators.spec import AUDIT_COLUMNS



_SETTINGS = "struct<mappings:array<string>>"
_MAPPING = "struct<source:struct<path:string>,sink:struct<name:string,type:string>>"


def latest_config(control: DataFrame) -> DataFrame:
    """Newest enabled control row of every source."""
    enabled = control.filter(F.col("enableflag") == "y")
    return latest_per_key(enabled, ["ecname"], [F.col("modifieddate").desc(), F.col("id").desc()])


def json_object(text: str) -> F.Column:
    """A settings column as a map; bad or absent JSON is an empty one."""
    return F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>"))


def parse_mappings(configs: DataFrame) -> DataFrame:
    """(ecname, pos, source, sink, type) for every usable entry of ``mappingsettings``.

    Entries are parsed one by one, so a bad one is skipped alone; a source named
    again takes the later sink and keeps its first place. A sink's type is the
    last one given for it.
    """
    # Parsed inside the explode: a filter on its output cannot repeat the parsing.
    texts = F.from_json("mappingsettings", _SETTINGS)["mappings"]
    entries = F.transform(texts, lambda entry: F.from_json(entry, _MAPPING))
    # Shuffled by source before the parsing, so that this is spread and all below is grouped without another shuffle.
    parsed = (
        configs.select("ecname", "mappingsettings").repartition("ecname").select("ecname", F.posexplode(entries).alias("pos", "m"))
        .select("ecname", "pos", "m.source.path", F.col("m.sink.name").alias("sink"), F.col("m.sink.type").alias("type"))
        .select("ecname", "pos", mapping_source(F.col("path")).alias("source"), "sink", "type")
        .filter((F.length("source") > 0) & (F.length("sink") > 0))
    )
    of_sink = Window.partitionBy("ecname", "sink")
    given = F.when(F.length("type") > 0, F.col("pos"))
    return (
        parsed.withColumn("type", F.max_by("type", given).over(of_sink))
        .groupBy("ecname", "source")
        .agg(F.min("pos").alias("pos"), F.max_by("sink", "pos").alias("sink"), F.max_by("type", "pos").alias("type"))
        .select("ecname", "pos", "source", "sink", "type")
    )


def id_sources(mappings: DataFrame) -> DataFrame:
    """Source field of the key for every source; ``id`` where none is mapped to it."""
    return mappings.groupBy("ecname").agg(
        F.coalesce(F.min_by(F.when(F.col("sink") == "id", F.col("source")), F.when(F.col("sink") == "id", F.col("pos"))), F.lit("id")).alias("id_source")
    )


def check_target(mappings: DataFrame, target_columns: DataFrame) -> DataFrame:
    """Mapped sinks and audit columns that the target lacks, as (ecname, sink)."""
    audit = F.array(*[F.lit(c) for c in AUDIT_COLUMNS])
    # one pass over the mappings, whose rows of a source stand together; a source's sinks fit a row as its settings do
    needed = mappings.groupBy("ecname").agg(F.collect_set("sink").alias("sinks"), F.max(F.col("sink").isNull()).alias("unnamed"))
    sinks = F.concat(F.array_union("sinks", audit), F.when(F.col("unnamed"), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>")))
    needed = needed.select("ecname", F.explode(sinks).alias("sink"))
    return needed.join(target_columns.select("ecname", "sink"), ["ecname", "sink"], "left_anti")


def declared_type(name: str | None) -> T.DataType | None:
    """The type a mapping names, or None where Spark does not know the name."""
    if not name:
        return None
    try:
        return T.DataType.fromDDL(name)
    except Exception:
        return None
