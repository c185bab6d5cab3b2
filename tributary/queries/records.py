"""Queries over records: JSON parsing, rescue, mapping, settings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import config as cfg
from tributary.operators.files import PATH, RESCUED
from tributary.operators.mapping import MappedColumn, add_audit, map_columns
from tributary.queries.feed import AT, table
from tributary.sources.landing import parse_texts

EVENT_SCHEMA = (
    T.StructType().add("event_id", T.LongType()).add("user_id", T.LongType())
    .add("event_type", T.StringType()).add("value", T.DoubleType())
)


def _event_texts(spark, sf_dir):
    """Every event as JSON text; errors carry an unknown field, sign-ups a value that is no number."""
    events = table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "signup", "n/a").otherwise(F.col("value").cast("string"))
    record = F.struct(
        "event_id", "user_id", "event_type", value.alias("value"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("debug"),
    )
    texts = events.select(F.concat(F.lit("landing/"), F.col("event_id").cast("string")).alias(PATH), F.to_json(record).alias("value"))
    return texts.repartition(PATH)  # parsing is the dear part; the table may be a single split


def rescued_data(spark, sf_dir):
    rows = parse_texts(_event_texts(spark, sf_dir), EVENT_SCHEMA)
    held = F.from_json(RESCUED, "map<string,string>")
    return rows.select(
        "event_id", "value", F.array_join(F.array_sort(F.map_keys(held)), ",").alias("fields"), held["debug"].alias("debug")
    )


def json_fields(spark, sf_dir):
    """Settings of which some are absent and some are no JSON."""
    kind = F.col("event_id") % 7
    props = F.when(kind == 0, F.lit("{bad")).when(kind != 1, F.col("props"))
    return table(spark, sf_dir, "events").withColumn("props", props).select("event_id", cfg.json_object("props")["k"].alias("k"))


def map_customer(spark, sf_dir):
    mapping = [
        MappedColumn("c_custkey", "id", T.LongType()),
        MappedColumn("c_name", "name", T.StringType()),
        MappedColumn("c_acctbal", "balance", T.DoubleType()),
        MappedColumn("c_fax", "fax", T.StringType()),
    ]
    rows = table(spark, sf_dir, "customer").withColumn("_sid", F.lit(1).cast("long"))
    mapped = add_audit(map_columns(rows, mapping, "_sid"), F.lit(AT))
    return mapped.select("id", "name", "balance", "sourceid", "deleted_flag", F.col("date_deleted").isNull().alias("live"))


def array_to_csv(spark, sf_dir):
    words = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return map_columns(words, [MappedColumn("p_partkey", "p_partkey"), MappedColumn("words", "p_name_csv")])


def typed_projection(spark, sf_dir):
    raw = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("event_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return map_columns(rows, [MappedColumn("event_id", "event_id"), MappedColumn("raw", "typed", T.LongType())])


def latest_config(spark, sf_dir):
    control = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ecname"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("modifieddate"),
        F.when(F.col("o_orderstatus") == "F", "y").otherwise("n").alias("enableflag"),
    )
    return cfg.latest_config(control).select(F.col("ecname").alias("o_custkey"), F.col("id").alias("o_orderkey"))


def _order_configs(spark, sf_dir, key=None):
    """A control row per order: three mapping entries, one of them unusable."""
    key = F.lit("id") if key is None else key
    settings = F.concat(
        F.lit("""{"mappings":[{"source":{"path":"$['o_custkey']"},"sink":{"name":\""""), key, F.lit("""\","type":"bigint"}},"""),
        F.lit("""{"source":{"path":"$["""), F.col("o_orderstatus"), F.lit("""]"},"sink":{"name":\""""),
        F.col("o_orderpriority"), F.lit("""\"}},{"source":{"path":"total"},"sink":{}}]}"""),
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("ecname"), settings.alias("mappingsettings"))


def parse_mappings(spark, sf_dir):
    return cfg.parse_mappings(_order_configs(spark, sf_dir)).withColumn("pos", F.col("pos").cast("long"))


def id_sources(spark, sf_dir):
    """Finished orders map no field to the key."""
    configs = _order_configs(spark, sf_dir, F.when(F.col("o_orderstatus") == "F", "other").otherwise("id"))
    return cfg.id_sources(cfg.parse_mappings(configs))


def target_check(spark, sf_dir):
    """Targets lack the sink of urgent orders; the other columns are there."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("ecname"), "o_orderpriority")
    columns = F.array(*[F.lit(c) for c in ("id", *cfg.AUDIT_COLUMNS)])
    target = orders.select(
        "ecname", F.explode(F.when(F.col("o_orderpriority") == "1-URGENT", columns).otherwise(F.array_append(columns, F.col("o_orderpriority")))).alias("sink")
    )
    return cfg.check_target(cfg.parse_mappings(_order_configs(spark, sf_dir)), target)


QUERIES = {
    f.__name__: f
    for f in (
        rescued_data, json_fields, map_customer, array_to_csv, typed_projection, latest_config, parse_mappings,
        id_sources, target_check,
    )
}

ORACLES = {
    "rescued_data": """SELECT event_id, CASE WHEN event_type <> 'signup' THEN value END AS value,
        CASE WHEN event_type = 'error' THEN 'debug' WHEN event_type = 'signup' THEN 'value' END AS fields,
        CASE WHEN event_type = 'error' THEN props END AS debug FROM events""",
    "json_fields": "SELECT event_id, CASE WHEN event_id % 7 > 1 THEN json_extract_string(props, '$.k') END AS k FROM events",
    "map_customer": """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(1 AS BIGINT) AS sourceid,
        'N' AS deleted_flag, TRUE AS live FROM customer""",
    "array_to_csv": "SELECT p_partkey, array_to_string(string_split(p_name, ' '), ',') AS p_name_csv FROM part",
    "typed_projection": """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a'
        ELSE CAST(event_id AS VARCHAR) END AS BIGINT) AS typed FROM events""",
    "latest_config": """SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "parse_mappings": """SELECT CAST(o_orderkey AS VARCHAR) AS ecname, CAST(0 AS BIGINT) AS pos, 'o_custkey' AS source,
        'id' AS sink, 'bigint' AS type FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(1 AS BIGINT), o_orderstatus, o_orderpriority, NULL FROM orders""",
    "id_sources": """SELECT CAST(o_orderkey AS VARCHAR) AS ecname,
        CASE WHEN o_orderstatus = 'F' THEN 'id' ELSE 'o_custkey' END AS id_source FROM orders""",
    "target_check": """SELECT CAST(o_orderkey AS VARCHAR) AS ecname, o_orderpriority AS sink FROM orders
        WHERE o_orderpriority = '1-URGENT'""",
}
