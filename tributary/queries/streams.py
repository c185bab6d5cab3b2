"""Queries that run the ingestion itself: JSON landing files, stream, merge, logs."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.audit import DRIFT_MESSAGE
from tributary.operators.files import PATH
from tributary.plans.target import create_target
from tributary.queries.feed import DRIFT_ABOVE_DAILY, STATE_SQL, records_of, table
from tributary.queries.landed import RECORDS_PER_FILE, chunked, write_files
from tributary.queries.state import STATE
from tributary.session import scratch_dir
from tributary.sources.landing import save_schema, typed_schema
from tributary.streaming.ingest import Ingest, IngestConfig, load_config, run_sources

AUDIT = "sourceid bigint, loaddtm timestamp, deleted_flag string, date_deleted timestamp"
USERS = {"user_id": ("id", "bigint"), "event_type": ("name", "string"), "value": ("amount", "double")}
ORDERS = {"o_custkey": ("id", "bigint"), "o_orderpriority": ("name", "string"), "o_totalprice": ("amount", "double")}


def _config(spark, folder, columns, ecname, merge=None, **settings) -> IngestConfig:
    """Control rows and an empty target for one source below ``folder``."""
    target = f"default.{ecname}_{uuid.uuid4().hex}"
    create_target(spark, target, f"{', '.join(' '.join(c) for c in columns.values())}, {AUDIT}", f"{folder}/target")
    entries = [{"source": {"path": f"$['{s}']"}, "sink": {"name": n, "type": t}} for s, (n, t) in columns.items()]
    control = spark.createDataFrame(
        [(1, ecname, json.dumps({"mappings": entries}), "y", datetime(2024, 1, 1))],
        "id long, ecname string, mappingsettings string, enableflag string, modifieddate timestamp",
    )
    row = {
        "ecname": ecname, "enabled_flag": "y", "source_path": f"{folder}/in", "schema_location": f"{folder}/schema",
        "checkpoint_location": f"{folder}/checkpoint", "target_full_name": target, "target_partitions": "8", **settings,
    }
    loader = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    merges = None
    if merge is not None:
        merges = spark.createDataFrame([(ecname, "merge", json.dumps(merge))], "query_name string, query_type string, query_text string")
    return load_config(spark, ecname, control, loader, merges=merges)


def _event_files(spark, sf_dir, folder, extra=None, alone=None, lines=False, rows=None):
    """Files by day; the records where ``alone`` holds each in a file of its own."""
    day = F.date_format("ts", "yyyyMMdd")
    if alone is not None:
        day = F.when(alone, F.concat(day, F.lit("_one_"), F.col("event_id").cast("string"))).otherwise(day)
    events = (table(spark, sf_dir, "events") if rows is None else rows).select(
        day.alias("day"),
        F.when(F.col("event_type") == "error", "_delete_users.json").otherwise("_users.json").alias("suffix"),
        F.col("event_id").alias("pos"),
        F.to_json(F.struct("user_id", "event_type", "value", *([extra] if extra is not None else []))).alias("json"),
    )
    write_files(spark, events.select(chunked("day", "pos", "suffix").alias("fn"), "pos", "json"), folder, lines)


def _order_files(spark, sf_dir, folder):
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMM")).alias("month"),
        F.when(F.col("o_orderstatus") == "F", "_delete.json").otherwise(".json").alias("suffix"),
        F.col("o_orderkey").alias("pos"),
        F.to_json(F.struct("o_custkey", "o_orderpriority", "o_totalprice")).alias("json"),
    )
    write_files(spark, orders.select(chunked("month", "pos", "suffix").alias("fn"), "pos", "json"), folder)


def ingest_stream(spark, sf_dir):
    """JSON files drained in several capped batches; the published target."""
    folder = scratch_dir(spark, "stream")
    _event_files(spark, sf_dir, folder)
    cfg = _config(spark, folder, USERS, "users", max_files_per_trigger="40")
    Ingest(spark, cfg).run()
    return spark.table(cfg.target).select(*STATE)


class _FailsOnce(Ingest):
    """Stops the run just before its first batch is decided."""

    def start(self):
        def fail(**_):
            raise RuntimeError("forced failure before the record")

        self.data.decide = fail
        return super().start()


def ingest_replay(spark, sf_dir):
    """A run that fails after its batch was written, then a second run."""
    folder = scratch_dir(spark, "replay")
    _event_files(spark, sf_dir, folder)
    cfg = _config(spark, folder, USERS, "users")
    try:
        _FailsOnce(spark, cfg).run()
    except StreamingQueryException:
        pass
    Ingest(spark, cfg).run()
    return spark.table(cfg.target).select(*STATE)


def ingest_batches(spark, sf_dir):
    """The feed in weekly batches, each merged into the target."""
    folder = scratch_dir(spark, "batches")
    cfg = _config(spark, folder, USERS, "users")
    save_schema(spark, T.StructType([T.StructField(c, T.StringType()) for c in USERS]), cfg.schema_location)
    ingest = Ingest(spark, cfg)
    ingest.prepare()
    events = table(spark, sf_dir, "events")
    weeks = events.select(F.date_trunc("week", F.to_date("ts")).alias("week")).distinct()
    for number, first in enumerate(weeks.orderBy("week").collect()):
        # a range of the table's own column, which reaches the scan
        begin = F.lit(first["week"])
        week = events.filter((F.col("ts") >= begin) & (F.col("ts") < begin + F.expr("INTERVAL 7 DAYS")))
        part = records_of(week).withColumn("user_id", F.col("user_id").cast("string"))
        ingest.run_records(lambda part=part: part, "weekly", number)
    return spark.table(cfg.target).select(*STATE)


def sources_parallel(spark, sf_dir):
    """Three sources at once, each with its own folders; one cannot start, as its folder is not there. Its rows, and both
    other targets together."""
    folder = scratch_dir(spark, "sources")
    _event_files(spark, sf_dir, f"{folder}/users")
    _order_files(spark, sf_dir, f"{folder}/orders")
    configs = [_config(spark, f"{folder}/users", USERS, "users"), _config(spark, f"{folder}/orders", ORDERS, "orders")]
    lost = _config(spark, f"{folder}/lost", USERS, "lost")
    outcome = run_sources(spark, [lost, *configs])
    for cfg in configs:
        if outcome[cfg.ecname] is not None:
            raise outcome[cfg.ecname]
    if outcome["lost"] is None or not spark.table(lost.target).isEmpty():
        raise RuntimeError("a source without a folder counts as drained")
    targets = [spark.table(c.target).select(F.lit(c.ecname).alias("ecname"), *STATE) for c in configs]
    return targets[0].unionByName(targets[1])


def _drifting(spark, sf_dir, label):
    """Files whose large amounts carry a field that the source schema does not know."""
    folder = scratch_dir(spark, label)
    _event_files(spark, sf_dir, folder, F.when(F.col("value") > DRIFT_ABOVE_DAILY, "large").alias("size"))
    cfg = _config(spark, folder, USERS, "users")
    save_schema(spark, T.StructType([T.StructField(c, T.StringType()) for c in USERS]), cfg.schema_location)
    return Ingest(spark, cfg)


def rejected_files(spark, sf_dir):
    """The schema-error log of a run with drifted files."""
    ingest = _drifting(spark, sf_dir, "rejected")
    ingest.run()
    return ingest.schema_errors().select("filename", "error_message")


def quarantine_replay(spark, sf_dir):
    """Drifted files are set aside, then accepted under a wider schema with later ids."""
    ingest = _drifting(spark, sf_dir, "quarantine")
    ingest.run()
    ingest.replay_quarantine(T.StructType([T.StructField(c, T.StringType()) for c in (*USERS, "size")]))
    return spark.table(ingest.cfg.target).select(*STATE)


def ingest_log(spark, sf_dir):
    """The file log of a run."""
    folder = scratch_dir(spark, "log")
    _event_files(spark, sf_dir, folder)
    ingest = Ingest(spark, _config(spark, folder, USERS, "users"))
    ingest.run()
    return ingest.file_log().select("id", "filename", "status", "file_rows")


def archived_files(spark, sf_dir):
    """Files moved to the archive: those of all batches but the last."""
    folder = scratch_dir(spark, "archive")
    _event_files(spark, sf_dir, folder)
    cfg = _config(
        spark, folder, USERS, "users", max_files_per_trigger="40", archive_enabled="y", archive_directory=f"{folder}/archive"
    )
    Ingest(spark, cfg).run()
    archive = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/archive")
    return archive.select(F.element_at(F.split("path", "/"), -1).alias("filename"))


def ingest_bytes(spark, sf_dir):
    """A run under a byte cap, beside a marker that is no JSON file."""
    folder = scratch_dir(spark, "bytes")
    _event_files(spark, sf_dir, folder)
    spark.range(0, 1, 1, 1).select(F.lit("not json").alias("value")).write.text(f"{folder}/in/marker.done")
    cfg = _config(spark, folder, USERS, "users", max_bytes_per_trigger="400000")
    Ingest(spark, cfg).run()
    return spark.table(cfg.target).select(*STATE)


def ingest_large_files(spark, sf_dir):
    """Files of one record a line, which are read in many splits, some of a single record."""
    folder = scratch_dir(spark, "large")
    _event_files(spark, sf_dir, folder, alone=F.col("event_id") % 1000 == 7, lines=True)
    cfg = _config(spark, folder, USERS, "users", json_lines="Y")
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, "4k")
    try:
        Ingest(spark, cfg).run()
    finally:
        spark.conf.set(split, before)
    return spark.table(cfg.target).select(*STATE)


def ingest_columns(spark, sf_dir):
    """Two halves of the feed under different mappings: the first without ``amount``."""
    folder = scratch_dir(spark, "columns")
    cfg = _config(spark, folder, USERS, "users")
    save_schema(spark, T.StructType([T.StructField(c, T.StringType()) for c in USERS]), cfg.schema_location)
    events = table(spark, sf_dir, "events")
    half = events.select(F.median("event_id")).scalar()
    narrow = replace(cfg, mapping=tuple(m for m in cfg.mapping if m.sink != "amount"))
    for number, (part, own) in enumerate(((F.col("event_id") < half, narrow), (F.col("event_id") >= half, cfg))):
        ingest = Ingest(spark, own)
        ingest.prepare()
        rows = records_of(events.filter(part)).withColumn("user_id", F.col("user_id").cast("string"))
        ingest.run_records(lambda rows=rows: rows, "halves", number)
    return spark.table(cfg.target).select(*STATE)


LINES = {
    "l_orderkey": ("order_id", "bigint"), "l_linenumber": ("line", "int"), "l_extendedprice": ("price", "double"),
    "l_returnflag": ("flag", "string"),
}


def merge_specs(spark, sf_dir):
    """Two sources with merge specs of their own, in several batches. Lines have a key of two columns, and a known line
    takes a new price only. Users keep their greatest amount, and the name that came first."""
    folder = scratch_dir(spark, "specs")
    order = [F.col(c) for c in ("l_shipdate", "l_extendedprice", "l_returnflag")]
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("lines_"), F.date_format("l_shipdate", "yyyyMM"), F.lit(".json")).alias("fn"),
        F.struct(*order).alias("pos"), F.to_json(F.struct(*LINES)).alias("json"),
    )
    write_files(spark, lines, f"{folder}/lines", lines=True)
    by_line = _config(
        spark, f"{folder}/lines", LINES, "lines", {"key": ["order_id", "line"], "update_cols": ["price"]},
        max_files_per_trigger="40", json_lines="Y",
    )
    users = table(spark, sf_dir, "events").filter("event_type <> 'error'")
    _event_files(spark, sf_dir, f"{folder}/users", rows=users)
    by_amount = _config(
        spark, f"{folder}/users", USERS, "users", {"key": ["id"], "order_col": "amount", "update_cols": ["amount"]},
        max_files_per_trigger="12",
    )
    for ecname, error in run_sources(spark, [by_line, by_amount]).items():
        if error is not None:
            raise error
    a = spark.table(by_line.target).select(
        F.lit("lines").alias("ecname"), F.concat_ws("-", "order_id", "line").alias("key"), F.col("price").alias("amount"),
        F.col("flag").alias("name"), "sourceid",
    )
    b = spark.table(by_amount.target).select(
        F.lit("users").alias("ecname"), F.col("id").cast("string").alias("key"), "amount", "name", "sourceid"
    )
    return a.unionByName(b)


class _StopsInSecondBatch(Ingest):
    """Stops the run when its second batch is staged and decided, before the target and the logs have it."""

    def _settle(self, batch):
        if batch["seq"] == 2:
            raise RuntimeError("forced failure before the target")
        super()._settle(batch)


def staging_tables(spark, sf_dir):
    """What both staging tables hold when a run has stopped between two batches: rows of the second, as the first is
    logged. A run that goes on empties them."""
    folder = scratch_dir(spark, "staging")
    _event_files(spark, sf_dir, folder)
    cfg = _config(spark, folder, USERS, "users", max_files_per_trigger="40")
    try:
        _StopsInSecondBatch(spark, cfg).run()
    except StreamingQueryException:
        pass
    upserts = spark.table(cfg.staging_table).select(
        F.lit("upsert").alias("kind"), F.col("id").cast("string").alias("id"), "name", "amount", "sourceid"
    )
    deletes = spark.table(cfg.delete_staging_table).select(F.lit("delete").alias("kind"), "id", "sourceid")
    held = f"{folder}/held"
    upserts.unionByName(deletes, allowMissingColumns=True).write.parquet(held)
    Ingest(spark, cfg).run()
    if not (spark.table(cfg.staging_table).isEmpty() and spark.table(cfg.delete_staging_table).isEmpty()):
        raise RuntimeError("staging holds rows of files that are through")
    return spark.read.parquet(held)


def typed_fields(spark, sf_dir):
    """The merged type of every field of the feed: nested records, arrays, numbers of two kinds, and values that are
    text in some records and numbers in others."""
    odd = F.col("event_id") % 10 == 0
    record = F.struct(
        "user_id", "event_type", F.col("value").alias("amount"),
        F.struct(F.col("event_id").alias("number"), F.array("event_type").alias("tags")).alias("meta"),
        F.array(F.struct(F.col("value").alias("v"))).alias("parts"),
    )
    text = F.to_json(record)
    mixed = F.when(odd, F.lit(',"mixed":"many"')).otherwise(F.concat(F.lit(',"mixed":'), F.col("event_id").cast("string")))
    wide = F.when(odd, F.lit(',"wide":2.5')).otherwise(F.lit(',"wide":2'))
    lines = table(spark, sf_dir, "events").select(
        F.lit("feed").alias(PATH), F.lit(0).alias("_split"), F.col("event_id").alias("_nth"),
        F.concat(F.regexp_replace(text, r"\}$", ""), mixed, wide, F.lit("}")).alias("value"),
    )
    # how many digits a number with a point needs follows from the data, that it is one does not
    fields = [(f.name, re.sub(r"decimal\([0-9,]+\)", "decimal", f.dataType.simpleString())) for f in typed_schema(lines).fields]
    return spark.createDataFrame(fields, "name string, type string")


QUERIES = {
    f.__name__: f
    for f in (
        ingest_stream, ingest_replay, ingest_batches, sources_parallel, rejected_files, quarantine_replay, ingest_log,
        archived_files, ingest_bytes, ingest_large_files, ingest_columns, merge_specs, staging_tables, typed_fields,
    )
}


def _chunk(column: str) -> str:
    return f"'_' || lpad(CAST({column} // {RECORDS_PER_FILE} AS VARCHAR), 12, '0') || "


USERS_SQL = f"""
WITH feed AS (
  SELECT event_id AS pos, user_id AS id, event_type AS name, value AS amount, strftime(ts, '%Y%m%d') || {_chunk('event_id')}
    CASE WHEN event_type = 'error' THEN '_delete_users.json' ELSE '_users.json' END AS fn FROM events),"""

ORDERS_SQL = f"""
WITH feed AS (
  SELECT o_orderkey AS pos, o_custkey AS id, o_orderpriority AS name, o_totalprice AS amount,
    'orders_' || strftime(o_orderdate, '%Y%m') || {_chunk('o_orderkey')}
    CASE WHEN o_orderstatus = 'F' THEN '_delete.json' ELSE '.json' END AS fn FROM orders),"""

NUMBERED = "files AS (SELECT fn, row_number() OVER (ORDER BY fn) AS sid FROM (SELECT DISTINCT fn FROM feed)),"

CHANGES = """
w AS (SELECT f.*, s.sid, contains(lower(f.fn), 'delete') AS is_delete FROM feed f JOIN files s USING (fn)),
stg AS (SELECT id, name, amount, sid FROM w WHERE NOT is_delete
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY sid DESC, pos DESC) = 1),
del AS (SELECT CAST(id AS VARCHAR) AS id, max(sid) AS sid FROM w WHERE is_delete GROUP BY 1)"""

DRIFTED = f"drifted AS (SELECT DISTINCT fn FROM feed WHERE amount > {DRIFT_ABOVE_DAILY}),"

# Files that were set aside are numbered after all others, again by name.
REPLAYED = DRIFTED + """
files AS (SELECT fn, row_number() OVER (ORDER BY fn IN (SELECT fn FROM drifted), fn) AS sid
  FROM (SELECT DISTINCT fn FROM feed)),"""

ORACLES = {
    "ingest_stream": USERS_SQL + NUMBERED + CHANGES + STATE_SQL,
    "ingest_replay": USERS_SQL + NUMBERED + CHANGES + STATE_SQL,
    "ingest_batches": USERS_SQL.replace(_chunk("event_id"), "") + NUMBERED + CHANGES + STATE_SQL,
    "sources_parallel": f"""SELECT 'users' AS ecname, * FROM ({USERS_SQL + NUMBERED + CHANGES + STATE_SQL})
        UNION ALL SELECT 'orders', * FROM ({ORDERS_SQL + NUMBERED + CHANGES + STATE_SQL})""",
    "rejected_files": USERS_SQL + DRIFTED + """x AS (SELECT 1)
        SELECT fn AS filename, '""" + DRIFT_MESSAGE + """' AS error_message FROM drifted""",
    "quarantine_replay": USERS_SQL + REPLAYED + CHANGES + STATE_SQL,
    "archived_files": USERS_SQL + NUMBERED + """x AS (SELECT count(*) AS n FROM files)
        SELECT fn AS filename FROM files, x WHERE sid <= (n - 1) // 40 * 40""",
    "ingest_bytes": USERS_SQL + NUMBERED + CHANGES + STATE_SQL,
    "ingest_large_files": USERS_SQL.replace("'%Y%m%d') ||", "'%Y%m%d') || CASE WHEN event_id % 1000 = 7"
        " THEN '_one_' || CAST(event_id AS VARCHAR) ELSE '' END ||") + NUMBERED + CHANGES + STATE_SQL,
    "ingest_columns": """
WITH feed AS (SELECT event_id AS pos, user_id AS id, event_type AS name, value AS amount,
    event_id >= (SELECT median(event_id) FROM events) AS late, strftime(ts, '%Y%m%d') ||
    CASE WHEN event_type = 'error' THEN '_delete_users.json' ELSE '_users.json' END AS fn FROM events),
files AS (SELECT late, fn, row_number() OVER (ORDER BY late, fn) AS sid FROM (SELECT DISTINCT late, fn FROM feed)),
w AS (SELECT f.*, s.sid, contains(lower(f.fn), 'delete') AS is_delete FROM feed f JOIN files s USING (late, fn)),
a AS (SELECT * FROM w WHERE NOT is_delete AND NOT late QUALIFY row_number() OVER (PARTITION BY id ORDER BY sid DESC, pos DESC) = 1),
b AS (SELECT * FROM w WHERE NOT is_delete AND late QUALIFY row_number() OVER (PARTITION BY id ORDER BY sid DESC, pos DESC) = 1),
stg AS (SELECT coalesce(b.id, a.id) AS id, coalesce(b.name, a.name) AS name, b.amount, coalesce(b.sid, a.sid) AS sid
  FROM a FULL JOIN b ON a.id = b.id),
del AS (SELECT CAST(id AS VARCHAR) AS id, max(sid) AS sid FROM w WHERE is_delete GROUP BY 1)""" + STATE_SQL,
    "ingest_log": USERS_SQL + NUMBERED + CHANGES + """
        SELECT sid AS id, fn AS filename, 'SUCCESS' AS status,
        (SELECT count(*) FROM feed f WHERE f.fn = files.fn) AS file_rows FROM files""",
    "merge_specs": f"""
WITH line_feed AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key, l_extendedprice AS amount,
    l_returnflag AS name, l_shipdate AS pos, 'lines_' || strftime(l_shipdate, '%Y%m') || '.json' AS fn FROM lineitem),
line_files AS (SELECT fn, row_number() OVER (ORDER BY fn) AS sid FROM (SELECT DISTINCT fn FROM line_feed)),
line_rows AS (SELECT *, (sid - 1) // 40 AS batch FROM line_feed JOIN line_files USING (fn)),
user_feed AS (SELECT CAST(user_id AS VARCHAR) AS key, event_type AS name, value AS amount, event_id AS pos,
    strftime(ts, '%Y%m%d') || {_chunk('event_id')} '_users.json' AS fn FROM events WHERE event_type <> 'error'),
user_files AS (SELECT fn, row_number() OVER (ORDER BY fn) AS sid FROM (SELECT DISTINCT fn FROM user_feed)),
user_rows AS (SELECT *, (sid - 1) // 12 AS batch FROM user_feed JOIN user_files USING (fn)),
line_first AS (SELECT key, name FROM line_rows
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY batch, sid DESC, pos DESC, amount DESC, name DESC) = 1),
line_last AS (SELECT key, amount, sid FROM line_rows
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY sid DESC, pos DESC, amount DESC, name DESC) = 1),
user_first AS (SELECT key, name FROM user_rows
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY batch, amount DESC, sid DESC, pos DESC) = 1),
user_most AS (SELECT key, amount, sid FROM user_rows
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY amount DESC, sid DESC, pos DESC) = 1)
SELECT 'lines' AS ecname, key, amount, name, sid AS sourceid FROM line_last JOIN line_first USING (key)
UNION ALL SELECT 'users', key, amount, name, sid FROM user_most JOIN user_first USING (key)""",
    "staging_tables": USERS_SQL + NUMBERED + """
w AS (SELECT f.*, s.sid, contains(lower(f.fn), 'delete') AS is_delete FROM feed f JOIN files s USING (fn) WHERE sid > 40 AND sid <= 80),
stg AS (SELECT id, name, amount, sid FROM w WHERE NOT is_delete
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY sid DESC, pos DESC) = 1)
SELECT 'upsert' AS kind, CAST(id AS VARCHAR) AS id, name, amount, sid AS sourceid FROM stg
UNION ALL SELECT 'delete', CAST(id AS VARCHAR), NULL, NULL, max(sid) FROM w WHERE is_delete GROUP BY id""",
    "typed_fields": """
SELECT name, type FROM (VALUES ('user_id', 'bigint'), ('event_type', 'string'), ('amount', 'decimal'), ('mixed', 'variant'),
  ('meta', 'struct<number:bigint,tags:array<string>>'), ('parts', 'array<struct<v:decimal>>'), ('wide', 'decimal')) t(name, type)
WHERE EXISTS (SELECT 1 FROM events)""",
}
