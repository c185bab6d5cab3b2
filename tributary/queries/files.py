"""Queries over the files of a feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.scalars import basename, flag, message, run_label
from tributary.operators import audit, files as ops
from tributary.operators.files import NAME, PATH, POS, SID
from tributary.plans.batch import plan_changes
from tributary.queries.feed import AT, DRIFT_ABOVE, EVENT_MAPPING, event_records, table, with_feed

HOURLY, HOURLY_SQL = "yyyyMMddHH", "%Y%m%d%H"


def file_inventory(spark, sf_dir):
    return ops.file_inventory(event_records(spark, sf_dir)).select(F.col(NAME).alias("fn"), "file_rows")


def source_ids(spark, sf_dir, last_id=0):
    """Few files in a range, so that the ranges' counts matter."""
    inventory = ops.file_inventory(event_records(spark, sf_dir))
    return ops.assign_source_ids(inventory, last_id, ops.name_splitters(inventory, together=4)).select(F.col(NAME).alias("fn"), F.col(SID).alias("sid"))


def source_ids_resume(spark, sf_dir):
    return source_ids(spark, sf_dir, last_id=100)


def tag_rows(spark, sf_dir):
    rows = event_records(spark, sf_dir)
    ids = ops.assign_source_ids(ops.file_inventory(rows))
    return ops.tag_rows(rows, ids).select(F.col(POS).alias("pos"), F.col(NAME).alias("fn"), F.col(SID).alias("sid"))


def route_files(spark, sf_dir):
    marked = ops.mark_route(event_records(spark, sf_dir))
    return marked.groupBy(F.col(NAME).alias("fn"), F.col("_is_delete").alias("is_delete")).agg(F.count("*").alias("n"))


def drift_files(spark, sf_dir):
    return ops.drift_files(event_records(spark, sf_dir, HOURLY, drift=True)).select(F.col(NAME).alias("fn"))


def drift_survivors(spark, sf_dir):
    clean, _ = ops.split_drift(event_records(spark, sf_dir, HOURLY, drift=True))
    return clean.select(F.col(POS).alias("pos"), F.col(NAME).alias("fn"))


def path_basename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", basename(F.col("url")).alias("name"))


def run_labels(spark, sf_dir):
    run = F.when(F.col("event_type") != "error", F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", run_label(run, F.col("event_id")).alias("label"))


def _changes(spark, sf_dir):
    records = event_records(spark, sf_dir)
    files = ops.number_files(ops.file_inventory(records))
    return files, plan_changes(records, files, EVENT_MAPPING, "user_id", F.lit(AT))


def file_log(spark, sf_dir):
    files, changes = _changes(spark, sf_dir)
    merged = changes.staged.agg(F.count("*")).scalar()
    rows = audit.file_log(files, "users", merged, F.lit(7), F.lit("manual_run_0"), F.lit(AT), F.lit(0))
    return rows.select("id", "tablename", "filename", "status", "lndrowscopied", "stgrowscopied", "file_rows")


def clean_staging(spark, sf_dir):
    files, changes = _changes(spark, sf_dir)
    status = F.when(F.col(SID) % 3 != 0, audit.SUCCESS).otherwise(audit.FAILED)
    log = files.select(F.col(SID).alias("id"), F.lit("users").alias("tablename"), status.alias("status"))
    return audit.clean_staging(changes.staged, log, "users").select("id", "sourceid")


def error_texts(spark, sf_dir):
    """Long texts as error messages."""
    return table(spark, sf_dir, "documents").select("doc_id", message(F.col("text")).alias("cmnts"))


def switches(spark, sf_dir):
    """Yes/no settings in several spellings."""
    text = F.when(F.col("o_orderstatus") == "F", F.lit(" Yes ")).when(F.col("o_orderstatus") == "O", F.lit("N"))
    return table(spark, sf_dir, "orders").select("o_orderkey", flag(text).alias("on"))


def schema_errors(spark, sf_dir):
    drifted = ops.drift_files(event_records(spark, sf_dir, HOURLY, drift=True))
    rows = audit.schema_error_log(drifted, "users", F.lit(7), F.lit("manual_run_0"), F.lit(AT))
    return rows.select("tablename", "filename", "error_message", "pipelinerunid", F.col("batchid").cast("long").alias("batchid"))


def error_log(spark, sf_dir):
    drifted = ops.drift_files(event_records(spark, sf_dir, HOURLY, drift=True))
    rows = audit.error_log(
        drifted, "users", audit.STEP_SCHEMA_DRIFT, F.lit(audit.DRIFT_MESSAGE), F.lit(7), F.lit("manual_run_0"), F.lit(AT)
    )
    return rows.select("tablename", "filename", "step_name", "status", "cmnts")


def batch_summary(spark, sf_dir):
    return audit.batch_summary(event_records(spark, sf_dir, HOURLY, drift=True), "user_id")


QUERIES = {
    f.__name__: f
    for f in (
        file_inventory, source_ids, source_ids_resume, tag_rows, route_files, drift_files, drift_survivors,
        path_basename, run_labels, error_texts, switches, file_log, clean_staging, schema_errors, error_log, batch_summary,
    )
}

_DRIFTED = f"SELECT DISTINCT fn FROM w WHERE amount > {DRIFT_ABOVE}"

ORACLES = {
    "file_inventory": with_feed("SELECT fn, count(*) AS file_rows FROM feed GROUP BY fn"),
    "source_ids": with_feed("SELECT fn, sid FROM files"),
    "source_ids_resume": with_feed("SELECT fn, 100 + sid AS sid FROM files"),
    "tag_rows": with_feed("SELECT pos, fn, sid FROM w"),
    "route_files": with_feed("SELECT fn, is_delete, count(*) AS n FROM w GROUP BY 1, 2"),
    "drift_files": with_feed(_DRIFTED, HOURLY_SQL),
    "drift_survivors": with_feed(f"SELECT pos, fn FROM w WHERE fn NOT IN ({_DRIFTED})", HOURLY_SQL),
    "path_basename": "SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS name FROM pages",
    "run_labels": """SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type ELSE 'manual_run' END
        || '_' || CAST(event_id AS VARCHAR) AS label FROM events""",
    "file_log": with_feed("""SELECT sid AS id, 'users' AS tablename, fn AS filename, 'SUCCESS' AS status,
        (SELECT count(*) FROM stg) AS lndrowscopied, (SELECT count(*) FROM stg) AS stgrowscopied, n AS file_rows
        FROM files JOIN (SELECT fn, count(*) AS n FROM feed GROUP BY fn) USING (fn)"""),
    "clean_staging": with_feed(
        "SELECT id, sid AS sourceid FROM stg WHERE sid NOT IN (SELECT sid FROM files WHERE sid % 3 <> 0)"
    ),
    "error_texts": "SELECT doc_id, substr(text, 1, 4000) AS cmnts FROM documents",
    "switches": 'SELECT o_orderkey, o_orderstatus = \'F\' AS "on" FROM orders',
    "schema_errors": with_feed(
        f"""SELECT 'users' AS tablename, fn AS filename, '{audit.DRIFT_MESSAGE}' AS error_message,
        'manual_run_0' AS pipelinerunid, CAST(7 AS BIGINT) AS batchid FROM ({_DRIFTED})""",
        HOURLY_SQL,
    ),
    "error_log": with_feed(
        f"""SELECT 'users' AS tablename, fn AS filename, '{audit.STEP_SCHEMA_DRIFT}' AS step_name, 'FAILED' AS status,
        '{audit.DRIFT_MESSAGE}' AS cmnts FROM ({_DRIFTED})""",
        HOURLY_SQL,
    ),
    "batch_summary": with_feed(
        f""", drifted AS ({_DRIFTED}), ok AS (SELECT * FROM w WHERE fn NOT IN (SELECT fn FROM drifted))
        SELECT (SELECT count(DISTINCT fn) FROM ok) AS files,
        (SELECT count(DISTINCT id) FROM ok WHERE NOT is_delete) AS merged,
        (SELECT count(DISTINCT id) FROM ok WHERE is_delete) AS deleted,
        (SELECT count(*) FROM drifted) AS rejected""",
        HOURLY_SQL,
    ),
}
