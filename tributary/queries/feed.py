"""The given tables as change feeds, and the same feeds in SQL for the checks.

``events`` is the main feed: one record per event, keyed by user, in two files a
day; the files of ``error`` events are delete files.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tributary.operators.files import NAME, PATH, POS, RESCUED
from tributary.operators.mapping import MappedColumn

AT = datetime(2024, 2, 1)

EVENT_MAPPING = (
    MappedColumn("user_id", "id", T.LongType()),
    MappedColumn("event_type", "name", T.StringType()),
    MappedColumn("value", "amount", T.DoubleType()),
)

# A record above this amount counts as off-schema, in queries over hourly and over daily files: some files in a
# hundred have one.
DRIFT_ABOVE, DRIFT_ABOVE_DAILY = 250, 340


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_file(stamp: str) -> Column:
    """File of an event: its day or hour, and whether the file carries deletes."""
    kind = F.when(F.col("event_type") == "error", "_delete_users.json").otherwise("_users.json")
    return F.concat(F.date_format("ts", stamp), kind)


def event_records(spark: SparkSession, sf_dir: str, stamp: str = "yyyyMMdd", drift: bool = False) -> DataFrame:
    """Events as parsed records."""
    return records_of(table(spark, sf_dir, "events"), stamp, drift)


def records_of(events: DataFrame, stamp: str = "yyyyMMdd", drift: bool = False) -> DataFrame:
    off_schema = F.lit(None).cast("string")
    if drift:
        off_schema = F.when(F.col("value") > DRIFT_ABOVE, F.to_json(F.struct("value")))
    name = event_file(stamp)
    return events.select(
        F.concat(F.lit("landing/"), name).alias(PATH),
        name.alias(NAME),
        F.col("event_id").alias(POS),
        off_schema.alias(RESCUED),
        "user_id",
        "event_type",
        "value",
    )


def with_feed(select: str, stamp: str = "%Y%m%d") -> str:
    """SQL over the feed: ``feed``, ``files``, ``w`` (numbered rows), ``stg`` and ``del``."""
    return f"""
WITH feed AS (
  SELECT event_id AS pos, user_id AS id, event_type AS name, value AS amount,
    strftime(ts, '{stamp}') || CASE WHEN event_type = 'error' THEN '_delete_users.json' ELSE '_users.json' END AS fn
  FROM events),
files AS (SELECT fn, row_number() OVER (ORDER BY fn) AS sid FROM (SELECT DISTINCT fn FROM feed)),
w AS (SELECT f.*, s.sid, contains(lower(f.fn), 'delete') AS is_delete FROM feed f LEFT JOIN files s USING (fn)),
stg AS (SELECT id, name, amount, sid FROM w WHERE NOT is_delete
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY sid DESC, pos DESC) = 1),
del AS (SELECT CAST(id AS VARCHAR) AS id, max(sid) AS sid FROM w WHERE is_delete AND id IS NOT NULL GROUP BY 1)
{select}"""


STATE_SQL = """
SELECT s.id, s.name, s.amount, CASE WHEN d.sid > s.sid THEN d.sid ELSE s.sid END AS sourceid,
  CASE WHEN d.sid > s.sid THEN 'Y' ELSE 'N' END AS deleted_flag
FROM stg s LEFT JOIN del d ON CAST(s.id AS VARCHAR) = d.id"""
