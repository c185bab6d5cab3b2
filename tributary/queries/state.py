"""Queries over keyed state: newest rows, upsert, soft delete, the whole merge."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import files as ops, merge
from tributary.operators.mapping import MappedColumn
from tributary.plans.batch import merge_once, plan_changes
from tributary.queries.feed import AT, EVENT_MAPPING, STATE_SQL, event_records, table, with_feed

STATE = ("id", "name", "amount", "sourceid", "deleted_flag")


def _changes(spark, sf_dir):
    records = event_records(spark, sf_dir)
    return plan_changes(records, ops.number_files(ops.file_inventory(records)), EVENT_MAPPING, "user_id", F.lit(AT))


def latest_per_id(spark, sf_dir):
    staged = _changes(spark, sf_dir).staged
    return staged.select("id", "name", "amount", F.col("sourceid").alias("sid"))


def latest_lineitem(spark, sf_dir):
    order = [F.col(c).desc() for c in ("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity")]
    newest = merge.latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return newest.select("l_orderkey", "l_linenumber", "l_quantity")


def delete_keys(spark, sf_dir):
    """Some records have no key."""
    records = event_records(spark, sf_dir).withColumn("user_id", F.when(F.col(ops.POS) % 5 != 0, F.col("user_id")))
    deletes = plan_changes(records, ops.number_files(ops.file_inventory(records)), EVENT_MAPPING, "user_id", F.lit(AT)).deletes
    return deletes.withColumnRenamed("sourceid", "sid")


def upsert_orders(spark, sf_dir):
    """State holds the unfinished orders; every order's newest line is staged."""
    state = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "F").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority")
    )
    order = [F.col(c).desc() for c in ("l_shipdate", "l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey")]
    newest = merge.latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order)
    return merge.upsert(state, newest.select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("amount")))


def clear_deletes(spark, sf_dir):
    """One market segment is marked deleted; customers with an urgent finished order come back."""
    gone = F.col("c_mktsegment") == "BUILDING"
    state = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(gone, "Y").otherwise("N").alias("deleted_flag"),
        F.when(gone, F.lit(AT)).alias("date_deleted"),
    )
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    staged = table(spark, sf_dir, "orders").filter(urgent).select(F.col("o_custkey").alias("id"))
    cleared = merge.clear_deletes(state, staged)
    return cleared.select("id", "deleted_flag", F.col("date_deleted").isNotNull().alias("dated"))


def soft_delete(spark, sf_dir):
    """Rows whose newest event is a sign-up have no source id yet."""
    changes = _changes(spark, sf_dir)
    state = changes.staged.withColumn("sourceid", F.when(F.col("name") != "signup", F.col("sourceid")))
    return merge.soft_delete(state, changes.deletes, F.lit(AT)).select("id", "sourceid", "deleted_flag")


def ingest_state(spark, sf_dir):
    """The target after the whole feed as one batch."""
    return merge_once(*_changes(spark, sf_dir)).select(*STATE)


def merge_into_state(spark, sf_dir):
    """The feed merged into a target that already holds every customer."""
    state = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"),
        F.lit(0).cast("long").alias("sourceid"), F.lit(AT).alias("loaddtm"), F.lit("N").alias("deleted_flag"),
        F.lit(None).cast("timestamp").alias("date_deleted"),
    )
    changes = _changes(spark, sf_dir)
    marks = merge.newest_marks(changes.deletes.withColumn("loaddtm", F.lit(AT)), T.LongType())
    return merge.apply_changes(state, merge.newest_upserts(changes.staged), marks).select(*STATE)


def second_source(spark, sf_dir):
    """Orders as their own feed: files by month, keyed by customer; finished orders are deletes."""
    kind = F.when(F.col("o_orderstatus") == "F", "_delete.json").otherwise(".json")
    name = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMM"), kind)
    records = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("landing/"), name).alias(ops.PATH), name.alias(ops.NAME), F.col("o_orderkey").alias(ops.POS),
        F.lit(None).cast("string").alias(ops.RESCUED), "o_custkey", "o_orderpriority", "o_totalprice",
    )
    mapping = [
        MappedColumn("o_custkey", "id", T.LongType()),
        MappedColumn("o_orderpriority", "name", T.StringType()),
        MappedColumn("o_totalprice", "amount", T.DoubleType()),
    ]
    changes = plan_changes(records, ops.number_files(ops.file_inventory(records)), mapping, "o_custkey", F.lit(AT))
    return merge_once(*changes).select(*STATE)


QUERIES = {
    f.__name__: f
    for f in (
        latest_per_id, latest_lineitem, delete_keys, upsert_orders, clear_deletes, soft_delete, ingest_state,
        merge_into_state, second_source,
    )
}

ORDERS_FEED = """
WITH feed AS (
  SELECT o_orderkey AS pos, o_custkey AS id, o_orderpriority AS name, o_totalprice AS amount,
    'orders_' || strftime(o_orderdate, '%Y%m') || CASE WHEN o_orderstatus = 'F' THEN '_delete.json' ELSE '.json' END AS fn
  FROM orders),
files AS (SELECT fn, row_number() OVER (ORDER BY fn) AS sid FROM (SELECT DISTINCT fn FROM feed)),
w AS (SELECT f.*, s.sid, contains(fn, 'delete') AS is_delete FROM feed f JOIN files s USING (fn)),
stg AS (SELECT id, name, amount, sid FROM w WHERE NOT is_delete
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY sid DESC, pos DESC) = 1),
del AS (SELECT CAST(id AS VARCHAR) AS id, max(sid) AS sid FROM w WHERE is_delete GROUP BY 1)"""

ORACLES = {
    "latest_per_id": with_feed("SELECT * FROM stg"),
    "latest_lineitem": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC,
        l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1""",
    "delete_keys": with_feed("""SELECT CAST(id AS VARCHAR) AS id, max(sid) AS sid FROM w
        WHERE is_delete AND pos % 5 <> 0 GROUP BY 1"""),
    "upsert_orders": """WITH l AS (SELECT l_orderkey AS id, l_extendedprice AS amount FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_extendedprice DESC,
        l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1)
        SELECT coalesce(o.o_orderkey, l.id) AS id, coalesce(l.amount, o.o_totalprice) AS amount, o.o_orderpriority AS priority
        FROM (SELECT * FROM orders WHERE o_orderstatus <> 'F') o FULL JOIN l ON o.o_orderkey = l.id""",
    "clear_deletes": """WITH s AS (SELECT c_custkey AS id, c_mktsegment = 'BUILDING' AND c_custkey NOT IN
        (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS gone FROM customer)
        SELECT id, CASE WHEN gone THEN 'Y' ELSE 'N' END AS deleted_flag, gone AS dated FROM s""",
    "soft_delete": with_feed(
        """SELECT s.id, CASE WHEN coalesce(s.sid, 0) < d.sid THEN d.sid ELSE s.sid END AS sourceid,
        CASE WHEN coalesce(s.sid, 0) < d.sid THEN 'Y' ELSE 'N' END AS deleted_flag
        FROM (SELECT id, CASE WHEN name <> 'signup' THEN sid END AS sid FROM stg) s
        LEFT JOIN del d ON CAST(s.id AS VARCHAR) = d.id"""
    ),
    "ingest_state": with_feed(STATE_SQL),
    "merge_into_state": with_feed(
        """, m AS (SELECT coalesce(s.id, c.c_custkey) AS id, CASE WHEN s.id IS NULL THEN c.c_name ELSE s.name END AS name,
        CASE WHEN s.id IS NULL THEN c.c_acctbal ELSE s.amount END AS amount, coalesce(s.sid, 0) AS sid
        FROM customer c FULL JOIN stg s ON c.c_custkey = s.id)
        SELECT m.id, m.name, m.amount, CASE WHEN d.sid > m.sid THEN d.sid ELSE m.sid END AS sourceid,
        CASE WHEN d.sid > m.sid THEN 'Y' ELSE 'N' END AS deleted_flag
        FROM m LEFT JOIN del d ON CAST(m.id AS VARCHAR) = d.id"""
    ),
    "second_source": ORDERS_FEED + STATE_SQL,
}
