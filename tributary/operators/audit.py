"""Audit relations: file log, schema errors, error log, staging clean-up, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.functions.rescue import quoted
from tributary.functions.scalars import is_delete_name, message
from tributary.operators.files import NAME, PATH, POS, RESCUED, SID

# Log readers look for exactly these texts.
SUCCESS = "SUCCESS"
FAILED = "FAILED"
STEP_TARGET_SCHEMA = "STEP_10_TARGET_SCHEMA"
STEP_SCHEMA_DRIFT = "STEP_13D_SCHEMA_DRIFT"
STEP_BATCH = "STEP_13_FOREACH_BATCH"
DRIFT_MESSAGE = (
    "Schema change detected. New/unmapped source field(s) were found in file. "
    "Mappingsettings/target schema must be updated after confirmation."
)
TARGET_MESSAGE = "Mappingsettings contains target columns which do not exist in target table: "


def file_log(
    files: DataFrame, table: str, merged: Column, etl_id: Column, label: Column, at: Column, micro_batch: Column
) -> DataFrame:
    """One SUCCESS row per accepted file.

    The row counts are the batch's de-duplicated total, the same on every row;
    ``file_rows`` is the file's own count.
    """
    return files.select(
        F.col(SID).alias("id"),
        F.lit(table).alias("tablename"),
        F.col(NAME).alias("filename"),
        F.lit(SUCCESS).alias("status"),
        at.alias("lastmodified"),
        merged.alias("lndrowscopied"),
        merged.alias("stgrowscopied"),
        label.alias("pipelinerunid"),
        etl_id.alias("batchid"),
        at.alias("watermark"),
        at.alias("startdate"),
        at.alias("enddate"),
        "file_rows",
        micro_batch.alias("micro_batch_id"),
    )


def schema_error_log(drifted: DataFrame, table: str, etl_id: Column, label: Column, at: Column) -> DataFrame:
    """One row per rejected file."""
    return drifted.select(
        F.lit(table).alias("tablename"),
        F.col(NAME).alias("filename"),
        F.lit(DRIFT_MESSAGE).alias("error_message"),
        label.alias("pipelinerunid"),
        etl_id.alias("batchid"),
        at.alias("created_timestamp"),
    )


def error_log(
    events: DataFrame, table: str, step: str, comment: Column, etl_id: Column, label: Column, at: Column
) -> DataFrame:
    """One FAILED row per event; ``events`` may name a file in ``_fn``."""
    filename = F.col(NAME) if NAME in events.columns else F.lit("")
    return events.select(
        etl_id.alias("etl_id"),
        F.lit(table).alias("tablename"),
        filename.alias("filename"),
        F.lit(step).alias("step_name"),
        F.lit(FAILED).alias("status"),
        message(comment).alias("cmnts"),
        label.alias("pipelinerunid"),
        at.alias("createddt"),
    )


def loaded(log: DataFrame, table: str) -> DataFrame:
    """Source ids of the files that are logged as loaded into ``table``."""
    done = log.filter((F.col("tablename") == table) & (F.col("status") == SUCCESS))
    return done.select(F.col("id").alias("sourceid")).distinct()


def clean_staging(staged: DataFrame, log: DataFrame, table: str) -> DataFrame:
    """Staged rows whose file is not yet logged as loaded into ``table``."""
    return staged.join(loaded(log, table), "sourceid", "left_anti")


def batch_summary(records: DataFrame, key: str) -> DataFrame:
    """Totals of a batch's records in one row, from one pass: accepted and rejected files, rows staged (the newest per
    key; the keyless ones count as one) and keys deleted.

    Records are first counted by file and key; what follows works on those counts.
    """
    per = records.groupBy(PATH, NAME, F.col(quoted(key)).alias("_key")).agg(
        F.max(F.col(RESCUED).isNotNull()).alias("_bad"), F.count(POS).alias("_rows")
    )
    per = per.withColumn("_bad", F.max("_bad").over(Window.partitionBy(PATH)))
    accepted, deletes = ~F.col("_bad"), is_delete_name(F.col(NAME))
    return per.agg(
        F.count_distinct(F.when(accepted, F.col(PATH))).alias("files"),
        F.count_distinct(F.when(accepted & ~deletes & (F.col("_rows") > 0), F.struct("_key"))).alias("merged"),
        F.count_distinct(F.when(accepted & deletes, F.col("_key"))).alias("deleted"),
        F.count_distinct(F.when(~accepted, F.col(PATH))).alias("rejected"),
    )
