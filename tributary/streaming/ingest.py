"""The ingestion run: settings, stream, batches, logs, quarantine."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, partial
from math import ceil
from xml.sax.saxutils import quoteattr

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tributary.functions.rescue import quoted
from tributary.functions.scalars import MANUAL_RUN, is_delete_name, steady
from tributary.operators import audit, config as cfg_ops
from tributary.operators.files import NAME, NUMBERED_TOGETHER, PATH, SID, file_inventory, name_splitters, number_files
from tributary.operators.mapping import MappedColumn, MappingError, record_schema, sink_types
from tributary.operators.spec import MergeSpec, SpecError, load_spec
from tributary.plans.batch import plan_deletes, plan_staged, tagged
from tributary.plans.datasets import Datasets, Staging, now
from tributary.plans.target import PART, PARTS, Target
from tributary.session import exists, side_by_side
from tributary.sources import landing
from tributary.streaming.monitor import Monitor

log = logging.getLogger(__name__)

#: Rejected files that are kept together, and so come back together.
HELD_TOGETHER = 20

#: The numbered files of a batch.
FILES = f"{PATH} string, {NAME} string, file_rows long, drifted boolean, {SID} long, replay boolean"


class ConfigError(ValueError):
    """Settings that cannot be run."""


@dataclass(frozen=True)
class IngestConfig:
    ecname: str
    source_path: str
    schema_location: str
    checkpoint_location: str
    target: str
    mapping: tuple[MappedColumn, ...]
    id_source: str
    etl_id: int | None = None
    max_files: str = "1000"
    max_bytes: str | None = None
    archive_directory: str | None = None
    state_location: str | None = None
    run_id: str = MANUAL_RUN
    lines: bool = False
    parts: int = PARTS
    spec: MergeSpec = MergeSpec()

    @property
    def table(self) -> str:
        return self.target.split(".")[-1]

    @property
    def key_sources(self) -> dict[str, str]:
        """The source field of each key column."""
        source = {m.sink: m.source for m in self.mapping}
        return {k: source[k] for k in self.spec.key}

    @property
    def staging_table(self) -> str:
        return f"{self.target}_stg"

    @property
    def delete_staging_table(self) -> str:
        return f"{self.target}_del_stg"

    @property
    def root(self) -> str:
        return self.state_location or f"{self.checkpoint_location.rstrip('/')}_state"


def _value(row: Row, name: str, default=None):
    """A setting, with a default where the column is absent or NULL."""
    value = row[name] if name in row.__fields__ else None
    return default if value is None else value


def _switch(value) -> bool:
    return str(value or "").strip().upper() == "Y"


def _object(text) -> dict:
    try:
        value = json.loads(text) if text else {}
    except ValueError:
        return {}
    return value if isinstance(value, dict) else {}


def load_config(
    spark: SparkSession, ecname: str, control: DataFrame, loader: DataFrame, run_id: str = MANUAL_RUN,
    merges: DataFrame | None = None,
) -> IngestConfig:
    """Settings of one source out of the control tables, checked.

    ``merges`` holds stored merge specs (query_name, query_type, query_text); without it rows merge by ``id``.
    """
    ecname = (ecname or "").strip()
    if not ecname:
        raise ConfigError("a source name (ecname) is needed")
    newest = cfg_ops.latest_config(control.filter(F.col("ecname") == ecname))
    rows = newest.collect()
    if not rows:
        raise ConfigError(f"source '{ecname}' has no enabled control row")
    found = loader.filter((F.col("ecname") == ecname) & (F.col("enabled_flag") == "y")).take(2)
    if not found:
        raise ConfigError(f"source '{ecname}' has no enabled loader row")
    if len(found) > 1:
        raise ConfigError(f"source '{ecname}' has several enabled loader rows")
    settings, entry = found[0], rows[0]

    target = _value(settings, "target_full_name")
    if not target:
        sink = _object(_value(entry, "sinkobject"))
        target = ".".join(filter(None, [sink.get("schemaname"), sink.get("tablename")]))
    if "." not in target:
        raise ConfigError(f"target_full_name of '{ecname}' needs a schema and a table, got '{target}'")
    for name in ("source_path", "schema_location", "checkpoint_location"):
        if not _value(settings, name):
            raise ConfigError(f"the loader row of source '{ecname}' gives no {name}")

    mappings = cfg_ops.parse_mappings(newest)
    ordered = mappings.orderBy("pos").collect()
    sinks = [m["sink"] for m in ordered]
    if not ordered:
        raise ConfigError(f"source '{ecname}' maps no field")
    if len(set(sinks)) != len(sinks):
        raise ConfigError(f"source '{ecname}' maps several fields to one column")
    try:
        spec = MergeSpec() if merges is None else load_spec(merges, ecname)
        if spec.key == MergeSpec().key and "id" not in sinks:
            raise ConfigError(f"source '{ecname}' maps no field to its key")
        spec.checked(set(sinks))
    except SpecError as error:
        raise ConfigError(str(error)) from error
    mapping = tuple(MappedColumn(m["source"], m["sink"], cfg_ops.declared_type(m["type"])) for m in ordered)

    archive = _switch(_value(settings, "archive_enabled"))
    max_bytes = _value(settings, "max_bytes_per_trigger")
    cfg = IngestConfig(
        ecname=ecname,
        source_path=settings["source_path"],
        schema_location=settings["schema_location"],
        checkpoint_location=settings["checkpoint_location"],
        target=target,
        mapping=mapping,
        id_source=next(m.source for m in mapping if m.sink == spec.key[0]),
        etl_id=int(entry["id"]) if entry["id"] is not None else None,
        max_files=str(_value(settings, "max_files_per_trigger", "1000")),
        max_bytes=None if max_bytes is None else str(max_bytes),
        archive_directory=_value(settings, "archive_directory") if archive else None,
        state_location=_value(settings, "state_location"),
        run_id=run_id,
        lines=_switch(_value(settings, "json_lines")),
        parts=int(_value(settings, "target_partitions", PARTS)),
        spec=spec,
    )
    if archive and not cfg.archive_directory:
        raise ConfigError(f"archive_directory is missing for ecname = '{ecname}'")
    check_target(spark, cfg, mappings)
    return cfg


def check_target(spark: SparkSession, cfg: IngestConfig, mappings: DataFrame) -> None:
    """The target is never altered, so every mapped and audit column must be there."""
    columns = spark.createDataFrame([(cfg.ecname, n) for n in spark.table(cfg.target).columns], "ecname string, sink string")
    unknown = sorted(r["sink"] for r in cfg_ops.check_target(mappings, columns).collect())
    if unknown:
        text = audit.TARGET_MESSAGE + ", ".join(unknown)
        Ingest(spark, cfg).log_error(audit.STEP_TARGET_SCHEMA, text, cfg.run_id)
        raise ConfigError(text)


def _query_id(batch: DataFrame) -> str:
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


class Ingest:
    """One source: its target, what it keeps beside it, and the batches that feed them.

    A batch is prepared (files numbered, rows staged, the touched partitions merged into a folder), decided by its record,
    and settled (target, logs, staging, quarantine). A replay before the record prepares anew, with the same ids; after
    it only settles again, which changes nothing where it was done.
    """

    def __init__(self, spark: SparkSession, cfg: IngestConfig):
        self.spark = spark
        self.cfg = cfg
        self.monitor: Monitor | None = None
        self._schema: T.StructType | None = None
        self._newest: Row | None = None
        self._told = False

    @cached_property
    def data(self) -> Datasets:
        return Datasets(self.spark, self.cfg.root)

    @cached_property
    def target(self) -> Target:
        return Target(self.spark, self.cfg.target, self.cfg.spec, self.cfg.parts)

    @cached_property
    def mapping(self) -> tuple[MappedColumn, ...]:
        return sink_types(self.cfg.mapping, self.target.schema)

    @cached_property
    def staged(self) -> Staging:
        columns = T.StructType([f for f in self.target.schema if f.name != PART])
        return Staging(self.data, self.cfg.staging_table, "staging", columns)

    @cached_property
    def staged_deletes(self) -> Staging:
        keys = [T.StructField(k, T.StringType()) for k in self.cfg.spec.key]
        columns = [*keys, T.StructField("sourceid", T.LongType()), T.StructField("loaddtm", T.TimestampType())]
        return Staging(self.data, self.cfg.delete_staging_table, "delete_staging", T.StructType(columns))

    # stream

    def start(self) -> StreamingQuery:
        """Drain the present backlog in bounded batches, in the background."""
        self.prepare()
        files = landing.stream_files(
            self.spark, self.cfg.source_path, self.cfg.max_files, self.cfg.max_bytes, self.cfg.archive_directory
        )
        return self._drain(files, self.cfg.checkpoint_location, self.process_batch)

    def _drain(self, stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None]) -> StreamingQuery:
        self._newest = None  # read once, then carried from batch to batch
        return (
            stream.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def run(self) -> DataFrame:
        """Drain the backlog, return the totals of the run's batches."""
        before = self.data.last()
        with Monitor(self.spark) as self.monitor:
            query = self.start()
            self.monitor.watch(query, self.ended)
            query.awaitTermination()
        return self.summary(after=before["seq"] if before else 0)

    def ended(self, error: str | None) -> None:
        """Log what ended the query, unless it came out of a batch, which has logged it."""
        if error is not None and not self._told:
            self.log_error(audit.STEP_BATCH, error, self.cfg.run_id)

    def progress(self) -> DataFrame | None:
        """Files read and time taken by each batch of this run, as Spark's listener has told."""
        return None if self.monitor is None else self.monitor.progress()

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        files = landing.landed_files(batch)
        if files:
            own = landing.listed_together(batch.sparkSession)  # the stream's, which is a clone
            self.run_batch(lambda: landing.read_texts(own, files, self.cfg.lines), _query_id(batch), batch_id, listed=len(files))

    # batches

    def prepare(self) -> None:
        """Check once that the target's rows stand where their keys are looked for."""
        if self.data.last() is None and (wrong := self.target.misplaced()):
            raise ConfigError(f"{wrong} rows of {self.cfg.target} are in another partition than {PART} of their key")

    def schema(self) -> T.StructType:
        """Types in which records are read; empty until the folder holds a readable file."""
        if self._schema is None or not self._schema.fields:
            source = landing.source_schema(self.spark, self.cfg.source_path, self.cfg.schema_location, self.cfg.lines)
            self._schema = record_schema(source, self.mapping)
        return self._schema

    def run_batch(
        self, read: Callable[[], DataFrame], query_id: str, batch_id: int, replay: bool = False, listed: int | None = None
    ) -> None:
        """One batch of texts, out of so many files where that is known."""
        def parsed() -> DataFrame:
            return landing.parse(read(), self.schema(), self.cfg.key_sources.values())

        self.run_records(parsed, query_id, batch_id, replay, streamed=True, listed=listed)

    def run_records(
        self, read: Callable[[], DataFrame], query_id: str, batch_id: int, replay: bool = False, streamed: bool = False,
        listed: int | None = None,
    ) -> None:
        """One batch of records."""
        label = f"{self.cfg.run_id}_{batch_id}"
        try:
            batch = self.data.decided(query_id, batch_id) or self._prepared(
                read(), query_id, batch_id, label, replay, self._newest if streamed else None, listed
            )
            self._settle(batch)
        except Exception as error:
            self._told = True
            self.log_error(audit.STEP_BATCH, str(error), label)
            raise

    def _prepared(
        self, records: DataFrame, query_id: str, batch_id: int, label: str, replay: bool, last: Row | None = None,
        listed: int | None = None,
    ) -> Row:
        """Stage and merge one batch, and write its record. ``last``: the newest record, where it is known."""
        cfg, data, at = self.cfg, self.data, now()
        last = last or data.last()
        last_id = last["end_id"] if last else 0

        # The parsed rows are written once; every later step reads the columns it needs.
        parsed = data.write(records, "records", query_id, 0)
        files, counts = self._numbered(parsed, query_id, batch_id, last_id, replay, listed)
        files_seen = counts["files"] + counts["rejected"]

        self.staged.drop(query_id, batch_id)
        self.staged_deletes.drop(query_id, batch_id)
        if counts["regular"] and not set(cfg.key_sources.values()) <= set(parsed.columns):
            raise MappingError("no source field holds the key")

        def upserts() -> tuple[int, DataFrame]:
            rows = plan_staged(tagged(parsed, files, files_seen), self.mapping, steady(at, F.col("sourceid")), cfg.spec)
            n = self.staged.stage(rows, query_id, batch_id)
            # a column that the batch has no field for is NULL there, but no value of its rows
            return n, self.staged.of_batch(query_id, batch_id, rows.schema)

        def deletions() -> tuple[int, DataFrame]:
            rows = plan_deletes(tagged(parsed, files, files_seen), cfg.key_sources).withColumn("loaddtm", steady(at, F.col("sourceid")))
            n = self.staged_deletes.stage(rows, query_id, batch_id)
            return n, self.staged_deletes.of_batch(query_id, batch_id, rows.schema)

        wanted = [step for step, n in ((upserts, counts["regular"]), (deletions, counts["deletes"])) if n]
        found = dict(zip(wanted, side_by_side(self.spark, *wanted)))
        (merged, staged), (deleted, deletes) = (found.get(step, (0, None)) for step in (upserts, deletions))
        newly_deleted = 0
        if (merged or deleted) and not self.target.native:
            newly_deleted = self.target.merge(staged, deletes, data.folder("merged", query_id, batch_id), max(merged, deleted))

        self._newest = data.decide(
            seq=last["seq"] + 1 if last else 1, query_id=query_id, batch_id=batch_id, start_id=last_id + 1,
            end_id=counts["end_id"], files=counts["files"], rejected=counts["rejected"], merged=merged, deleted=deleted,
            deleted_rows=newly_deleted, label=label, at=at,
        )
        return self._newest

    def _numbered(
        self, parsed: DataFrame, query_id: str, batch_id: int, last_id: int, replay: bool, listed: int | None
    ) -> tuple[DataFrame, dict[str, int]]:
        """The batch's files with their ids, written, and their totals. Files that are not known to be few are counted
        first, and cut into ranges where they are many."""
        inventory, cuts = file_inventory(parsed), []
        if listed is None or listed > NUMBERED_TOGETHER:
            seen = Observation()
            inventory = self.data.write(inventory.observe(seen, F.count(F.lit(1)).alias("n")), "inventory", query_id, 0)
            cuts = name_splitters(inventory, n=seen.get["n"])
        else:
            inventory = inventory.coalesce(1)  # one task numbers them, so it may as well add up their rows
        is_delete, clean, counted = is_delete_name(F.col(NAME)), ~F.col("drifted"), Observation()
        files = number_files(inventory, last_id, cuts).withColumn("replay", F.lit(replay)).observe(
            counted,
            F.count(SID).alias("files"),
            F.max(SID).alias("end_id"),
            F.count_if("drifted").alias("rejected"),
            F.sum(F.when(~is_delete & clean, F.col("file_rows"))).alias("regular"),
            F.sum(F.when(is_delete & clean, F.col("file_rows"))).alias("deletes"),
        )
        files = self.data.write(files, "files", query_id, batch_id)
        totals = {name: n or 0 for name, n in counted.get.items()}
        return files, totals | {"end_id": totals["end_id"] or last_id}

    def _settle(self, batch: Row) -> None:
        """Bring a decided batch into the target, then into the logs, and clean up after it."""
        cfg, data, key = self.cfg, self.data, (batch["query_id"], batch["batch_id"])
        self.target.apply(data.folder("merged", *key))
        files = data.load("files", *key, FILES)
        own = lambda name: steady(batch[name], F.col(PATH))
        stamp = (F.lit(cfg.etl_id).cast("long"), F.lit(batch["label"]), own("at"))
        if batch["files"]:
            accepted, total = files.filter(F.col(SID).isNotNull()), own("merged").cast("long")
            rows = audit.file_log(accepted, cfg.table, total, *stamp, own("batch_id").cast("long"))
            data.write(rows, "file_process_logs", *key)
        if batch["rejected"]:
            drifted = files.filter("drifted")
            data.write(audit.schema_error_log(drifted, cfg.table, *stamp), "file_schema_validation_errors", *key)
            rows = audit.error_log(drifted, cfg.table, audit.STEP_SCHEMA_DRIFT, F.lit(audit.DRIFT_MESSAGE), *stamp)
            data.write(rows, "etl_error_log", *key)
            self._quarantine(drifted.filter("NOT replay"), *key)
        self._clean(*key)
        self.target.settled(data.folder("merged", *key))

    def _clean(self, query_id: str, batch_id: int) -> None:
        """Take the rows of logged files out of staging. Best effort: what is left over goes with a later batch.

        The batch has just logged all files whose rows it staged, so its own rows go as they are. The logs are read only
        where other batches left rows, so a batch costs the same however many were before it.
        """
        def clean(staging: Staging) -> None:
            try:
                staging.drop(query_id, batch_id)
                if staging.holds() and (done := self.file_log()) is not None:
                    staging.clean(audit.loaded(done, self.cfg.table))
            except Exception as failure:
                log.warning("staging clean-up failed: %s", failure)

        side_by_side(self.spark, *[partial(clean, staging) for staging in (self.staged, self.staged_deletes)])

    # quarantine

    def _quarantine(self, drifted: DataFrame, query_id: str, batch_id: int) -> None:
        """Keep the texts of the rejected files, some files in a part; none of a file that a replay rejects again."""
        names = [landing.LandedFile(landing.decoded(r[PATH]), 0) for r in drifted.select(PATH).collect()]
        if names:
            texts = landing.read_texts(self.spark, names, self.cfg.lines)
            self.data.write(texts.repartition(ceil(len(names) / HELD_TOGETHER), PATH), "quarantine", query_id, batch_id)

    def _accepted(self) -> DataFrame | None:
        """Files that a replay has accepted."""
        files = self.data.read("files")
        return None if files is None else files.filter(F.col("replay") & F.col(SID).isNotNull()).select(PATH).distinct()

    def quarantined(self) -> DataFrame | None:
        """Rejected files that no replay has accepted yet."""
        held = self.data.read("quarantine")
        return None if held is None else held.drop("query_id", "batch_id").join(self._accepted(), PATH, "left_anti")

    def start_replay(self) -> StreamingQuery | None:
        """Feed the quarantined files again, in the background: a stream of its own over the quarantine, in batches under
        the source's caps. Its progress is kept for each source schema: under an unchanged one only files that were
        rejected since are read, as all others would be rejected again."""
        held = self.data.read("quarantine")
        if held is None:
            return None
        self.prepare()
        cfg, kind = self.cfg, hashlib.md5(self.schema().json().encode()).hexdigest()
        stream = self.spark.readStream.schema(held.drop("query_id", "batch_id").schema).option("recursiveFileLookup", "true")
        if cfg.max_bytes:
            stream = stream.option("maxBytesPerTrigger", cfg.max_bytes)
        else:
            stream = stream.option("maxFilesPerTrigger", str(max(1, int(cfg.max_files) // HELD_TOGETHER)))
        texts = stream.option("maxFileAge", "36500d").option("pathGlobFilter", "*.parquet").parquet(f"{cfg.root}/quarantine")
        return self._drain(texts, f"{cfg.checkpoint_location.rstrip('/')}_replay/{kind}", self.process_replay)

    def process_replay(self, batch: DataFrame, batch_id: int) -> None:
        def texts() -> DataFrame:
            # read once more as a table: the batch's own frame belongs to the stream
            return batch.join(self._accepted(), PATH, "left_anti")

        if not batch.isEmpty():
            self.run_batch(texts, _query_id(batch), batch_id, replay=True)

    def replay_quarantine(self, schema: T.StructType | str | None = None) -> DataFrame:
        """Replay under a new source schema, if one is given; the totals of the replay's batches. They get new ids."""
        if schema is not None:
            schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            landing.save_schema(self.spark, schema, self.cfg.schema_location)
        self._schema = None
        before = self.data.last()
        query = self.start_replay()
        if query is not None:
            query.awaitTermination()
        return self.summary(after=before["seq"] if before else 0)

    # results

    def _log(self, dataset: str) -> DataFrame | None:
        rows = self.data.read(dataset)
        return None if rows is None else rows.drop("query_id", "batch_id")

    def file_log(self) -> DataFrame | None:
        return self._log("file_process_logs")

    def schema_errors(self) -> DataFrame | None:
        return self._log("file_schema_validation_errors")

    def errors(self) -> DataFrame | None:
        """Rejected files and failures."""
        drifted = self._log("etl_error_log")
        if not exists(self.spark, f"{self.cfg.root}/failures"):
            return drifted
        failures = self.spark.read.parquet(f"{self.cfg.root}/failures")
        return failures if drifted is None else drifted.unionByName(failures)

    def staging(self, dataset: str = "upserts") -> DataFrame:
        """Staged rows whose files are not logged as loaded: none once a batch is through."""
        return (self.staged if dataset == "upserts" else self.staged_deletes).rows()

    def summary(self, after: int = 0) -> DataFrame:
        """Totals per batch."""
        return self.data.batches().filter(F.col("seq") > after).select(
            F.col("label").alias("pipelinerunid"), "batch_id", "files", "merged", "deleted", "deleted_rows", "rejected"
        )

    def log_error(self, step: str, text: str, label: str, filename: str = "") -> None:
        """Best effort: a failure to log never hides the error being logged."""
        try:
            event = self.spark.createDataFrame([(filename, text)], f"{NAME} string, text string")
            rows = audit.error_log(
                event, self.cfg.table, step, F.col("text"), F.lit(self.cfg.etl_id).cast("long"), F.lit(label), F.lit(now())
            )
            rows.coalesce(1).write.mode("append").parquet(f"{self.cfg.root}/failures")
        except Exception as failure:
            log.warning("error log write failed: %s", failure)


def run_sources(spark: SparkSession, configs: Sequence[IngestConfig]) -> dict[str, Exception | None]:
    """Drain several sources at once; one that fails does not stop the others.

    Each runs in a scheduler pool of its own name. Under ``spark.scheduler.mode=FAIR`` they share the cluster, by the weights of
    ``pools_file`` where the session was started with one, so a small source need not wait for a large one.
    """
    seen: dict[str, str] = {}
    for cfg in configs:
        for place in (cfg.checkpoint_location, cfg.schema_location, cfg.root):
            if seen.setdefault(place.rstrip("/"), cfg.ecname) != cfg.ecname:
                raise ConfigError(f"'{cfg.ecname}' shares {place} with '{seen[place.rstrip('/')]}'")
    outcome: dict[str, Exception | None] = {cfg.ecname: None for cfg in configs}
    started = []
    pool = "spark.scheduler.pool"
    before = spark.sparkContext.getLocalProperty(pool)
    with Monitor(spark) as monitor:
        for cfg in configs:
            ingest = Ingest(spark, cfg)
            ingest.monitor = monitor
            try:
                spark.sparkContext.setLocalProperty(pool, cfg.ecname)  # which the query's thread takes over
                query = ingest.start()
                monitor.watch(query, ingest.ended)
                started.append((cfg.ecname, query))
            except Exception as error:
                outcome[cfg.ecname] = error
                ingest.log_error(audit.STEP_BATCH, str(error), cfg.run_id)
            finally:
                spark.sparkContext.setLocalProperty(pool, before)
        for ecname, query in started:
            try:
                query.awaitTermination()
            except Exception as error:
                outcome[ecname] = error
    return outcome


def pools_file(weights: Mapping[str, int]) -> str:
    """The text for ``spark.scheduler.allocation.file``: a pool for each source with its weight."""
    pools = "".join(
        f"<pool name={quoteattr(name)}><schedulingMode>FIFO</schedulingMode><weight>{max(1, int(weight))}</weight></pool>"
        for name, weight in sorted(weights.items())
    )
    return f'<?xml version="1.0"?><allocations>{pools}</allocations>'
