"""A landing folder and control tables for stream tests."""

from __future__ import annotations

import json
import os
import uuid

from tributary.plans.target import create_target
from tributary.streaming.ingest import Ingest, load_config

CONTROL = (
    "id long, ecname string, metadatatype string, batchsetting string, sourceobject string, sinkobject string, "
    "loadsetting string, mappingsettings string, enableflag string, modifieddate timestamp"
)
LOADER = (
    "ecname string, enabled_flag string, source_path string, schema_location string, checkpoint_location string, "
    "target_full_name string, archive_directory string, archive_enabled string, max_files_per_trigger string, "
    "max_bytes_per_trigger string, json_lines string, target_partitions int"
)
MERGES = "query_name string, query_type string, query_text string"
AUDIT = "sourceid bigint, loaddtm timestamp, deleted_flag string, date_deleted timestamp"

USERS = {"name": "string", "language": "string", "id": "string", "bio": "string", "version": "double"}
ORDERS = {
    "id": "bigint", "customer_id": "bigint", "product": "string",
    "quantity": "bigint", "amount": "double", "status": "string",
}


def mappings(columns):
    return json.dumps(
        {"mappings": [{"source": {"path": f"$['{c}']"}, "sink": {"name": c, "type": t}} for c, t in columns.items()]}
    )


class Landing:
    """One source with its own folders and target table."""

    def __init__(self, spark, root, columns=None, ecname="users_demo", spread=False, merge=None, **settings):
        from datetime import datetime

        self.spark, self.root, self.ecname = spark, str(root), ecname
        self.columns = columns or USERS
        self.source = os.path.join(self.root, "in")
        os.makedirs(self.source, exist_ok=True)
        self.clock = 1_700_000_000
        table = f"{ecname}_{uuid.uuid4().hex[:8]}"
        self.target = settings.pop("target_full_name", f"default.{table}")
        declared = f"{', '.join(f'`{c}` {t}' for c, t in self.columns.items())}, {AUDIT}"
        if spread:
            create_target(spark, self.target, declared)
        elif not spark.catalog.tableExists(self.target):
            spark.sql(f"CREATE TABLE {self.target} ({declared}) USING parquet")
        self.merge = merge
        self.control_row = [
            7, ecname, "file", None, None, None, None, settings.pop("mappingsettings", mappings(self.columns)), "y",
            datetime(2024, 1, 1),
        ]
        place = lambda name: os.path.join(self.root, name)
        self.loader_row = {
            "ecname": ecname, "enabled_flag": "y", "source_path": self.source, "schema_location": place("schema"),
            "checkpoint_location": place("checkpoint"), "target_full_name": self.target, "archive_directory": None,
            "archive_enabled": "N", "max_files_per_trigger": None, "max_bytes_per_trigger": None, "json_lines": None, "target_partitions": None, **settings,
        }

    def config(self, **changes):
        from dataclasses import replace

        names = [c.split()[0] for c in LOADER.split(", ")]
        control = self.spark.createDataFrame([tuple(self.control_row)], CONTROL)
        loader = self.spark.createDataFrame([tuple(self.loader_row[n] for n in names)], LOADER)
        merges = None
        if self.merge is not None:
            merges = self.spark.createDataFrame([(self.ecname, "merge", json.dumps(self.merge))], MERGES)
        return replace(load_config(self.spark, self.ecname, control, loader, merges=merges), **changes)

    def ingest(self, **changes):
        return Ingest(self.spark, self.config(**changes))

    def put(self, name, content):
        """Write a file; later files get later modification times."""
        path = os.path.join(self.source, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as out:
            out.write(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False))
        self.clock += 10
        os.utime(path, (self.clock, self.clock))

    def state(self, *columns):
        columns = columns or ("id", "version", "sourceid", "deleted_flag")
        rows = self.spark.table(self.target).select(*columns).collect()
        return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))
