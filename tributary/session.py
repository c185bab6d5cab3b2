"""Session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache, wraps

from pyspark import SparkContext
from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tributary")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a run in one process may go without that setting; its folder is a local one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tributary-")
    return f"{root.rstrip('/')}/tributary/{label}-{uuid.uuid4().hex}"


def literal_path(path: str) -> str:
    """A path that a reader takes as it is, glob characters escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def sql_text(value: str) -> str:
    """A value as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def exists(spark: SparkSession, path: str, below: str = "") -> bool:
    """Whether a path is there, or something below it that fits a glob pattern."""
    place = spark._jvm.org.apache.hadoop.fs.Path(literal_path(path) + below)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, 0 where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(fs.getContentSummary(found.getPath()).getLength() for found in fs.globStatus(place) or [])


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder; False where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def put_texts(spark: SparkSession, folder: str, texts: Mapping[str, str]) -> None:
    """Make a folder of small files, in the order given; one that is there is replaced. A reader sees a file whole or not at all."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    place = path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(place, True)
    for name, text in texts.items():
        hidden = path(place, f"_writing-{name}")
        out = fs.create(hidden, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not fs.rename(hidden, path(place, name)):
            raise OSError(f"{folder}/{name} was not written")


def kept(build: Callable) -> Callable:
    """Columns that are built once for their arguments, as a stream asks for the same ones in each of its batches.

    A column belongs to no session, only to the JVM, and building one takes a call to it for each of its parts.
    """
    held = lru_cache(maxsize=256)(lambda jvm, *args: build(*args))

    @wraps(build)
    def found(*args):
        return held(SparkContext._gateway, *args)

    return found


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What the steps return, run at once, each under the local properties of the thread that asks: its pool, its job group.

    All have ended when this returns or raises.
    """
    if len(steps) < 2:
        return [step() for step in steps]
    with ThreadPoolExecutor(len(steps)) as pool:
        # a wrapper each: what it hands on is one object, which a query changes while it runs
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]
