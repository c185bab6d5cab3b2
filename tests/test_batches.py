"""What a batch costs: jobs, tasks, generated code; and that it stays right for it."""

import threading
from datetime import datetime, timezone

import pytest

from pyspark.sql import functions as F

from landing import Landing
from tributary.functions.scalars import steady
from tributary.session import put_texts, side_by_side
from tributary.sources.landing import LISTERS

KV = {"id": "string", "v": "double"}


def _jobs(spark, ingest):
    """The stages' task counts of each job of a run, which has the run's own group."""
    runs, drain = [], ingest._drain

    def noted(*args):
        query = drain(*args)
        runs.append(str(query.runId))
        return query

    ingest._drain = noted
    ingest.run()
    tracker = spark.sparkContext.statusTracker()
    infos = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(runs[0])]
    return [[stage.numTasks for s in info.stageIds if (stage := tracker.getStageInfo(s))] for info in infos if info]


def test_jobs_of_a_batch(spark, tmp_path):
    """A batch of rows and deletes takes some 20 jobs, not 30; results as ever."""
    land = Landing(spark, tmp_path, KV, spread=True, max_files_per_trigger="2")
    for n in range(5):
        land.put(f"{n}a.json", [{"id": str(k), "v": n} for k in range(10 * n, 10 * n + 20)])
        land.put(f"{n}b_delete.json", [{"id": str(10 * n)}])
    jobs = _jobs(spark, land.ingest())
    assert len(jobs) / 5 <= 24
    assert land.state("id", "v", "sourceid", "deleted_flag")[:3] == [("0", 0.0, 2, "Y"), ("1", 0.0, 1, "N"), ("10", 1.0, 4, "Y")]


def test_many_files_are_listed_by_few_tasks(spark, tmp_path):
    """More than 32 files of a batch are not listed in a task each; the session that started the stream keeps its setting."""
    land, before = Landing(spark, tmp_path, KV, max_files_per_trigger="70"), spark.conf.get(LISTERS)
    for n in range(210):
        land.put(f"{n:03d}.json", [{"id": str(n), "v": n}])
    jobs = _jobs(spark, land.ingest())
    assert sum(70 in tasks for tasks in jobs) <= 3  # the listing of the stream itself, by Spark
    assert land.state("id", "sourceid") == sorted((str(n), n + 1) for n in range(210)) and spark.conf.get(LISTERS) == before


def test_steady_constants_keep_generated_code(spark, tmp_path):
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME().getCount
    rows, took = spark.range(3).withColumn("x", F.xxhash64("id")), []
    rows.write.parquet(f"{tmp_path}/rows")
    for n in (2**40 + 7, 2**41 + 9, 2**42 + 11):
        at, before = datetime.fromtimestamp(n / 1e4, timezone.utc), compiled()
        read = spark.read.parquet(f"{tmp_path}/rows")
        found = read.select((F.col("id") + steady(n, F.col("x"))).alias("n"), steady(at, F.col("x")).cast("double").alias("at"))
        assert sorted(r["n"] for r in found.collect()) == [n, n + 1, n + 2]
        assert [r["at"] for r in found.collect()] == [at.timestamp()] * 3
        took.append(compiled() - before)
    assert took[1:] == [0, 0]


def test_record_reads_back(spark, tmp_path):
    """A batch's record is as it was told, in one small file; a decision that is made again replaces it."""
    data = Landing(spark, tmp_path, KV).ingest().data
    at = datetime(2026, 3, 1, 12, 0, 0, 123456, timezone.utc)
    assert data.decided("q", 3) is None
    for merged in (5, 6):
        told = data.decide(seq=1, query_id="q", batch_id=3, end_id=9, merged=merged, label="it's \"x\"", at=at)
        read = data.decided("q", 3)
        assert told.asDict() | {"at": None} == read.asDict() | {"at": None} and read["merged"] == merged
        assert read["at"].astimezone(timezone.utc) == at and data.last() == read and data.batches().count() == 1


def test_side_by_side(spark):
    """Steps see the asking thread's properties, not each other's, and an error comes out when all have ended."""
    sc, ended = spark.sparkContext, []
    sc.setLocalProperty("mine", "kept")
    meet = threading.Barrier(2, timeout=30)

    def step(name):
        def run():
            seen = sc.getLocalProperty("mine")
            sc.setLocalProperty("mine", name)
            meet.wait()
            ended.append(name)
            if name == "b":
                raise ValueError(name)
            return seen, sc.getLocalProperty("mine")
        return run

    try:
        assert side_by_side(spark, step("a"), step("c")) == [("kept", "a"), ("kept", "c")]
        with pytest.raises(ValueError, match="b"):
            side_by_side(spark, step("a"), step("b"))
        assert sorted(ended) == ["a", "a", "b", "c"] and sc.getLocalProperty("mine") == "kept"
        assert side_by_side(spark) == [] and side_by_side(spark, lambda: 1) == [1]
    finally:
        sc.setLocalProperty("mine", None)


def test_put_texts(spark, tmp_path):
    put_texts(spark, f"{tmp_path}/a b", {"x": "1\n", "y": "é"})
    put_texts(spark, f"{tmp_path}/a b", {"y": "ü"})
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/a b").collect()] == ["ü"]


def test_many_keys_touch_all_partitions(spark, tmp_path):
    """A batch of many keys does not ask for its partitions, one of few does; rows without a key and deletes are right in both."""
    land = Landing(spark, tmp_path, KV, spread=True, target_partitions=4)
    land.put("a.json", [{"id": str(n), "v": n} for n in range(400)] + [{"v": -1}])
    land.put("b_delete.json", [{"id": str(n)} for n in range(300)])
    ingest, asked = land.ingest(), []
    touched = ingest.target._touched
    ingest.target._touched = lambda *frames: asked.append(1) or touched(*frames)
    ingest.run()
    assert not asked
    land.put("c.json", [{"id": "7", "v": 70}, {"v": -2}])
    land.put("d_delete.json", [{"id": "399"}, {"id": "0399"}])
    ingest.run()
    assert asked
    state = land.state("id", "v", "deleted_flag")
    assert state[:2] == [(None, -1.0, "N"), (None, -2.0, "N")] and len(state) == 402
    assert dict((r[0], r[1:]) for r in state[2:]) == {
        str(n): (70.0 if n == 7 else float(n), "Y" if n != 7 and n < 300 or n == 399 else "N") for n in range(400)
    }


def test_numbering_of_few_files_is_as_of_many(spark, tmp_path, monkeypatch):
    """Ids do not depend on whether the files are counted first and cut into ranges."""
    from tributary.streaming import ingest as module

    def ids(name, together):
        monkeypatch.setattr(module, "NUMBERED_TOGETHER", together)
        (tmp_path / name).mkdir()
        land = Landing(spark, tmp_path / name, KV)
        for n in (3, 1, 2):
            land.put(f"f{n}.json", [{"id": str(n), "v": n}])
        ingest = land.ingest()
        ingest.run()
        return sorted((r["filename"], r["id"], r["file_rows"]) for r in ingest.file_log().collect())

    assert ids("few", 20_000) == ids("many", 1) == [("f1.json", 1, 1), ("f2.json", 2, 1), ("f3.json", 3, 1)]


def test_marks_once(spark):
    """Deletes that hold a key once need not be grouped; both ways give the same marks."""
    from pyspark.sql import types as T
    from tributary.operators.merge import newest_marks

    rows = spark.createDataFrame([("1", 5), ("01", 6), ("x", 7)], "id string, sourceid long").withColumn("loaddtm", F.current_timestamp())
    marks = [newest_marks(rows, T.LongType(), once=once) for once in (False, True)]
    assert [sorted((r["_key_0"], r["_deleted_by"]) for r in m.collect()) for m in marks] == [[(1, 5)]] * 2
    assert "Exchange" not in marks[1]._jdf.queryExecution().executedPlan().toString()


def test_basename(spark):
    """The last segment, without a pattern to be matched for each record."""
    from tributary.functions.scalars import basename

    paths = ["file:/a/b c.json", "b.json", "a/", "", None, "a//", "a/b\nc", "a/b\n", "a/ü.json", "/"]
    found = spark.createDataFrame([(k, p) for k, p in enumerate(paths)], "k long, p string").select("k", basename(F.col("p")).alias("n"))
    assert [r["n"] for r in found.orderBy("k").collect()] == ["b c.json", "b.json", "", "", None, "", "b\nc", "b\n", "ü.json", ""]
    assert "regexp" not in found._jdf.queryExecution().executedPlan().toString()


def test_types_of_lines_are_made_once(spark):
    """Lines that are no objects, are broken or name a field twice take no part, and no line's type is made to tell."""
    from tributary.sources import landing

    lines = ['{"a": 1}', ' \t{"b": "x"} ', "[1]", '"{"', "{", "", None, '{"c": 1, "c": 2}', "null", "\ufeff{\"d\": null}", "7"]
    texts = spark.createDataFrame([(t, 0) for t in lines], f"value string, {landing.SPLIT} long")
    assert landing.typed_schema(texts).simpleString() == "struct<a:bigint,b:string,d:void>"
    plans, first = [], type(texts).first
    try:
        type(texts).first = lambda frame: plans.append(frame._jdf.queryExecution().optimizedPlan().toString()) or first(frame)
        landing.typed_schema(texts)
    finally:
        type(texts).first = first
    assert plans and "schemaofvariant(" not in plans[0].lower().replace("_", "").replace("schemaofvariantagg(", "")
