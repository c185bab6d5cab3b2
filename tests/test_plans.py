"""Physical plans: no Python in the data path, no cross joins, no shuffle of the state."""

import contextlib
import io
import os

import pytest

from landing import Landing

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")


def plan(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_lazy_queries(spark):
    from tributary.queries import files, records, state

    for module in (files, records, state):
        for name, query in module.QUERIES.items():
            text = plan(query(spark, SF_DIR))
            for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
                assert bad not in text, (name, bad)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_pruning_and_partial_limit(spark):
    from tributary.queries import files, state

    text = plan(state.latest_lineitem(spark, SF_DIR))
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")
    assert "l_tax" not in text
    assert "user_id" not in plan(files.file_inventory(spark, SF_DIR))


def test_merge_reads_touched_partitions(spark, tmp_path):
    """The merge's scan of the target is pruned to the partitions of the batch's keys."""
    land = Landing(spark, tmp_path, {"id": "string", "v": "double"}, spread=True)
    land.put("a.json", [{"id": str(n), "v": n} for n in range(300)])
    ingest = land.ingest()
    ingest.run()
    touched = ingest.target._touched(spark.table(land.target).filter("id IN ('7', '8')"))
    text = plan(touched)
    assert "PartitionFilters: [key_part" in text and "InMemoryFileIndex(2 paths)" in text
    assert touched.count() < 300


def test_target_check_reads_mappings_once(spark):
    """A sink without a name or a source without one is as missing as before."""
    from tributary.operators import config as cfg

    configs = spark.createDataFrame([("a", '{"mappings": [{"source": {"path": "x"}, "sink": {"name": "y"}}]}')], "ecname string, mappingsettings string")
    target = spark.createDataFrame([("a", c) for c in cfg.AUDIT_COLUMNS], "ecname string, sink string")
    found = cfg.check_target(cfg.parse_mappings(configs), target)
    assert plan(found).count("posexplode(") == 1
    assert [tuple(r) for r in found.collect()] == [("a", "y")]
    mappings = spark.createDataFrame([("a", None), (None, "z"), (None, "z")], "ecname string, sink string")
    found = sorted(map(tuple, cfg.check_target(mappings, target).collect()), key=repr)
    assert found == sorted([("a", None), (None, "z"), *((None, c) for c in cfg.AUDIT_COLUMNS)], key=repr)
