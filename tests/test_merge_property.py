"""Batch by batch, folded, and a plain simulation give the same state."""

import random
from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import merge
from tributary.operators.files import NAME, PATH, POS, RESCUED, file_inventory, number_files
from tributary.operators.mapping import MappedColumn
from tributary.plans.batch import plan_changes

DAY = datetime(2024, 1, 2)
STATE = "id long, v long, sourceid long, loaddtm timestamp, deleted_flag string, date_deleted timestamp"
RECORDS = f"{PATH} string, {NAME} string, {POS} long, {RESCUED} string, key string, v long"
MAPPING = [MappedColumn("key", "id", T.LongType()), MappedColumn("v", "v", T.LongType())]


def history(rng):
    """Batches of files of (key text, value) records."""
    batches, value = [], 0
    for b in range(4):
        files = {}
        for f in range(rng.randrange(1, 4)):
            name = f"{b}{rng.choice('azAZ')}{f}{rng.choice(['', '', '_delete'])}.json"
            records = []
            for _ in range(rng.randrange(1, 6)):
                value += 1
                key = rng.choice(["1", "2", "3", "4", None, "03"] if "delete" in name else ["1", "2", "3", "4", None])
                records.append((key, value))
            files[name] = records
        batches.append(files)
    return batches


def simulate(batches):
    state, keyless, last = {}, [], 0
    for files in batches:
        upserts, deletes = {}, {}
        for name in sorted(files):
            last += 1
            for key, value in files[name]:
                if "delete" in name:
                    if key is not None:
                        deletes[key] = last
                else:
                    upserts[key] = (value, last, "N")
        if None in upserts:
            keyless.append((None, *upserts.pop(None)))
        state.update(upserts)
        for key, sid in deletes.items():
            if key in state and state[key][1] < sid:
                state[key] = (state[key][0], sid, "Y")
    return sorted([(int(k), *v) for k, v in state.items()] + keyless, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.select("id", "v", "sourceid", "deleted_flag").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_state(spark, seed):
    rng = random.Random(seed)
    batches = history(rng)
    state, empty, changes, last = None, spark.createDataFrame([], STATE), [], 0
    for files in batches:
        rows = [(f"d/{n}", n, p, None, k, v) for n, records in files.items() for p, (k, v) in enumerate(records)]
        rng.shuffle(rows)
        records = spark.createDataFrame(rows, RECORDS).repartition(3)
        planned = plan_changes(records, number_files(file_inventory(records), last), MAPPING, "key", F.lit(DAY))
        staged = spark.createDataFrame(planned.staged.collect(), planned.staged.schema)
        deletes = spark.createDataFrame(planned.deletes.collect(), planned.deletes.schema)
        changes.append((staged, deletes))
        last += len(files)
        state = merge.upsert(empty if state is None else state, staged)
        state = merge.soft_delete(merge.clear_deletes(state, staged), deletes, F.lit(DAY))
        state = spark.createDataFrame(state.collect(), STATE)
    expected = simulate(batches)
    assert result(state) == expected

    upserts = reduce(lambda a, b: a.unionByName(b), [c[0] for c in changes])
    deletes = reduce(lambda a, b: a.unionByName(b), [c[1] for c in changes]).withColumn("loaddtm", F.lit(DAY))
    marks = merge.newest_marks(deletes, T.LongType())
    assert result(merge.apply_changes(empty, merge.newest_upserts(upserts), marks)) == expected
