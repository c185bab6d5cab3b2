"""Operators on small frames."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import rescue, scalars
from tributary.operators import audit, config as cfg, files as ops, merge
from tributary.operators.mapping import MappedColumn, MappingError, add_audit, map_columns, record_schema, sink_types

DAY = datetime(2024, 1, 2)
STATE = "id string, v double, sourceid long, loaddtm timestamp, deleted_flag string, date_deleted timestamp"


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns or frame.columns).collect()), key=repr)


def off_schema(record, schema):
    raw = {f.name: record.getItem(f.name) for f in schema}
    read = {f.name: rescue.typed(raw[f.name], f.dataType) for f in schema}
    return rescue.rescued(record, schema, rescue.only_known(record, schema), raw, read)


def test_scalars(spark):
    paths = spark.createDataFrame(
        [("s3://b/x/a%20b.json",), ("Users_DeLeTe.json",), ("dir/",)], "p string"
    ).select(scalars.basename(F.col("p")).alias("n"))
    assert [r["n"] for r in paths.collect()] == ["a%20b.json", "Users_DeLeTe.json", ""]
    assert [r[0] for r in paths.select(scalars.is_delete_name(F.col("n"))).collect()] == [False, True, False]
    sources = ["$['a']", "$['a']['b']", "$[b]", "c.d", "$.e", "", "$['f"]
    got = spark.createDataFrame([(s,) for s in sources], "s string").select(scalars.mapping_source(F.col("s")))
    assert [r[0] for r in got.collect()] == ["a", "a", "b", "c.d", "$.e", "", "f"]
    flags = spark.createDataFrame([(f,) for f in [" Y ", "true", "1", "n", None]], "f string").select(scalars.flag(F.col("f")))
    assert [r[0] for r in flags.collect()] == [True, True, True, False, False]
    assert (scalars.run_id("1", "2"), scalars.run_id(None, "2"), scalars.run_id("1")) == ("1_2", "2", "manual_run")
    labels = spark.createDataFrame([("r", 1), (None, 2)], "r string, b long").select(scalars.run_label(F.col("r"), F.col("b")))
    assert [r[0] for r in labels.collect()] == ["r_1", "manual_run_2"]
    assert spark.range(1).select(F.length(scalars.message(F.lit("'" * 5000)))).first()[0] == 4000


def test_as_text_list(spark):
    frame = spark.createDataFrame(
        [(["a", None, "b"], [1, 2], [(1,)], None)], "s array<string>, n array<int>, o array<struct<x:int>>, z array<string>"
    )
    out = frame.select(*[scalars.as_text_list(F.col(f.name), f.dataType) for f in frame.schema]).first()
    assert tuple(out) == ("a,b", "1,2", '[{"x":1}]', "")


def test_rescue(spark):
    schema = T.StructType.fromDDL("id string, v double, t array<string>")
    cases = {
        '{"id":"a","v":1,"t":["x"]}': None,
        '{"id":5}': None,
        "{}": None,
        '{"id":"a","v":null,"t":null}': None,
        '{"id":"a","x":null}': {"x": None},
        '{"ID":"a"}': {"ID": "a"},
        '{"v":"bad","t":7,"id":{"k":1}}': {"v": "bad", "t": "7"},
        '{"id":"a","x":{"y":[1]}}': {"x": '{"y":[1]}'},
    }
    frame = spark.createDataFrame([(c,) for c in cases], "c string").select(
        off_schema(rescue.records(rescue.parsed(F.col("c")))[0], schema)
    )
    got = [r[0] and json.loads(r[0]) for r in frame.collect()]
    assert got == list(cases.values())


def test_record_values_and_duplicates(spark):
    text = '[{"id": 500100200300, "v": "1.50", "id2": {"a": 1}}, {"id": "x", "id": "y"}, {"v": 1, "id": "z", "v": 2}]'
    schema = T.StructType.fromDDL("id string, v string")
    frame = spark.range(1).select(F.explode(rescue.records(rescue.parsed(F.lit(text)))).alias("r"))
    frame = frame.select(rescue.last_values(F.col("r"), rescue.only_known(F.col("r"), schema)).alias("r"))
    got = frame.select(F.col("r")["id"], F.col("r")["v"], F.col("r")["id2"], off_schema(F.col("r"), schema)).collect()
    assert [tuple(r) for r in got] == [
        ("500100200300", "1.50", '{"a":1}', '{"id2":"{\\"a\\":1}"}'), ("y", None, None, None), ("z", "2", None, None),
    ]


def test_repeated_fields_are_clean(spark):
    from tributary.sources.landing import parse_texts

    texts = spark.createDataFrame([("a.json", '[{"id": "x", "id": "y"}, {"id": "1", "n": "no", "n": 2}]')], f"{ops.PATH} string, value string")
    got = parse_texts(texts, T.StructType.fromDDL("id string, n long")).orderBy(ops.POS)
    assert rows(got, "id", "n", ops.RESCUED) == [("1", 2, None), ("y", None, None)]


def test_files(spark):
    records = spark.createDataFrame(
        [("d/b.json", 0, None), ("d/b.json", 1, None), ("d/a.json", 0, None), ("d/Z.json", 0, None), ("d/bad.json", 0, "{}"),
         ("d/empty.json", None, None), ("e/a.json", 0, None)],
        f"{ops.PATH} string, {ops.POS} long, {ops.RESCUED} string",
    )
    records = ops.with_filename(records)
    numbered = ops.number_files(ops.file_inventory(records), 10)
    assert rows(numbered, ops.PATH, "file_rows", ops.SID) == [
        ("d/Z.json", 1, 11), ("d/a.json", 1, 12), ("d/b.json", 2, 14), ("d/bad.json", 1, None), ("d/empty.json", 0, 15),
        ("e/a.json", 1, 13),
    ]
    clean, drifted = ops.split_drift(records)
    assert rows(drifted, ops.NAME) == [("bad.json",)] and clean.count() == 6
    small = ops.tag_rows(records, numbered, 6)
    assert rows(small) == rows(ops.tag_rows(records, numbered)) and small.count() == 7


@pytest.mark.parametrize("n, together", [(0, 5), (3, 5), (500, 7), (100_000, 20_000)])
def test_numbering_in_ranges(spark, n, together):
    """A long file list is numbered by several tasks as one sort would; most of it may have one name."""
    names = [f"d{i % 997}/" + ("same.json" if i % 3 else f"ä{i * 7919 % 10_007}.json") + f"/{i}" for i in range(n)]
    made = [(f"{name}", name.split("/")[1], i % 11 == 0) for i, name in enumerate(names)]
    files = spark.createDataFrame(made, f"{ops.PATH} string, {ops.NAME} string, drifted boolean").repartition(5)
    cuts = ops.name_splitters(files, together)
    assert len(cuts) == min(-(-n // together), 4) - 1 if n > together else cuts == []
    ordered = sorted(made, key=lambda f: (f[1].encode(), f[0].encode()))
    found = {r[ops.PATH]: r[ops.SID] for r in ops.assign_source_ids(files, 10, cuts).collect()}
    assert found == {f[0]: 11 + i for i, f in enumerate(ordered)} and len(found) == n
    clean = [f[0] for f in ordered if not f[2]]
    found = {r[ops.PATH]: r[ops.SID] for r in ops.number_files(files, 0, cuts).collect()}
    assert found == {**{f[0]: None for f in made}, **{path: i + 1 for i, path in enumerate(clean)}}


def test_mapping(spark):
    frame = spark.createDataFrame([("1", ["x", "y"], "n/a", "q", 3)], "`a b` string, t array<string>, w string, o string, _sid long")
    mapping = [
        MappedColumn("a b", "id", T.LongType()), MappedColumn("t", "tags", T.StringType()),
        MappedColumn("w", "amount", T.DoubleType()), MappedColumn("absent", "z"),
    ]
    out = add_audit(map_columns(frame, mapping, "_sid"), F.lit(DAY))
    assert out.columns == ["id", "tags", "amount", "sourceid", "loaddtm", "deleted_flag", "date_deleted"]
    assert tuple(out.drop("loaddtm").first()) == (1, "x,y", None, 3, "N", None)
    with pytest.raises(MappingError, match="none of the mapped fields"):
        map_columns(frame, [MappedColumn("absent", "z")])
    target = T.StructType.fromDDL("id string, tags array<string>, amount decimal(9,2)")
    typed = sink_types(mapping, target)
    assert [m.type for m in typed] == [T.StringType(), None, T.DecimalType(9, 2), None]
    source = T.StructType.fromDDL("`a b` string, t array<string>, w string, n struct<x:string>")
    assert [f.dataType for f in record_schema(source, mapping)] == [
        T.LongType(), T.ArrayType(T.StringType()), T.DoubleType(), T.StringType(),
    ]


def test_config(spark):
    control = spark.createDataFrame(
        [(1, "a", "y", 1), (2, "a", "y", 2), (3, "a", "Y", 9), (4, "a", "y", 2), (5, "b", "n", 1)],
        "id long, ecname string, enableflag string, modifieddate long",
    )
    assert rows(cfg.latest_config(control), "id") == [(4,)]
    entries = [
        {"source": {"path": "$['k']"}, "sink": {"name": "id", "type": "string"}}, "bad", {"source": {"path": "x"}}, 5,
        {"source": {"path": "x"}, "sink": {"name": "y", "type": "int"}}, {"sink": {"name": "w"}},
        {"source": {"path": "x"}, "sink": {"name": "z"}}, {"source": {"path": "q"}, "sink": {"name": "z", "type": "date"}},
    ]
    configs = spark.createDataFrame(
        [("a", json.dumps({"mappings": entries})), ("b", "{bad"), ("c", None), ("d", '{"mappings": []}'),
         ("e", json.dumps({"mappings": [{"source": {"path": "u"}, "sink": {"name": "v"}}]}))],
        "ecname string, mappingsettings string",
    )
    parsed = cfg.parse_mappings(configs)
    assert rows(parsed) == [
        ("a", 0, "k", "id", "string"), ("a", 4, "x", "z", "date"), ("a", 7, "q", "z", "date"), ("e", 0, "u", "v", None),
    ]
    assert rows(cfg.id_sources(parsed)) == [("a", "k"), ("e", "id")]
    target = spark.createDataFrame([(e, c) for e in "ae" for c in ("id", *cfg.AUDIT_COLUMNS)] + [("e", "v")], "ecname string, sink string")
    assert rows(cfg.check_target(parsed, target.filter("NOT (ecname = 'e' AND sink = 'loaddtm')"))) == [("a", "z"), ("e", "loaddtm")]
    assert cfg.declared_type("decimal(5,1)") == T.DecimalType(5, 1) and cfg.declared_type("Int64") is None
    assert cfg.declared_type(None) is None


def test_latest_and_delete_keys(spark):
    frame = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("a", 2, 1), (None, 1, 0), (None, 3, 0)], "id string, sourceid long, p long")
    newest = merge.latest_per_key(frame, ["id"], [F.col("sourceid").desc(), F.col("p").desc()])
    assert rows(newest) == [("a", 2, 1), (None, 3, 0)]
    deletes = frame.withColumnRenamed("sourceid", "_sid")
    assert rows(merge.delete_keys(deletes, "id")) == [("a", 2)]
    assert merge.delete_keys(deletes, "other").isEmpty()


def state(spark, *entries):
    return spark.createDataFrame([(i, v, s, None, f, None) for i, v, s, f in entries], STATE)


def test_upsert_clear_and_soft_delete(spark):
    old = state(spark, ("a", 1.0, 1, "Y"), ("b", 1.0, 1, "N"), (None, 1.0, 1, "N"), ("c", 1.0, None, "N"), ("d", 1.0, 9, "Y"))
    staged = spark.createDataFrame([("a", 5.0), ("n", 6.0), (None, 7.0)], "id string, v double")
    merged = merge.upsert(old, staged)
    assert rows(merged, "id", "v", "deleted_flag") == [
        ("a", 5.0, "Y"), ("b", 1.0, "N"), ("c", 1.0, "N"), ("d", 1.0, "Y"), ("n", 6.0, None), (None, 1.0, "N"), (None, 7.0, None),
    ]
    dated = old.withColumn("date_deleted", F.when(F.col("deleted_flag") == "Y", F.lit(DAY)))
    cleared = merge.clear_deletes(dated, staged.unionByName(staged))
    assert rows(cleared.select("id", "deleted_flag", F.col("date_deleted").isNotNull())) == [
        ("a", "N", False), ("b", "N", False), ("c", "N", False), ("d", "Y", True), (None, "N", False),
    ]
    keys = spark.createDataFrame([("b", 1), ("c", 1), ("d", 10), ("zz", 3), ("a", 2)], "id string, sourceid long")
    dead = merge.soft_delete(old, keys, F.lit(DAY))
    assert rows(dead, "id", "deleted_flag", "sourceid") == [
        ("a", "Y", 2), ("b", "N", 1), ("c", "Y", 1), ("d", "Y", 10), (None, "N", 1),
    ]
    assert dead.filter("date_deleted IS NOT NULL AND loaddtm IS NOT NULL").count() == 3


def test_audit(spark):
    files = spark.createDataFrame([("a.json", 3, 1), ("b.json", 4, 2)], f"{ops.NAME} string, file_rows long, {ops.SID} long")
    log = audit.file_log(files, "users", F.lit(9), F.lit(7), F.lit("r_0"), F.lit(DAY), F.lit(0))
    assert rows(log, "id", "tablename", "filename", "status", "lndrowscopied", "stgrowscopied", "pipelinerunid", "batchid") == [
        (1, "users", "a.json", "SUCCESS", 9, 9, "r_0", 7), (2, "users", "b.json", "SUCCESS", 9, 9, "r_0", 7),
    ]
    staged = spark.createDataFrame([("x", 1), ("y", 5)], "id string, sourceid long")
    assert rows(audit.clean_staging(staged, log, "users"), "id") == [("y",)]
    assert audit.clean_staging(staged, log, "other").count() == 2
    errors = audit.schema_error_log(files, "users", F.lit(7), F.lit("r_0"), F.lit(DAY))
    assert errors.columns == ["tablename", "filename", "error_message", "pipelinerunid", "batchid", "created_timestamp"]
    events = audit.error_log(files, "users", audit.STEP_SCHEMA_DRIFT, F.lit("it's"), F.lit(None), F.lit("r_0"), F.lit(DAY))
    assert rows(events, "filename", "status", "cmnts") == [("a.json", "FAILED", "it's"), ("b.json", "FAILED", "it's")]
    records = spark.createDataFrame(
        [("p/a.json", "a.json", 0, None, 1), ("p/a.json", "a.json", 1, None, 1), ("p/a.json", "a.json", 2, None, None),
         ("p/b.json", "b.json", 0, None, 2), ("p/bad.json", "bad.json", 0, "{}", 3), ("p/bad.json", "bad.json", 1, None, 4),
         ("p/delete.json", "delete.json", 0, None, 1), ("p/delete.json", "delete.json", 1, None, None),
         ("p/empty.json", "empty.json", None, None, None)],
        f"{ops.PATH} string, {ops.NAME} string, {ops.POS} long, {ops.RESCUED} string, k long",
    )
    assert tuple(audit.batch_summary(records, "k").first()) == (4, 3, 1, 1)
    assert tuple(audit.batch_summary(records.limit(0), "k").first()) == (0, 0, 0, 0)
