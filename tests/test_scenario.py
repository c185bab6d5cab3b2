"""The sample scenario: inserts, an update, a soft delete, irregular ids."""

import pytest

from landing import ORDERS, Landing

FIRST = [
    {"name": "North quay", "language": "Dutch", "id": "BERTH-10", "bio": "two cranes", "version": 1.25},
    {"name": "South quay", "language": "Dutch", "id": "BERTH-20", "bio": "one crane", "version": 2.5},
    {"name": "Old basin", "language": "Frisian", "id": "BERTH-30", "bio": "shallow", "version": 3.75},
    {"name": "Lock, inner", "language": "Danish", "id": "BERTH-40", "bio": None, "version": 4.0},
]
UPDATE = [{"name": "Old basin, dredged", "language": "Frisian", "id": "BERTH-30", "bio": "deep", "version": 5.5}]
DELETE = [{"id": "BERTH-20"}]
GOLDEN = [
    ("BERTH-10", 1.25, 1, "N"),
    ("BERTH-20", 2.5, 3, "Y"),
    ("BERTH-30", 5.5, 2, "N"),
    ("BERTH-40", 4.0, 1, "N"),
]


def users(land):
    land.put("berths_01.json", FIRST)
    land.put("berths_02.json", UPDATE)
    land.put("berths_03_delete.json", DELETE)


@pytest.mark.parametrize("per_batch", ["1", "1000"])
def test_users(spark, tmp_path, per_batch):
    land = Landing(spark, tmp_path, max_files_per_trigger=per_batch)
    users(land)
    ingest = land.ingest()
    totals = ingest.run().collect()
    assert land.state() == GOLDEN
    assert len(totals) == (3 if per_batch == "1" else 1)
    assert sum(t["deleted"] for t in totals) == 1
    deleted = [r for r in land.state("id", "date_deleted", "loaddtm") if r[1] is not None]
    assert [r[0] for r in deleted] == ["BERTH-20"] and deleted[0][1] == deleted[0][2]
    logged = ingest.file_log().orderBy("id").collect()
    assert [(r["id"], r["filename"], r["status"], r["file_rows"]) for r in logged] == [
        (1, "berths_01.json", "SUCCESS", 4), (2, "berths_02.json", "SUCCESS", 1), (3, "berths_03_delete.json", "SUCCESS", 1),
    ]
    assert ingest.staging().isEmpty() and ingest.staging("deletes").isEmpty()


def test_irregular_ids(spark, tmp_path):
    land = Landing(spark, tmp_path)
    users(land)
    land.put("Berths-9.json", '[\n {"name": "Ferry slip", "id": 500100200300, "version": 6.5},\n'
             ' {"name": "Môle d\'été", "id": "BERTH-50", "version": 7.0},\n {"name": "unnumbered", "version": 8.25}\n]')
    totals = land.ingest().run().first()
    assert totals["files"] == 4 and totals["merged"] == 4 + 3
    state = land.state("id", "name", "sourceid")
    assert (None, "unnumbered", 1) in state
    assert ("500100200300", "Ferry slip", 1) in state and ("BERTH-50", "Môle d'été", 1) in state


def test_second_source(spark, tmp_path):
    land = Landing(spark, tmp_path, ORDERS, "orders_demo")
    land.put("orders_001.json", '[\n{"id": 71, "customer_id": 5, "product": "Rope", "quantity": 4, "amount": 12.5, "status": "OPEN"},\n'
             '{"id": 72, "customer_id": 6, "product": "Anchor", "quantity": 1, "amount": 310.0, "status": "OPEN"}\n]')
    land.put("orders_002.json", [{"id": 73, "customer_id": 5, "product": "Buoy", "quantity": 2, "amount": 48.0, "status": "SENT"}])
    land.put("orders_delete.json", [{"id": "72"}, {"id": "071"}])
    land.ingest().run()
    # Delete keys compare as text, so "071" is not the key 71.
    assert land.state("id", "amount", "deleted_flag") == [(71, 12.5, "N"), (72, 310.0, "Y"), (73, 48.0, "N")]
