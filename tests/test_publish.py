from __future__ import annotations

import datetime
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medleaf import schemas
from medleaf.operators import products as P
from medleaf.operators import publish as K
from medleaf.operators.serialize import json_rows
from medleaf.streaming import ingest


@pytest.fixture()
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t1")
    spark.sql("USE t1")
    yield spark
    spark.sql("USE default")
    spark.sql("DROP DATABASE t1 CASCADE")


def test_ids():
    assert K.import_id("2024-01-01/a b") == "20240101ab" and len(K.import_id("x" * 50)) == 32 and len(K.import_id("--")) == 8


@pytest.mark.parametrize(("staged", "expected", "answer"), [(95, 100, (True, True)), (94, 100, (False, False)), (100, 100, (True, False)), (0, 0, (False, False)), (120, 100, (True, True))])
def test_product_gate(staged, expected, answer):
    assert K.product_gate(staged, expected) == answer


def test_other_gates():
    assert K.label_gate(25, 25) and not K.label_gate(24, 25) and not K.label_gate(0, 0) and not K.label_gate(5, None)
    assert K.evidence_gate(100) and not K.evidence_gate(99) and K.evidence_gate(0, allow_empty=True) and K.evidence_gate(0, least=0)


def test_publish_with_backup(db):
    for n in (1, 2, 3):
        K.stage(db.range(n), "product", f"r{n}")
        K.stage(db.range(n), "product", f"r{n}")  # a leftover is replaced
        K.publish_with_backup(db, "product", f"r{n}")
    assert db.table("product").count() == 3 and db.table("product_old").count() == 2


def test_gate_stops_publication(db):
    products, packages = db.range(94).select(F.col("id").cast("string").alias("product_id")), db.range(3)
    with pytest.raises(K.GateError):
        K.publish_products(db, products, packages, 100, "a")
    assert not db.catalog.tableExists("product")
    K.publish_products(db, products, packages, 98, "b")
    assert db.table("product").count() == 94 and db.table("package").count() == 3


def test_replacement(db):
    K.stage(db.range(2), "evidence", "x")
    assert not K.publish_by_replacement(db, "evidence", "x", test=True)
    assert K.publish_by_replacement(db, "evidence", "x", test=True, force=True) and db.table("evidence").count() == 2


def test_append_and_columns(db):
    db.createDataFrame([(1, "a")], "k int, v string").write.saveAsTable("t")
    K.append_new(db.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "k int, v string"), "t", "k")
    assert rows(db.table("t")) == [(1, "a"), (2, "c")]
    assert K.add_column(db, "t", "w", "array<string>") and not K.add_column(db, "t", "w", "array<string>")
    assert db.table("t").columns == ["k", "v", "w"] and K.without_column(db.table("t"), "w").columns == ["k", "v"]
    K.laid_out(db.table("t"), "t_laid_out", "k", 2)
    assert db.table("t_laid_out").count() == 2


def test_json_rows(spark):
    at, day = datetime.datetime(2024, 1, 2, 3, 4, 5), datetime.date(2024, 1, 2)
    df = spark.createDataFrame([(1, at, at.replace(microsecond=70), day, [day, None], {"a": at}, None, "x")], "k int, a timestamp_ntz, b timestamp_ntz, d date, l array<date>, m map<string,timestamp_ntz>, n string, gone string")
    got = json.loads(json_rows(df, exclude=("gone",), computed={"twice": F.col("k") * 2}).first().json)
    assert got == {"k": 1, "a": "2024-01-02T03:04:05Z", "b": "2024-01-02T03:04:05.000070Z", "d": "2024-01-02Z", "l": ["2024-01-02Z", None], "m": {"a": "2024-01-02T03:04:05Z"}, "n": None, "twice": 2}


def test_ingest_as_archives_land(db, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()

    def land(name, ids):
        (folder / name).write_text(json.dumps({"results": [{"product_id": i, "generic_name": name} for i in ids]}))

    def run():
        return ingest.ingest(ingest.landed_records(db, str(folder), schemas.PRODUCT_RECORD), P.products, "product", "s", "product_id", state)

    land("a.json", ["1", "2", "2"])
    assert run() == 2
    land("b.json", ["2", "3"])
    assert run() == 3 and run() == 3
    with pytest.raises(K.GateError):
        ingest.finish(db, "product", "s", "product_id", 3, 10)
    ingest.finish(db, "product", "s", "product_id", 3, 3)
    assert rows(db.table("product").select("product_id", "generic_name")) == [("1", "a.json"), ("2", "a.json"), ("3", "b.json")]
