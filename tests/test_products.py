from __future__ import annotations

import datetime
import io
import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medleaf import schemas
from medleaf.functions import codes, dates
from medleaf.operators import labels as L
from medleaf.operators import products as P
from medleaf.sources import archives

RECORD = {
    "product_ndc": "12345-678", "product_id": "p1", "generic_name": "ASPIRIN", "brand_name": "", "dosage_form": "TABLET, FILM COATED", "marketing_category": "OTC Monograph Final", "finished": False,
    "marketing_start_date": "20200131", "openfda": {"rxcui": [1791588, "1791593"]}, "route": [], "unknown": 1,
    "packaging": [{"package_ndc": "12345-678-90", "description": "1 TABLET in 1 BLISTER PACK (12345-678-90)", "sample": False}, {"package_ndc": "01", "description": "a bottle"}],
}


def landed(tmp_path, *documents):
    for k, records in enumerate(documents):
        (tmp_path / f"part-{k}.json").write_text(json.dumps({"meta": {"results": 3}, "results": records}))
    return str(tmp_path)


def test_product_fields(spark, tmp_path):
    path = landed(tmp_path, [RECORD, {"product_id": "p2", "openfda": {}, "product_type": "HUMAN PRESCRIPTION DRUG"}])
    one, two = sorted(P.products(archives.read_records(spark, path, schemas.PRODUCT_RECORD)).collect(), key=lambda r: r.product_id)
    assert one.rxnorm_ids == ["1791588", "1791593"] and one.is_otc is True and one.brand_name is None and one.finished is None and one.route is None
    assert one.short_dosage_form == "TABLET" and one.marketing_start_date == datetime.date(2020, 1, 31)
    assert two.rxnorm_ids == [] and two.is_otc is False and two.short_dosage_form is None and two.openfda is None
    assert set(schemas.PRODUCT.names) <= set(one.asDict())


def test_packages(spark, tmp_path):
    got = {r.package_ndc: r for r in P.packages(archives.read_records(spark, landed(tmp_path, [{**RECORD, "dosage_form": "TABLET"}, {"product_id": "none"}]), schemas.PRODUCT_RECORD)).collect()}
    assert set(got) == {"12345-678-90", "12345-678-01"}
    full = got["12345-678-90"]
    assert (full.ndc11, full.size, full.size_extra, full.packages_number, full.package_format) == ("12345067890", 1, "", 1, "BLISTER PACK")
    assert got["12345-678-01"].size is None and got["12345-678-01"].ndc11 == "12345067801"


@pytest.mark.parametrize(("code", "digits"), [
    ("51662-1407-1", "51662140701"), ("0001-0001-01", "00001000101"), ("12345-678-90", "12345067890"), ("12345-6789-01", "12345678901"), ("1-2", "12"), ("", ""), (None, None), ("12345-678-9-1", "123450678" + "91"),
])
def test_eleven_digits(spark, code, digits):
    assert spark.createDataFrame([(code,)], "c string").select(codes.eleven_digits(F.col("c"))).first()[0] == digits


@pytest.mark.parametrize(("category", "kind", "own", "flag"), [
    (None, None, None, None), (" ", "", [], None), ("OTC Monograph", None, None, True), ("Over-the-Counter", "HUMAN PRESCRIPTION DRUG", None, True), (None, "HUMAN PRESCRIPTION DRUG", None, False),
    ("Rx only", None, None, False), ("xrx", None, None, None), (None, None, ["sold", "RX", "here"], False), ("unapproved", None, None, None),
])
def test_over_the_counter(spark, category, kind, own, flag):
    df = spark.createDataFrame([(category, kind, own)], "a string, b string, c array<string>")
    assert df.select(codes.over_the_counter(F.col("a"), F.col("b"), F.col("c"))).first()[0] is flag


def test_dates(spark):
    texts = ["20200131", "2020-01-31", "01/31/2020", "Jan 31, 2020", "January 31, 2020", "20209999", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(dates.parsed_date(F.col("t"))).collect()]
    assert got == [datetime.date(2020, 1, 31)] * 5 + [None] * 3


def test_description_overflow_and_levels(spark):
    texts = ["9999999999999999999999 A in 2 B (1-2-3)", "1 KIT in 1 CARTON (1-2-3) / 5 mL in 1 VIAL", "x 1 A in 2 B (1-2-3)"]
    df = spark.createDataFrame([(t, None) for t in texts], "d string, f string")
    got = df.select(*[c.alias(k) for k, c in codes.described(F.col("d"), F.col("f")).items()]).collect()
    assert got[0].size is None and got[0].packages_number == 2 and got[0].size_extra == "A"
    assert tuple(got[1]) == (1, "KIT", 1, "CARTON") and tuple(got[2]) == (None,) * 4


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 0), ("", 0, 0), (None, 0, 0), ("b", 0, 0)], "k string, archive int, pos int")
    assert rows(P.last_per_key(df, "k", "archive", "pos")) == [("a", 1, 0), ("b", 0, 0)]


def test_labels(spark, tmp_path):
    records = [
        {"id": "1", "set_id": "s", "version": "", "warnings": [" first", "second "], "purpose": [], "openfda": {"product_ndc": ["a"]}, "other": 1},
        {"id": "1", "set_id": "later"}, {"set_id": "no id"},
    ]
    got = L.labels(archives.read_records(spark, landed(tmp_path, records), schemas.LABEL_RECORD))
    first = next(r for r in got.collect() if r.set_id == "s")
    assert first.warnings == "first\nsecond" and first.purpose == "" and first.abuse is None and first.version is None and first.product_ndc == ["a"] and first.package_ndc == []
    assert len(schemas.LABEL.names) == 129
    assert [r.set_id for r in L.last_labels(got).collect()] == ["later"]


def test_manifest_and_caps(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"results": {"drug": {"ndc": {"total_records": 7, "partitions": [{"file": "a.zip", "records": "3"}, {"file": "b.zip", "records": 4}]}}}}))
    assert rows(archives.read_manifest(spark, str(tmp_path / "m.json"), "ndc")) == [("a.zip", 3, 1, 7), ("b.zip", 4, 2, 7)]
    assert archives.read_manifest(spark, str(tmp_path / "m.json"), "label").count() == 0


def test_zipped_archives(spark, tmp_path):
    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"{k}.json.zip", "w") as z:
            z.writestr("x.json", json.dumps({"meta": {"note": "[é]"}, "results": [{**RECORD, "product_id": f"{k}-{i}", "generic_name": "é" * i} for i in range(1500 * k + 3)]}, ensure_ascii=False))
    got = archives.read_zipped(spark, str(tmp_path), schemas.PRODUCT_RECORD)
    assert got.count() == 1506
    assert {(r.archive, r.pos, r.record.product_id) for r in archives.capped(got, "1.json.zip", 2).collect()} == {("1.json.zip", 0, "1-0"), ("1.json.zip", 1, "1-1")}
    assert max(len(r.record.generic_name) for r in got.collect()) == 1502
    with pytest.raises(ValueError):
        archives.capped(got, "x", -1)


@pytest.mark.parametrize("text", ['{"results":[]}', '{"results": [1, 2.5, "a,]", {"b": [1]}]}', '{"x": 1}', ""])
def test_results_in_small_pieces(text):
    want = json.loads(text).get("results", []) if text else []
    for piece in (1, 2, 7, 100):
        assert [json.loads(r) for r in archives.results(io.StringIO(text), piece)] == want


@pytest.mark.parametrize("piece", [1, 3, 1 << 20])
def test_only_the_documents_own_results_count(piece):
    for text, want in (
        ('{"meta":{"results":{"tags":[9,8]}},"results":[{"a":1}]}', [{"a": 1}]), ('{"results":[],"x":[1]}', []), ('{"x":"\\"results\\":[1]"}', []), ('{"a":{"results":[1]}}', []),
        (' { "results" : [ 1 , 23 , "x" , null ] , "z" : 4.5 } ', [1, 23, "x", None]), ("{}", []), ("", []), ("[1]", []), ('{"results":5}', []),
    ):
        assert [json.loads(r) for r in archives.results(io.StringIO(text), piece)] == want
    with pytest.raises(ValueError):
        list(archives.results(io.StringIO('{"results":[1,'), piece))


def test_or_empty(spark):
    bad = lambda: spark.read.parquet("/nowhere/at/all")
    assert archives.or_empty(bad, spark, schemas.CATALOG, allow_empty=True).count() == 0
    with pytest.raises(Exception):  # noqa: B017
        archives.or_empty(bad, spark, schemas.CATALOG)
