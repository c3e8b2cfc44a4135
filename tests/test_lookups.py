from __future__ import annotations

import pytest
from conftest import rows

from medleaf.operators import lookups as L


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([
        ("1", "A", "ASPIRIN", "ASPIRIN", "TABLET", "TABLET", "lab", ["10"], "s1"), ("2", "B", "ASPIRIN", "Aspirin Low", "TABLET", "TABLET", "lab", ["10", "11"], "s2"),
        ("3", "C", "ASPIRIN", None, "TABLET", "TABLET", "lab", [], None), ("4", "D", None, "Other", "GEL", "GEL", "lab", None, ""), ("5", "B", "ASPIRIN", "Aspirin Low", "TABLET", "TABLET", "lab", ["11"], "s9"),
    ], "product_id string, product_ndc string, generic_name string, brand_name string, dosage_form string, short_dosage_form string, labeler_name string, rxnorm_ids array<string>, spl_id string")


@pytest.fixture(scope="module")
def packages(spark):
    return spark.createDataFrame([("A-1", "A", "d", 1, "", 1, "BOX"), ("B-1", "B", "d", 2, "", 1, "BOX"), ("Z-1", "Z", "d", 3, "", 1, "BOX")], "package_ndc string, product_ndc string, description string, size long, size_extra string, packages_number long, package_format string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([("s1", "x", "one"), ("l2", "s2", "by set"), ("l3", "s2", "later"), (None, "s1", "no id")], "id string, set_id string, title string")


def test_search(products, packages):
    got = rows(L.search(products, None, "aspirin%20LOW").select("product_ndc", "match_group"))
    assert got == [("A", "generic"), ("B", "brand"), ("B", "brand"), ("C", "generic")]
    assert rows(L.search(products, packages, "ASPIRIN").select("package_ndc", "match_group")) == [("A-1", "generic"), ("B-1", "brand"), ("B-1", "brand")]
    assert L.search(products, packages, "notarealdrugzz").count() == 0
    assert L.search(products, None, "as%25", literal=True).count() == 0 and L.search(products, None, "as%25").count() == 4
    with pytest.raises(ValueError):
        L.search(products, None, "x", groups=())


def test_paging(products):
    everything = [r.product_id for r in L.list_products(products).collect()]
    assert everything[0] == "1" and everything[-1] == "4"  # nulls last
    assert [r.product_id for r in L.list_products(products, size=2, page=1).collect()] == everything[2:4]
    assert rows(L.list_products(products, size=2, page=-3)) == rows(L.list_products(products, size=2, page=0)) == rows(L.list_products(products, size=2))
    assert L.list_products_by_letter(products, "a").count() == 4
    for call in (lambda: L.list_products_by_letter(products, "as"), lambda: L.list_products(products, size=-1)):
        with pytest.raises(ValueError):
            call()


def test_one_key_or_many(spark, products, packages):
    assert [r.product_id for r in L.product_of(products, "B").collect()] == ["2"]
    keys = spark.createDataFrame([("B",), ("B",), ("C",), ("none",)], "product_ndc string")
    assert rows(L.product_of(products, keys).select("product_id")) == [("2",), ("3",)]
    assert rows(L.packages_of(packages, "A").select("package_ndc")) == [("A-1",)] and L.packages_of(packages, "0000-0000").count() == 0


def test_labels_by_id_then_by_set(products, packages, labels):
    got = {r.product_id: r.label and r.label.title for r in L.with_label(products, labels).collect()}
    assert got == {"1": "one", "2": "by set", "3": None, "4": None, "5": None}
    nested = L.package_details(packages, products, labels, "B-1").collect()
    assert len(nested) == 1 and nested[0].product.product_id == "2" and nested[0].label.title == "by set"
    alone = L.package_details(packages, products, None, "Z-1").collect()
    assert alone[0].product is None


def test_rxnorm(spark, products, packages):
    assert rows(L.products_by_rxnorm(products, " 11 ").select("product_id")) == [("2",), ("5",)]
    assert rows(L.packages_by_rxnorm(products, packages, "10").select("package_ndc")) == [("A-1",), ("B-1",)]
    assert L.packages_by_rxnorm(products, packages, "999999999999").count() == 0
    keys = spark.createDataFrame([("10 ",), ("11",)], "rxnorm_id string")
    assert rows(L.products_by_rxnorm(products, keys).select("product_id", "rxnorm_id")) == [("1", "10"), ("2", "10"), ("2", "11"), ("5", "11")]


def test_evidence_limits(spark):
    ev = spark.createDataFrame([(f"{k:04d}", ["1"], ["p"], f"s{k % 2}") for k in range(700)], "evidence_id string, rxnorm_ids array<string>, product_ndc array<string>, set_id string")
    assert [r.evidence_id for r in L.evidence_by_rxnorm(ev, " 1", 2).collect()] == ["0000", "0001"]
    assert L.evidence_by_product(ev, "p", 9999).count() == 500 and L.evidence_by_product(ev, "p").count() == 100 and L.evidence_by_label(ev, "s1 ").count() == 350
    with pytest.raises(ValueError):
        L.evidence_by_rxnorm(ev, "1", -1)


def test_counts(products, packages):
    assert rows(L.counts(products, packages)) == [(5, 3)]
