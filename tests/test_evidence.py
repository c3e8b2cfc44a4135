from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medleaf.functions import text as X
from medleaf.operators import evidence as E
from medleaf.schemas import CATALOG, EVIDENCE, RELATIONSHIP, SYNONYM


@pytest.fixture(scope="module")
def inputs(spark):
    labels = spark.createDataFrame([
        ("label-1", "set-1", ["0001-0001"], ["0001-0001-01"], "This medication is indicated for  Menorrhagia in adults."), ("label-2", "set-2", ["9"], [], None), ("label-3", None, ["0001-0001", "0002"], None, "hemorrhagia only"),
    ], "id string, set_id string, product_ndc array<string>, package_ndc array<string>, indications_and_usage string")
    products = spark.createDataFrame([("a", "0001-0001", ["1"]), ("b", "0001-0001", ["12345"]), ("c", "0002", None)], "product_id string, product_ndc string, rxnorm_ids array<string>")
    links = spark.createDataFrame([
        ("RXNORM", "12345", "MESH", "D008595", "may_treat", None), ("RXNORM", "12345", "MESH", "D008595", "may_prevent", ""), ("RXNORM", "12345", "MESH", "X", "may_treat", "no such condition"),
        ("OTHER", "12345", "MESH", "D008595", "may_treat", None), ("RXNORM", "12345", "MESH", "D008595", "induces", None),
    ], RELATIONSHIP)
    catalog = spark.createDataFrame([("MESH", "D008595", "condition", " Menorrhagia ", "cat"), ("MESH", "Y", "drug", "x", None), ("MESH", "Z", "condition", "", None)], CATALOG)
    synonyms = spark.createDataFrame([("MESH", "D008595", "MENORRHAGIA", "synonym"), ("MESH", "D008595", "flow", "synonym"), ("MESH", "D008595", "  ", "synonym")], SYNONYM)
    return labels, products, E.relationships(links, catalog), E.terms(catalog, synonyms)


def test_inputs(inputs):
    _, _, links, terms = inputs
    assert rows(links.select("rxcui", "relationship", "source_attribution")) == [("12345", "may_prevent", ""), ("12345", "may_treat", "cat")]
    assert rows(terms.select("term", "term_type")) == [("flow", "synonym"), ("menorrhagia", "preferred"), ("menorrhagia", "synonym")]


def test_both_kinds(inputs):
    labels, products, links, terms = inputs
    found = E.evidence(labels, products, links, terms, F.lit("2024-01-01 00:00:00"))
    assert found.schema.names == EVIDENCE.names
    got = {(r.label_id, r.evidence_source): r for r in found.collect()}
    assert set(got) == {("label-1", E.FROM_RELATIONSHIP), ("label-1", E.FROM_TERM), ("label-3", E.FROM_RELATIONSHIP)}
    rel, term = got["label-1", E.FROM_RELATIONSHIP], got["label-1", E.FROM_TERM]
    assert rel.confidence == 0.85 and rel.source_attribution == E.ATTRIBUTION and rel.rxnorm_ids == ["12345"]
    assert rel.evidence_text == "RxNorm 12345 may_prevent MESH:D008595 via clinical terminology relationship."
    assert rel.evidence_id == hashlib.sha1(b"set-1|label-1|12345|MESH|D008595").hexdigest()
    assert term.confidence == 0.9 and term.evidence_text == "This medication is indicated for Menorrhagia in adults."
    assert term.evidence_id == hashlib.sha1(b"set-1|label-1|12345|MESH|D008595|menorrhagia").hexdigest()
    assert got["label-3", E.FROM_RELATIONSHIP].evidence_id == hashlib.sha1(b"|label-3|12345|MESH|D008595").hexdigest()
    assert rows(E.summary(labels, found)) == [(3, 3, 3)]  # matches, not labels


def test_last_product_of_a_code(inputs):
    assert rows(E.rxnorm_by_product(inputs[1])) == [("0001-0001", ["12345"]), ("0002", [])]


def test_text_rules_against_python(spark):
    rng = random.Random(3)
    pieces = ["pain", "back pain", "a+b", "c.d", "[x]y", r"\E", "PAIN", "painful", " ", "  ", "\n", " ", "é", "-", "1", "."]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(150)] + ["x" * 400 + " pain " + "y" * 700, ""]
    terms = ["pain", "back pain", "a+b c", "[x]y", r"x\Ey", "abc", "pa", "é1é1"]
    pairs = spark.createDataFrame([(t, w) for t in texts for w in terms], "t string, w string")
    got = pairs.select("t", "w", X.holds_term(X.search_text(F.col("t")), F.col("w")).alias("hit"), X.excerpt(F.col("t"), F.col("w")).alias("cut"), X.normal_term(F.col("t")).alias("normal")).collect()
    for r in got:
        low = re.sub(r"\s+", " ", r.t.lower())
        assert r.hit == (len(r.w) >= 4 and re.search(rf"(?<![a-z0-9]){re.escape(r.w)}(?![a-z0-9])", low) is not None), (r.t, r.w)
        clean = " ".join(r.t.split())
        at = clean.lower().find(r.w.lower())
        assert r.cut == (clean[:500] if at < 0 else clean[max(0, at - 180) : at + len(r.w) + 320])
        assert r.normal == re.sub(r"\s+", " ", r.t.strip().lower())


def test_redacted(spark):
    cases = {"https://a.example/x/y.zip?token=1": "a.example/y.zip", "http://a.example": "a.example", "http://a.example/": "a.example", "plain text " * 40: ("plain text " * 40)[:256], "x": "x"}
    got = spark.createDataFrame([(c,) for c in cases], "c string").select("c", X.redacted(F.col("c"))).collect()
    assert {r[0]: r[1] for r in got} == cases


def test_display_name(spark):
    cases = [("B", "g", "B"), ("G", "g", "g"), (None, "g", "g"), ("B", None, "B"), ("", "", ""), (None, None, "")]
    df = spark.createDataFrame([c[:2] for c in cases], "b string, g string")
    assert [r[0] for r in df.select(X.display_name(F.col("b"), F.col("g"))).collect()] == [c[2] for c in cases]
