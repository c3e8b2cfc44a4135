"""Evidence and names for tables of keys, stored listings."""

from __future__ import annotations

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medleaf.operators import evidence as E
from medleaf.operators import lookups as L
from medleaf.operators import names as N
from medleaf.operators import pages, publish


@pytest.mark.parametrize("salts", [1, 5, 64])
def test_first_rows_per_key(spark, salts):
    rng = random.Random(4)
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), f"{k:05d}") for k in range(3000)]  # one key has half of the rows
    got = rows(L.first_rows_per_key(spark.createDataFrame(data, "key string, evidence_id string"), "key", "evidence_id", 7, salts))
    want = [(key, i) for key in ("hot", "a", "b", None) for i in sorted(i for k, i in data if k == key)[:7]]
    assert got == sorted(want, key=repr)


def test_first_rows_are_cut_before_they_are_dealt(spark, capsys):
    df = L.first_rows_per_key(spark.range(10).select(F.col("id").alias("key"), F.col("id").alias("evidence_id")), "key", "evidence_id", 3)
    df.explain("formatted")
    assert capsys.readouterr().out.count("WindowGroupLimit") >= 4  # each step before and behind its shuffle


def test_keys_are_looked_up_among_what_is_cut(spark):
    bridge = spark.range(40_000).select(F.when(F.col("id") >= 0, "hot").alias("rxnorm_id"), F.format_string("%06d", "id").alias("evidence_id"))
    evidence, keys = bridge.select("evidence_id"), spark.createDataFrame([("hot",), ("cold",)] * 5, "rxnorm_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = L.evidence_by_rxnorm(evidence, keys, limit=5, bridge=bridge)
        assert [r.evidence_id for r in found.orderBy("evidence_id").collect()] == [f"{k:06d}" for k in range(5)]
        found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    below = plan[re.search(r"Exchange hashpartitioning\(rxnorm_id#\d+, \d+\)", plan).start():]
    assert "WindowGroupLimit" in below[:below.index("Range (")]  # what goes to a key's task has been cut


@pytest.fixture(scope="module")
def evidence(spark):
    data = [(f"e{k:04d}", ["all", f"rx{k % 7}", "all"] if k % 11 else None, [f"p{k % 3}"], f"l{k}") for k in range(900)]
    return spark.createDataFrame(data, "evidence_id string, rxnorm_ids array<string>, product_ndc array<string>, label_id string"), data


def test_evidence_of_many_keys(spark, evidence):
    df, data = evidence
    keys = spark.createDataFrame([(" all ",), ("rx3",), ("rx3",), ("none",), (None,)], "rxnorm_id string")
    got = rows(L.evidence_by_rxnorm(df, keys, limit=20).select("rxnorm_id", "evidence_id", "label_id"))
    want = [(key, i, label) for key in ("all", "rx3") for i, ids, _, label in sorted(data, key=lambda x: x[0]) if ids and key in ids]
    assert got == sorted([x for key in ("all", "rx3") for x in [w for w in want if w[0] == key][:20]], key=repr)
    assert L.evidence_by_rxnorm(df, keys, limit=9999).filter("rxnorm_id = 'all'").count() == 500
    codes = spark.createDataFrame([("p0",), ("p1",)], "product_code string")
    assert L.evidence_by_product(df, codes, limit=0).count() == 0
    assert rows(L.evidence_by_product(df, codes, limit=2).select("product_code", "evidence_id")) == [("p0", "e0000"), ("p0", "e0003"), ("p1", "e0001"), ("p1", "e0004")]
    with pytest.raises(ValueError):
        L.evidence_by_product(df, codes, limit=-1)
    assert [r.evidence_id for r in L.evidence_by_rxnorm(df, " rx3 ", limit=2).collect()] == ["e0003", "e0010"]


def test_stored_evidence(spark, evidence):
    spark.sql("CREATE DATABASE IF NOT EXISTS stored_evidence")
    df, data = evidence
    with pytest.raises(publish.GateError):
        publish.store_evidence(spark, df, "r0", "stored_evidence.", least=901)
    for run in ("r1", "r2"):
        publish.store_evidence(spark, df, run, "stored_evidence.", least=900)
    keys = spark.createDataFrame([("rx5",)], "rxnorm_id string")
    stored, bridge = spark.table("stored_evidence.drug_condition_evidence"), spark.table("stored_evidence.evidence_rxnorm")
    assert rows(L.evidence_by_rxnorm(stored, keys, 500, bridge).select("evidence_id")) == [(i,) for i, ids, *_ in data if ids and "rx5" in ids]
    assert bridge.count() == sum(len(set(ids)) for _, ids, *_ in data if ids)
    spark.sql("DROP DATABASE stored_evidence CASCADE")


# terms by automata


@pytest.mark.parametrize("size", [E.TERM_BYTES, 10])
def test_terms_as_by_patterns(spark, monkeypatch, size):
    monkeypatch.setattr(E, "TERM_BYTES", size)  # small: several automata
    rng = random.Random(3)
    pieces = ["pain", "back pain", "a+b", "c.d", "[x]y", "PAIN", "painful", " ", "  ", "\n", "é", "-", "1", "back"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None, "", "pain" * 500 + " pain"]
    terms = ["pain", "back pain", "a+b c", "[x]y", "abc", "pa", "é1é1", "pain back", "n-pa"]
    labels = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "id string, indications_and_usage string").withColumn("term", F.lit(1))
    words = spark.createDataFrame([("S", str(k), t, "preferred" if k % 2 else "synonym") for k, t in enumerate(terms)] + [("S", "0", "pain", "preferred"), ("S", "9", "pain", "other")], "condition_system string, condition_code string, term string, term_type string")
    got = rows(E.term_matches(labels, words).select("id", "condition_code", "term", "confidence"))
    want = []
    for k, t in enumerate(texts):
        low = re.sub(r"\s+", " ", (t or "").lower())
        for code, term in [*((str(c), t) for c, t in enumerate(terms)), ("9", "pain")]:
            if len(term) >= 4 and re.search(rf"(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])", low):
                want.append((str(k), code, term, 0.9 if code == "0" or (code != "9" and int(code) % 2) else 0.8))
    assert got == sorted(want, key=repr) and len(want) > 100
    assert rows(E.term_matches(labels, words.limit(0))) == []


# names


def like(name, pattern):
    if re.fullmatch(r"(?s:[^\\]|\\[\\%_])*", pattern) is None:
        return False
    parts = re.findall(r"(?s)\\.|.", pattern)
    return re.fullmatch("(?s)" + "".join(".*" if p == "%" else "." if p == "_" else re.escape(p[-1]) for p in parts).lower(), name.lower()) is not None


NAMES = ["", "a", "ab", "A%b", "aspirin", "Aspirin Low", "aspirin low dose", "as_in", "b\\c", "éclair", "no\nline", "rin", "x" * 200]
PATTERNS = ["", "%", "_", "__", "a", "A", "a%", "%a", "%in%", "as_irin%", "%LOW%", "as\\_in", "a\\%b", "b\\\\c", "bad\\", "bad\\x", "%zz%", "É%", "%n_l%", "_s%", "x%x", "%i%r%i%n%"]


def test_names_as_by_scan(spark):
    products = spark.createDataFrame([(a, b) for k, a in enumerate([*NAMES, None]) for b in (NAMES[(3 * k) % len(NAMES)], None)], "generic_name string, brand_name string")
    patterns = spark.createDataFrame([(p,) for p in [*PATTERNS, "a%", None]], "pattern string")
    got = rows(N.matching_names(patterns, N.name_grams(products)))
    assert got == sorted([(p, n) for p in PATTERNS for n in NAMES if like(n, p)], key=repr)
    generic = rows(N.matching_generic_names_of(products, patterns))
    pairs = {(r.generic_name, r.brand_name) for r in products.collect()}
    want = {(p, a) for p in PATTERNS for a, b in pairs if (a is not None and like(a, p)) or (b is not None and like(b, p))}
    assert generic == sorted(want, key=repr)


def test_search_of_many_names(spark):
    products = spark.createDataFrame([
        ("1", "A", "ASPIRIN", "ASPIRIN", "TABLET", "TABLET", "lab"), ("2", "B", "ASPIRIN", "Aspirin Low", "TABLET", "TABLET", "lab"), ("3", "C", "ASPIRIN", None, "TABLET", "TABLET", "lab"),
        ("4", "D", None, "Other", "GEL", "GEL", "lab"), ("5", "B", "ASPIRIN", "Aspirin Low", "TABLET", "TABLET", "lab"), ("6", "E", "100% wool", "x", "GEL", "GEL", "lab"),
    ], "product_id string, product_ndc string, generic_name string, brand_name string, dosage_form string, short_dosage_form string, labeler_name string")
    packages = spark.createDataFrame([("A-1", "A", "d", 1, "", 1, "BOX"), ("B-1", "B", "d", 2, "", 1, "BOX")], "package_ndc string, product_ndc string, description string, size long, size_extra string, packages_number long, package_format string")
    asked = ["aspirin%20LOW", "as%25", "notarealdrugzz", "100% WOOL", "other"]
    got = rows(N.search_names(products, None, spark.createDataFrame([(a,) for a in [*asked, "as%25", None]], "name string")).select("name", "product_ndc", "match_group"))
    want = [(a, r.product_ndc, r.match_group) for a in asked for r in L.search(products, None, a).collect()]
    assert got == sorted(want, key=repr) and len(want) == 9
    one = spark.createDataFrame([("ASPIRIN",)], "name string")
    assert rows(N.search_names(products, packages, one).select("package_ndc", "match_group")) == rows(L.search(products, packages, "ASPIRIN").select("package_ndc", "match_group"))
    assert rows(N.search_names(products, None, one, groups=("brand",)).select("product_ndc")) == [("B",), ("B",)]
    with pytest.raises(ValueError):
        N.search_names(products, None, one, groups=())


def test_names_of_codes_that_repeat(spark):
    rng = random.Random(6)
    kinds = "product_ndc string, generic_name string, brand_name string, dosage_form string, short_dosage_form string, labeler_name string"
    data = [(rng.choice(["A", "B", "C", "D", "E", None]), rng.choice([*NAMES, None]), rng.choice([*NAMES, None]), "f", "s", str(k)) for k in range(60)]
    asked = ["a%25", "%25r%25n%25", "_", "%25", "nothing"]
    got = N.search_names(spark.createDataFrame(data, kinds), None, spark.createDataFrame([(a,) for a in asked], "name string"))
    pairs, group = {r[:3] for r in data}, lambda a, b: "generic" if b is None or a.lower() == b.lower() else "brand"
    want = []
    for name in asked:
        p = name.replace("%25", "%")
        generic = {a for _, a, b in pairs if a is not None and (like(a, p) or (b is not None and like(b, p)))}
        codes = {(c, group(a, b)) for c, a, b in pairs if c is not None and a in generic}
        want += [(name, r[1], r[2], r[3], r[0], r[5], g) for r in data for c, g in codes if r[0] == c]
    assert rows(got) == sorted(want, key=repr) and len(want) > 200


def test_named_rows_are_not_grouped_again(spark):
    kinds = "product_ndc string, generic_name string, brand_name string, dosage_form string, short_dosage_form string, labeler_name string"
    products = spark.createDataFrame([(str(k), "one name", None, "f", "s", "l") for k in range(3000)], kinds)
    names = spark.createDataFrame([(p,) for k in range(8) for p in ("one name"[:k] + "%25", "%25" + "one name"[k:])], "name string").distinct()
    found = N.search_names(products, None, names)
    assert found.select("name", "product_ndc").distinct().count() == found.count() == 3000 * 16
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert not re.search(r"Aggregate\(keys=\[(pattern|name)#\d+, product_ndc#", plan)


def test_plan_of_names_joins_grams_only(spark, capsys):
    patterns = spark.createDataFrame([("a%",)], "pattern string")
    N.matching_names(patterns, spark.createDataFrame([("a", "ab")], "gram string, name string")).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# pages


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_pages_as_by_offset(spark, tmp_path, ranges):
    rng = random.Random(5)
    data = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, "x", "y"]), f"{k:04d}") for k in range(500)]
    df = spark.createDataFrame(data, "generic_name string, brand_name string, product_ndc string")
    order = ["generic_name", "brand_name", "product_ndc"]
    pages.store_listing(df, str(tmp_path / "l"), *order, ranges=ranges)
    for size, page in ((7, 0), (7, 30), (7, 71), (7, 72), (7, -1), (7, None), (200, 1), (0, 3), (1000, 0)):
        got = [tuple(r) for r in pages.stored_page(spark, str(tmp_path / "l"), order, size, page).collect()]
        assert got == [tuple(r) for r in L.list_products(df, size, page).select(*order).collect()], (size, page)
    with pytest.raises(ValueError):
        pages.stored_page(spark, str(tmp_path / "l"), order, -1)


def test_a_page_reads_its_ranges(spark, tmp_path, capsys):
    pages.store_listing(spark.range(1000).select("id"), str(tmp_path / "l"), "id", ranges=10)
    pages.stored_page(spark, str(tmp_path / "l"), ["id"], 20, 30).explain("formatted")
    assert re.search(r"PartitionFilters: .*__range", capsys.readouterr().out)
    pages.store_listing(spark.range(0).select("id"), str(tmp_path / "none"), "id")
    assert pages.stored_page(spark, str(tmp_path / "none"), ["id"], 20, 0).count() == 0
