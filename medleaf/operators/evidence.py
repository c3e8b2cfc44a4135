"""Evidence that a drug treats a condition, from labels, products and clinical terminology.

Nested lookups are joins: label codes are exploded and joined with the products' RxNorm ids and with relationships. Terms
are found by automata that read each text once; what they find is joined with the conditions that it names, and then with
the label's RxNorm ids. Texts stay out of the joins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medleaf.functions.text import SHORTEST_TERM, excerpt, joined_hash, normal_term, search_text
from medleaf.schemas import EVIDENCE

#: Fixed values.
RELATIONSHIPS = ("may_treat", "may_prevent")
ATTRIBUTION = (
    "This product uses publicly available data from the U.S. National Library of Medicine (NLM), "
    "National Institutes of Health, Department of Health and Human Services; NLM is not responsible "
    "for the product and does not endorse or recommend this or any other product."
)
TERM_BYTES = 8 << 20
BESIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
FROM_RELATIONSHIP, FROM_TERM = "clinical_rxnorm_relationship", "clinical_synonym_label_match"


def relationships(links: DataFrame, catalog: DataFrame, system: str = "RXNORM") -> DataFrame:
    """(rxcui, condition_system, condition_code, relationship, source_attribution) of links to conditions."""
    wanted = links.filter((F.col("from_system") == system) & F.col("relationship").isin(*RELATIONSHIPS))
    known = catalog.filter("code_type = 'condition'").select(F.col("code_system").alias("to_system"), F.col("code").alias("to_code"), F.col("source_attribution").alias("own"))
    return wanted.join(known, ["to_system", "to_code"]).select(
        F.col("from_code").alias("rxcui"), F.col("to_system").alias("condition_system"), F.col("to_code").alias("condition_code"), "relationship",
        F.coalesce("source_attribution", "own").alias("source_attribution"),
    )


def terms(catalog: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(condition_system, condition_code, term, term_type): preferred names and synonyms, normalised, without empty ones."""
    preferred = catalog.filter("code_type = 'condition'").select("code_system", "code", F.col("display_name").alias("term"), F.lit("preferred").alias("term_type"))
    both = preferred.unionByName(synonyms.select("code_system", "code", F.col("synonym").alias("term"), "term_type"))
    both = both.select(F.col("code_system").alias("condition_system"), F.col("code").alias("condition_code"), normal_term(F.col("term")).alias("term"), "term_type")
    return both.filter("term <> ''")


def rxnorm_by_product(products: DataFrame) -> DataFrame:
    """(product_ndc, rxnorm_ids): of products that share a code, the ids of the one with the largest product_id."""
    ids = F.coalesce("rxnorm_ids", F.array().cast("array<string>"))
    return products.groupBy("product_ndc").agg(F.max_by(ids, F.coalesce("product_id", F.lit(""))).alias("rxnorm_ids"))


def label_rxnorm(labels: DataFrame, by_product: DataFrame) -> DataFrame:
    """(id, rxcui): distinct RxNorm ids of every label."""
    codes = labels.select("id", F.explode("product_ndc").alias("product_ndc")).distinct()
    return codes.join(by_product, "product_ndc").select("id", F.explode("rxnorm_ids").alias("rxcui")).distinct()


def _one_per_condition(links: DataFrame) -> DataFrame:
    attributed = links.withColumn("source_attribution", F.coalesce(F.nullif("source_attribution", F.lit("")), F.lit(ATTRIBUTION)))
    first = F.min(F.struct("relationship", "source_attribution"))
    return attributed.groupBy("rxcui", "condition_system", "condition_code").agg(first.alias("r")).select("rxcui", "condition_system", "condition_code", "r.*")


def _rows(found: DataFrame, labels: DataFrame, ids: DataFrame, key: list[Column], imported_at: Column) -> DataFrame:
    heads = labels.select("id", "set_id", "product_ndc", "package_ndc").join(ids.groupBy("id").agg(F.sort_array(F.collect_set("rxcui")).alias("rxnorm_ids")), "id", "left")
    out = found.join(heads, "id").withColumns({"evidence_id": joined_hash(F.col("set_id"), F.col("id"), *key), "label_id": F.col("id"), "imported_at": imported_at.cast("timestamp_ntz")})
    return out.select(*EVIDENCE.names)


def relationship_evidence(labels: DataFrame, ids: DataFrame, links: DataFrame, imported_at: Column) -> DataFrame:
    """One row for every label, RxNorm id and condition that it is linked to."""
    found = ids.join(_one_per_condition(links), "rxcui").withColumns({
        "evidence_text": F.format_string("RxNorm %s %s %s:%s via clinical terminology relationship.", "rxcui", "relationship", "condition_system", "condition_code"),
        "evidence_source": F.lit(FROM_RELATIONSHIP), "confidence": F.lit(0.85),
    })
    return _rows(found, labels, ids, [F.col(c) for c in ("rxcui", "condition_system", "condition_code")], imported_at)


def _automata(terms: DataFrame) -> list[list[str]]:
    """Distinct terms (term) in lists of at most TERM_BYTES bytes each, or about that."""
    total = terms.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / TERM_BYTES))
    dealt = terms.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)))
    return [[r.term for r in dealt.filter(F.col("part") == k).select("term").toLocalIterator()] for k in range(parts)]


def terms_in(labels: DataFrame, terms: list[str]) -> DataFrame:
    """(id, indications_and_usage, found) of labels whose text holds one of the terms with no letter or digit beside it. An
    automaton of all terms reads each text once, however many terms there are.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for term in terms:
            automaton.add_word(term, term)
        automaton.make_automaton()
        for batch in batches:
            found = []
            for text in batch.column("searched").to_pylist():
                hits = {term for end, term in automaton.iter(text) if end + 1 == len(text) or text[end + 1] not in BESIDE if end < len(term) or text[end - len(term)] not in BESIDE}
                found.append(sorted(hits))
            rows = [batch.column("id"), batch.column("indications_and_usage"), pa.array(found, pa.list_(pa.string()))]
            out = pa.RecordBatch.from_arrays(rows, names=["id", "indications_and_usage", "found"])
            yield out.filter(pa.array([bool(f) for f in found], pa.bool_()))

    texts = labels.select("id", "indications_and_usage", search_text(F.col("indications_and_usage")).alias("searched"))
    kinds = {c: labels.schema[c].dataType.simpleString() for c in ("id", "indications_and_usage")}
    if not terms:
        return texts.select("id", "indications_and_usage", F.array().cast("array<string>").alias("found")).limit(0)
    return texts.mapInArrow(search, ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", found array<string>")


def term_matches(labels: DataFrame, words: DataFrame) -> DataFrame:
    """(id, condition_system, condition_code, term, confidence, evidence_text) of terms that stand in a label's text. A
    preferred term goes before an equal synonym.

    Terms go to all tasks, at most TERM_BYTES at once: more are looked for in several passes.
    """
    best = words.groupBy("condition_system", "condition_code", "term").agg(F.max(F.when(F.col("term_type") == "preferred", 0.9).otherwise(0.8)).alias("confidence"))
    best = best.filter(F.length("term") >= SHORTEST_TERM)
    passes = [terms_in(labels, terms) for terms in _automata(best.select("term").distinct())]
    hits = passes[0]
    for more in passes[1:]:
        hits = hits.unionByName(more)
    hits = hits.select("id", "indications_and_usage", F.explode("found").alias("term"))
    hits = hits.select("id", "term", excerpt(F.col("indications_and_usage"), F.col("term")).alias("evidence_text"))
    return hits.join(best, "term").select("id", "condition_system", "condition_code", "term", "confidence", "evidence_text")


def term_evidence(labels: DataFrame, ids: DataFrame, links: DataFrame, words: DataFrame, imported_at: Column) -> DataFrame:
    """One row for every label, RxNorm id, condition and term of it that stands in the label's text.

    Hits come first: what labels could be about by their links alone is never listed.
    """
    known = _one_per_condition(links).drop("relationship")
    found = term_matches(labels, words).join(ids, "id").join(known, ["rxcui", "condition_system", "condition_code"]).withColumn("evidence_source", F.lit(FROM_TERM))
    return _rows(found, labels, ids, [F.col(c) for c in ("rxcui", "condition_system", "condition_code", "term")], imported_at)


def evidence(labels: DataFrame, products: DataFrame, links: DataFrame, words: DataFrame, imported_at: Column) -> DataFrame:
    """All evidence of both kinds, one row for every evidence id.

    Ids are distinct by construction: labels have distinct ids, and both kinds give one row for every label, RxNorm id,
    condition and term. (Only codes with a bar in them could be joined to the same text.)
    """
    ids = label_rxnorm(labels, rxnorm_by_product(products))
    return relationship_evidence(labels, ids, links, imported_at).unionByName(term_evidence(labels, ids, links, words, imported_at))


def summary(labels: DataFrame, found: DataFrame) -> DataFrame:
    """(labels_scanned, evidence_rows, matched_labels), one row; matched_labels counts matches, so a label with several
    counts as often.
    """
    counts = found.agg(F.count("evidence_id").alias("evidence_rows"), F.count("*").alias("matched_labels"))
    return labels.agg(F.count("*").alias("labels_scanned")).join(counts)
