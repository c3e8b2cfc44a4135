"""Jaccard join, connected components, fingerprints."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from medleaf.llm import ctph
from medleaf.llm import jaccard_join as J
from medleaf.llm.tables import components


def brute(texts: dict, width=4, percent=85) -> dict:
    """Component of every id, by looking at all pairs that share an n-gram."""
    sets, parent = {}, {i: i for i in texts}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists: dict = {}
    for i in sorted(sets):
        seen = Counter(j for g in sets[i] for j in lists.get(g, ()))
        for j, both in seen.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for g in sets[i]:
            lists.setdefault(g, []).append(i)
    return {i: (len(sets[i]), root(i)) for i in texts}


def near_copies(n=300, seed=7):
    """Groups of near copies with every number of edits, copies, passages that many share, and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(40)]
    bases = [[word() for _ in range(rng.randint(3, 90))] for _ in range(12)]
    out = {}
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.2:
            w = w[: rng.randint(0, 6)]
        if rng.random() < 0.3:
            w += passage
        out[i * 3] = " ".join(w).upper() if i % 4 == 0 else "\t".join(w)
    return out


@pytest.mark.parametrize(("block", "flush", "width", "percent"), [(J.BLOCK, J.FLUSH, 4, 85), (600, 700, 4, 85), (J.BLOCK, 300, 5, 80)])
def test_components_as_by_all_pairs(spark, monkeypatch, block, flush, width, percent):
    monkeypatch.setattr(J, "BLOCK", block)  # small blocks: clusters are searched as pairs of blocks
    monkeypatch.setattr(J, "FLUSH", flush)  # tasks send their documents in several parts
    monkeypatch.setattr(J, "BROADCAST_ROWS", J.BROADCAST_ROWS if width == 4 else 0)
    texts = near_copies() | {1: None, 4: "", 7: " \n ", 10: "one", 13: "one", 16: "ONE two", 19: "x " * 30_000, 22: "x x x x"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("label", F.lit(1)).withColumn("n", F.lit(2))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(df, width, percent).collect()}
    assert got == brute(texts, width, percent)


@pytest.mark.parametrize("block", [J.BLOCK, 600])
def test_every_link_counts_once(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    texts = near_copies()
    sets = {i: frozenset(zip(*(w[k:] for k in range(4)), strict=False)) or frozenset([tuple(w)] * bool(w)) for i, t in texts.items() for w in [t.lower().split()]}
    links = {(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    want = Counter(i for pair in links for i in pair)
    df = spark.createDataFrame([*texts.items(), (None, texts[0]), (0, texts[0])], "doc_id long, text string")
    got = J.jaccard_components(df, 4, 85).collect()
    assert len(got) == len(texts) + 2 and {r.doc_id: r.n_links for r in got} == {None: 0} | {i: want[i] for i in texts}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    pairs = [tuple(sorted((r.a, r.b))) for r in J.similar_pairs(df, 4, 85).collect()]
    assert sorted(pairs) == sorted({(i, j) for i, j in links if first[sets[i]] == i and first[sets[j]] == j and sets[i] != sets[j]})


def test_rows_without_or_with_the_same_id(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (3, "a b c d e"), (9, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(df, 4, 85).collect()), key=repr)
    assert got == sorted([(None, 2, None), (None, 2, None), (5, 2, 3), (5, 2, 3), (3, 2, 3), (9, 1, 9)], key=repr)
    assert J.jaccard_components(df.limit(0), 4, 85).count() == 0


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_planted_copies_of_the_given_documents(spark, width, percent):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs, width, percent).collect()} == brute(texts, width, percent)


def test_divide_skip_against_counting():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lists = sorted((np.unique(rng.integers(0, 40, rng.integers(1, 30))) for _ in range(rng.integers(1, 12))), key=len)
        threshold = int(rng.integers(1, len(lists) + 2))
        counts = Counter(np.concatenate(lists).tolist())
        ids, seen = J.divide_skip(lists, threshold)
        assert dict(zip(ids.tolist(), seen.tolist(), strict=True)) == {k: v for k, v in counts.items() if v >= threshold}


def test_needed_overlap_is_exact():
    """No pair that links has less overlap than T of the larger set."""
    for a in range(1, 60):
        for b in range(1, a + 1):
            for both in range(b + 1):
                if 100 * both >= 85 * (a + b - both):
                    assert both >= J.needed(a, 85)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1080)] + [(5000, k) for k in range(5001, 5100)] + [(7, 7)]
    parent: dict = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text: bytes) -> str:
    """The same fingerprint, one byte at a time."""
    window, ends, mask = [0] * 7, [], 0xFFFFFFFF
    sums, total = [], 0
    for c in text:
        window = [*window[1:], c]
        h = (sum(x * (k + 2) for k, x in enumerate(window)) + 0) & mask
        x = 0
        for k, v in enumerate(reversed(window)):
            x ^= (v << (5 * k)) & mask
        h = (h + x) & mask
        m = (h * 2654435761) & mask
        total = (total + (m ^ (m >> 15))) & mask
        sums.append(total)
        ends.append((h + 1) & mask)

    def step(t):
        return 32 if t == 0 else (t & -t).bit_length() - 1

    cuts = [(i, step(t)) for i, t in enumerate(ends) if t % 3 == 0]
    k = 0
    while 3 * 2**k * 64 < len(text):
        k += 1
    while k and sum(s >= k for _, s in cuts) + 1 < 32:
        k -= 1

    def signature(at):
        if not text:
            return ""
        marks = [sums[i] for i, s in cuts if s >= at and i < len(text) - 1][:63] + [total]
        out = ""
        for a, b in zip([0, *marks], marks, strict=False):
            p = (b - a) & mask
            p = ((p ^ (p >> 13)) * 0x85EBCA6B) & mask
            out += chr(ctph.ALPHABET[p >> 26])
        return out

    return f"{3 * 2**k}:{signature(k)}:{signature(k + 1)}"


def test_fingerprint_byte_by_byte(monkeypatch):
    rng = random.Random(1)
    for n in [0, 1, 2, 6, 7, 8, 63, 200, 1000, 5000]:
        text = bytes(rng.randrange(256) for _ in range(n))
        want = plain_fingerprint(text)
        assert ctph.fingerprint(text) == want
        monkeypatch.setattr(ctph, "SEGMENT", 97)
        assert ctph.fingerprint(text) == want
        monkeypatch.setattr(ctph, "SEGMENT", 1 << 20)


def test_likeness():
    rng = random.Random(2)

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 20))) for _ in range(2))
        assert ctph.common_length(a, b) == lcs(a, b)
    assert ctph.likeness("3::", "3::") == 1.0 and ctph.likeness("3:a:b", "12:a:b") == 0.0 and ctph.likeness("3:abcdefgh:abcdefgh", "6:abcdefgh:x") == 1.0


def test_edits_of_messy_rows(spark):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("abc é中\n") for _ in range(rng.choice([0, 1, 3, 40, 900])))) for k in range(60)]
    rows += [(100, None), (101, "x" * 300_000), (101, "y"), (None, "no id"), (102, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("guard", F.lit(1))
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0))
    for parts in (1, 9):
        got = ctph.fingerprint_edits(df.select("doc_id", "text", "guard"), parts).collect()
        assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((i, len(t)) for i, t in ordered)
        by = {(r.doc_id, r.n_chars): r for r in got}
        for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
            if i == 101 or i == 100:
                continue  # the order of the two rows with one id is that of their hashes
            r = by[i, len(t)]
            edited = (t[: len(t) - len(t) // 4] + following[: len(t) // 4]).encode()
            assert r.edited_sha256 == hashlib.sha256(edited).hexdigest()
            assert r.fingerprint == ctph.fingerprint(t.encode()) and r.edited_fingerprint == ctph.fingerprint(edited)
            assert r.near_edited == ctph.likeness(r.fingerprint, r.edited_fingerprint) and r.near_next == ctph.likeness(r.fingerprint, ctph.fingerprint(following.encode()))
    assert ctph.fingerprint_edits(df.select("doc_id", "text").limit(0), 4).count() == 0
    assert ctph.fingerprint_edits(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string"), 4).first().near_edited >= 0


def test_edited_texts_are_nearer_than_next_ones(spark):
    got = ctph.fingerprint_edits(spark.read.parquet(f"{DATA}/sf0.001/documents.parquet"), 8).agg(F.avg("near_edited"), F.avg("near_next"), F.avg((F.col("near_edited") > F.col("near_next")).cast("int"))).first()
    assert got[0] > 0.6 and got[1] < 0.1 and got[2] > 0.95
