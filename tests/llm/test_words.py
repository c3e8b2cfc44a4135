"""Near duplicates by MinHash, spelling variants, collocations."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F
from test_pairs import brute, near_copies

from medleaf.llm import near_dedup as N
from medleaf.llm import phrases as P
from medleaf.llm import registry
from medleaf.llm import spelling as S


# near duplicates


def components_of(df, width=5, percent=85):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in N.minhash_components(df, width, percent).collect()}


@pytest.mark.parametrize(("block", "flush", "width", "percent"), [(N.BLOCK, N.FLUSH, 5, 85), (6_000, 4_000, 5, 85), (N.BLOCK, 3_000, 4, 80)])
def test_components_as_by_all_pairs(spark, monkeypatch, block, flush, width, percent):
    monkeypatch.setattr(N, "BLOCK", block)  # small: clusters are searched in parts, and across them
    monkeypatch.setattr(N, "FLUSH", flush)
    texts = near_copies() | {1: None, 4: "", 7: " \n ", 10: "one", 13: "one", 16: "ONE two", 19: "x " * 30_000, 22: "x x x x x"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("cluster", F.lit(1)).withColumn("n", F.lit(2))
    assert components_of(df, width, percent) == brute(texts, width, percent)


def test_components_of_given_documents(spark):
    df = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    assert components_of(df) == brute({r.doc_id: r.text for r in df.collect()}, 5, 85)


def test_a_chain_across_parts(spark, monkeypatch):
    """Each text is like the next one only, and parts hold few of them."""
    monkeypatch.setattr(N, "BLOCK", 2_000)
    words = [f"w{k}" for k in range(400)]
    texts = {k: " ".join(words[3 * k : 3 * k + 80]) for k in range(100)}
    got = components_of(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert got == brute(texts, 5, 85)
    assert {c for _, c in got.values()} == {0}


def test_rows_without_id_repeated_ids_and_kept(spark):
    long = " ".join(f"w{k}" for k in range(50))
    data = [(None, long), (None, None), (5, long), (5, long), (9, long + " more"), (5, "another text of some words here"), (7, None), (8, "one two"), (3, "ONE two")]
    got = rows(N.minhash_components(spark.createDataFrame(data, "doc_id long, text string")))
    assert got == sorted([(None, 46, None, True), (None, 0, None, True), (5, 46, 5, True), (5, 46, 5, True), (9, 47, 5, False), (5, 2, 5, True), (7, 0, 7, True), (8, 1, 3, False), (3, 1, 3, True)], key=repr)
    assert rows(N.minhash_components(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for j in (0.3, 0.6, 0.9):
        agree = []
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 300, np.uint64)
            both = int(200 * 2 * j / (1 + j))
            s = N.signatures([x[:200], np.r_[x[:both], x[200 : 400 - both]]], 180)
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - j) < 0.02
    assert (1 - 0.85**N.ROWS) ** N.bands(85) < 1e-6


@pytest.mark.parametrize("name", ["op2_jaccard_join", "op11_circulant_minhash"])
def test_links_as_by_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, f"{DATA}/sf0.001").select(*want.columns)
    assert rows(got) == sorted(want.fetchall(), key=repr)


# spelling variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def spelled(docs, least=5, share=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    by_cut: dict = {}
    for w in words:
        for k in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))}:
            by_cut.setdefault(k, set()).add(w)
    out, forms = {}, {}
    for w, n in words.items():
        others = [v for k in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))} for v in by_cut[k] if v != w and near(v, w)]
        others = sorted(set(others), key=lambda v: (-words[v], v))
        forms[w] = others[0] if others and words[others[0]] >= share * n else None
        out[w] = [n, len(others), forms[w], words.get(forms[w])]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def grouped(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in S.spelling_groups(df).collect()}


@pytest.mark.parametrize(("batch", "most"), [(S.BATCH, S.MOST), (20, S.MOST), (50, 7)])
def test_spelling_as_by_all_words(spark, monkeypatch, batch, most):
    monkeypatch.setattr(S, "BATCH", batch)
    monkeypatch.setattr(S, "MOST", most)  # places are cut into parts
    rng = random.Random(5)
    bases = ["".join(rng.choice("abcé×ÀZ") for _ in range(rng.randint(6, 12))) for _ in range(40)] + ["x" * 300, "aaaaaaa", "aaaaaaaa", "a" * 6]
    docs = [(None, "nullid nullid"), (1, None), (2, ""), (3, "-- 12 \n")]
    for k in range(400):
        words = []
        for _ in range(40):
            w = rng.choice(bases[: 1 + int(rng.random() ** 3 * len(bases))])
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "b" + w[at:], w[:at] + "c" + w[at + 1 :]])
            words.append(w)
        docs.append((k + 10, rng.choice([" ", "; ", "1"]).join(words)))
    docs += [(9000, "qwertya " * 5), (9001, "qwertyab " * 25), (9002, "qwertyabc " * 125)]  # a chain
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(1))
    got, want = grouped(df), spelled(docs)
    assert got == want
    assert sum(v[2] is not None for v in want.values()) > 5 and any(v[4] not in (w, v[2]) for w, v in want.items())


def test_spelling_of_given_documents(spark):
    df = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    assert grouped(df) == spelled([(r.doc_id, r.text) for r in df.collect()])


def test_spelling_of_nothing(spark):
    assert rows(S.spelling_groups(spark.createDataFrame([], "doc_id long, text string"))) == []
    with pytest.raises(ValueError):
        S.spelling_groups(spark.createDataFrame([], "doc_id long, text string"), share=1)


def test_schemes_find_every_error_once():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(6, 11))).encode() for _ in range(300)})
    q, v = S.near_words(words, [(side, w) for side in (0, 1) for w in words])
    got = sorted((words[a % len(words)], words[b]) for a, b in zip(q, v, strict=True))
    assert got == sorted((a, b) for a in words for b in words if a != b and near(a, b))


def test_index_holds_every_part_of_words():
    words = sorted([b"banana", b"bandana", b"ananas", b"nab"])
    index = S.Index(words)
    text = b"\0" + b"\0".join(words) + b"\0"
    for part in (b"an", b"ana", b"nab", b"\0b", b"a\0", b"x", b"bandana"):
        for right in (False, True):
            at = index.start(1)
            for c in part if right else part[::-1]:
                at = index.grown(at, index.code[[c]], right)
            assert at[0, 2] == len(re.findall(b"(?=" + part + b")", text)), (part, right)


# collocations


def best_phrases(docs, least=10, most=2000):
    n, f = Counter(), {}
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang in f:
        found = []
        for p, a in f[lang].items():
            if len(p) == 1 or a < least:
                continue
            score, _, left, right = min((10**6 * a * a // (f[lang][p[:k]] * f[lang][p[k:]]), k, f[lang][p[:k]], f[lang][p[k:]]) for k in range(1, len(p)))
            found.append((p, a, left, right, score))
        counts = {x[0]: x[1] for x in found}
        inner = Counter()
        for p in counts:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    inner[q] = max(inner[q], counts[p])
        found = [x for x in found if not 100 * inner[x[0]] >= 50 * x[1]]
        found.sort(key=lambda x: (-x[4], -x[1], " ".join(x[0]).encode()))
        out += [(lang, k + 1, " ".join(x[0]), x[1], x[2], x[3], n[lang], x[4]) for k, x in enumerate(found[:most])]
    return sorted(out, key=repr)


def some_texts():
    rng = random.Random(11)
    words = ["the", "of", "New", "york", "city", "é", "x" * 90, "a", "\x01", "bc", "bcd", "ab"]
    out = [(None, None), ("en", ""), ("en", " .\n\t "), ("", "empty lang " * 12), ("a\nb", "odd lang " * 12), (None, "no lang. " * 12)]
    for k in range(300):
        text = "".join(rng.choice(words[: 3 + k % 10]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " \r\n"]) for _ in range(60))
        out.append((rng.choice(["en", "en", "fr", None]), text + "new york city " * (k % 2)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_collocations_as_by_all_phrases(spark, monkeypatch, small):
    docs = some_texts() + [("en", "over and over again " * 3000)]
    if small:
        for name, value in {"BLOCK": 500, "TEXTS": 900, "HELD": 40, "KEYS": 400, "SAFE_BITS": 14}.items():
            monkeypatch.setattr(P, name, value)
        monkeypatch.setattr(P, "HUB", 3)
        monkeypatch.setattr(P, "GROUP", 2000)
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("key", F.lit(1))
    got = sorted(map(tuple, P.collocations(df, most=40).collect()), key=repr)
    want = best_phrases(docs, most=40)
    if small:  # a text of one piece is not cut, one of several is
        df = spark.createDataFrame([*docs, ("en", "a b, c\n" * 200)], "lang string, text string")
        assert sorted(map(tuple, P.collocations(df, most=40).collect()), key=repr) == best_phrases([*docs, ("en", "a b, c\n" * 200)], most=40)
    assert got == want
    assert {r[0] for r in want} >= {"en", "fr", "und", "", "a\nb"}


def test_collocations_of_given_documents(spark):
    df = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    want = best_phrases([(r.lang, r.text) for r in df.collect()])
    assert sorted(map(tuple, P.op13_trie_collocations(spark, f"{DATA}/sf0.001").collect()), key=repr) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    assert sorted(con.sql(P.OP13_SQL).fetchall(), key=repr) == want


def test_collocations_of_nothing(spark):
    assert rows(P.collocations(spark.createDataFrame([], "lang string, text string"))) == []


def test_trie_holds_its_keys_only():
    rng = random.Random(1)
    keys = sorted({("en\n" + " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 3))) + " ").encode() for _ in range(3000)})
    trie = P.Trie(keys)
    assert [trie.keys[trie.key_of[list(trie.ends).index(trie.root(k))]] for k in keys[:200]] == keys[:200]
    assert trie.root(b"fr\n") is None and trie.root(keys[0][:-1] + b"\0") is None
    cells = np.flatnonzero(trie.check >= 0)
    assert len(cells) == len({k[:n] for k in keys for n in range(1, len(k) + 1)})
