"""Mixing, sharding and packing."""

from __future__ import annotations

import bisect
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medleaf.llm import mixing, packing, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, shard int, rows int"


def messy(spark, n=150):
    """Null ids, sources and texts, empty and very long texts, ties and repeated rows, clashing columns."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(n):
        text = [None, "", "  \t", "Word word, 12 don't\x0bstop", "long " * 30_000][k % 5] if k % 6 else " ".join(["w%d" % x for x in rng.integers(0, 50, rng.integers(1, 400))])
        rows.append((None if k % 17 == 0 else k, text, "en", None if k % 7 == 0 else f"s{k % 5}" if k % 3 else "hot", 1, 9, 9, 9))
    return spark.createDataFrame(rows + rows[:40] + rows[:10], DOCS)


def targets(sizes: dict, weights=(1, 2, 3), cap=3):
    """Water level by repeated sharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    left, out, free = sum(sizes.values()), {}, set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 100, None: 7}, {"a": 0, "b": 5}, {None: 3}, {"a": 0}, {f"s{k}": k * k for k in range(40)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, rows long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_mixing_of_messy_rows(spark):
    docs = messy(spark).withColumn("words", mixing.words_of("text"))
    units = docs.select("doc_id", "source", F.col("words").alias("size"))
    one, two = ([tuple(r) for r in mixing.mix_copies(u).sort("doc_id", "source", "size", "copies").collect()] for u in (units, units.repartition(7)))
    assert one == two
    taken, source = {}, {}
    for _, s, size, total, target, copies in one:
        assert 0 <= copies <= 3
        taken[s] = taken.get(s, 0) + size * copies
        source[s] = (total, target)
    largest = max(size for _, _, size, *_ in one)
    assert {s: t for s, (_, t) in source.items()} == pytest.approx(targets({s: n for s, (n, _) in source.items()}))
    assert all(abs(taken[s] - source[s][1]) <= largest / 2 + 1e-6 for s in source)
    assert len(one) == docs.count()


def test_rows_alike_are_rounded_one_by_one(spark):
    """A unit of many rows takes its fraction to half a row, in counts and in rows."""
    df = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("w " * 10).alias("text"))
    df = df.union(spark.range(300).select(F.col("id"), F.lit("b"), F.lit("x " * 7)))
    sized = df.select("doc_id", "source", mixing.words_of("text").alias("size"))
    for rows in (mixing.mix_copies(sized), mixing.mix_rows(df).select("doc_id", "source", mixing.words_of("text").alias("size"), F.lit(1).alias("copies"))):
        taken = {r.source: r.taken for r in rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()}
        want = targets({"a": 10_000, "b": 2_100})
        assert abs(taken["a"] - want["a"]) <= 5 and abs(taken["b"] - want["b"]) <= 3.5


@pytest.mark.parametrize("sources", [1, 2, 7])
def test_sources_ranked_by_ranges(spark, monkeypatch, sources):
    monkeypatch.setattr(mixing, "SOURCES_IN_RANGE", sources)
    sizes = {f"s{k:02d}": k * k + 1 for k in range(30)} | {None: 50, "": 3, "Z": 9, "é": 8}
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, rows long")
    assert {r.source: r.target for r in mixing.source_targets(df).collect()} == pytest.approx(targets(sizes))


def test_mixing_over_a_tree(spark):
    """One source with many equal documents: several levels, and the words taken are the target to half a document."""
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 8000, "big").otherwise("small").alias("source"), F.lit(10).alias("size"))
    got = mixing.mix_copies(df).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.countDistinct("copies").alias("kinds")).collect()
    assert all(abs(r.taken - r.target) <= 5 for r in got) and any(r.kinds > 1 for r in got)


def test_mixed_rows_keep_their_columns(spark):
    docs = messy(spark)
    out = mixing.mix_rows(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    want = {}
    marked = docs.select("doc_id", "source", mixing.words_of("text").alias("size"), F.xxhash64("text").alias("mark"))
    for r in mixing.mix_counts(marked).collect():
        want[r.doc_id, r.source, r.size] = want.get((r.doc_id, r.source, r.size), 0) + r.rows * r.base + r.extra
    got = {}
    for r in out.select("doc_id", "source", mixing.words_of("text").alias("w")).collect():
        got[r.doc_id, r.source, r.w] = got.get((r.doc_id, r.source, r.w), 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_mixing_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix_counts(empty.select("doc_id", "source", "size")).count() == 0 and mixing.mix_rows(empty).count() == 0


def test_columns_of_any_name(spark):
    """Names that the operators use themselves, as columns of the input."""
    df = spark.createDataFrame([(k, f"w {k} x", "en", "s", 1, k, k, k, k, k) for k in range(40)], "doc_id long, text string, lang string, source string, n_chars int, copies int, arc int, rows int, size int, base int")
    out = mixing.mix_rows(df)
    assert out.columns == df.columns and all(r.copies == r.doc_id == r.arc == r.rows for r in out.collect()) and out.count() == 40
    sharded = sharding.assign_shards(df, F.col("doc_id"), 4, 8)
    assert sharded.columns == [*df.columns, "shard", "slot"] and {r.arc - r.doc_id for r in sharded.collect()} == {0}


@pytest.mark.parametrize("load_factor", [1.0, 1.3])
def test_overflow_passes_full_shards_only(spark, load_factor):
    """Walked row by row: from a key's own point clockwise, every shard that was passed over is full."""
    shards, vnodes, n = 6, 5, 700
    df = spark.range(n).select((F.col("id") % 180).alias("doc_id"), F.col("id").alias("row"))
    mask = (1 << sharding.RING_BITS) - 1
    placed = sharding.assign_shards(df.withColumn("pos", F.xxhash64("doc_id", F.lit(7)).bitwiseAND(F.lit(mask))), F.col("doc_id"), shards, vnodes, load_factor, ("row",)).collect()
    bits = math.ceil(math.log2(shards * vnodes)) + 2
    points = sharding.ring_points(shards, vnodes, bits)
    held = [sum(r.shard == k for r in placed) for k in range(shards)]
    whole = math.ceil(n * load_factor)
    capacity = [whole // shards + (k < whole % shards) for k in range(shards)]
    moved = 0
    for r in placed:
        at = bisect.bisect_left([c for c, _ in points], r.pos >> (sharding.RING_BITS - bits))
        while (owner := points[at % len(points)][1]) != r.shard:
            assert held[owner] == capacity[owner]
            at, moved = at + 1, moved + 1
    assert moved and all(h <= c for h, c in zip(held, capacity, strict=True))


def check_shards(rows, shards, capacity):
    by = {}
    for shard, slot in rows:
        by.setdefault(shard, []).append(slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by.get(k, [])) for k in range(shards)]
    assert max(counts) <= capacity and set(by) <= set(range(shards))
    return counts


@pytest.mark.parametrize(("n", "shards", "vnodes"), [(0, 3, 4), (1, 40, 64), (500, 7, 1), (1000, 40, 64)])
def test_shards_by_rows(spark, n, shards, vnodes):
    df = spark.range(n).select(F.col("id").alias("doc_id"))
    counts = check_shards([tuple(r)[-2:] for r in sharding.assign_shards(df, F.col("doc_id"), shards, vnodes).collect()], shards, -(-n // shards))
    assert sum(counts) == n and max(counts) - min(counts) <= 1


def test_shards_of_messy_rows(spark):
    docs = messy(spark)
    out = sharding.assign_shards(docs, F.col("doc_id"), 6, order=("text",))
    assert sorted(out.columns) == sorted([*docs.columns, "slot"]) and out.count() == docs.count()
    counts = check_shards([(r.shard, r.slot) for r in out.select("shard", "slot").collect()], 6, 40)
    assert max(counts) - min(counts) <= 1
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, F.col("doc_id"), 0)


def test_few_keys_move(spark):
    """With room to spare, one more shard moves about its own share of the keys and no bound is broken."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"))
    where = lambda k: {r.doc_id: r.shard for r in sharding.assign_shards(df, F.col("doc_id"), k, 128, 1.25).collect()}
    ten, eleven = where(10), where(11)
    assert max(list(ten.values()).count(k) for k in range(10)) <= 500
    assert sum(ten[k] != eleven[k] for k in ten) < 0.3 * len(ten)


def test_settle_against_one_by_one():
    """Segments place every rank once, within capacities, and nothing passes a point whose shard has room."""
    rng = np.random.default_rng(2)
    for _ in range(30):
        shards = int(rng.integers(1, 6))
        owners = rng.integers(0, shards, int(rng.integers(1, 12))).tolist() + list(range(shards))
        arcs = rng.integers(0, 30, len(owners)).tolist()
        total = sum(arcs)
        capacity = [total // shards + (k < total % shards) for k in range(shards)]
        found = sharding.settle(arcs, owners, capacity)
        ranks = sorted((a, r) for a, lo, hi, *_ in found for r in range(lo, hi))
        assert ranks == [(a, r) for a, n in enumerate(arcs) for r in range(n)]
        slots = sorted((s, first + r) for _, lo, hi, s, first in found for r in range(hi - lo))
        assert slots == [(s, k) for s in range(shards) for k in range(capacity[s])]


PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_the_tokenizers(spark):
    plain = Tokenizer.from_file(PATH)
    enc = packing.WordEncoder(PATH, keep=50)
    rng = np.random.default_rng(4)
    letters = list("aB.,'s;:!?é İßſΣς́\xa0\x0b\x1c\x85 中1２<|>dt")
    for _ in range(1500):
        text = "".join(rng.choice(letters, rng.integers(0, 14))) + str(rng.choice(["", "", "<|endoftext|>", "<|EndOfText|>", "a<|endoftext|>b C"]))
        assert enc.ids(text.encode()) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_of_messy_rows(spark, rule):
    docs = messy(spark)
    out = packing.pack(docs, PATH, capacity=256, max_docs=9, max_cost=256 * 256, rule=rule).toPandas()
    plain = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r.doc_id, k // 256, k, len(ids[k : k + 256]), zlib.crc32(ids[k : k + 256].tobytes())) for k in range(0, len(ids), 256)]
    got = [(None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 256 and len(s) <= 9 and (s.length**2).sum() <= 256 * 256
        assert (s.offset == s.length.cumsum() - s.length).all()
    assert out.sequence_id.nunique() < 1.1 * max(out.length.sum() / 256, len(out) / 9) + 2


def test_few_sequences(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    out = packing.pack(docs, PATH).agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert out[1] <= 1.01 * out[0] / 2048 + 2


def plain_best_fit(lengths, capacity, max_docs, max_cost, rule):
    """One piece and one bin at a time."""
    size, weights, bins, of = (capacity, max_docs, max_cost), (1.0, 0.05, 0.05), [], {}
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need, best = (lengths[i], 1, lengths[i] ** 2), None
        for b, left in enumerate(bins):
            rest = [x - y for x, y in zip(left, need, strict=True)]
            if min(rest) < 0:
                continue
            if rule == "norm":
                score = sum(w * (r / c) ** 2 for w, r, c in zip(weights, rest, size, strict=True))
            else:
                score = -sum(w * (x / c) * (y / c) for w, x, y, c in zip(weights, left, need, size, strict=True))
            if best is None or score < best[0] - 1e-12:
                best = (score, b)
        if best is None:
            bins.append(list(size))
            best = (0, len(bins) - 1)
        of[i] = best[1]
        bins[best[1]] = [x - y for x, y in zip(bins[best[1]], need, strict=True)]
    return of, bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_against_one_by_one(rule):
    """As many bins, as full, as by looking at every bin; equal scores may go to either."""
    rng = np.random.default_rng(6)
    for _ in range(40):
        lengths = rng.integers(1, 100, rng.integers(1, 60))
        limits = (100, int(rng.integers(2, 9)), int(rng.integers(2000, 10_000)))
        bins, offsets = packing.best_fit(lengths, *limits, rule=rule)
        of, _ = plain_best_fit(lengths.tolist(), *limits, rule)
        assert sorted(np.bincount(bins, lengths)) == sorted(np.bincount([of[i] for i in range(len(lengths))], lengths))
        for b in set(bins):
            mine = np.flatnonzero(bins == b)
            assert lengths[mine].sum() <= 100 and len(mine) <= limits[1] and ((lengths[mine] ** 2).sum() <= limits[2] or len(mine) == 1)


def probes():
    rng = np.random.default_rng(8)
    yield np.r_[rng.integers(1, 20, 600), rng.integers(300, 2048, 200), rng.integers(2010, 2040, 20)]
    yield rng.integers(10, 31, 8192)
    yield np.ones(8192, np.int64)
    yield np.r_[rng.integers(2007, 2048, 500), rng.integers(1, 41, 500)]
    yield np.r_[rng.integers(2040, 2048, 2000), np.ones(4096, np.int64)]


@pytest.mark.parametrize("lengths", probes())
def test_the_defaults_add_no_sequences(lengths):
    """As many as by tokens alone, give or take 2 %; and what is left of the others still moves pieces."""
    most, cost = packing.largest_crowd(lengths, 2048), 2048**2
    both, _ = packing.best_fit(lengths, 2048, most, cost)
    tokens, _ = packing.best_fit(lengths, 2048, 10**9, 10**18, weights=(1.0, 0.0, 0.0))
    assert len(set(both)) <= 1.02 * len(set(tokens))


def test_every_weight_decides():
    lengths = next(probes())
    most, cost = packing.largest_crowd(lengths, 2048), 2048**2
    groups = lambda b: {tuple(np.flatnonzero(b == k)) for k in set(b)}
    base = groups(packing.best_fit(lengths, 2048, most, cost)[0])
    for weights in ((0.0, 0.05, 0.05), (1.0, 0.0, 0.05), (1.0, 0.05, 0.0)):
        assert groups(packing.best_fit(lengths, 2048, most, cost, weights=weights)[0]) != base, weights


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = packing.best_fit(np.array([90, 80, 20, 10]), 100, 10, 10_000)
    assert bins[2] == bins[1] and bins[3] == bins[0] and offsets[2] == 80 and offsets[3] == 90
    bins, _ = packing.best_fit(np.array([5, 5, 5]), 100, 1, 10_000)
    assert len(set(bins)) == 3
    bins, _ = packing.best_fit(np.array([6, 6, 6]), 100, 10, 72)
    assert len(set(bins)) == 2
