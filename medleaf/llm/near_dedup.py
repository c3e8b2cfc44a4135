"""Near-duplicate removal by circulant MinHash.

A document is its set of distinct word n-grams. Two permutations give the whole signature: the first moves every n-gram to
its place in a circle of 2^32 places, the second gives each place a rank, and coordinate k is the least rank that the
document's places have when the circle is turned by k. (Both permutations are bijective mixing functions, so that no table
of them is kept.) Two documents of similarity J agree in a coordinate with probability J.

ROWS coordinates make a band. There are as many bands as it takes that two documents which are just similar enough miss
each other in all of them with probability MISS at most. In Spark:

1. Tasks read texts in blocks. Documents with equal sets are one class; a block computes a signature once for each class.
   Of the classes that share a band within a block, the head alone is sent on, and the others are tied to it.
2. Heads that share a band are tied to the smallest of them: a sorted pass over the bands, with no group held. What is
   tied, directly or by others, is a cluster: any two documents that share a band lie in one.
3. Within a cluster, documents that share a band are compared by their full sets and joined if they are similar. Those that
   are joined already are not compared again, so that a group of copies costs one comparison for each document and not one
   for each pair. Signatures that are too far apart for the similarity asked for (7 standard deviations) are not compared.
4. A cluster beyond BLOCK n-grams (a document counts SIGNATURE more than it has) is cut into parts by hash: each is searched alone, then one document of every component
   found is searched with the others', and only bands that hold several components after that are searched across parts,
   as pairs of parts.

Nulls, ties and repeated rows: null and empty texts are empty sets and linked with nothing (n_shingles 0, own component,
kept); rows with a null id take no part in links, get no component and are kept; every row of the input gives one row, so
that rows which repeat an id all have its component. Where an id repeats with different sets, each set is a document of
its own. An empty table gives an empty table. Texts of any length are read whole; one text's n-grams are held by one task.
Columns other than doc_id and text are not looked at, so that none can clash. N-grams, and sets, are compared by 64-bit
hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import stored, table, utf8
from medleaf.llm.jaccard_join import BROADCAST_ROWS, GRAMS_IN_TASK, digest, mix, runs, shingles, texts_of
from medleaf.llm.tables import components

ROWS, MISS = 6, 1e-6
BLOCK, FLUSH, CHUNK = 4_000_000, 2_000_000, 12_288
SIGNATURE = 256  # what a document costs besides its n-grams, in n-grams
DOCUMENT, TIE, BAND = range(3)
FOUND = "kind int, a long, b long, n long"


def bands(percent: int) -> int:
    """How many bands it takes that a pair of this similarity is missed with probability MISS at most."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def places(s: np.ndarray) -> np.ndarray:
    """The first permutation: where n-grams stand in the circle."""
    x = (s ^ (s >> np.uint64(32))).astype(np.uint32)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """(sets, size) coordinates; the sets must not be empty.

    The second permutation multiplies a place, shifts and multiplies again; a turn of the circle subtracts from the place.
    """
    out = np.empty((size, len(sets)), np.uint32)
    lengths = np.array([len(s) for s in sets], np.int64)
    a, b = np.uint32(0x9E3779B1), np.uint32(0xC2B2AE35)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(sets):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + CHUNK)))
        x = places(np.concatenate(sets[first:last])) * a
        y, t = np.empty_like(x), np.empty_like(x)
        start = np.cumsum(lengths[first:last]) - lengths[first:last]
        for k in range(size):
            np.subtract(x, np.uint32(k * int(a) & 0xFFFFFFFF), out=y)
            np.right_shift(y, np.uint32(15), out=t)
            np.bitwise_xor(y, t, out=y)
            np.multiply(y, b, out=y)
            out[k, first:last] = np.minimum.reduceat(y, start)
        first = last
    return np.ascontiguousarray(out.T)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(sets, bands) 64-bit keys, different ones for different bands."""
    n = signature.shape[1] // ROWS
    rows = signature.reshape(len(signature), n, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return out


def by_band(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys in order, the positions of their sets, starts and lengths of runs of equal keys)."""
    flat = keys.reshape(-1)
    order = np.argsort(flat, kind="stable")
    start, length = runs(flat[order])
    return flat[order], order // keys.shape[1], start, length


def tied(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows of FOUND: documents (id, class, size), classes tied to a head (class, head), and heads of bands (band, head). The
    head of some classes is that with the smallest hash.
    """
    size, flush = bands(percent) * ROWS, FLUSH

    def batch(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
        columns = [np.full(len(a), kind, np.int32), a.view(np.int64), b.view(np.int64), np.zeros(len(a), np.int64) if n is None else n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b", "n"])

    def block(classes: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not classes:
            return
        names = np.array(list(classes), np.int64)
        keys, owner, start, _ = by_band(band_keys(signatures(list(classes.values()), size)))
        head = np.minimum.reduceat(names[owner], start)
        member, to = names[owner], np.repeat(head, np.diff(np.r_[start, len(owner)]))
        ties = np.unique(np.rec.fromarrays([member[member != to], to[member != to]]))
        yield batch(TIE, np.ascontiguousarray(ties["f0"]), np.ascontiguousarray(ties["f1"]))
        for k in range(0, len(head), 1 << 16):
            yield batch(BAND, keys[start[k : k + (1 << 16)]], head[k : k + (1 << 16)])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[int, np.ndarray] = {}
        held = 0
        for some in batches:
            ids, names, sizes = some.column("doc_id"), [], []
            known = ids.is_valid().to_pylist()
            for there, text in zip(known, utf8(some, "text"), strict=True):
                s = shingles(text, width)
                names.append(digest(s)[0])
                sizes.append(len(s))
                if there and len(s) and names[-1] not in classes:
                    classes[names[-1]] = s
                    held += len(s) + SIGNATURE
            rows = [pa.array([DOCUMENT] * len(names), pa.int32()), ids.cast(pa.int64()), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, names=["kind", "a", "b", "n"])
            if held > flush:
                yield from block(classes)
                classes, held = {}, 0
        yield from block(classes)

    return docs.mapInArrow(sign, FOUND)


def stars(heads: DataFrame) -> DataFrame:
    """(a, b): the heads (band, head) of every band tied to its smallest."""

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, low = None, 0
        for batch in batches:
            key, head = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "head"))
            if not len(key):
                continue
            start, length = runs(key)
            first = head[start]
            if key[0] == band:
                first[0] = low
            to = np.repeat(first, length)
            band, low = key[-1], first[-1]
            keep = head != to
            yield pa.RecordBatch.from_arrays([pa.array(head[keep]), pa.array(to[keep])], names=["a", "b"])

    return heads.repartition("band").sortWithinPartitions("band", "head").mapInArrow(tie, "a long, b long")


def joined(sets: list[np.ndarray], percent: int, group: list[int] | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(pairs of positions that join two groups, band keys): sets that share a band and are similar. Those of one group are
    joined already.
    """
    m = len(sets)
    signature = signatures(sets, bands(percent) * ROWS)
    keys = band_keys(signature)
    size, share = signature.shape[1], percent / 100
    least = size * share - 7 * math.sqrt(size * share * (1 - share))
    sizes = np.array([len(s) for s in sets], np.int64)
    parts = np.arange(m) if group is None else np.unique(np.array(group), return_inverse=True)[1]
    root = parts.copy()
    order = np.argsort(root, kind="stable")
    members = {int(root[some[0]]): some for some in np.split(order, runs(root[order])[0][1:]) if len(some)}
    links, failed = [], set()
    _, owner, start, length = by_band(keys)
    for at, count in zip(start[length > 1], length[length > 1], strict=True):
        mine = owner[at : at + count]
        if (root[mine] == root[mine[0]]).all():
            continue
        for k in range(1, count):
            j = mine[k]
            others = mine[:k]
            others = others[root[others] != root[j]]
            others = others[(np.minimum(sizes[others], sizes[j]) * 100 >= np.maximum(sizes[others], sizes[j]) * percent)]
            if not len(others):
                continue
            agree = (signature[others] == signature[j]).sum(axis=1)
            others = others[np.argsort(-agree, kind="stable")][: int((agree >= least).sum())]
            for i in others:
                if root[i] == root[j] or (i, j) in failed:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if (100 + percent) * both >= percent * (sizes[i] + sizes[j]):
                    links.append((int(i), int(j)))
                    small, large = sorted((int(root[i]), int(root[j])), key=lambda r: len(members[r]))
                    root[members[small]] = large
                    members[large] = np.concatenate([members[large], members.pop(small)])
                else:
                    failed.add((i, j))
                    failed.add((j, i))
    return links, keys


def verified(docs: DataFrame, placed: DataFrame, grams: int, width: int, percent: int, keep_bands: bool = False) -> DataFrame:
    """Rows (kind, a, b) of classes placed (id, h1, part, joined): TIE for links found within parts and, if wanted, BAND for
    the bands (band, class) of all. Classes of a part with the same `joined` are joined already.
    """

    def solve(group: list[tuple[int, int]], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sets:
            names = np.array([h for h, _ in group], np.int64)
            links, keys = joined(sets, percent, [g for _, g in group])
            found = np.array(links, np.int64).reshape(-1, 2)
            yield rows(TIE, names[found[:, 0]], names[found[:, 1]])
            if keep_bands:
                yield rows(BAND, keys.reshape(-1).view(np.int64), np.repeat(names, keys.shape[1]))

    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, sets, there = None, [], [], set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cluster", "i", "j", "h1", "joined")]
            for c, i, j, h1, one, text in zip(*columns, utf8(batch, "text"), strict=True):
                if (c, i, j) != part:
                    yield from solve(group, sets)
                    part, group, sets, there = (c, i, j), [], [], set()
                s = shingles(text, width)
                if h1 not in there and digest(s)[0] == h1:  # not another text of this id, nor the same once more
                    there.add(h1)
                    group.append((h1, one))
                    sets.append(s)
        yield from solve(group, sets)

    small = F.broadcast(placed) if placed.count() <= BROADCAST_ROWS else placed
    texts = texts_of(docs, placed.select("id")).join(small, "id").select("cluster", "i", "j", "h1", "joined", "text")
    texts = texts.repartition(max(32, grams // GRAMS_IN_TASK), "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "h1")
    return stored(texts.mapInArrow(link, "kind int, a long, b long"), "verified")


def minhash_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text): the smallest id that links reach, and
    whether the row is the one of its component that stays.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(tied(docs, width, percent), "tied")
    rows = found.filter(F.col("kind") == DOCUMENT).select(F.col("a").alias("doc_id"), F.col("b").alias("h1"), "n")
    classes = stored(rows.filter("doc_id is not null and n > 0").groupBy("h1").agg(F.min("doc_id").alias("id"), F.min("n").alias("n")), "classes")
    ties = found.filter(F.col("kind") == TIE).select("a", "b").union(stars(found.filter(F.col("kind") == BAND).select(F.col("a").alias("band"), F.col("b").alias("head"))))
    clusters = components(ties).select(F.col("id").alias("h1"), F.col("label").alias("cluster"))
    links = stored(links_in(docs, classes.join(clusters, "h1"), width, percent), "links")
    named = classes.join(components(links).withColumnRenamed("id", "h1"), "h1", "left").select("h1", "id", F.coalesce("label", "h1").alias("label"))
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    named = named.join(least, "label").select("h1", "component_id")
    out = rows.join(named, "h1", "left")
    known = F.col("doc_id").isNotNull()
    component = F.when(known, F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (~known | (F.col("doc_id") == component)).alias("kept"))


def links_in(docs: DataFrame, clusters: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes (h1, id, n, cluster) that join all that similarity joins."""
    clusters = stored(clusters, "clusters")
    weight = F.col("n") + SIGNATURE
    sizes = clusters.groupBy("cluster").agg(F.sum(weight).alias("total"))
    parts = F.ceil(F.col("total") / BLOCK).cast("int")
    placed = clusters.join(sizes.select("cluster", parts.alias("parts")), "cluster").withColumn("own", F.pmod(F.xxhash64("h1"), "parts").cast("int"))
    placed = stored(placed, "placed")
    total, most = placed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("parts"), F.lit(1))).first()
    alone = placed.select("id", "h1", "cluster", F.col("own").alias("i"), F.col("own").alias("j"), F.col("h1").alias("joined"))
    single = verified(docs, alone.join(placed.filter("parts = 1").select("h1"), "h1", "left_semi") if most > 1 else alone, total, width, percent)
    links = single.filter(F.col("kind") == TIE).select("a", "b")
    if most == 1:
        return links
    placed = stored(placed.filter("parts > 1"), "placed-large")
    own = verified(docs, placed.select("id", "h1", "cluster", F.col("own").alias("i"), F.col("own").alias("j"), F.col("h1").alias("joined")), total, width, percent, keep_bands=True)
    posts, ties = own.filter(F.col("kind") == BAND).select(F.col("a").alias("band"), F.col("b").alias("h1")), own.filter(F.col("kind") == TIE).select("a", "b")
    # one document of every component, with those of the other parts
    now = _component(placed, ties)
    ones = now.filter("h1 = component")
    ones = ones.join(ones.groupBy("cluster").agg(F.ceil(F.sum(weight) / BLOCK).alias("of")), "cluster").withColumn("part", F.pmod(F.xxhash64("h1", F.lit(1)), "of").cast("int"))
    more = verified(docs, stored(ones, "ones").select("id", "h1", "cluster", F.col("part").alias("i"), F.col("part").alias("j"), F.col("h1").alias("joined")), total, width, percent)
    ties = stored(ties.union(more.filter(F.col("kind") == TIE).select("a", "b")), "ties")
    # what shares a band and is still apart
    now = _component(placed, ties)
    apart = posts.join(now.select("h1", "component"), "h1").groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    left = stored(now.join(posts.join(apart, "band", "left_semi").select("h1").distinct(), "h1", "left_semi"), "apart")
    across = left.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("with <> own")
    across = across.select("id", "h1", "cluster", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), F.col("component").alias("joined"))
    last = verified(docs, stored(across, "across"), total, width, percent)
    return links.union(ties).union(last.filter(F.col("kind") == TIE).select("a", "b"))


def _component(placed: DataFrame, ties: DataFrame) -> DataFrame:
    found = components(ties).select(F.col("id").alias("h1"), F.col("label"))
    return stored(placed.join(found, "h1", "left").withColumn("component", F.coalesce("label", "h1")).drop("label"), "component")


def op11_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word n-gram sets are at least 85 % alike, and which document of each is kept."""
    return minhash_components(table(spark, sf_dir, "documents"), width=5, percent=85)
