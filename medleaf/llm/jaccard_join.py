"""N-gram Jaccard self-join as a T-occurrence search.

A document is its set of distinct word n-grams. Two documents of at least p % Jaccard similarity share at least
T = p % of the larger set, so a partner occurs on at least T of a document's inverted lists. DivideSkip sets some of the
longest lists aside: the others are merged, and only documents that occur on enough of them are looked up, by binary
search, on the long ones.

In Spark:

1. Word frequencies are counted over all documents, in a table of fixed size. The frequency of an n-gram's rarest word
   bounds the length of its list, and gives the order from short lists to long ones. (Any order gives the same result;
   cells that words share only blur it.)
2. Documents with equal sets are one class. The n - T + MEET rarest n-grams of every class are its short lists; two
   that link meet on MEET of these at least (or on T, if that is less). Tasks send these n-grams once, sorted and packed,
   to partitions by their hash; a class goes once from each block of documents.
3. Lists of at most FEW classes give pairs with the number of times they meet. Classes on a longer list are tried again
   among themselves, with the n-grams in the order of their own counts: what many documents share comes last then, so
   that documents with a common passage and nothing else no longer meet. Only lists that are still long are turned into a
   star. A list that is long within one block of documents is not sent, but only its head.
4. Pairs that meet often enough, and stars, form clusters. Every link lies within a cluster.
5. Clusters are searched with their whole texts: inverted lists, short ones merged, long ones probed. A cluster beyond
   BLOCK n-grams is searched as pairs of blocks. Every link found is counted once for both of its documents, with the
   copies of the other one; similar_pairs returns each. Components are formed from those that join two parts, so that a
   group of copies sends one link for each document and not one for each pair.

Nulls, ties and repeated rows: null and empty texts are empty sets and linked with nothing; rows with a null id take no
part in links, get no component and have 0 links; every row of the input gives one row. Rows that repeat an id and an
n-gram set count as one document. Where an id repeats with different sets, their links are counted together. An empty
table gives an empty table. Texts of any length are read whole; one text's n-grams are held by one task. Columns other
than doc_id and text are not looked at, so that none can clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import lower_words, remembered, stored, table, utf8
from medleaf.llm.tables import components, tally

BLOCK, FLUSH, POSTS = 2_000_000, 500_000, 700_000
WORD_BITS, GRAM_BITS, CHOSEN_BITS = 22, 23, 26
MEET, FEW = 3, 16
BROADCAST_ROWS, GRAMS_IN_TASK = 400_000, 1_000_000  # some 30 MB
MU = 0.2  # cost of a binary search on a long list against that of merging an entry


class _Hashes(dict):
    """64-bit hashes of words, as bytes; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 250_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_digest(word)
        return value


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: bytes | None) -> np.ndarray:
    return np.frombuffer(b"".join(map(remembered("word hashes", _Hashes).__getitem__, lower_words(text))), "<u8")


def ngrams(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the n-grams of hashed words, in their order; with fewer words than `width`, of the whole sequence."""
    if not len(h):
        return np.zeros(0, np.uint64)
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    return out


def shingles(text: bytes | None, width: int = 4) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams."""
    return np.unique(ngrams(word_hashes(text), width))


def rarest_words_first(text: bytes | None, width: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct n-grams, their order from rare to frequent, whether each may stand elsewhere), by the frequency of
    their rarest word; equal rarities in the order of hashes.
    """
    h = word_hashes(text)
    sets, first = np.unique(ngrams(h, width), return_index=True)
    level_of = levels[cells(h, WORD_BITS)].astype(np.int32)
    width = min(width, len(h))
    each = [level_of[k : len(h) - width + 1 + k] for k in range(width)] or [level_of]
    rarest = np.minimum.reduce(each)
    return sets, np.argsort((rarest * 4096 + np.add.reduce(each))[first], kind="stable"), rarest[first] > 0


def rarest_grams_first(text: bytes | None, width: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by the counts of the n-grams themselves."""
    sets = shingles(text, width)
    rarity = levels[cells(sets, len(levels).bit_length() - 1)]
    return sets, np.argsort(rarity, kind="stable"), rarity > 0


def cells(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def needed(n: int, percent: int) -> int:
    """T: the least overlap with any partner of a document of n n-grams."""
    return -(-n * percent // 100)


def level(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of 255 steps."""
    return np.minimum(255, np.round(8 * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


def present(counts: np.ndarray) -> np.ndarray:
    return np.packbits(counts > 0)


def bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def word_cells(batch: pa.RecordBatch) -> np.ndarray:
    found = [cells(word_hashes(t), WORD_BITS) for t in utf8(batch, "text")]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def merge_short(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents of sorted lists with their number of occurrences: a heap merge; many entries by numpy's merge of runs."""
    total = sum(map(len, lists))
    if total < 300:
        merged = np.fromiter(heapq.merge(*(x.tolist() for x in lists)), np.int64, total)
    else:
        merged = np.sort(np.concatenate(lists), kind="stable")
    first = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]]) if total else np.zeros(0, np.int64)
    return merged[first], np.diff(np.r_[first, total])


def long_lists(lists: list[np.ndarray], threshold: int) -> int:
    """How many of the longest lists are set aside: T / (MU * log2(M) + 1), M the length of the longest."""
    return min(threshold - 1, int(threshold / (MU * np.log2(max(2, len(lists[-1]))) + 1)))


def divide_skip(lists: list[np.ndarray], threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, occurrences) of those on at least `threshold` of the sorted lists; the lists must be sorted by length.

    L of the longest lists are set aside, the others merged. Documents on threshold - L of these at least are looked up on
    the long lists by binary search, and given up as soon as those left cannot bring them to the threshold.
    """
    if len(lists) < threshold:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    aside = long_lists(lists, threshold)
    short = len(lists) - aside
    found, seen = merge_short(lists[:short])
    keep = seen >= threshold - aside
    found, seen = found[keep], seen[keep]
    for k, long in enumerate(lists[short:]):
        if not len(found):
            break
        at = np.searchsorted(long, found)
        seen = seen + (long[np.minimum(at, len(long) - 1)] == found)
        if k % 16 == 15:
            keep = seen + (aside - k - 1) >= threshold
            found, seen = found[keep], seen[keep]
    keep = seen >= threshold
    return found[keep], seen[keep]


def search(sets: list[np.ndarray], percent: int, counted: Callable[[int, int], None] | None = None) -> list[tuple[int, int]]:
    """Links that join two parts, as pairs of positions, among sets; `counted` is called with every link once.

    Sets are taken by rising size, so that a query's partners are on the lists already and are no larger than it is.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    if n < 2:
        return []
    order = np.argsort(sizes, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    values = np.concatenate(sets)
    owner = np.repeat(rank, sizes)
    by = np.lexsort((owner, values))
    values, owner = values[by], owner[by]
    start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    length = np.diff(np.r_[start, len(values)])
    start, length = start[length > 1], length[length > 1]  # an n-gram of one document finds no partner
    keys = values[start]
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for r, i in enumerate(order):
        least = needed(int(sizes[i]), percent)
        at = np.searchsorted(keys, sets[i])
        at = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == sets[i])] if len(keys) else at[:0]
        if len(at) < least:
            continue
        lists = [owner[start[k] : start[k] + length[k]] for k in at[np.argsort(length[at], kind="stable")]]
        lists = [x[: np.searchsorted(x, r)] for x in lists]
        lists = sorted((x for x in lists if len(x)), key=len)
        found, seen = divide_skip(lists, least)
        for j, both in zip(order[found], seen, strict=True):
            if (100 + percent) * both >= percent * (sizes[i] + sizes[j]):
                if counted is not None:
                    counted(int(i), int(j))
                a, b = root(int(i)), root(int(j))
                if a != b:
                    parent[a] = b
                    links.append((int(i), int(j)))
    return links


def digest(s: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def planes(x: np.ndarray) -> bytes:
    """Whole numbers by byte planes: those of sorted numbers compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unplanes(data: list[bytes], kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(d, np.uint8).reshape(width, -1).T).view(kind).reshape(-1) for d in data]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


DOCUMENT, NO_ID, PAIR, LONG, POST = range(5)


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of runs of equal numbers."""
    start = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return start, np.diff(np.r_[start, len(x)])


class Block:
    """What a task holds of some documents: their signatures, and the posts (n-gram, class, size) of their short lists."""

    def __init__(self) -> None:
        self.documents: dict[int, list[tuple[int, int, int, int]]] = {DOCUMENT: [], NO_ID: []}
        self.classes: set[int] = set()
        self.x: list[np.ndarray] = []
        self.owners: list[tuple[int, int, int]] = []  # class, size, posts
        self.held = 0

    def add(self, doc_id: int | None, n: int, key: tuple[int, int], short: np.ndarray) -> None:
        self.documents[NO_ID if doc_id is None else DOCUMENT].append((doc_id or 0, key[0], n, key[1]))
        self.held += 8
        if doc_id is not None and n and key[0] not in self.classes:
            self.classes.add(key[0])
            self.x.append(short)
            self.owners.append((key[0], n, len(short)))
            self.held += len(short)

    def rows(self, number: int, parts: int, star: bool) -> list[tuple[int, int, bytes, bytes, bytes, bytes]]:
        """(partition, kind, four columns of numbers by planes). Of a list that is long already, the head alone is sent, with
        size 0; its classes are named (each with the head if `star`).
        """
        out = []
        for kind, found in self.documents.items():
            if found:
                out.append((-1 - number % parts, kind, *(planes(c) for c in np.ascontiguousarray(np.array(found, np.int64).T))))
        if not self.owners:
            return out
        owner = np.array(self.owners, np.int64)
        x = np.concatenate(self.x)
        h, n = np.repeat(owner[:, 0], owner[:, 2]), np.repeat(owner[:, 1], owner[:, 2])
        by = np.argsort(x, kind="stable")
        x, h, n = x[by], h[by], n[by]
        start, size = runs(x)
        long = size > FEW
        if long.any():
            inside = np.repeat(long, size)
            head = np.repeat(np.minimum.reduceat(h, start), size)
            named = np.unique(np.stack([head[inside] if star else h[inside], h[inside]]), axis=1)
            out.append((-1 - number % parts, LONG, *(planes(np.ascontiguousarray(c)) for c in named), b"", b""))
            n = np.where(inside, 0, n)
            h = np.where(inside, head, h)
            keep = ~inside
            keep[start[long]] = True
            x, h, n = x[keep], h[keep], n[keep]
        p = ((x >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cut = np.searchsorted(p, np.arange(parts + 1))
        for k in np.flatnonzero(cut[1:] > cut[:-1]):
            one = slice(cut[k], cut[k + 1])
            out.append((int(k), POST, planes(x[one]), h[one].tobytes(), planes(n[one].astype("<u4")), b""))
        return out


MET = "kind int, a long, b long, n long, m long"


def met(rows: pd.DataFrame, percent: int, star: bool) -> pd.DataFrame:
    """What some rows of blocks give, as rows of MET: documents (id, class, size, second key), classes on long lists (a is
    the head if `star`), and from whole lists pairs (a, b, size of the larger, times they meet) and more long lists.
    """
    out: list[tuple[int, list[np.ndarray]]] = []
    for kind in (DOCUMENT, NO_ID, LONG):
        mine = rows[rows["kind"] == kind]
        if len(mine):
            out.append((kind, [unplanes(list(mine[c]), "<i8") for c in ("a", "b", "c", "d") if kind != LONG or c < "c"]))
    mine = rows[rows["kind"] == POST]
    if len(mine):
        x, h, n = unplanes(list(mine["a"]), "<u8"), np.frombuffer(b"".join(mine["b"]), "<i8"), unplanes(list(mine["c"]), "<u4").astype(np.int64)
        by = np.lexsort((-n, h, x))
        x, h, n = x[by], h[by], n[by]
        start, size = runs(x)
        headed = np.minimum.reduceat(n, start) == 0  # long within some block
        once = np.r_[True, (x[1:] != x[:-1]) | (h[1:] != h[:-1])]
        size = np.add.reduceat(once.astype(np.int64), start)
        long = np.repeat(headed | (size > FEW), np.diff(np.r_[start, len(x)]))[once]
        x, h, n = x[once], h[once], n[once]
        if long.any():
            first, length = runs(x)
            head = np.repeat(h[first], length)[long]  # the smallest: sorted
            found = np.unique(np.stack([head if star else h[long], h[long]]), axis=1)
            out.append((LONG, list(found)))
        x, h, n = x[~long], h[~long], n[~long]
        pairs = []
        for d in range(1, FEW):
            if len(x) <= d:
                break
            i = np.flatnonzero(x[d:] == x[:-d])
            most, least = np.maximum(n[i], n[i + d]), np.minimum(n[i], n[i + d])
            i, most = i[least * 100 >= most * percent], most[least * 100 >= most * percent]
            pairs.append((h[i], h[i + d], most))
        if pairs:
            a, b, most = (np.concatenate([p[k] for p in pairs]) for k in range(3))
            by = np.lexsort((b, a))
            a, b, most = a[by], b[by], most[by]
            first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
            out.append((PAIR, [a[first], b[first], most[first], np.diff(np.r_[first, len(a)])]))
    columns = {c: np.concatenate([np.zeros(0, np.int64)] + [f[k] if k < len(f) else np.zeros(len(f[0]), np.int64) for _, f in out]) for k, c in enumerate(("a", "b", "n", "m"))}
    kinds = np.concatenate([np.zeros(0, np.int32)] + [np.full(len(f[0]), kind, np.int32) for kind, f in out])
    return pd.DataFrame({"kind": kinds, **columns})


def meetings(docs: DataFrame, percent: int, parts: int, signs: Callable[[bytes | None], tuple[np.ndarray, np.ndarray, np.ndarray]], star: bool = False) -> DataFrame:
    """Rows of MET from docs (doc_id, text); signs gives a text's n-grams, their order and which may stand elsewhere."""
    flush = FLUSH

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, block = TaskContext.get().partitionId() << 20, Block()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch, "text"), strict=True):
                s, order, shared = signs(text)
                short = order[: len(s) - needed(len(s), percent) + MEET]
                block.add(doc_id, len(s), digest(s), s[short[shared[short]]])
                if block.held > flush:
                    yield from packed(block.rows(number, parts, star))
                    number, block = number + 1, Block()
        yield from packed(block.rows(number, parts, star))

    def packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(rows), 16):
            columns = zip(zip(*rows[k : k + 16], strict=True), [pa.int32(), pa.int32()] + [pa.binary()] * 4, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["p", "kind", "a", "b", "c", "d"])

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        return met(rows, percent, star)

    return docs.mapInArrow(sign, "p int, kind int, a binary, b binary, c binary, d binary").repartition(parts, "p").groupBy("p").applyInPandas(reduce, MET)


def frequent(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that meet often enough, from parts of their meetings."""
    pairs = pairs.filter(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("m").alias("met"), F.max("n").alias("n"))
    return pairs.filter(F.col("met") >= F.least(F.lit(MEET), F.ceil(F.col("n") * percent / 100))).select("a", "b")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of docs whose id may be among `ids` (id): all that are, and a few more. They are picked out by a table of
    bits, 16 for each id up to 2**CHOSEN_BITS (8 MB); beyond that more others are passed on, at most every text once.
    """
    bits = int(np.clip(np.ceil(np.log2(16 * ids.count() + 1)), 10, CHOSEN_BITS))

    def chosen_cells(batch: pa.RecordBatch) -> np.ndarray:
        return cells(mix(batch.column("id").to_numpy(zero_copy_only=False).astype(np.uint64)), bits)

    chosen = docs.sparkSession.sparkContext.broadcast(tally(ids.select("id"), chosen_cells, bits, present, few=True))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("doc_id")
            known = at.fill_null(0).to_numpy(zero_copy_only=False)
            keep = pa.array(bit(chosen.value, cells(mix(known.astype(np.uint64)), bits)) & ~at.is_null().to_numpy(zero_copy_only=False))
            if keep.true_count:
                yield batch.filter(keep)

    return docs.mapInArrow(choose, "doc_id long, text string").withColumnRenamed("doc_id", "id")


def clustered(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures of all rows, classes of documents with equal sets, clusters (h1, cluster) of classes that may link)."""
    sc = docs.sparkSession.sparkContext
    levels = tally(docs.select("text"), word_cells, WORD_BITS, level)
    words = float(np.exp2(levels[levels > 0] / 8.0).sum())  # about
    by_words = sc.broadcast(levels)
    parts = max(32, int(words * (100 - percent) / 100 / POSTS) + 1)
    found = stored(meetings(docs, percent, parts, lambda text: rarest_words_first(text, width, by_words.value)), "met")
    signed = found.filter(F.col("kind") <= NO_ID).select(F.when(F.col("kind") == DOCUMENT, F.col("a")).alias("doc_id"), "n", F.col("b").alias("h1"), F.col("m").alias("h2"))
    real = signed.filter("n > 0 and doc_id is not null").groupBy("h1", "h2", "doc_id").agg(F.min("n").alias("n"))
    classes = stored(real.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.min("n").alias("n"), F.count("*").alias("copies")), "classes")
    meets = frequent(found, percent)
    again = found.filter(F.col("kind") == LONG).select(F.col("a").alias("h1")).distinct()
    again = stored(classes.join(again, "h1").select("id", "n"), "again")
    grams = again.agg(F.sum("n")).first()[0]
    if grams:
        texts = texts_of(docs, again).join(again.select("id").distinct(), "id").select(F.col("id").alias("doc_id"), "text")
        texts = stored(texts, "again-texts")
        bits = int(np.clip(np.ceil(np.log2(2 * grams)), 14, GRAM_BITS))

        def gram_cells(batch: pa.RecordBatch) -> np.ndarray:
            found = [cells(shingles(t, width), bits) for t in utf8(batch, "text")]
            return np.concatenate(found) if found else np.zeros(0, np.int64)

        by_grams = sc.broadcast(tally(texts.select("text"), gram_cells, bits, level))
        parts = max(32, int(grams / POSTS) + 1)
        more = stored(meetings(texts, percent, parts, lambda text: rarest_grams_first(text, width, by_grams.value), star=True), "met-again")
        meets = meets.union(frequent(more, percent)).union(more.filter(F.col("kind") == LONG).select("a", "b")).distinct()
    return signed, classes, components(meets).select(F.col("id").alias("h1"), F.col("label").alias("cluster"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of docs (doc_id, text); n_links counts the other documents
    that it is similar to, equal sets included.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed, classes, clusters = clustered(docs, width, percent)
    links = stored(links_between(docs, classes.join(clusters, "h1"), width, percent), "links")
    found = components(links.filter("b is not null"))
    degrees = links.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    named = classes.select("h1", "h2", "id", "copies").join(found, "id", "left").join(degrees, "id", "left")
    named = named.select("h1", "h2", F.coalesce("label", "id").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = signed.select("doc_id", "n", "h1", "h2").join(named, ["h1", "h2"], "left")
    known = F.col("doc_id").isNotNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(known, F.coalesce("component", "doc_id")).alias("component_id"), F.when(known, F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"))


def similar_pairs(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(a, b): every similar pair of docs (doc_id, text) with different sets, once, in no order; of documents with equal
    sets, that with the smallest id stands for all.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _, classes, clusters = clustered(docs, width, percent)
    return links_between(docs, classes.join(clusters, "h1"), width, percent, every=True).select("a", "b")


def links_between(docs: DataFrame, clusters: DataFrame, width: int, percent: int, every: bool = False) -> DataFrame:
    """Rows (a, b, n) among classes (h1, h2, id, n, copies, cluster): links (a, b) that join all that similarity joins, and
    a part of the number n of documents that those of class a are linked with, with a null b. With every, all links, and
    those only.
    """
    clusters = stored(clusters, "clusters")
    sizes = clusters.groupBy("cluster").agg(F.sum("n").alias("total"))
    blocks = F.when(F.col("total") <= BLOCK, F.lit(1)).otherwise(F.ceil(F.col("total") * 2 / BLOCK)).cast("int")
    placed = clusters.join(sizes.withColumn("blocks", blocks).drop("total"), "cluster")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    # each block meets every other once, and is searched itself in every pair
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("blocks = 1 or with <> own")
    # the links within a block count in one of its pairs, that with the next block
    within = (F.col("with") == F.pmod(F.col("own") + 1, "blocks")) | (F.col("blocks") == 1)
    placed = placed.select("id", "h1", "cluster", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "copies", within.alias("within"))
    placed = stored(placed, "placed")
    total, rows_placed = clusters.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], placed.count()
    # a small table goes to the texts, so that these are sent once; a large one is joined
    small = F.broadcast(placed) if rows_placed <= BROADCAST_ROWS else placed
    parts = texts_of(docs, clusters).join(small, "id").select("id", "h1", "cluster", "i", "j", "own", "copies", "within", "text")
    parts = parts.repartition(max(32, total // GRAMS_IN_TASK), "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "id")

    def solve(group: list[tuple[int, int, int, bool]], sets: list[np.ndarray]) -> list[tuple[int, int | None, int]]:
        degrees, pairs = [0] * len(group), []

        def counted(i: int, j: int) -> None:
            if group[i][1] != group[j][1] or group[i][3]:
                if every:
                    pairs.append((group[i][0], group[j][0], 0))
                degrees[i] += group[j][2]
                degrees[j] += group[i][2]

        joining = search(sets, percent, counted)
        if every:
            return pairs
        return [(group[i][0], group[j][0], 0) for i, j in joining] + [(g[0], None, d) for g, d in zip(group, degrees, strict=True) if d]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, sets, classes = None, [], [], set()
        for batch in batches:
            keys = zip(batch.column("cluster").to_pylist(), batch.column("i").to_pylist(), batch.column("j").to_pylist(), strict=True)
            out = []
            columns = [batch.column(c).to_pylist() for c in ("id", "own", "copies", "within", "h1")]
            for k, *one, h1, text in zip(keys, *columns, utf8(batch, "text"), strict=True):
                if k != key:
                    out += solve(group, sets)
                    key, group, sets, classes = k, [], [], set()
                s = shingles(text, width)
                if h1 not in classes and digest(s)[0] == h1:  # not another text of this id, nor the same once more
                    classes.add(h1)
                    group.append(one)
                    sets.append(s)
            yield rows(out)
        yield rows(solve(group, sets))

    def rows(links: list[tuple[int, int | None, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(3)], names=["a", "b", "n"])

    return parts.mapInArrow(link, "a long, b long, n long")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word n-gram sets are at least 85 % alike, and the number of links of each."""
    return jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)
