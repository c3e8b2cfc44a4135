"""Language-model scores by deleted interpolation.

A bigram model over words and an end token: P(w | h) mixes the maximum-likelihood estimates c(h, w) / c(h) and c(w) / N
and the uniform 1 / (V + 1), with weights that depend on a bucket of the context's frequency (its binary logarithm). The
weights are learned by expectation-maximisation on counts from which each training token is deleted in turn, so
that every token is held out once. The context of a text's first word is the end token.

Counts are exact and cover all training texts:

1. Word counts are a distributed aggregate. The most frequent words (DICTIONARY of them at most) are sent to all tasks.
   Bucket 0, which mixes the last two estimates only, is for contexts that no training text holds.
2. Pairs are sent, sorted and packed, to partitions by their hash (by the second word's hash if it is not in the
   dictionary), document by document, and counted there. Pairs of the HOT most frequent words are added up by blocks of
   documents first and go without them, so that no pair that is sent by document occurs more often than the word after.
3. Each document's share of the score is summed per partition, and sent on only where it has one.
4. What needs no counts of rare pairs is scored where the text lies; the parts of a document are added up.
5. If training words are left outside the dictionary, pairs behind them are scored as behind an unseen context first. Their
   counts are then taken by joins on the hashes of both words, and what they add to a document's score is added.

Rows alike in id and text are scored as one and returned as often as they stand there. A null id is in the training part or
not by crc32 of the empty text; null texts are empty. An empty table gives an empty table. A text of any length is read
whole, by one task. Columns other than doc_id and text are not looked at, so that none can clash. Ties of words in
frequency are broken by their hashes; they change where a pair is counted, not what is counted.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import fold, forget, remembered, stored, table, utf8

DICTIONARY, HOT, FLUSH, DOC_BITS = 1 << 20, 512, 1_000_000, 14
NONE = 0xFFFFFFFF
LEVELS = 256
SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))  # as bytes.split has it


def hash_of(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), "<u8")


END = int(hash_of([b"\nend of text\n"])[0])  # holds white space: no word is spelled so


def spelled(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct words of some texts, number of each word that stands there, words of each text)."""
    data = np.frombuffer(b"\n".join([b"", *(t or b"" for t in texts), b""]).lower(), np.uint8)
    space = SPACE[data]
    starts, ends = (np.flatnonzero(edge) + 1 for edge in (space[:-1] & ~space[1:], ~space[:-1] & space[1:]))
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~space])]).dictionary_encode()
    limits = np.cumsum([1, *(len(t or b"") + 1 for t in texts)])
    return hash_of(found.dictionary.to_pylist()), found.indices.to_numpy(), np.diff(np.searchsorted(starts, limits))


class Words:
    """Hashes of words and their ranks in a table (NONE if they have none)."""

    def __init__(self, hashes: np.ndarray, ranks: np.ndarray):
        self.hashes, self.ranks = hashes, ranks

    def ranked(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), NONE, np.uint32)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ranks[at], NONE).astype(np.uint32)

    def tokens(self, texts: list[bytes | None], end_rank: int = NONE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, ranks, ranks of the token before, number of the text) of all tokens of some texts. Before a text's
        first token stands the end token.
        """
        hashes, words, sizes = spelled(texts)
        hashes = np.append(hashes, np.uint64(END))
        sizes = sizes + 1
        ends = np.cumsum(sizes) - 1
        word = np.full(int(sizes.sum()), len(hashes) - 1)
        inside = np.ones(len(word), bool)
        inside[ends] = False
        word[inside] = words
        h, r = hashes[word], self.ranked(hashes)[word]
        before = np.empty_like(r)
        before[1:] = r[:-1]
        before[ends + 1 - sizes] = end_rank
        return h, r, before, np.repeat(np.arange(len(texts)), sizes)


def in_pieces(batch: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[tuple[list[int], list[bytes | None]]]:
    """(rows, texts) of a batch, in pieces of about a bounded size."""
    rows, texts, size = [], [], 0
    for k, t in enumerate(utf8(batch, "text")):
        rows.append(k)
        texts.append(t)
        size += len(t or b"")
        if size > limit:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def words_of(shared: Broadcast) -> Words:
    """The worker's own table for a broadcast (hashes, ranks, ..., name)."""
    return remembered(shared.value[-1], lambda: Words(*shared.value[:2]))


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(first) else c[:0]


def level(q: np.ndarray) -> np.ndarray:
    """Estimates on a scale of quarter octaves; 0 for none."""
    with np.errstate(divide="ignore"):
        return np.where(q > 0, 1 + np.clip(np.round(-4 * np.log2(np.maximum(q, 1e-300))), 0, LEVELS - 2), 0).astype(np.int64)


def value(at: np.ndarray) -> np.ndarray:
    return np.where(at > 0, 2.0 ** (-(at - 1) / 4), 0.0)


def bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for contexts without training tokens, else 1 + the binary logarithm of the count."""
    return np.where(context_count > 0, 1 + np.floor(np.log2(np.maximum(context_count, 1))), 0).astype(np.int64)


def deleted(c2: np.ndarray, ch: np.ndarray, c1: np.ndarray, total: int) -> np.ndarray:
    """Cells (bucket, level of the pair's, level of the word's estimate) with one occurrence deleted from each count."""
    q2 = np.where(ch > 1, (c2 - 1) / np.maximum(ch - 1, 1), 0.0)
    return (bucket(ch) * LEVELS + level(q2)) * LEVELS + level((c1 - 1) / max(total - 1, 1))


def learn(cells: np.ndarray, weights: np.ndarray, vocabulary: int, rounds: int = 80) -> np.ndarray:
    """Weights (bucket, [pair, word, uniform]) by expectation-maximisation; buckets without tokens get those of all."""
    b, q2, q1 = cells // (LEVELS * LEVELS), value(cells // LEVELS % LEVELS), value(cells % LEVELS)
    q = np.stack([q2, q1, np.full(len(cells), 1 / (vocabulary + 1))], 1)
    out = np.tile([0.0, 0.9, 0.1], (64, 1))
    for k in np.unique(b):
        mine, w = q[b == k], weights[b == k].astype(float)
        if k == 0:
            mine = mine * [0, 1, 1]
        lam = np.array([0.0 if k == 0 else 0.4, 0.4, 0.2])
        for _ in range(rounds):
            share = mine * lam
            share /= share.sum(axis=1, keepdims=True)
            lam = (share * w[:, None]).sum(axis=0) + [0.0 if k == 0 else 0.1, 0.1, 0.1]
            lam /= lam.sum()
        out[k] = lam
    seen = np.unique(b[b > 0])
    for k in range(1, 64):
        if k not in seen:
            out[k] = out[seen[np.argmin(np.abs(seen - k))]] if len(seen) else out[0]
    return out


def probability(c2: np.ndarray, ch: np.ndarray, c1: np.ndarray, total: int, vocabulary: int, lam: np.ndarray) -> np.ndarray:
    w = lam[bucket(ch)]
    return w[:, 0] * c2 / np.maximum(ch, 1) + w[:, 1] * c1 / max(total, 1) + w[:, 2] / (vocabulary + 1)


def planes(x: np.ndarray, width: int) -> bytes:
    """Whole numbers by byte planes, compressed."""
    return zlib.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), 1)


def unplanes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8").reshape(-1)


def spread(h: np.ndarray, parts: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """(key, n): tokens of the training rows, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            for _, texts in in_pieces(batch):
                k, words, _ = spelled(texts)
                keys.append(np.append(k, np.uint64(END)))
                counts.append(np.append(np.bincount(words, minlength=len(k)), len(texts)).astype(np.int64))
                held += len(k) + 1
            if held > FLUSH:
                k, n = added(keys, counts)
                keys, counts, held = [k], [n], 0 if len(k) < FLUSH else len(k) - FLUSH
        if keys:
            k, n = added(keys, counts)
            for some in range(0, len(k), 200_000):
                one = slice(some, some + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(k[one].view(np.int64)), pa.array(n[one])], names=["key", "n"])

    return docs.filter("train").select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequent_words(single: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts), by falling count, of the end token and the most frequent words, `most` at most: as many whole
    eighths of octaves of counts as fit.
    """
    octave = F.floor(F.log2("n") * 8)
    steps = single.groupBy(octave.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()  # some hundreds at most
    least, fit = None, 1
    for step, words in steps:
        fit += words
        if fit > most:
            break
        least = step
    wanted = F.col("key") == F.lit(END - (1 << 64) if END >= 1 << 63 else END)
    found = single.filter(wanted if least is None else wanted | (octave >= least)).select("key", "n").toArrow()
    hashes, n = found.column("key").to_numpy().view(np.uint64), found.column("n").to_numpy()
    if END not in hashes:
        hashes, n = np.append(hashes, np.uint64(END)), np.append(n, 0)
    order = np.lexsort((hashes, -n))
    return hashes[order], n[order]


PACKED = "p int, block long, trained int, keys binary, counts binary, tail_words binary, tail_pairs binary, hot binary, hot_counts binary, uids binary"


def scatter(docs: DataFrame, known: Broadcast, end: int, parts: int) -> DataFrame:
    """Pairs sorted and packed by partition, rows of PACKED. A block is some documents of one task, the `trained` training
    ones first; its ids come once, in a row with a negative p.
    """
    names = [c.split()[0] for c in PACKED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 7

    def pack(block: int, uids: list[int], train: list[bool], tokens: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, r, before = (np.concatenate([t[k] for t in tokens]) for k in range(3))
        ends = np.cumsum([0] + [t[4] for t in tokens])
        use = np.array(train, bool)
        first_trained = np.argsort(~use, kind="stable")
        number = np.empty(len(use), np.uint64)
        number[first_trained] = np.arange(len(use), dtype=np.uint64)
        doc = np.concatenate([t[3] + at for t, at in zip(tokens, ends, strict=False)])
        hot = (r < HOT) & (before < HOT)
        hot_pairs, hot_n = np.unique(before[hot & use[doc]].astype(np.uint64) * np.uint64(HOT) + r[hot & use[doc]], return_counts=True)
        doc = number[doc]
        first = (r != NONE) & (before != NONE) & ~hot
        packed, m = np.unique((((before[first].astype(np.uint64) << np.uint64(20)) | r[first]) << np.uint64(DOC_BITS)) | doc[first], return_counts=True)
        p = spread(packed >> np.uint64(DOC_BITS), parts)
        by = np.argsort(p.astype(np.uint16) if parts < 65536 else p, kind="stable")
        packed, m, starts = packed[by], m[by], np.searchsorted(p[by], np.arange(parts + 1))
        tail = r == NONE
        words, pair = h[tail], (before[tail].astype(np.uint64) << np.uint64(DOC_BITS)) | doc[tail]
        q = spread(words, parts)
        by = np.lexsort((pair, words, q))
        words, pair, tail_starts = words[by], pair[by], np.searchsorted(q[by], np.arange(parts + 1))
        o = spread(hot_pairs, parts)
        by = np.argsort(o, kind="stable")
        hot_pairs, hot_n, hot_starts = hot_pairs[by], hot_n[by], np.searchsorted(o[by], np.arange(parts + 1))
        trained = int(use.sum())
        out = [(-1 - block % parts, block, trained, *[b""] * 6, np.array(uids, np.int64)[first_trained].tobytes())]
        for k in range(parts):
            a, b, c, d, e, f = starts[k], starts[k + 1], tail_starts[k], tail_starts[k + 1], hot_starts[k], hot_starts[k + 1]
            if a < b or c < d or e < f:
                out.append((k, block, trained, planes(packed[a:b], 7), planes(m[a:b], 4), planes(words[c:d], 8), planes(pair[c:d], 6), planes(hot_pairs[e:f], 4), planes(hot_n[e:f], 4), b""))
        for k in range(0, len(out), 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 16], strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, block = words_of(known), TaskContext.get().partitionId() << 24
        uids, train, tokens, held = [], [], [], 0
        for batch in batches:
            all_uids, all_train = batch.column("uid").to_pylist(), batch.column("train").to_pylist()
            for rows, texts in in_pieces(batch):
                for some in range(0, len(rows), 1 << (DOC_BITS - 1)):
                    part = slice(some, some + (1 << (DOC_BITS - 1)))
                    tokens.append((*words.tokens(texts[part], end), len(texts[part])))
                    uids += [all_uids[k] for k in rows[part]]
                    train += [all_train[k] for k in rows[part]]
                    held += len(tokens[-1][0])
                    if held > FLUSH or len(uids) > 1 << (DOC_BITS - 1):
                        yield from pack(block, uids, train, tokens)
                        block, uids, train, tokens, held = block + 1, [], [], [], 0
        if uids:
            yield from pack(block, uids, train, tokens)

    return docs.select("uid", "train", "text").mapInArrow(run, PACKED)


MERGED = "p int, blocks binary, sizes binary, uids binary, c2 binary, ch binary, c1 binary, runs binary, known_keys long, docs binary, m binary, hot binary, hot_counts binary"


#: Bytes of the numbers of each column, which are compressed by byte planes.
WIDTHS = {"c2": 6, "ch": 6, "c1": 6, "runs": 4, "docs": 6, "m": 4}


def merge(rows: DataFrame, known: Broadcast, parts: int) -> DataFrame:
    """Counts of the pairs of each partition, and the documents that hold them: docs are the place of a block among the
    partition's blocks, then DOC_BITS for the document in it.
    """

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        forget()  # words are not looked up here: room for the counts
        names, none = [c.split()[0] for c in MERGED.split(", ")], [b""] * 4
        blocks = rows["block"].to_numpy(np.int64)
        if key[0] < 0:
            sizes = np.array([len(u) // 8 for u in rows["uids"]], np.int64)
            return pd.DataFrame([(key[0], blocks.tobytes(), sizes.tobytes(), b"".join(rows["uids"]), *none, 0, *none)], columns=names)
        counts = known.value[2]
        docs, keys, m, words, tail_docs, contexts, hot, hot_n = ([] for _ in range(8))
        use, tail_use = [], []
        low = np.uint64((1 << DOC_BITS) - 1)
        for at, r in enumerate(rows.itertuples()):
            packed, pair, at = unplanes(r.keys, 7), unplanes(r.tail_pairs, 6), np.uint64(at << DOC_BITS)
            keys.append(packed >> np.uint64(DOC_BITS))
            docs.append((packed & low) + at)
            use.append((packed & low) < r.trained)
            m.append(unplanes(r.counts, 4).astype(np.uint32))
            words.append(unplanes(r.tail_words, 8))
            contexts.append(pair >> np.uint64(DOC_BITS))
            tail_docs.append((pair & low) + at)
            tail_use.append((pair & low) < r.trained)
            hot.append(unplanes(r.hot, 4))
            hot_n.append(unplanes(r.hot_counts, 4).astype(np.int64))
        k, d, m, u = np.concatenate(keys), np.concatenate(docs), np.concatenate(m), np.concatenate(use)
        order = np.argsort(k, kind="stable")
        k, d, m, u = k[order], d[order], m[order], u[order]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
        c2 = np.add.reduceat(m.astype(np.int64) * u, first) if len(first) else np.zeros(0, np.int64)
        ch, c1 = counts[(k[first] >> np.uint64(20)).astype(np.int64)], counts[(k[first] & np.uint64((1 << 20) - 1)).astype(np.int64)]
        runs = np.diff(np.r_[first, len(k)])
        w, x, e, v = np.concatenate(words), np.concatenate(contexts), np.concatenate(tail_docs), np.concatenate(tail_use).astype(np.int64)
        order = np.lexsort((x, w))
        w, x, e, v = w[order], x[order], e[order], v[order]
        if len(w):
            new_word = np.r_[True, w[1:] != w[:-1]]
            start = np.flatnonzero(new_word | np.r_[True, x[1:] != x[:-1]])
            by_word = np.add.reduceat(v, np.flatnonzero(new_word))
            t1 = by_word[np.cumsum(new_word)[start] - 1]
            outside = x[start] == NONE
            t2 = np.where(outside, 0, np.add.reduceat(v, start))
            th = np.where(outside, 0, counts[np.where(outside, 0, x[start]).astype(np.int64)])
            c2, ch, c1, runs = np.r_[c2, t2], np.r_[ch, th], np.r_[c1, t1], np.r_[runs, np.diff(np.r_[start, len(w)])]
            d, m = np.r_[d, e], np.r_[m, np.ones(len(e), np.uint32)]
        as_bytes = [planes(x, WIDTHS[k]) for k, x in (("c2", c2), ("ch", ch), ("c1", c1), ("runs", runs))]
        hot, hot_n = added(hot, hot_n)
        return pd.DataFrame([(key[0], blocks.tobytes(), b"", b"", *as_bytes, len(first), planes(d, WIDTHS["docs"]), planes(m, WIDTHS["m"]), planes(hot, 4), planes(hot_n, 6))], columns=names)

    return rows.repartition(parts, "p").groupBy("p").applyInPandas(one, MERGED)


def read_counts(batch: pa.RecordBatch, names: tuple[str, ...] = ("c2", "ch", "c1")) -> Iterator[list[np.ndarray]]:
    """Columns of numbers of each merged row, one row at a time; rows of ids give none."""
    for k in range(len(batch)):
        raw = [batch.column(c)[k].as_py() for c in names]
        yield [unplanes(r, WIDTHS[c]).astype(np.int64) if r else np.zeros(0, np.int64) for c, r in zip(names, raw, strict=True)]


def rare_contexts(docs: DataFrame, known: Broadcast, end: int) -> DataFrame:
    """(uid, train, x, w, c1, m): pairs of words w behind words x outside the dictionary, with how often a row holds them;
    c1 is null if w is outside, too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = words_of(known), known.value[2]
        for batch in batches:
            for rows, texts in in_pieces(batch):
                h, r, before, doc = words.tokens(texts, end)
                at = np.flatnonzero(before == NONE)  # never a text's first token: before that stands the end token
                if not len(at):
                    continue
                x, w, r, doc = h[at - 1], h[at], r[at], doc[at]
                by = np.lexsort((w, x, doc))
                x, w, r, doc = x[by], w[by], r[by], doc[by]
                first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (w[1:] != w[:-1]) | (doc[1:] != doc[:-1])])
                m, outside = np.diff(np.r_[first, len(x)]), r[first] == NONE
                c1 = pa.array(counts[np.where(outside, 0, r[first]).astype(np.int64)], pa.int64(), mask=outside)
                row = pa.array(doc[first] + rows[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("uid").take(row), batch.column("train").take(row), pa.array(x[first].view(np.int64)), pa.array(w[first].view(np.int64)), c1, pa.array(m.astype(np.int64))],
                    names=["uid", "train", "x", "w", "c1", "m"],
                )

    return docs.select("uid", "train", "text").mapInArrow(run, "uid long, train boolean, x long, w long, c1 long, m long")


def rare_pairs(rows: DataFrame, single: DataFrame) -> DataFrame:
    """(x, w, c2, ch, c1) of the pairs of rare_contexts whose context stands in the training texts."""
    pairs = rows.groupBy("x", "w").agg(F.sum(F.when(F.col("train"), F.col("m")).otherwise(0)).alias("c2"), F.max("c1").alias("c1"))
    pairs = pairs.join(single.select(F.col("key").alias("x"), F.col("n").alias("ch")), "x")
    names = ["x", "w", "c2", "ch", "c1"]
    outside = pairs.filter("c1 is null").drop("c1").join(single.select(F.col("key").alias("w"), F.col("n").alias("c1")), "w", "left").fillna(0, ["c1"])
    return pairs.filter("c1 is not null").select(names).union(outside.select(names))


def lm_scores(docs: DataFrame, dictionary: int = DICTIONARY, learned: dict | None = None) -> DataFrame:
    """Scores of every row of docs (doc_id, text); the columns of op4. A dict given as learned gets the weights by bucket."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), (fold("doc_id") != 1).alias("train"))
    docs = docs.withColumn("uid", F.xxhash64("doc_id", "text"))
    single = stored(count_words(docs), "counts")
    total, vocabulary = single.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hashes, by_rank = frequent_words(single, dictionary)
    order = np.argsort(hashes)
    known = sc.broadcast((hashes[order], order.astype(np.uint32), by_rank, uuid.uuid4().hex))
    end = int(np.flatnonzero(hashes == np.uint64(END))[0])

    parts = max(32, -(-total * 5 // 4 // 1_500_000))
    merged = stored(merge(scatter(docs, known, end, parts), known, parts), "merged")
    dense = np.zeros(HOT * HOT, np.int64)
    for keys, n in merged.filter("p >= 0").select("hot", "hot_counts").collect():  # HOT * HOT pairs at most
        dense[unplanes(keys, 4).astype(np.int64)] = unplanes(n, 6).astype(np.int64)

    def deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for c2, ch, c1 in read_counts(batch):
                real = (c2 > 0) & (ch > 0)
                cells = np.bincount(deleted(c2[real], ch[real], c1[real], total), c2[real].astype(float), minlength=1)
                some = np.flatnonzero(cells)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(cells[some].astype(np.int64))], names=["cell", "n"])

    found = merged.select("c2", "ch", "c1").mapInArrow(deletions, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()  # cells are fixed in number
    pair = np.flatnonzero(dense)
    cells = [np.array([c for c, _ in found], np.int64), deleted(dense[pair], by_rank[pair // HOT], by_rank[pair % HOT], total)]
    weights = [np.array([w for _, w in found], np.int64), dense[pair]]
    rows = pairs = None
    if np.count_nonzero(by_rank) < vocabulary:  # training words outside the dictionary
        rows = stored(rare_contexts(docs, known, end), "rare-rows")
        pairs = stored(rare_pairs(rows, single), "rare-pairs")

        def more_deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                c2, ch, c1 = (batch.column(c).to_numpy() for c in ("c2", "ch", "c1"))
                some, at = np.unique(deleted(c2, ch, c1, total), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.bincount(at, c2.astype(float), len(some)).astype(np.int64))], names=["cell", "n"])

        more = pairs.filter("c2 > 0").select("c2", "ch", "c1").mapInArrow(more_deletions, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()
        cells.append(np.array([c for c, _ in more], np.int64))
        weights.append(np.array([w for _, w in more], np.int64))
    # contexts that are not in the training texts: all tokens, by their own counts
    for c, words in single.groupBy("n").agg(F.count("*")).collect() if total else []:
        cells.append(deleted(np.zeros(1), np.zeros(1), np.array([c]), total))
        weights.append(np.array([c * words]))
    lam = learn(np.concatenate(cells), np.concatenate(weights), vocabulary)
    if learned is not None:
        learned.update(weights=lam, total=int(total), vocabulary=int(vocabulary))
    denominator = total + 0.5 * (vocabulary + 1)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a partition's pairs over each document that holds some, by block."""
        forget()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("p", "blocks", "sizes", "uids", "known_keys")]
            for (c2, ch, c1, runs, where, m), p, blocks, sizes, uids, first in zip(read_counts(batch, tuple(WIDTHS)), *columns, strict=True):
                blocks = np.frombuffer(blocks, np.int64)
                if p < 0:
                    sizes = np.frombuffer(sizes, np.int64)
                    ends = np.cumsum(sizes)
                    cut = [uids[8 * (e - n) : 8 * e] for e, n in zip(ends, sizes, strict=True)]
                    yield made_sums(blocks, cut, [b""] * len(cut), [b""] * len(cut))
                    continue
                n = int(runs[:first].sum())
                score = m * np.repeat(np.log10(probability(c2, ch, c1, total, vocabulary, lam)), runs)
                # base scores of words in the dictionary are taken with the text
                base, seen = np.repeat(np.log10((c1[first:] + 0.5) / denominator), runs[first:]), np.repeat((c1[first:] > 0).astype(float), runs[first:])
                for at, values in ((where[:n], [score[:n]]), (where[n:], [score[n:], base, seen])):
                    order = np.argsort(at, kind="stable")
                    at = at[order]
                    if not len(at):
                        continue
                    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    docs_at, sums = at[starts], [np.add.reduceat(v[order], starts) for v in values]
                    mine = docs_at >> DOC_BITS
                    cuts = np.searchsorted(mine, np.arange(len(blocks) + 1))
                    some = np.flatnonzero(cuts[1:] > cuts[:-1])
                    ids = [(docs_at[cuts[k] : cuts[k + 1]] & ((1 << DOC_BITS) - 1)).astype("<u2").tobytes() for k in some]
                    yield made_sums(blocks[some], [b""] * len(some), ids, [b"".join(s[cuts[k] : cuts[k + 1]].tobytes() for s in sums) for k in some])

    def made_sums(blocks: np.ndarray, uids: list[bytes], ids: list[bytes], sums: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(blocks), *(pa.array(c, pa.binary()) for c in (uids, ids, sums))], names=["block", "uids", "ids", "sums"])

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up the sums of a block, whose rows follow each other."""
        at, uids, sums = None, None, np.zeros((3, 1 << DOC_BITS))
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "uids", "ids", "sums")]
            for block, u, ids, part in zip(*columns, strict=True):
                if block != at:
                    if at is not None:
                        yield made(uids, sums)
                    at, uids, sums = block, None, np.zeros((3, 1 << DOC_BITS))
                if u:
                    uids = np.frombuffer(u, np.int64)
                else:  # a score alone, or a score, a base score and the words seen; a document stands once in a row
                    ids = np.frombuffer(ids, "<u2")
                    values = np.frombuffer(part, np.float64).reshape(-1, len(ids))
                    sums[: len(values), ids] += values
        if at is not None:
            yield made(uids, sums)

    def made(uids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        score, base, seen = sums[:, : len(uids)]
        return pa.RecordBatch.from_arrays([pa.array(uids), pa.array(np.round(seen).astype(np.int64)), pa.array(base.copy()), pa.array(score.copy())], names=["uid", "n_known", "base_score", "score"])

    hot_pairs = sc.broadcast(dense)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, by_rank_, dense_ = words_of(known), known.value[2], hot_pairs.value
        base_of = np.log10((by_rank_ + 0.5) / denominator)
        none = np.zeros(len(by_rank_))
        alone_of = np.log10(probability(none, none, by_rank_, total, vocabulary, lam))
        pairs_of = np.arange(HOT * HOT)
        hot_of = np.zeros(HOT * HOT)
        real = (pairs_of // HOT < len(by_rank_)) & (pairs_of % HOT < len(by_rank_))
        some = pairs_of[real]
        hot_of[some] = np.log10(probability(dense_[some], by_rank_[some // HOT], by_rank_[some % HOT], total, vocabulary, lam))
        for batch in batches:
            for rows, texts in in_pieces(batch):
                _, r, before, doc = words.tokens(texts, end)
                mine = r != NONE
                r, before, at = r[mine].astype(np.int64), before[mine], doc[mine]
                both, alone, n = (r < HOT) & (before < HOT), before == NONE, len(texts)
                score = np.bincount(at[both], hot_of[before[both].astype(np.int64) * HOT + r[both]], n) + np.bincount(at[alone], alone_of[r[alone]], n)
                head = [batch.column(c).slice(rows[0], n) for c in ("uid", "doc_id", "train")]
                sums = [np.bincount(doc, minlength=n), np.bincount(at, by_rank_[r] > 0, n).astype(np.int64), np.bincount(at, base_of[r], n), score]
                yield pa.RecordBatch.from_arrays([*head, *map(pa.array, sums)], names=["uid", "doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    local = docs.select("uid", "doc_id", "train", "text").mapInArrow(near, "uid long, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double").withColumn("rows", F.lit(1))
    far = merged.select("p", "blocks", "sizes", "uids", "c2", "ch", "c1", "runs", "known_keys", "docs", "m").mapInArrow(rest, "block long, uids binary, ids binary, sums binary")
    far = far.repartition(max(32, int(total) // 4_000_000), "block").sortWithinPartitions("block").mapInArrow(by_document, "uid long, n_known long, base_score double, score double")
    far = far.select("uid", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("train"), F.lit(0).cast("long").alias("n_tokens"), "n_known", "base_score", "score", F.lit(0).alias("rows"))
    if rows is not None:

        def gain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """What the pairs add to a row's score beyond that behind an unseen context."""
            for batch in batches:
                c2, ch, c1, m = (batch.column(c).to_numpy() for c in ("c2", "ch", "c1", "m"))
                none = np.zeros(len(m))
                more = m * (np.log10(probability(c2, ch, c1, total, vocabulary, lam)) - np.log10(probability(none, none, c1, total, vocabulary, lam)))
                yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(more)], names=["uid", "score"])

        gains = rows.select("uid", "x", "w", "m").join(pairs, ["x", "w"]).select("uid", "m", "c2", "ch", "c1").mapInArrow(gain, "uid long, score double").groupBy("uid").agg(F.sum("score").alias("score"))
        zero = F.lit(0).cast("long")
        far = far.unionByName(gains.select("uid", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("train"), zero.alias("n_tokens"), zero.alias("n_known"), F.lit(0.0).alias("base_score"), "score", F.lit(0).alias("rows")))
    sums = local.unionByName(far).groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("train").alias("train"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score", "rows")])
    each = sums.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select(
        "doc_id", (~F.col("train")).alias("held_out"), F.expr("n_tokens div rows").alias("n_tokens"), F.expr("n_known div rows").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base_score") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score"),
    )


def op4_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a bigram model of the training part."""
    return lm_scores(table(spark, sf_dir, "documents"))
