"""Document fingerprints by context-triggered piecewise hashing.

A hash over the last seven bytes rolls along the UTF-8 text. Where it plus one is divisible by the block size, a piece
ends; every piece gives one character of a signature. Block sizes are 3 * 2^k; a fingerprint has the signatures at a
block size chosen by the text's length and at twice that size, so that texts of similar length can be compared.

Null and empty texts have an empty fingerprint, texts of any length are read whole, by segments; rows that repeat have equal
fingerprints, an empty table gives an empty table; columns other than doc_id and text are not looked at, so that none
can clash.

Likeness of two fingerprints: at equal or neighbouring block sizes, one minus the edit distance of the signatures
(insertions and deletions) over their joint length, if they share a run of GATE characters (of a quarter of the shorter
one, if that is less); else 0. Equal fingerprints have likeness 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import table

WINDOW, LENGTH, GATE, SMALLEST = 7, 64, 4, 3
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
SEGMENT = 1 << 20


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the seven bytes that end at each place; 32 bits. Bytes before the start count as zeros."""
    c = np.concatenate([np.zeros(WINDOW - 1, np.uint32), raw.astype(np.uint32)])
    n = len(raw)
    total = np.zeros(n, np.uint32)
    shifted = np.zeros(n, np.uint32)
    for k in range(WINDOW):
        part = c[WINDOW - 1 - k : WINDOW - 1 - k + n]
        total += part * np.uint32(8 - k)
        shifted ^= part << np.uint32(5 * k)
    return total + shifted


def fingerprint(text: bytes) -> str:
    """`block size:signature:signature at twice the size`; an empty text gives `3::`. Long texts are read by segments."""
    ends, steps, sums = [], [], []
    for at in range(0, len(text), SEGMENT):
        before = min(at, WINDOW - 1)
        raw = np.frombuffer(text, np.uint8, min(SEGMENT, len(text) - at) + before, at - before)
        h = rolling(raw)[before:]
        t = h + np.uint32(1)
        cut = np.flatnonzero(t % np.uint32(SMALLEST) == 0)
        low = t[cut]
        low = low & (~low + np.uint32(1))  # the lowest bit that is set: the power of two that divides
        mixed = h * np.uint32(2654435761)
        mixed ^= mixed >> np.uint32(15)
        total = np.cumsum(mixed, dtype=np.uint32)
        sums.append(np.append(total[cut], total[-1]))
        ends.append(cut + at)
        steps.append(np.where(low == 0, 32, np.log2(np.maximum(low, 1)).astype(np.int64)))
    # running sums over the whole text, at the possible cuts and at the end
    carry, cuts_sum = np.uint32(0), []
    with np.errstate(over="ignore"):
        for s in sums:
            cuts_sum.append(s[:-1] + carry)
            carry = carry + s[-1]
    step = np.concatenate(steps) if steps else np.zeros(0, np.int64)
    running = np.concatenate(cuts_sum) if cuts_sum else np.zeros(0, np.uint32)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    k = 0
    while SMALLEST * 2**k * LENGTH < len(text):
        k += 1
    while k and (step >= k).sum() + 1 < LENGTH // 2:
        k -= 1

    def signature(at: int) -> str:
        if not len(text):
            return ""
        chosen = np.flatnonzero(step >= at)
        chosen = chosen[end[chosen] < len(text) - 1][: LENGTH - 1]
        marks = np.append(running[chosen], carry).astype(np.uint32)
        piece = np.diff(marks, prepend=np.zeros(1, np.uint32))
        piece = (piece ^ (piece >> np.uint32(13))) * np.uint32(0x85EBCA6B)
        return ALPHABET[(piece >> np.uint32(26)).astype(np.int64)].tobytes().decode()

    return f"{SMALLEST * 2**k}:{signature(k)}:{signature(k + 1)}"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of a's places in one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    v = every
    for c in b:
        u = v & places.get(c, 0)
        v = ((v + u) | (v - u)) & every
    return len(a) - v.bit_count()


def signature_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    gate = max(1, min(GATE, len(a) // 4, len(b) // 4))  # short signatures have short runs
    runs = {a[i : i + gate] for i in range(len(a) - gate + 1)}
    if not any(b[i : i + gate] in runs for i in range(len(b) - gate + 1)):
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; signatures are compared where the block sizes are equal."""
    if a == b:
        return 1.0
    size_a, one_a, two_a = a.split(":")
    size_b, one_b, two_b = b.split(":")
    x, y = int(size_a), int(size_b)
    if x == y:
        return max(signature_likeness(one_a, one_b), signature_likeness(two_a, two_b))
    if x == 2 * y:
        return signature_likeness(one_a, two_b)
    if y == 2 * x:
        return signature_likeness(two_a, one_b)
    return 0.0


def edit(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many (or all) of the next text's first."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text, bucket, guard): documents by rising id in buckets of similar numbers, each sorted within a
    partition and followed by the first document of the next bucket (guard), the last by the first of all.

    Null ids come last, in the order of their texts' hashes; ids that repeat are ordered by these, too. Texts are shuffled once; the bucket borders are
    quantiles of the ids, `parts` of them at most.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    borders = np.unique(np.array(docs.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.25 / parts) if parts > 1 else [], float))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series, h: pd.Series) -> pd.Series:
        at = np.searchsorted(borders, ids.to_numpy(dtype=float, na_value=np.nan), "right")
        last = len(borders) + 1 + 32 + (h.to_numpy() >> 58)  # rows without an id, by ranges of their hashes
        return pd.Series(np.where(ids.isna(), last, at).astype(np.int32))

    rows = docs.withColumn("h", F.xxhash64("text")).withColumn("bucket", bucket_of("doc_id", "h"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h")
    firsts = sorted((r[0], r[1]["doc_id"], r[1]["h"]) for r in rows.groupBy("bucket").agg(F.min(order)).collect())  # one row a bucket
    before = [b for b, _, _ in firsts]
    guards = [(before[k - 1], d, h) for k, (_, d, h) in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(guards or [(0, None, None)], "guards int, g_id long, g_h long")
    ahead = rows.join(F.broadcast(heads), rows["doc_id"].eqNullSafe(heads["g_id"]) & (rows["h"] == heads["g_h"]))
    ahead = ahead.select("doc_id", "text", F.col("guards").alias("bucket"), "h", F.lit(1).alias("guard"))
    both = rows.select("doc_id", "text", "bucket", "h", F.lit(0).alias("guard")).union(ahead)
    return both.repartition("bucket").sortWithinPartitions("bucket", "guard", F.col("doc_id").asc_nulls_last(), "h").drop("h")


def fingerprint_edits(docs: DataFrame, parts: int) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are; null texts count as empty. A table of
    one row has itself as the next document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out = []
            for doc_id, text, guard in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("guard").to_pylist(), strict=True):
                if guard and waiting is None:
                    continue
                raw = text.encode()
                mark = fingerprint(raw)
                if waiting is not None:
                    own_id, own, own_mark = waiting
                    edited = edit(own, text).encode()
                    edited_mark = fingerprint(edited)
                    out.append((own_id, len(own), hashlib.sha256(edited).hexdigest(), own_mark, edited_mark, likeness(own_mark, edited_mark), likeness(own_mark, mark)))
                waiting = None if guard else (doc_id, text, mark)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), TYPES, strict=True)], names=NAMES)

    return with_next(docs, parts).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def op10_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    parts = min(50_000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return fingerprint_edits(table(spark, sf_dir, "documents"), parts)
