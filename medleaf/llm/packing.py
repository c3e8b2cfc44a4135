"""Vector best-fit packing of token sequences.

A bin has three capacities: tokens, documents and attention cost (the sum of squared piece lengths). A piece goes to the
open bin that can take it under every one of them and that scores best: the smallest weighted norm of what is left
(`norm`), or the largest weighted dot product of the piece and what is left (`dot`). Pieces are taken in order of
falling length, in blocks of bounded size; the pieces of bins that a block leaves poorly filled are packed again with
those of other blocks. A piece that exceeds the cost capacity by itself has a bin of its own.

The defaults add no sequence: a bin takes as many documents as the smallest pieces of its block could fill it with, and
the cost of one full piece. What is left of them still tells bins apart that tokens alone leave equal: a piece goes where
it leaves little of all three. Smaller capacities, as a model with limits of its own would have, do cost sequences.

Nulls and empty texts are the end token alone, texts of any length are cut whole, rows that repeat are packed as often,
ties in length go by id and piece, an empty table gives an empty table; columns other than doc_id and text are not
looked at, so that none can clash.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import remembered, stored, table, utf8

BLOCK = 8192


class WordEncoder:
    """Token ids of white-space-free words, as little-endian 32-bit bytes, remembered in two generations of bounded size.

    The tokenizer lower-cases and never joins across white space, so the ids of a text are those of its words in turn. A
    mark after a letter is a token of its own, so that a word with a comma needs no more than the word and the comma. A text
    that spells a special token goes to the tokenizer whole, as it makes that one token.
    """

    MARKS = frozenset(b".,;:!?")

    def __init__(self, path: str, keep: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism; threads would spin over few words
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keep, self.young, self.old = keep, {}, {}

    def encode(self, words: list[bytes]) -> None:
        self.tokenizer.encode_special_tokens = True  # lower-casing may spell one that the text has not
        for w, e in zip(words, self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False), strict=True):
            ids = e.ids
            self.young[w] = struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: bytes | None) -> bytes:
        if text and any(t in text for t in self.special):
            self.tokenizer.encode_special_tokens = False
            ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        words = (text or b"").lower().split()
        young = self.young
        try:
            return b"".join(map(young.__getitem__, words))
        except KeyError:
            pass
        if len(young) > self.keep:
            self.old, self.young = young, (young := {})
        missing, marked, old = set(), [], self.old
        for w in set(words):
            if w in young:
                continue
            if (known := old.get(w)) is not None:
                young[w] = known
            elif len(w) > 1 and w[-1] in self.MARKS and 97 <= w[-2] <= 122:
                marked.append(w)
                for part in (w[:-1], w[-1:]):
                    if part not in young:
                        if (known := old.get(part)) is not None:
                            young[part] = known
                        else:
                            missing.add(part)
            else:
                missing.add(w)
        if missing:
            self.encode(list(missing))
        for w in marked:
            young[w] = young[w[:-1]] + young[w[-1:]]
        return b"".join(map(young.__getitem__, words))


def encoder(path: str) -> WordEncoder:
    return remembered(f"encoder {path}", lambda: WordEncoder(path))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, salt) of every document; null and empty texts are the end token alone.

    Only documents longer than the capacity are cut. salt spreads pieces over blocks whatever their ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, end, at = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes(), 0
        part = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch, "text"), strict=True):
                ids = enc.ids(text) + end
                for k in range(0, len(ids), 4 * capacity):
                    one = ids[k : k + 4 * capacity]
                    rows.append((doc_id, k // (4 * capacity), k // 4, len(one) // 4, zlib.crc32(one), part + (at := at + 1)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SHAPE, strict=True)], names=NAMES)

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, salt long")


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
SHAPE = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int, weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece. Lengths are 1 to capacity; a piece alone may exceed max_cost."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    size, scale = np.array([capacity, max_docs, max_cost], float), np.array(weights)
    left = np.empty((n, 3))  # of open bins, by place
    name = np.empty(n, np.int64)
    open_, made = 0, 0
    least = int(lengths.min()) if n else 1
    for count, i in enumerate(order):
        need = np.array([lengths[i], 1, lengths[i] ** 2], float)
        at = -1
        if open_:
            rest = left[:open_] - need
            fits = (rest >= 0).all(axis=1)
            if fits.any():
                if rule == "dot":
                    score = -((left[:open_] / size) * (need / size) * scale).sum(axis=1)
                else:
                    score = (np.square(rest / size) * scale).sum(axis=1)
                at = int(np.argmin(np.where(fits, score, np.inf)))
        if at < 0:
            at, made, open_ = open_, made + 1, open_ + 1
            left[at], name[at] = size, made - 1
        bins[i], offsets[i] = name[at], capacity - left[at, 0]
        left[at] -= need
        if left[at, 0] < least or left[at, 1] < 1 or left[at, 2] <= 0:  # closed: the last open bin takes its place
            open_ -= 1
            left[at], name[at] = left[open_], name[open_]
    return bins, offsets


def largest_crowd(lengths: np.ndarray, capacity: int) -> int:
    """How many pieces a bin can hold at most, at least 1."""
    return max(1, int(np.searchsorted(np.cumsum(np.sort(lengths)), capacity, side="right")))


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long"


def _pack_blocks(rows: DataFrame, first: int, capacity: int, max_docs: int | None, max_cost: int, rule: str) -> DataFrame:
    blocks = max(1, -(-rows.count() // BLOCK))

    def pack(block: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece", "salt"], ignore_index=True)
        lengths = part["length"].to_numpy()
        full = lengths >= capacity
        bins, offsets = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        most = largest_crowd(lengths, capacity) if max_docs is None else max_docs
        some, at = best_fit(lengths[~full], capacity, most, max_cost, rule=rule)
        bins[~full], offsets[~full] = some, at
        bins[full] = np.arange(full.sum()) + (some.max() + 1 if len(some) else 0)
        fill = np.bincount(bins, lengths).astype(np.int64)[bins]
        return part[NAMES[:5]].assign(sequence_id=first + (int(block[0]) << 24) + bins, offset=offsets, fill=fill)

    return rows.withColumn("block", F.pmod(F.xxhash64("salt"), F.lit(blocks))).groupBy("block").applyInPandas(pack, PACKED)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, max_docs: int | None = None, max_cost: int | None = None, rule: str = "norm", again_below: float = 0.98) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of docs.

    Offsets are gapless from 0 within a sequence. Rows that repeat are packed as often as they stand there; an empty
    table gives an empty table; columns other than doc_id and text are not looked at. max_docs None: no limit of its
    own (see above); max_cost None: capacity squared.
    """
    cost = capacity * capacity if max_cost is None else max_cost
    cut = stored(pieces(docs, tokenizer_path, capacity), "pieces")
    first = stored(_pack_blocks(cut, 0, capacity, max_docs, cost, rule), "packed")
    good = F.col("fill") >= int(again_below * capacity)
    rest = first.filter(~good).select(*NAMES[:5], F.xxhash64("sequence_id", "offset").alias("salt"))
    second = _pack_blocks(rest, 1 << 61, capacity, max_docs, cost, rule)
    return first.filter(good).unionByName(second).drop("fill")


def op6_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
