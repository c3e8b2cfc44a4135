"""Spelling variants: words of the corpus that differ by one letter, found with bidirectional FM-indexes.

A vocabulary is a text of words, each behind a delimiter. Its index has the Burrows-Wheeler transforms of the text and of
the text of the reversed words, and holds a pattern as a pair of suffix-rank intervals of equal size, so that the pattern
can grow at either end. One error lies in one half of a word, so there are two search schemes: match the left half behind a
delimiter exactly, and extend across the right one to the next delimiter allowing one error; or the mirror image of that.
All words of a length are searched at once, with arrays of intervals.

In Spark:

1. Tasks count the words of texts, and send sums; the counts of a word are added up, and rare and short words go. What is
   held from there on is the vocabulary, whose words are distinct.
2. Every word is sent to the places where the words that can be near to it look for it: the exact half of those of its
   length, one less and one more. Words of such a place that the first scheme can reach share their beginning, those of
   the second their end. Tasks index the words of some places together, BATCH words at a time, and search those words
   whose own half it is. A place with more than MOST words is cut into parts by
   hash, and every part is searched for the words of every other.
3. Near words are counted, and the most frequent one taken, by task; partial results are combined by word.
4. Roots are found by following forms by doubled steps. A form is at least SHARE times as frequent as its word, so that the
   largest count bounds the number of steps.

Nulls, ties and repeated rows: null and empty texts have no words; a row with a null id counts as one with an empty id;
rows that repeat count as often as they stand there. Of near words that are equally frequent, the first in code-point order
is the form. An empty table gives an empty table. Texts are read whole, and a text's words are held by one task; words of any
length are found. Columns other than doc_id and text are not looked at, so that none can clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import stored, table, utf8

#: Words are of Latin-1 letters, so that one byte is one code point.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST, SHARE, EVERY = 6, 5, 5, 199
HELD, BATCH, MOST, STEP = 400_000, 60_000, 50_000, 16


def word_counts(docs: DataFrame, shortest: int = SHORTEST, every: int = EVERY) -> DataFrame:
    """(word, n) of docs (doc_id, text): lower-case runs of letters of at least `shortest` letters with their numbers of
    occurrences. A run whose hash with its document's id is a multiple of `every` lacks one letter.
    """
    find = re.compile(f"[{LETTERS}]{{{shortest},}}").findall  # greedy: such runs cannot be parts of longer ones

    def rows(counts: Counter) -> Iterator[pa.RecordBatch]:
        some = [(w, k) for w, k in counts.items() if k and len(w) >= shortest]
        for at in range(0, len(some), 50_000):
            words, ns = zip(*some[at : at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ns, pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch, "text"), strict=True):
                if not text:
                    continue
                words = find(text.lower().decode())  # of bytes, lower() changes A-Z only
                counts.update(words)
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                hashed = ((word, zlib.crc32(word.encode(), start)) for word in set(words))
                if hit := {word: h % len(word) for word, h in hashed if not h % every}:
                    for word, k in Counter(filter(hit.__contains__, words)).items():
                        counts[word] -= k
                        counts[word[: hit[word]] + word[hit[word] + 1 :]] += k
                if len(counts) > HELD:
                    yield from rows(counts)
                    counts = Counter()
        yield from rows(counts)

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Ranks:
    """How often symbols stand before a place of a transform: counts at every STEP-th place, and the symbols between."""

    def __init__(self, bwt: np.ndarray, symbols: int) -> None:
        n = -(-(len(bwt) + 1) // STEP)
        self.blocks = np.full(n * STEP, symbols, np.uint8)
        self.blocks[: len(bwt)] = bwt
        self.blocks = self.blocks.reshape(n, STEP)
        cells = (np.arange(n)[:, None] + 1) * (symbols + 1) + self.blocks
        counts = np.bincount(cells.reshape(-1), minlength=(n + 1) * (symbols + 1)).reshape(n + 1, symbols + 1)
        self.counts = np.ascontiguousarray(np.cumsum(counts[:, :symbols], axis=0, dtype=np.int32))
        self.lower = np.cumsum(self.counts, axis=1, dtype=np.int32) - self.counts
        self.first = np.r_[0, np.cumsum(np.bincount(bwt, minlength=symbols))][:symbols]

    def one(self, c: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how often symbol c, and how often smaller ones, stand before a place)."""
        block, rest = at // STEP, at % STEP
        inside = np.arange(STEP) < rest[:, None]
        some = self.blocks[block]
        same = ((some == c[:, None]) & inside).sum(axis=1)
        less = ((some < c[:, None]) & inside).sum(axis=1)
        return self.counts[block, c] + same, self.lower[block, c] + less

    def all(self, at: np.ndarray) -> np.ndarray:
        """(places, symbols): how often each symbol stands before a place."""
        block, rest = at // STEP, at % STEP
        out = self.counts[block].astype(np.int64)
        for k in range(STEP - 1):
            mine = np.flatnonzero(rest > k)
            out[mine, self.blocks[block[mine], k]] += 1
        return out


def transform(words: list[bytes]) -> np.ndarray:
    """The Burrows-Wheeler transform of the circle 0 word 0 word ..., of sorted distinct words, as bytes.

    Rotations are compared up to their next delimiter; those alike are in the order of the word behind it, which is that of
    the words. They are ranked by their first letters, and then by pairs of ranks at doubling distances.
    """
    text = np.frombuffer(b"\0" + b"\0".join(words), np.uint8)
    n, k = len(text), len(words)
    starts = np.flatnonzero(text == 0)
    word = np.repeat(np.arange(k), np.diff(np.r_[starts, n]))
    left = np.r_[starts[1:], n][word] - np.arange(n)  # letters up to the next delimiter
    behind = (word + 1) % k
    width = 7
    key = np.zeros(n, np.int64)
    padded = np.r_[text, np.zeros(width, np.uint8)]
    for j in range(width):
        key = key * 256 + np.where(left > j, padded[j : j + n], 0)
    rank = np.unique(key, return_inverse=True)[1]
    while (left > width).any():
        there = np.minimum(np.arange(n) + width, n - 1)
        key = rank * np.int64(n + 1) + np.where(left > width, rank[there] + 1, 0)
        rank, width = np.unique(key, return_inverse=True)[1], width * 2
    order = np.lexsort((behind, rank))
    return text[order - 1]


class Index:
    """A bidirectional FM-index of distinct words, given in order."""

    def __init__(self, words: list[bytes]) -> None:
        used = np.unique(np.frombuffer(b"\0" + b"".join(words), np.uint8))
        self.code = np.full(256, len(used), np.int64)  # letters of no word
        self.code[used] = np.arange(len(used))
        self.size = sum(map(len, words)) + len(words)
        backward = sorted(w[::-1] for w in words)
        self.ranks = [Ranks(self.code[transform(some)].astype(np.uint8), len(used)) for some in (words, backward)]

    def start(self, n: int) -> np.ndarray:
        """n empty patterns, as rows (rank in the text, rank in the reversed text, size)."""
        return np.tile(np.array([0, 0, self.size], np.int64), (n, 1))

    def grown(self, at: np.ndarray, c: np.ndarray, right: bool) -> np.ndarray:
        """Patterns longer by a symbol at the right end or at the left one. Size 0: not in the text."""
        out = np.zeros_like(at)
        mine = np.flatnonzero((at[:, 2] > 0) & (c < len(self.ranks[0].first)))
        ranks, near, far = self.ranks[right], 1 if right else 0, 0 if right else 1
        here, c = at[mine], c[mine]
        low, less = ranks.one(c, here[:, near])
        high, more = ranks.one(c, here[:, near] + here[:, 2])
        out[mine, near] = ranks.first[c] + low
        out[mine, far] = here[:, far] + more - less
        out[mine, 2] = high - low
        return out

    def branches(self, at: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which pattern, symbol, longer pattern) for every symbol but the delimiter that goes on at that end."""
        ranks, near, far = self.ranks[right], 1 if right else 0, 0 if right else 1
        low = ranks.all(at[:, near])
        sizes = ranks.all(at[:, near] + at[:, 2]) - low
        before = np.cumsum(sizes, axis=1) - sizes
        sizes[:, 0] = 0
        which, c = np.nonzero(sizes)
        out = np.empty((len(which), 3), np.int64)
        out[:, near] = ranks.first[c] + low[which, c]
        out[:, far] = at[which, far] + before[which, c]
        out[:, 2] = sizes[which, c]
        return which, c, out


def within_one_error(index: Index, words: list[bytes], right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(positions in words, ranks of index words) of words of one length and those that differ from them by one error in
    the right half, or in the left one, and not in the other.
    """
    length = len(words[0])
    half = length // 2
    letters = index.code[np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)]
    delimiter = np.zeros(len(words), np.int64)
    exact, across = (range(half - 1, -1, -1), range(half, length)) if right else (range(half, length), range(half - 1, -1, -1))
    at = index.start(len(words))
    for j in exact:
        at = index.grown(at, letters[:, j], not right)
    at = index.grown(at, delimiter, not right)
    q = np.flatnonzero(at[:, 2] > 0)
    at = at[q]
    wrong_q, wrong = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    for j in [*across, None]:
        which, c, more = index.branches(at, right)
        # one symbol too many, before that of place j
        wrong_q, wrong = np.r_[wrong_q, q[which]], np.r_[wrong, more]
        if j is None:
            break
        wrong = index.grown(wrong, letters[wrong_q, j], right)
        there = wrong[:, 2] > 0
        own = c == letters[q[which], j]
        # those that are still right, with the symbol missing or another one in its place
        wrong_q, wrong = np.r_[wrong_q[there], q, q[which[~own]]], np.r_[wrong[there], at, more[~own]]
        q, at = q[which[own]], more[own]
    wrong = index.grown(wrong, np.zeros(len(wrong), np.int64), right)
    there = wrong[:, 2] > 0
    # the delimiters' suffixes come first, in the order of their words
    pairs = np.unique(wrong_q[there] * np.int64(index.size) + wrong[there, 0])
    return pairs // index.size, pairs % index.size


def near_words(words: list[bytes], asked: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(positions in asked, positions in words) of near words; asked: (0 for the first scheme or 1, word). Near words that
    both schemes find are those of the first.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if words:
        index, groups = Index(words), {}
        for k, (side, w) in enumerate(asked):
            groups.setdefault((side, len(w)), []).append(k)
        for (side, length), some in groups.items():
            q, v = within_one_error(index, [asked[k][1] for k in some], side == 0)
            if side:
                half = length // 2
                new = [not words[b].startswith(asked[some[a]][1][:half]) for a, b in zip(q, v, strict=True)]
                q, v = q[new], v[new]
            found.append((np.array(some, np.int64)[q], v))
    return np.concatenate([q for q, _ in found]), np.concatenate([v for _, v in found])


PLACE = "side int, length int, half string"


def looked_up(vocabulary: DataFrame) -> DataFrame:
    """(side, length, half, i, j, split, word, n, here, asks): where words (word, n) are to be found, and where they ask. Of a
    place that is split, cell (i, j) holds the words of part i, and those of part j ask there.
    """
    n = F.length("word")
    lengths = F.filter(F.array(n - 1, n, n + 1), lambda x: x > 1)
    left = F.transform(lengths, lambda x: F.struct(F.lit(0).alias("side"), x.alias("length"), F.substring("word", F.lit(1), F.floor(x / 2).cast("int")).alias("half")))
    right = F.transform(lengths, lambda x: F.struct(F.lit(1).alias("side"), x.alias("length"), F.right("word", F.least(n, x - F.floor(x / 2).cast("int"))).alias("half")))
    rows = vocabulary.select("word", "n", F.explode(F.concat(left, right)).alias("p")).select("p.*", "word", "n", (F.length("word") == F.col("p.length")).alias("asks"))
    key = ["side", "length", "half"]
    full = rows.groupBy(*key).count().filter(F.col("count") > MOST).select(*key, F.ceil(F.col("count") / MOST).cast("int").alias("parts"))
    rows = rows.join(full, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    cell = lambda i, j, here, asks: F.struct(i.alias("i"), j.alias("j"), here.alias("here"), asks.alias("asks"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    held = F.transform(every, lambda j: cell(F.col("own"), j, F.lit(True), F.col("asks") & (j == F.col("own"))))
    asking = F.filter(F.transform(every, lambda i: cell(i, F.col("own"), F.lit(False), F.col("asks"))), lambda x: x["asks"] & (x["i"] != F.col("own")))
    return rows.select(*key, (F.col("parts") > 1).alias("split"), "word", "n", F.explode(F.concat(held, asking)).alias("c")).select(*key, "split", "word", "n", "c.*")


def variants(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of words (word, n) that are near others: how many, and the most frequent of them."""

    def solve(rows: list[tuple[int, str, int, bool, bool]]) -> pa.RecordBatch:
        held = sorted({(w.encode("latin-1"), n) for _, w, n, here, _ in rows if here})
        words, counts = [w for w, _ in held], np.array([n for _, n in held], np.int64)
        asked = [(side, w.encode("latin-1")) for side, w, _, _, asks in rows if asks]
        q, v = near_words(words, asked)
        order = np.lexsort((v, -counts[v], q))
        q, v = q[order], v[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
        columns = [[asked[k][1].decode("latin-1") for k in q[first]], np.diff(np.r_[first, len(q)]), [words[k].decode("latin-1") for k in v[first]], counts[v[first]]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)], names=["word", "n_near", "best", "best_n"])

    key = ["side", "length", "half", "i", "j"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last, alone = [], None, False
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
            columns = [batch.column(c).to_pylist() for c in ("split", "side", "word", "n", "here", "asks")]
            for place, split, *row in zip(places, *columns, strict=True):
                # whole places together; cells alone, as their words may also be there for another place
                if place != last and (split or alone or len(rows) > BATCH):
                    yield solve(rows)
                    rows = []
                last, alone = place, split
                rows.append(row)
        yield solve(rows)

    found = looked_up(vocabulary).repartition(*key).sortWithinPartitions(*key).mapInArrow(search, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.n")).alias("best_n"))


def spelling_groups(docs: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of docs (doc_id, text) that occur `least` times at least."""
    if share < 2:
        raise ValueError("a form must be more frequent than its word")
    vocabulary = stored(word_counts(docs).filter(F.col("n") >= least), "vocabulary")
    most = vocabulary.agg(F.max("n")).first()[0] or 0
    rows = vocabulary.join(variants(vocabulary), "word", "left")
    known = F.col("best_n") >= share * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(known, F.col("best")).alias("form"), F.when(known, F.col("best_n")).alias("form_n")), "forms")
    steps = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1, math.log(max(most, 1), share))))):  # as many as double the longest chain
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stored(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return rows.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent words that they may be misspellings of."""
    return spelling_groups(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
