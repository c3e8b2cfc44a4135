"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text, none of which depends on its label, language, source or id:

- lexicon densities: hits a word of a lexicon of words and word beginnings. A short list of insults is given; the rest is
  learned as those words and beginnings whose document frequency in toxic rows of the training sample is far above that
  in the others,
- second-person proximity: share of lexicon hits with a second-person word within five words,
- capitals, punctuation, repeated marks, digits, and obfuscation (letters with marks or digits between them that spell a
  lexicon word once these are taken out).

The model is fitted on the driver on at most `max_rows` labelled training rows, drawn by a hash of the id, a part of them
at a time; texts are scored in Arrow batches wherever they lie.

Null and empty texts have no features and score low, texts of any length are read whole, rows that repeat score alike, an
empty table gives an empty table; without labels of both kinds all texts score by the one that there is.
"""

from __future__ import annotations

import copy
import math
import re
import sys
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import fold, remembered, stored, table, utf8

#: Insults, and second-person words of English, German, French and Spanish.
INSULTS = "clown dirt disgusting dumb fool garbage idiot jerk loser moron pathetic scum stupid trash worthless".split()
SECOND = "du dich dir dein deine euch euer ihr sie te toi ton tu tus ustedes usted vos votre vous you your yours yourself ti tes".split()
LEET = str.maketrans("0134578@$!", "oleastbasi")
PREFIXES = (4, 5, 6, 7)
_EDGE = re.compile(r"^\W+|\W+$")
_INNER = re.compile(r"[\W_]+")
NORMAL, HIT, PREFIX_HIT, HIDDEN, SECOND_PERSON = 0, 1, 2, 3, 4
FEATURES = "hit_share prefix_share hidden_share weight_share weight_max hits_any prefix_any hidden_any near_second second_share caps_share punct_share mark_runs digit_share log_words".split()


@dataclass
class Lexicon:
    """Weights (log odds) of words and of word beginnings; words are kept with a code and a weight in a bounded memory."""

    words: dict[str, float]
    prefixes: dict[str, float]
    keep: int = 300_000
    seen: dict[bytes, int] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"words": self.words, "prefixes": self.prefixes, "keep": self.keep, "seen": {}}

    def code(self, raw: bytes) -> int:
        """code * 16 + weight in quarter steps (0 to 15)."""
        text = raw.decode("utf-8", "replace").lower()
        word = _EDGE.sub("", text)
        if word in SECOND_SET:
            return SECOND_PERSON * 16
        if (w := self.words.get(word)) is not None:
            return HIT * 16 + quarter(w)
        best = max((self.prefixes.get(word[:k], 0.0) for k in PREFIXES if len(word) > k), default=0.0)
        if best > 0:
            return PREFIX_HIT * 16 + quarter(best)
        plain = _INNER.sub("", text.translate(LEET))
        if plain != word and (w := self.words.get(plain)) is not None:
            return HIDDEN * 16 + quarter(w)
        return NORMAL

    def codes(self, words: list[bytes]) -> np.ndarray:
        seen = self.seen
        try:
            return np.frombuffer(bytes(map(seen.__getitem__, words)), np.uint8)
        except KeyError:
            pass
        if len(seen) > self.keep:
            seen.clear()
        for w in set(words):
            if w not in seen:
                seen[w] = self.code(w)
        return np.frombuffer(bytes(map(seen.__getitem__, words)), np.uint8)


SECOND_SET = frozenset(SECOND)


def quarter(weight: float) -> int:
    return max(1, min(15, round(weight * 2)))


_UP = np.zeros(256, bool)
_UP[65:91] = True
_LOW = np.zeros(256, bool)
_LOW[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def features(text: bytes | None, lexicon: Lexicon) -> np.ndarray:
    """The dense features of a text; null and empty texts give zeros."""
    out = np.zeros(len(FEATURES))
    words = (text or b"").split()
    if not words:
        return out
    packed = lexicon.codes(words)
    code, weight, n = packed >> 4, (packed & 15) / 2.0, len(words)
    hits = np.flatnonzero((code == HIT) | (code == PREFIX_HIT) | (code == HIDDEN))
    second = np.flatnonzero(code == SECOND_PERSON)
    if len(hits):
        counts = np.bincount(code, minlength=5)
        out[0:3] = counts[HIT] / n, counts[PREFIX_HIT] / n, counts[HIDDEN] / n
        out[3], out[4] = weight.sum() / n, weight.max()
        out[5:8] = math.log1p(counts[HIT]), math.log1p(counts[PREFIX_HIT]), math.log1p(counts[HIDDEN])
        if len(second):
            after = np.searchsorted(second, hits)
            near = np.minimum(np.abs(second[np.minimum(after, len(second) - 1)] - hits), np.abs(second[np.maximum(after - 1, 0)] - hits)) <= 5
            out[8] = near.mean()
    out[9] = len(second) / n
    marks = upper = lower = digits = runs = 0
    for at in range(0, len(text), 1 << 20):  # very long texts by pieces
        raw = np.frombuffer(text, np.uint8, min(1 << 20, len(text) - at), at)
        mark = _MARK[raw]
        marks, upper, lower, digits = marks + mark.sum(), upper + _UP[raw].sum(), lower + _LOW[raw].sum(), digits + _DIGIT[raw].sum()
        runs += int((mark[1:] & mark[:-1] & (raw[1:] == raw[:-1])).sum())
    out[10] = upper / max(1, upper + lower)
    out[11:14] = marks / len(text), runs / n, digits / len(text)
    out[14] = math.log1p(n)
    return out


@dataclass
class WordCounts:
    """In how many toxic and other rows words and beginnings of words stand."""

    words: tuple[Counter, Counter] = field(default_factory=lambda: (Counter(), Counter()))  # toxic, other
    prefixes: tuple[Counter, Counter] = field(default_factory=lambda: (Counter(), Counter()))
    rows: list[int] = field(default_factory=lambda: [0, 0])

    def add(self, texts: list[bytes | None], toxic: np.ndarray) -> "WordCounts":
        shared: dict[bytes, str] = {}  # one string for each word, however many texts hold it
        for text, y in zip(texts, toxic, strict=True):
            words = set()
            for raw in set((text or b"").split()):
                if (word := shared.get(raw)) is None:
                    word = shared[raw] = sys.intern(_EDGE.sub("", raw.decode("utf-8", "replace").lower()))
                words.add(word)
            self.words[0 if y else 1].update(words)
            self.prefixes[0 if y else 1].update({w[:k] for w in words for k in PREFIXES if len(w) > k})
            self.rows[0 if y else 1] += 1
        return self

    def merge(self, other: "WordCounts") -> None:
        for mine, theirs in zip((*self.words, *self.prefixes), (*other.words, *other.prefixes), strict=True):
            mine.update(theirs)
        self.rows = [a + b for a, b in zip(self.rows, other.rows, strict=True)]


def lexicon_of(counts: WordCounts, without: WordCounts | None = None, least: int = 4) -> Lexicon:
    """Given insults, plus words and beginnings that stand out in toxic rows of counts, less the rows of `without`.

    A word stands out when it is in `least` toxic rows or more and the 95 % lower bound of its log odds is over 0.5. As a
    beginning, it must also be shared by three words at least, so that a single word is not counted as a stem.
    """
    gone = without or WordCounts()
    n1, n0 = (max(1, a - b) for a, b in zip(counts.rows, gone.rows, strict=True))

    def weigh(own: tuple[Counter, Counter], other: tuple[Counter, Counter]) -> dict[str, float]:
        out = {}
        for w, a in own[0].items():
            a -= other[0].get(w, 0)
            if a >= least:
                b = own[1].get(w, 0) - other[1].get(w, 0)
                odds = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
                low = odds - 1.96 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
                if low > 0.5 or (b == 0 and odds > 2.5):
                    out[w] = odds
        return out

    words, prefixes = weigh(counts.words, gone.words), weigh(counts.prefixes, gone.prefixes)
    stems: dict[str, set[str]] = {}
    for own, other in zip(counts.words, gone.words, strict=True):
        for w, n in own.items():
            for k in PREFIXES:
                if len(w) > k and w[:k] in prefixes and len(stems.setdefault(w[:k], set())) < 3 and n > other.get(w, 0):
                    stems[w[:k]].add(w)
    prefixes = {p: v for p, v in prefixes.items() if len(stems.get(p, ())) >= 3}
    return Lexicon({**{w: 4.0 for w in INSULTS}, **words}, prefixes)


def learn_lexicon(texts: list[bytes], toxic: np.ndarray, least: int = 4) -> Lexicon:
    return lexicon_of(WordCounts().add(texts, toxic), least=least)


@dataclass
class Trees:
    """Boosted trees of fixed depth, as arrays: feature and threshold of inner nodes, value of leaves."""

    depth: int
    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.start), np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, f[node]] > t[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, least: float = 1.0, l2: float = 1.0) -> Trees:
    """Logistic gradient boosting with second-order gains on quantile cuts."""
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) if len(col) else np.zeros(1) for col in x.T]
    cuts = [np.unique(np.concatenate([c, np.quantile(col[col > 0], np.linspace(0, 1, 17)[:-1]) if (col > 0).any() else c])) for c, col in zip(cuts, x.T, strict=True)]
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)], 1)
    width = max(len(c) for c in cuts) + 1
    start = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    score, inner = np.full(len(y), start), 2**depth - 1
    feature, threshold, leaf = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, inner + 1))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first = 2**level - 1
            for k in range(first, 2 * first + 1):
                mine = np.flatnonzero(node == k)
                best = (1e-6, 0, np.inf)
                if len(mine) > 1:
                    gs, hs = g[mine], h[mine]
                    base = gs.sum() ** 2 / (hs.sum() + l2)
                    for f in range(x.shape[1]):
                        gl, hl = np.bincount(binned[mine, f], gs, width).cumsum(), np.bincount(binned[mine, f], hs, width).cumsum()
                        gr, hr = gl[-1] - gl, hl[-1] - hl
                        gain = np.where((hl >= least) & (hr >= least), gl**2 / (hl + l2) + gr**2 / (hr + l2) - base, -1)[: len(cuts[f])]
                        if len(gain) and (at := int(gain.argmax())) >= 0 and gain[at] > best[0]:
                            best = (float(gain[at]), f, float(cuts[f][at]))
                feature[r, k], threshold[r, k] = best[1], best[2]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[r, node]] > threshold[r, node])
        for k in range(inner + 1):
            mine = node == k + inner
            leaf[r, k] = -rate * g[mine].sum() / (h[mine].sum() + l2)
        score += leaf[r, node - inner]
    return Trees(depth, start, feature, threshold, leaf)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: rising knots (raw score, probability), with one pseudo-row of the base rate at each block."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of raw, sum of y, rows
    for a, b in zip(raw[order], y[order], strict=True):
        blocks.append([float(a), float(b), 1.0])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last, strict=True)]
    rate = float(y.mean()) if len(y) else 0.0
    return np.array([b[0] / b[2] for b in blocks]), np.array([(b[1] + rate) / (b[2] + 1) for b in blocks])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        x = np.stack([features(t, self.lexicon) for t in texts]) if texts else np.zeros((0, len(FEATURES)))
        raw = self.trees.raw(x)
        level = np.interp(raw, *self.knots) if len(self.knots[0]) else np.full(len(raw), 0.0)
        # steps of equal probability keep the order of the raw scores
        return np.clip(0.999 * level + 0.001 / (1 + np.exp(-raw)), 0.0, 1.0)


def fit_parts(part: Callable[[int], tuple[list[bytes | None], np.ndarray]], parts: int = 4) -> Model:
    """A model from parts of a sample, each of which is asked for twice and not kept: words are counted first, then features
    taken with a lexicon that was learned from the other parts, so that trees see densities as they are in texts the
    lexicon does not know. Each part's scores by trees of the others are kept for the calibration.
    """
    counts = [WordCounts().add(*part(k)) for k in range(parts)]
    whole = WordCounts()
    for one in counts:
        whole.merge(one)
    if 0 in whole.rows:
        return Model(Lexicon({w: 4.0 for w in INSULTS}, {}), Trees(0, -4.0 if not whole.rows[0] else 4.0, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1))), (np.zeros(0), np.zeros(0)))
    x, y, of = [np.zeros((0, len(FEATURES)))], [], []
    for k in range(parts):
        texts, toxic = part(k)
        others = lexicon_of(whole, counts[k])
        x += [features(t, others)[None] for t in texts]
        y.append(toxic.astype(float))
        of.append(np.full(len(texts), k))
    x, y, of = np.concatenate(x), np.concatenate(y), np.concatenate(of)
    raw = np.zeros(len(y))
    for k in range(parts):
        raw[of == k] = boost(x[of != k], y[of != k]).raw(x[of == k])
    return Model(lexicon_of(whole), boost(x, y), isotonic(raw, y))


def fit(texts: list[bytes | None], toxic: np.ndarray, seed: int = 5) -> Model:
    """A model from rows in memory, in four random parts."""
    of = np.random.default_rng(seed).permutation(len(texts)) % 4
    return fit_parts(lambda k: ([t for t, p in zip(texts, of, strict=True) if p == k], np.asarray(toxic)[of == k]))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 6_000, folds: int = 5, held_out: int = 0, parts: int = 4) -> Model:
    """Fits on at most `max_rows` labelled rows whose crc32(doc_id) modulo `folds` is not `held_out`.

    Rows come in the order of a hash of their ids, so that the sample does not depend on partitions. Rows without a
    label are left out; of ids that repeat, one text and label stand. The driver holds one of `parts` parts of the texts at
    a time.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(known, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = stored(rows.select("doc_id", F.encode("text", "UTF-8").alias("text"), "toxic", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(parts)).alias("part")), "toxic-sample")

    def part(k: int) -> tuple[list[bytes | None], np.ndarray]:
        found = sorted((r.doc_id, None if r.text is None else bytes(r.text), bool(r.toxic)) for r in rows.filter(F.col("part") == k).toLocalIterator())
        return [t for _, t, _ in found], np.array([y for *_, y in found], bool)

    return fit_parts(part, parts)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """Adds a column (0 to 1) to every row of docs; one of that name is replaced. Null and empty texts get the score of a
    text without features.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(model), f"model {uuid.uuid4().hex}"
    names = [c for c in docs.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a copy, whose words seen go when another operator comes
            found = remembered(name, lambda: copy.deepcopy(shared.value)).score(utf8(batch, "text"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found, pa.float64())], names=[*names, column])

    kept = docs.select(*[docs[c] for c in names])
    return kept.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + f", `{column}` double")


def op5_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
