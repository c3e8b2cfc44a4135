"""Collocations: phrases of a language that occur far more often than their parts make likely.

Texts are cut into pieces at punctuation and line ends and pieces into words. Phrases are counted by levels, as frequent
phrases have frequent parts only:

1. For each number of words, tasks add up hashes of the phrases whose shorter parts are all safe, and hash sums are added
   up. What sums to `least` or more is safe: a phrase that frequent always is, others by a collision of hashes alone.
   (Parts are looked up in tables of at most 2^SAFE_BITS bits; one that is too small for its phrases lets more through and
   never decides a result.)
2. The safe phrases with the largest sums, KEYS bytes of them, are named (by one text each that holds their hash) and go into a double-array trie that is sent to all
   tasks. A task starts a state at every word of a block of texts, advances all states together, byte by byte, and counts
   the phrases whose ends are reached. Tasks' counts are added up by blocks of phrases.
3. Safe phrases that do not fit are counted in the same pass and way, but by tries that tasks make of those which their own
   texts hold; these are rarer, and so sent by few tasks each. If all fit there are none.
4. Scores, and what longer phrases make superfluous, are joins on the counted phrases. Parts that very many phrases share
   are looked up in copies.

Texts are read once for each number of words and twice more, whatever their size. All memory is bounded: by blocks of
texts (BLOCK bytes, or one piece that is longer; TEXTS bytes of them for a trie of a task's own), by tables of HELD hashes,
and by the tries.

Nulls, ties and repeated rows: a null language is `und`, a null text empty; rows that repeat count as often as they stand
there; phrases alike in score and frequency are in the order of their bytes. An empty table gives an empty table. Columns
other than lang and text are not looked at, so that none can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf.llm.common import stored, table, utf8
from medleaf.llm.jaccard_join import bit, cells, mix, present, runs
from medleaf.llm.tables import HUB, _salt, _salted, tally

LEAST, LONGEST, INSIDE, MOST, PARTS_PER_MILLION = 10, 3, 50, 2000, 1_000_000
BLOCK, TEXTS, HELD, KEYS, SAFE_BITS, SUMS = 2 << 20, 10 << 20, 1_500_000, 2 << 20, 27, 1 << 14
GROUP = 1_000_000  # words of texts whose own counts are added up in one group
UNKNOWN = "und"
SPACE, LINE = 32, 10
#: Ends of pieces become line ends, white space within them spaces.
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
BASE = 0x9E3779B97F4A7C15  # odd
BYTES = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64)


class _Powers:
    """Powers of BASE and of its inverse, modulo 2^64, for as long as blocks have been so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            with np.errstate(over="ignore"):
                self.up, self.down = (np.multiply.accumulate(np.r_[np.ones(1, np.uint64), np.full(n, b, np.uint64)]) for b in (BASE, pow(BASE, -1, 1 << 64)))


_powers = _Powers()


class Block:
    """Texts of one language: their bytes, each word behind a space or line end and with one space behind it, and where the
    words stand.
    """

    def __init__(self, texts: list[bytes], lang: str) -> None:
        raw = np.frombuffer(b"\n" + b"\n".join(texts).lower().translate(ENDS).replace(b"\n", b" \n") + b" \n", np.uint8)
        gap = (raw == SPACE) | (raw == LINE)
        behind = np.r_[True, gap[:-1]]
        self.bytes = raw[~((raw == SPACE) & behind)]
        gap = (self.bytes == SPACE) | (self.bytes == LINE)
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.starts, self.ends = edge[::2], edge[1::2]
        self.joined = np.r_[self.starts[1:] == self.ends[:-1] + 1, False] if len(self.starts) else np.zeros(0, bool)
        self.lang = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        self._sums: np.ndarray | None = None

    def phrases(self, width: int) -> np.ndarray:
        """Whether a phrase of that many words begins at a word."""
        out = np.ones(len(self.starts), bool)
        for k in range(width - 1):
            out &= np.r_[self.joined[k:], np.zeros(min(k, len(out)), bool)]
        return out

    def hashes(self, at: np.ndarray, width: int) -> np.ndarray:
        """64-bit hashes of the phrases at some words."""
        if self._sums is None:
            _powers.reach(len(self.bytes))
            self._sums = np.r_[np.zeros(1, np.uint64), np.cumsum(BYTES[self.bytes] * _powers.up[: len(self.bytes)])]
        start = self.starts[at]
        return mix((self._sums[self.ends[at + width - 1]] - self._sums[start]) * _powers.down[start] ^ self.lang)

    def forget(self) -> None:
        """Gives up what hashes need; they can be made again."""
        self._sums = None

    def names(self, at: np.ndarray, width: int) -> list[bytes]:
        data = self.bytes.tobytes()
        return [data[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at + width - 1].tolist(), strict=True)]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Block]]:
    """(language, block) of rows (lang, text); texts longer than a block are cut at the ends of pieces."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch, "text"), strict=True):
            for piece in _cut(text or b""):
                held.setdefault(UNKNOWN if lang is None else lang, []).append(piece)
                size += len(piece) + 1
                if size > BLOCK:
                    yield from ((name, Block(texts, name)) for name, texts in held.items())
                    held, size = {}, 0
    yield from ((name, Block(texts, name)) for name, texts in held.items())


def _cut(text: bytes) -> Iterator[bytes]:
    if len(text) <= BLOCK:
        yield text
        return
    text, at = text.translate(ENDS), 0
    while at < len(text):
        end = text.find(b"\n", at + BLOCK)
        yield text[at : end if end >= 0 else len(text)]
        at = end + 1 if end >= 0 else len(text)


class _Sums:
    """Sums by hash, at most about HELD of them."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, h: np.ndarray) -> None:
        self.parts.append(np.unique(h, return_counts=True))
        self.held += len(self.parts[-1][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        h = np.concatenate([np.zeros(0, np.uint64)] + [p[0] for p in self.parts])
        n = np.concatenate([np.zeros(0, np.int64)] + [p[1] for p in self.parts])
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        start, _ = runs(h)
        return h[start], np.add.reduceat(n, start) if len(start) else n

    def full(self) -> bool:
        if self.held <= HELD:
            return False
        self.parts = [self.merged()]
        self.held = len(self.parts[0][0])
        return self.held > HELD * 2 // 3


class Safe:
    """Safe hashes of each number of words, as tables of bits sent to tasks."""

    def __init__(self) -> None:
        self.tables: list[tuple[Broadcast, int]] = []

    def add(self, hashes: DataFrame) -> None:
        """Adds a table for phrases with one more word: 32 bits or more for each hash (hash), up to 2^SAFE_BITS (16 MB)."""
        bits = int(np.clip(np.ceil(np.log2(32 * hashes.count() + 1)), 14, SAFE_BITS))
        table_of = tally(hashes, lambda b: cells(b.column("hash").to_numpy(zero_copy_only=False).view(np.uint64), bits), bits, present, few=True)
        self.tables.append((hashes.sparkSession.sparkContext.broadcast(table_of), bits))

    def phrases(self, block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(words, hashes) of phrases of a width that are safe, where they begin."""
        table_of, bits = self.tables[width - 1]
        at = np.flatnonzero(block.phrases(width))
        h = block.hashes(at, width)
        found = bit(table_of.value, cells(h, bits))
        return at[found], h[found]


def hash_sums(docs: DataFrame, width: int, safe: Safe, least: int) -> DataFrame:
    """(hash, lang, n): sums of the hashes of phrases of some width that reach `least`; with width 1 also the number of words
    of each language, without a hash.
    """

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, words = _Sums(), {}
        for lang, block in blocks(batches):
            if width == 1:
                words[lang] = words.get(lang, 0) + len(block.starts)
                keep = np.arange(len(block.starts))
            else:
                there = np.zeros(len(block.starts) + 1, bool)
                there[safe.phrases(block, width - 1)[0]] = True
                keep = np.flatnonzero(there[:-1] & there[1:] & block.phrases(width))
            sums.add(block.hashes(keep, width))
            if sums.full():
                yield from rows(*sums.merged())
                sums = _Sums()
        yield from rows(*sums.merged())
        yield made([None] * len(words), list(words), list(words.values()))

    def made(h: list | np.ndarray, langs: list, n: list | np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(langs, pa.string()), pa.array(n, pa.int64())], names=["hash", "lang", "n"])

    def rows(h: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(h), 1 << 16):
            some = h[k : k + (1 << 16)].view(np.int64)
            yield made(some, [None] * len(some), n[k : k + (1 << 16)])

    # tasks have added up already
    found = docs.mapInArrow(passed, "hash long, lang string, n long").repartition("hash", "lang").groupBy("hash", "lang").agg(F.sum("n").alias("n"))
    return stored(found.filter(F.col("hash").isNull() | (F.col("n") >= least)), "sums")


def named(docs: DataFrame, safe: Safe) -> DataFrame:
    """(hash, lang, phrase), each once, of the phrases of all widths that are safe."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for lang, block in blocks(batches):
            for k in range(len(safe.tables)):
                at, h = safe.phrases(block, k + 1)
                h, first = np.unique(h, return_index=True)
                new = [i for i, x in enumerate(h.tolist()) if x not in seen]
                h, first = h[new], first[new]
                if len(seen) + len(h) > HELD:
                    seen = set()
                seen.update(h.tolist())
                phrases = [p.decode() for p in block.names(at[first], k + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64), pa.int64()), pa.array([lang] * len(h), pa.string()), pa.array(phrases, pa.string())], names=["hash", "lang", "phrase"])

    return docs.mapInArrow(name, "hash long, lang string, phrase string").distinct()


class Trie:
    """A double-array trie of byte strings: the child of cell s by byte b is cell base[s] + b if check[that] is s."""

    def __init__(self, keys: list[bytes]) -> None:
        """keys: sorted, distinct, none empty."""
        self.keys = keys
        parents, labels, last = self._nodes(keys)
        n = len(parents) + 1
        first, count = runs(parents)
        base, cell = np.zeros(n, np.int32), np.zeros(n, np.int32)
        size = self._place(parents[first], first, count, labels, base)
        cell[1:] = base[parents] + labels
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.base[cell] = base
        self.check[cell[1:]] = cell[parents]
        order = np.argsort(cell[last])
        self.ends, self.key_of = cell[last][order].astype(np.int32), order.astype(np.int32)

    @staticmethod
    def _nodes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(parents, labels) of the nodes from 1, level by level, so that those of one parent stand together; and the last
        node of every key.
        """
        data = np.frombuffer(b"".join(keys), np.uint8)
        length = np.array([len(k) for k in keys], np.int64)
        start = np.cumsum(length) - length
        node, last = np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32)
        parents, labels, nodes, active, depth = [], [], 1, np.arange(len(keys)), 0
        while len(active):
            label = data[start[active] + depth]
            edge = node[active].astype(np.int64) * 256 + label
            new = np.r_[True, edge[1:] != edge[:-1]]
            parents.append(node[active][new])
            labels.append(label[new])
            node[active] = nodes - 1 + np.cumsum(new)
            nodes += len(labels[-1])
            depth += 1
            done = length[active] == depth
            last[active[done]] = node[active[done]]
            active = active[~done]
        return np.concatenate(parents), np.concatenate(labels), last

    @staticmethod
    def _place(parent: np.ndarray, first: np.ndarray, count: np.ndarray, labels: np.ndarray, base: np.ndarray) -> int:
        """Sets the bases of parents so that no two children share a cell, and gives the number of cells. Parents of many
        children come first; they try places at random, all at once, until they fit. Single children fill what is left.
        """
        rng = np.random.default_rng(7)
        size = len(labels) + len(labels) // 4 + 1024
        used, claim = np.zeros(size + 256, bool), np.zeros(size + 256, np.int64)
        used[0] = True  # the root
        several = np.flatnonzero(count > 1)
        for low, high in ((64, 257), (24, 64), (8, 24), (3, 8), (2, 3)):
            waiting, tries = several[(count[several] >= low) & (count[several] < high)], 0
            while len(waiting):
                tries += 1
                if tries % 64 == 0:
                    size += size // 8
                    used, claim = np.r_[used, np.zeros(size + 256 - len(used), bool)], np.zeros(size + 256, np.int64)
                at, n = rng.integers(0, size, len(waiting)), count[waiting]
                begin = np.cumsum(n) - n
                child = np.arange(n.sum()) - np.repeat(begin - first[waiting], n)
                target, mine = np.repeat(at, n) + labels[child], np.repeat(waiting, n)
                claim[target] = mine
                clash = np.logical_or.reduceat(used[target] | (claim[target] != mine), begin)
                used[target[np.repeat(~clash, n)]] = True
                base[parent[waiting[~clash]]] = at[~clash]
                waiting = waiting[clash]
        one = np.flatnonzero(count == 1)
        free = np.flatnonzero(~used[256:]) + 256
        if len(free) < len(one):
            free = np.r_[free, np.arange(len(one) - len(free)) + len(used)]
        base[parent[one]] = free[: len(one)] - labels[first[one]]
        return int(max(base.max() if len(base) else 0, len(used))) + 512

    def root(self, prefix: bytes) -> int | None:
        """The cell of a prefix, if keys have it."""
        s = 0
        for b in prefix:
            t = int(self.base[s]) + b
            if self.check[t] != s:
                return None
            s = t
        return s

    def holds(self, keys: list[bytes]) -> np.ndarray:
        """Which of some byte strings, none empty, are keys."""
        data = np.frombuffer(b"".join(keys), np.uint8)
        length = np.array([len(k) for k in keys], np.int64)
        at = np.cumsum(length) - length
        state, k, depth = np.zeros(len(keys), np.int32), np.arange(len(keys)), 0
        last = np.full(len(keys), -1, np.int32)
        while len(k):
            to = self.base[state] + data[at[k] + depth]
            there = self.check[to] == state
            state, k, depth = to[there], k[there], depth + 1
            done = length[k] == depth
            last[k[done]] = state[done]
            state, k = state[~done], k[~done]
        place = np.minimum(np.searchsorted(self.ends, last), len(self.ends) - 1)
        return self.ends[place] == last

    def count(self, data: np.ndarray, at: np.ndarray, root: int, total: np.ndarray) -> None:
        """Adds to total, by key, how often keys with the root's prefix go on in data at some places."""
        state, at = np.full(len(at), root, np.int32), at.copy()
        ends = []
        while len(state):
            b = data[at]
            to = self.base[state] + b
            there = self.check[to] == state
            state, at = to[there], at[there] + 1
            ends.append(state[b[there] == SPACE])
        found, n = np.unique(np.concatenate([np.zeros(0, np.int32), *ends]), return_counts=True)
        k = np.minimum(np.searchsorted(self.ends, found), len(self.ends) - 1)
        real = self.ends[k] == found
        total[self.key_of[k[real]]] += n[real]


def counted(docs: DataFrame, keys: list[bytes], rest: Safe | None, parts: int) -> DataFrame:
    """(lang, phrase, f) of docs (lang, text) for the phrases in keys (language, line end, words with a space behind each), and
    for those that are safe by `rest`, which are added up in `parts` groups.
    """
    trie = docs.sparkSession.sparkContext.broadcast(Trie(keys or [b"\0"]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        main, roots = trie.value, {}
        total = np.zeros(-(-len(main.keys) // SUMS) * SUMS, np.int64)
        held: list[tuple[bytes, Block, list[tuple[np.ndarray, np.ndarray]]]] = []
        size = 0
        for lang, block in blocks(batches):
            prefix = f"{lang}\n".encode()
            root = roots[lang] if lang in roots else roots.setdefault(lang, main.root(prefix))
            if root is not None:
                main.count(block.bytes, block.starts, root, total)
            if rest is None:
                continue
            found = []
            for width in range(1, len(rest.tables) + 1):
                at, h = rest.phrases(block, width)
                h, first = np.unique(h, return_index=True)
                found.append((at[first], h))
            block.forget()
            held.append((prefix, block, found))
            size += len(block.bytes)
            if size > TEXTS:
                yield from here(main, held)
                held, size = [], 0
        yield from here(main, held)
        total = total.reshape(-1, SUMS)
        for b in np.flatnonzero(total.any(axis=1)):
            yield made([int(b)], [zlib.compress(total[b].tobytes(), 1)], [None], [None])

    def here(main: Trie, held: list[tuple[bytes, Block, list[tuple[np.ndarray, np.ndarray]]]]) -> Iterator[pa.RecordBatch]:
        """Counts of phrases by a trie of a task's own; those that the trie of all counts are left out."""
        own: set[bytes] = set()
        for prefix in {p for p, _, _ in held}:
            mine = [(block, found) for p, block, found in held if p == prefix]
            for width in range(1, len(mine[0][1]) + 1):
                # each hash is named in the first block that has it
                first = np.unique(np.concatenate([found[width - 1][1] for _, found in mine]), return_index=True)[1]
                begin = 0
                for block, found in mine:
                    at = found[width - 1][0]
                    some = first[(first >= begin) & (first < begin + len(at))] - begin
                    own.update([prefix + p + b" " for p in block.names(at[some], width)])
                    begin += len(at)
        names = sorted(own)
        del own
        names = [n for n, there in zip(names, main.holds(names), strict=True) if not there] if names else names
        if not names:
            return
        trie_here = Trie(names)
        total = np.zeros(len(names), np.int64)
        for prefix, block, _ in held:
            if (root := trie_here.root(prefix)) is not None:
                trie_here.count(block.bytes, block.starts, root, total)
        del trie_here
        packed: dict[tuple[int, bytes], list[int]] = {}
        for k, name in enumerate(names):
            packed.setdefault((zlib.crc32(name) % parts, name[: name.rindex(b"\n")]), []).append(k)
        for (part, lang), some in packed.items():
            phrases = b"\n".join([names[k][len(lang) + 1 : -1] for k in some])
            yield made([part], [total[some].tobytes()], [lang.decode()], [phrases])

    def made(*columns: list | np.ndarray) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.binary(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "counts", "lang", "phrases"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[b] = sums.get(b, 0) + np.frombuffer(zlib.decompress(data), np.int64)
        for b, total in sums.items():
            k = np.flatnonzero(total)
            split = [trie.value.keys[b * SUMS + i].decode().rpartition("\n") for i in k]
            columns = [[x[0] for x in split], [x[2][:-1] for x in split], total[k]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "phrase", "f"])

    def sum_up(rows: pd.DataFrame) -> pd.DataFrame:
        sums: dict[str, dict[bytes, int]] = {}
        for lang, phrases, counts in zip(rows["lang"], rows["phrases"], rows["counts"], strict=True):
            mine = sums.setdefault(lang, {})
            for phrase, n in zip(phrases.split(b"\n"), np.frombuffer(counts, np.int64).tolist(), strict=True):
                mine[phrase] = mine.get(phrase, 0) + n
        out = [(lang, phrase.decode(), n) for lang, mine in sums.items() for phrase, n in mine.items()]
        return pd.DataFrame(out, columns=["lang", "phrase", "f"])

    found = stored(docs.mapInArrow(count, "block int, counts binary, lang string, phrases binary"), "counts")
    common = found.filter("lang is null").select("block", "counts").repartition("block").mapInArrow(add, "lang string, phrase string, f long")
    if rest is None:
        return common
    return common.union(found.filter("lang is not null").repartition(parts, "block").groupBy("block").applyInPandas(sum_up, "lang string, phrase string, f long"))


def _step() -> Column:
    """n on a scale of 8 steps for each doubling."""
    return F.floor(F.log2("n") * 8).cast("int")


def _from_step(sums: DataFrame, size: Column, most: int) -> int:
    """The least step from which on the sizes of rows (n, ...) add up to `most` at the most."""
    sizes = sums.groupBy(_step().alias("step")).agg(F.sum(size).alias("size")).orderBy(F.desc("step")).collect()  # 500 steps at most
    low, left = 1 << 20, most
    for r in sizes:
        if r["size"] > left:
            break
        low, left = r["step"], left - r["size"]
    return low


def frequencies(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of phrases of up to `longest` words with f of `least` or more, (lang, n) words of each language)."""
    docs, safe, levels = docs.select("lang", "text"), Safe(), []
    for width in range(1, longest + 1):
        levels.append(hash_sums(docs, width, safe, least))
        if width < longest:
            safe.add(levels[-1].filter("hash is not null").select("hash"))
    words = levels[0].filter("hash is null").select("lang", "n")
    levels = [sums.filter("hash is not null").select("hash", "n") for sums in levels]
    every = levels[0]
    for sums in levels[1:]:
        every = every.union(sums)
    # the most frequent phrases: as many as may fit, then, by their names, those that do
    low = _from_step(every, F.lit(1), KEYS // 16)
    common = Safe()
    for sums in levels:
        common.add(sums.filter(_step() >= low).select("hash"))
    names = stored(named(docs, common).join(every.filter(_step() >= low), "hash"), "names")
    low = max(low, _from_step(names, F.octet_length("phrase") + F.octet_length("lang") + 2, KEYS))
    chosen = names.filter(_step() >= low).select("lang", "phrase")
    keys = sorted({f"{r.lang}\n{r.phrase} ".encode() for r in chosen.collect()})  # KEYS bytes at most
    left = [sums.filter(_step() < low).select("hash") for sums in levels]
    rest = None
    if not all(hashes.isEmpty() for hashes in left):
        rest = Safe()
        for hashes in left:
            rest.add(hashes)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counted(docs, keys, rest, 1 + total // GROUP).filter(F.col("f") >= least), words


def _key(lang: Column, phrase: Column) -> Column:
    return F.concat_ws("\n", lang, phrase)  # phrases have no line ends


def _looked_up(rows: DataFrame, counts: DataFrame, key: str, name: str) -> DataFrame:
    """rows with the count of the phrase that a column names. What more than HUB rows ask for is there in copies."""
    hubs = stored(rows.groupBy(key).count().filter(F.col("count") > HUB).select(key, F.lit(True).alias("hub")), "hubs")
    rows = rows.join(hubs, key, "left").withColumn("salt", _salt("hub", "phrase")).drop("hub")
    return rows.join(_salted(counts.select(F.col("key").alias(key), F.col("f").alias(name)), hubs, key), [key, "salt"]).drop(key, "salt")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best `most` phrases of 2 to `longest` words of every language of docs
    (lang, text).

    A phrase of frequency a scores a million a^2 / (l r), rounded down, by its cut into two parts, of frequencies l and r,
    that gives the least. It goes if it stands in a longer phrase that is at least `inside` percent as frequent.
    """
    counts, words = frequencies(docs, longest, least)
    counts = stored(counts.withColumns({"key": _key(F.col("lang"), F.col("phrase")), "words": F.split("phrase", " ")}), "frequencies")
    phrases = counts.filter(F.size("words") > 1).select("lang", "phrase", "words", F.col("f").alias("a"))
    part = lambda start, n: _key(F.col("lang"), F.array_join(F.slice("words", start, n), " "))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    cuts = _looked_up(_looked_up(cuts, counts, "first", "l"), counts, "rest", "r")
    score = F.expr(f"cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast({PARTS_PER_MILLION} as decimal(7,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # all shorter phrases in a phrase, each once
    size = F.size("words")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))))
    longer = phrases.filter(size > 2).select("lang", "a", F.explode(F.array_distinct(spans)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (100 * F.col("most") < inside * F.col("a")))
    order = W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    top = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return top.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op13_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of two or three words of every language of the documents."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT lang, unnest(string_split_regex(x, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
s AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w FROM p),
tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM s GROUP BY lang HAVING sum(len(w)) > 0),
g AS (SELECT lang, k, phrase, count(*) AS f FROM (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM s, (VALUES (1), (2), (3)) AS ks(k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 10),
w AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE k > 1),
cuts AS (SELECT lang, phrase, k, f, ws, c, array_to_string(ws[1:c], ' ') AS a1, array_to_string(ws[c + 1:], ' ') AS a2 FROM w, (VALUES (1), (2)) AS cs(c) WHERE c < k),
sc AS (SELECT cuts.lang, cuts.phrase, cuts.k, cuts.f AS a, ws, c, x.f AS l, y.f AS r, (1000000::HUGEINT * cuts.f * cuts.f // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN g x ON x.lang = cuts.lang AND x.phrase = a1 AND x.k = c JOIN g y ON y.lang = cuts.lang AND y.phrase = a2 AND y.k = cuts.k - c),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner2 AS (SELECT lang, q, max(a) AS most FROM (SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS q FROM b WHERE k = 3) GROUP BY lang, q),
kept AS (SELECT b.* FROM b LEFT JOIN inner2 i ON i.lang = b.lang AND i.q = b.phrase AND b.k = 2 WHERE most IS NULL OR 100 * most < 50 * a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN tot USING (lang) WHERE rank <= 2000"""
