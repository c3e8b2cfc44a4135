"""Media, language model, toxicity, archives, web pages and the pipeline."""

from __future__ import annotations

import hashlib
import json
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from medleaf.llm import html_text as H
from medleaf.llm import interpolated_lm as LM
from medleaf.llm import mpeg_audio as A
from medleaf.llm import registry
from medleaf.llm import toxicity as T
from medleaf.llm import warc as WA

TEXTS = [None, "", " ", "\xff é中\n", "x" * 191, "y" * 192, "z" * 193, "A word, A WORD\tand\x0bmore", "long text " * 60_000, "A word, A WORD\tand\x0bmore"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k if k else None, t, "en", "s", 1, b"clash", 0.5, True, 1) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, media binary, score double, train boolean, uid int")


# --- media


def test_media_round_trip(spark, docs):
    got = {r.doc_id: r for r in A.media_features(A.store_media(docs)).collect()}
    assert len(got) == len(TEXTS)
    for k, t in enumerate(TEXTS):
        r, raw = got[k if k else None], (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        media = A.encode(payload, len(raw))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest()) and r.bad_checksums == r.lost_bytes == 0
        feature = json.loads(r.feature)
        n, d = map(int, feature["duration"].split("/"))
        assert n * 32000 == d * 1152 * len(r.frame_offsets) and feature["frames"] == feature["vbr_frames"] == len(r.frame_offsets)
        assert all(media[o : o + 2] == b"\xff\xfa" for o in r.frame_offsets)
    assert got[7].feature == got[9].feature and got[7].media_sha256 == got[9].media_sha256
    assert A.media_features(A.store_media(docs.limit(0))).count() == 0


def test_crc_and_lengths():
    assert A.crc16(b"123456789") == 0xAEE7  # the checksum of the usual check text for polynomial 0x8005 from 0xFFFF
    assert A.frame_length(14, 2, 0) == 1440 and A.frame_length(9, 0, 1) == 418 and A.frame_length(5, 1, 0) == 192


def test_resynchronisation():
    payload = bytes(range(32, 127)) * 90 + b" " * (-95 * 90 % 192)
    media = A.encode(payload)
    whole = A.decode(media)
    assert whole["payload"] == payload and whole["vbr"]["bytes"] == len(media) - whole["offsets"][0] - 128 + A.frame_length(5, 2, 0)
    third = whole["offsets"][2]
    junk = media[:third] + b"\xff\xfa\x00junk\xff\xfb" + media[third:]
    again = A.decode(junk)
    assert again["payload"] == payload and again["lost_bytes"] == 9 and len(again["offsets"]) == len(whole["offsets"])
    flipped = bytearray(media)
    flipped[third + 10] ^= 1  # side information
    assert A.decode(bytes(flipped))["bad_crc"] == 1
    assert A.decode(media[: third + 100])["payload"] == payload[: 2 * (1440 - 23)]
    assert A.decode(b"")["payload"] == b"" and A.decode(b"not audio \xff\xfb at all")["offsets"] == []


def audio_frame(version, rate, hertz, stereo, protected, fill=b"", padding=0):
    """A silent Layer III frame made by hand; fill lies behind the side information."""
    bits = {1: 3, 2: 2, 2.5: 0}[version]
    head = bytes([0xFF, 0xE0 | bits << 3 | 1 << 1 | (not protected), rate << 4 | hertz << 2 | padding << 1, 0x00 if stereo else 0xC0])
    kbits = (A.RATES if version == 1 else A.LOW_RATES)[rate]
    hz = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}[version][hertz]
    length = (144 if version == 1 else 72) * kbits * 1000 // hz + padding
    side = {(1, False): 17, (1, True): 32}.get((version, stereo), 17 if stereo else 9)
    crc = A.crc16(head[2:] + bytes(side)).to_bytes(2, "big") if protected else b""
    body = head + crc + bytes(side) + fill
    return body + bytes(length - len(body))


@pytest.mark.parametrize("stereo", [False, True])
@pytest.mark.parametrize("protected", [False, True])
@pytest.mark.parametrize(("version", "samples", "hz"), [(1, 1152, 44100), (2, 576, 22050), (2.5, 576, 11025)])
def test_frames_of_every_kind(version, samples, hz, stereo, protected):
    frames = [audio_frame(version, rate, 0, stereo, protected, b"x" * rate, rate % 2) for rate in (8, 9, 10, 8)]
    found = A.decode(b"".join(frames))
    assert found["offsets"] == [sum(map(len, frames[:k])) for k in range(4)] and (found["bad_crc"], found["lost_bytes"], found["hertz"]) == (0, 0, hz)
    from fractions import Fraction

    assert Fraction(*found["duration"]) == Fraction(4 * samples, hz)
    again = A.decode(frames[0] + b"\xff\x00 lost" + b"".join(frames[1:]))
    assert len(again["offsets"]) == 4 and again["lost_bytes"] == 7
    if protected:
        broken = bytearray(b"".join(frames))
        broken[len(frames[0]) + 8] ^= 4
        assert A.decode(bytes(broken))["bad_crc"] == 1


@pytest.mark.parametrize("stereo", [False, True])
def test_tables_of_both_kinds(stereo):
    audio = [audio_frame(1, 9, 0, stereo, False) for _ in range(5)]
    size = len(audio[0]) * 6
    xing = audio_frame(1, 9, 0, stereo, False, b"Xing" + (3).to_bytes(4, "big") + (5).to_bytes(4, "big") + size.to_bytes(4, "big"))
    found = A.decode(xing + b"".join(audio))
    assert (found["vbr"]["kind"], found["vbr"]["frames"], found["vbr"]["bytes"], found["table_agrees"], len(found["offsets"])) == ("Xing", 5, size, True, 5)
    assert A.decode(xing + b"".join(audio[1:]))["table_agrees"] is False
    bare = audio_frame(1, 9, 0, stereo, False, b"Info" + (0).to_bytes(4, "big"))
    assert A.decode(bare + b"".join(audio))["table_agrees"] is True
    vbri = bytearray(audio_frame(1, 9, 0, stereo, False))
    vbri[36 : 36 + 30] = b"VBRI" + bytes(6) + size.to_bytes(4, "big") + (5).to_bytes(4, "big") + b"\0\2\0\3\0\2\0\1" + b"\0\7\1\0"
    found = A.decode(bytes(vbri) + b"".join(audio))
    assert (found["vbr"]["kind"], found["vbr"]["toc"], found["table_agrees"]) == ("VBRI", [21, 768], True)


def test_tags_of_every_version():
    audio = audio_frame(1, 9, 0, True, True)
    long = "v" * 300
    raw = b"\x00key\x00" + long.encode()

    def tag(version, body, flags=0):
        return b"ID3" + bytes([version, 0, flags]) + A.synchsafe(len(body)) + body

    frames = {
        2: b"TXX" + len(raw).to_bytes(3, "big") + raw, 3: b"TXXX" + len(raw).to_bytes(4, "big") + b"\0\0" + raw, 4: b"TXXX" + A.synchsafe(len(raw)) + b"\0\0" + raw,
    }
    for version, body in frames.items():
        data = tag(version, body + bytes(20)) + audio
        found = A.decode(data)
        assert found["fields"]["key"] == long and found["offsets"] == [len(data) - len(audio)] and found["lost_bytes"] == 0
    wide = b"\x01" + "k\0\u20acx".encode("utf-16")
    assert A.decode(tag(3, b"TXXX" + len(wide).to_bytes(4, "big") + b"\0\0" + wide + b"TIT2\0\0\0\3\0\0\0ab") + audio)["fields"] == {"k": "\u20acx", "TIT2": "ab"}
    split = b"\x00key\x00\xff\x00\xe0"  # as it stands in an unsynchronised tag
    assert A.decode(tag(3, b"TXXX" + (len(split) - 1).to_bytes(4, "big") + b"\0\0" + split, 0x80) + audio)["fields"] == {"key": "\xff\xe0"}
    assert A.decode(tag(4, b"TXXX" + A.synchsafe(len(split)) + b"\0\2" + split) + audio)["fields"] == {"key": "\xff\xe0"}
    assert A.decode(tag(3, b"\0\0\0\6" + bytes(6) + frames[3], 0x40) + audio)["fields"] == {"key": long}


LONG = "This is a long paragraph of the main text with a good many words in it, so that sums rise. " * 2
PARA, LINE = f"<p>{LONG}</p>", LONG.strip()


@pytest.mark.parametrize(("page", "want"), [
    (f"<article><h2 class='related'>Related work</h2>{PARA}<h2 id='share-prices'>Share prices</h2>{PARA}</article>", ["Related work", LINE, "Share prices", LINE]),
    (f"<article>{PARA}<p class='ad'>Buy now<p>{LONG}<p>{LONG}</article>", [LINE, LINE, LINE]),
    (f"<div>{PARA}<p class='ad'>Buy now<p>{LONG}<p>{LONG}</div>", [LINE, LINE, LINE]),
    (f"<article>{PARA}<p class='ad'>Buy now</article><p>short", [LINE]),
    (f"<div><article>{PARA}<div class='ad'>Buy now</article></div><article>{PARA}</article>", [LINE, LINE]),
    (f"<article><p>{LONG} the <label>name</label> of it</p></article>", [LINE + " the name of it"]),
    (f"<head><title>x</title><article>{PARA}</article>", [LINE]),
    (f"<article><p>if a<b then c>d {LONG}</p></article>", ["if a<b then c>d " + LINE]),
    (f"<div>{PARA}{PARA}<div class='ad'>Buy</div><p>The end.</p></div><footer>f</footer>", [LINE, LINE, "The end."]),
    (f"<div>{PARA}<ul><li>one</li><li><a href='x'>A linked item</a></li><li>three</li></ul>{PARA}</div>", [LINE, "one", "A linked item", "three", LINE]),
    (f"<div>{PARA}<ul><li><a href='x'>Home</a></li><li><a href='y'>News</a></li></ul></div>", [LINE]),
    (f"<main>{PARA}</main><article>{PARA}<p>also</p></article>", [LINE, LINE, "also"]),
    (f"<ul class='menu'><li>x<li>y</ul><div>{PARA}</div>", [LINE]),
])
def test_pages_that_are_easily_cut(page, want):
    assert H.main_text(f"<html><body>{page}</body></html>").split("\n\n") == want


# --- language model


def plain_model(rows, dictionary=None):
    """Counts, weights and scores of a small corpus, token by token."""
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    train = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1 for i, _ in rows]
    c1, c2 = Counter(), Counter()
    for ts, use in zip(tokens, train, strict=True):
        if use:
            c1.update(ts)
            c2.update(zip([None, *ts[:-1]], ts, strict=True))
    return tokens, train, c1, c2


def test_language_model_against_counting(spark, docs):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{min(int(x), 400)}" for x in rng.zipf(1.3, rng.integers(0, 80)))) for k in range(200)] + [(None, "w1 w2"), (7, "w1 w2"), (7, "w1 w2"), (500, None), (501, ""), (502, "never seen before")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("train", F.lit("clash"))
    for dictionary in (LM.DICTIONARY, LM.HOT + 30):  # all words in the dictionary; most words outside
        learned: dict = {}
        got = sorted(LM.lm_scores(df, dictionary, learned).collect(), key=repr)
        lam = learned["weights"]
        assert len(got) == len(rows)
        tokens, train, c1, c2 = plain_model(rows)
        total, vocabulary = sum(c1.values()), len(c1)
        by = {}
        for r in got:
            by.setdefault((r.doc_id, r.n_tokens), []).append(r)
        for (i, _), ts, use in zip(rows, tokens, train, strict=True):
            r = by[i, len(ts)][0]
            assert r.held_out == (not use) and r.train_tokens == total and r.n_known == sum(c1[t] > 0 for t in ts)
            assert r.base_score == pytest.approx(sum(math.log10((c1[t] + 0.5) / (total + 0.5 * (vocabulary + 1))) for t in ts))
            score, before = 0.0, None
            for t in ts:
                w = lam[1 + int(math.log2(c1[before])) if c1[before] else 0]
                score += math.log10(w[0] * c2[before, t] / max(c1[before], 1) + w[1] * c1[t] / total + w[2] / (vocabulary + 1))
                before = t
            assert r.score == pytest.approx(score)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 1.2


def test_rare_contexts_keep_their_bigrams(spark):
    """Scores do not depend on how many words are sent to all tasks."""
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(w for x in rng.integers(0, 900, rng.integers(0, 60)) for w in (f"a{x}", f"b{x}" if x % 3 else "the"))) for k in range(150)]
    rows += [(None, "a1 b1 a2 b2"), (7, "a1 b1"), (7, "a1 b1"), (8, None), (9, "unseen a4 b4 unseen b5")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole, less = ([tuple(r) for r in LM.lm_scores(df, dictionary).collect()] for dictionary in (LM.DICTIONARY, LM.HOT + 30))
    whole, less = sorted(whole, key=repr), sorted(less, key=repr)
    assert len(whole) == len(rows) and [r[:5] for r in whole] == [r[:5] for r in less]
    assert [r[5:] for r in less] == [pytest.approx(r[5:]) for r in whole]


def test_probabilities_sum_to_one():
    lam = LM.learn(np.array([(b * LM.LEVELS + a) * LM.LEVELS + c for b in (0, 3, 4) for a in ((0,) if b == 0 else (0, 5, 9)) for c in (0, 12, 20)]), np.arange(1, 22), 9)
    assert np.allclose(lam.sum(axis=1), 1) and (lam[:, 2] > 0).all() and lam[0, 0] == 0
    c1, c2 = np.array([5, 3, 2, 0, 0, 0, 0, 0, 0, 0]), np.array([2, 0, 1, 0, 0, 0, 0, 0, 0, 0])  # nine words and the unknown one
    for ch, pair in ((3, c2), (0, c2 * 0)):
        assert LM.probability(pair, np.full(10, ch), c1, 10, 9, lam).sum() == pytest.approx(1)


def test_weights_learn_what_predicts():
    """Where pairs always predict, the pair's weight rises; where they never do, it falls."""
    cell = lambda q2, q1: (4 * LM.LEVELS + int(LM.level(np.array(q2)))) * LM.LEVELS + int(LM.level(np.array(q1)))
    good = LM.learn(np.array([cell(0.9, 0.001)]), np.array([1000]), 100)[4]
    bad = LM.learn(np.array([cell(0.0, 0.01)]), np.array([1000]), 10_000)[4]
    assert good[0] > 0.9 and bad[0] < 0.01 and bad[1] > 0.9


def test_planes():
    x = np.array([0, 1, 255, 256, 2**40 - 1, 2**40], np.uint64)
    assert (LM.unplanes(LM.planes(x, 7), 7) == x).all() and len(LM.unplanes(LM.planes(x[:0], 3), 3)) == 0


@pytest.mark.parametrize("texts", [[None], [b"", None, b" \n"], ["A b\x0bB\x0ca\x1ca\x85é É\0 \t\r\nword".encode(), b"a", None, b" b ", b"A\xff b"]])
def test_words_are_those_of_split(texts):
    words = [(t or b"").lower().split() for t in texts]
    hashes, place, sizes = LM.spelled(texts)
    assert sizes.tolist() == [len(w) for w in words]
    assert hashes[place].tolist() == LM.hash_of([w for some in words for w in some]).tolist() and len(set(hashes.tolist())) == len(hashes)
    assert [len(x) for x in LM.Words(np.zeros(0, np.uint64), np.zeros(0, np.uint32)).tokens(texts)] == [sum(sizes) + len(texts)] * 4


def test_language_model_of_nothing(spark):
    assert LM.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert LM.lm_scores(spark.createDataFrame([(1, None)], "doc_id long, text string")).first().n_tokens == 1


# --- toxicity


@pytest.fixture(scope="module")
def toxic_scores(spark):
    folder = f"{DATA}/sf0.01"
    return registry.queries()["op5_boosted_toxicity"](spark, folder).toPandas().merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")


def test_toxicity_on_held_out_rows(toxic_scores):
    held = toxic_scores[toxic_scores.held_out]
    assert set(held.held_out) == {True} and held.score.between(0, 1).all()
    wrong = (held.predicted != held.toxic).mean()
    assert wrong < 0.06 and ((held.score - held.toxic) ** 2).mean() < 0.06


def test_toxicity_of_messy_rows(spark, docs):
    texts = [b"you are an idiot moron", b"plain text here"] * 60
    model = T.fit(texts, np.array([True, False] * 60))
    out = T.score(docs.drop("score"), model).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 for r in out) and "media" in out[0].asDict()
    by = {r.doc_id: r.score for r in out}
    assert by[1] == by[2] == by[None] and by[7] == by[9] and by[1] < 0.5
    assert model.score([b"What an i.d.i.o.t, M0r0n you IDIOT"])[0] > 0.5 and T.score(docs.limit(0), model).count() == 0
    assert 0 <= T.fit([], np.zeros(0, bool)).score([b"x", None])[0] < 0.5 and T.fit([b"a"], np.ones(1, bool)).score([None])[0] <= 1


def test_lexicon_learns_words_and_beginnings():
    texts = [f"aa bb zork{k % 5} vile".encode() for k in range(30)] + [f"aa bb cc{k}".encode() for k in range(90)]
    found = T.learn_lexicon(texts, np.array([True] * 30 + [False] * 90))
    assert "vile" in found.words and "zork" in found.prefixes and "aa" not in found.words
    x = T.features(b"You vile, vile zork9 person!!", found)
    named = dict(zip(T.FEATURES, x, strict=True))
    assert named["hit_share"] == pytest.approx(2 / 5) and named["prefix_share"] == pytest.approx(1 / 5) and named["near_second"] == 1 and named["mark_runs"] > 0


def test_boosting_takes_the_best_cut():
    """One round of one cut, against every cut of every feature."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(60, 3)), 1)
    y = (x[:, 1] + rng.normal(size=60) > 0.4).astype(float)
    start = math.log((y.sum() + 1) / (60 - y.sum() + 1))
    p = 1 / (1 + math.exp(-start))
    g, h = p - y, np.full(60, p * (1 - p))

    def gain(f, t):
        left = x[:, f] <= t
        if h[left].sum() < 1 or h[~left].sum() < 1:
            return -1.0
        return sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1)

    trees = T.boost(x, y, rounds=1, depth=1, bins=60)
    best = max(gain(f, t) for f in range(3) for t in np.unique(x[:, f]))
    f, t = int(trees.feature[0, 0]), float(trees.threshold[0, 0])
    assert gain(f, t) == pytest.approx(best, rel=0.02) and f == 1
    left = x[:, f] <= t
    assert trees.leaf[0] == pytest.approx([-0.15 * g[m].sum() / (h[m].sum() + 1) for m in (left, ~left)])
    assert trees.raw(x) == pytest.approx(start + np.where(left, *trees.leaf[0]))


def test_lexicons_without_a_part():
    texts = [f"aa bb zork{k % 5} vile x{k % 3}".encode() for k in range(30)] + [f"aa bb cc{k} x1".encode() for k in range(90)]
    toxic, of = np.array([True] * 30 + [False] * 90), np.arange(120) % 4
    part = lambda k: ([t for t, p in zip(texts, of, strict=True) if p == k], toxic[of == k])
    counts = [T.WordCounts().add(*part(k)) for k in range(4)]
    whole = T.WordCounts()
    for one in counts:
        whole.merge(one)
    for k in range(4):
        others = T.learn_lexicon([t for t, p in zip(texts, of, strict=True) if p != k], toxic[of != k])
        assert T.lexicon_of(whole, counts[k]) == others


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    raw = rng.normal(size=400)
    knots, level = T.isotonic(raw, (rng.random(400) < 1 / (1 + np.exp(-raw))).astype(float))
    assert (np.diff(knots) > 0).all() and (np.diff(level) >= -1e-9).all()


# --- archives


def test_archives_of_messy_rows(spark):
    big = "".join(f"<p>{k}</p>" for k in range(9000))
    pages = [(3, "http://a", big), (1, None, big), (2, "u\r\nx", "x" * 100), (5, "u", "x" * 100), (6, "u", "short"), (7, "u", "short"), (8, "u", None), (9, "u", ""), (None, "u", big), (10, "u", "é" * 4096), (11, "u", "WARC/1.1\r\n\r\n" * 2000)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, archive int").repartition(3)
    archives = WA.write_archives(df, segment_bytes=1000, archive_bytes=5000)
    assert archives.count() > 3
    got = WA.read_archives(archives).collect()
    assert len(got) == len(pages) and all(r.problem is None for r in got)
    by = {r.page_id: r for r in got}
    for i, _, html in pages:
        raw = (html or "").encode()
        assert (by[i].payload_bytes, by[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert by[i].payload is None if by[i].record_type == "revisit" else bytes(by[i].payload) == raw
    assert {i: r.refers_to for i, r in by.items() if r.record_type == "revisit"} == {3: 1, None: 1, 5: 2} and by[1].segments > 50 and by[3].segments == 1
    assert WA.read_archives(WA.write_archives(df.limit(0))).count() == 0


def test_files_and_broken_archives(spark, tmp_path):
    page = spark.createDataFrame([(1, "u", "abc" * 2000)], "page_id long, url string, html string").coalesce(1)
    content = bytes(WA.write_archives(page, segment_bytes=1000).first().content)
    pieces = [WA.record(f["warc-type"], f["warc-record-id"][10:-1], b, {k: v for k, v in f.items() if k not in ("warc-type", "warc-record-id", "content-length", "warc-date")}) for f, b, _ in WA.parse(content)]
    (tmp_path / "b.warc.gz").write_bytes(b"".join(reversed(pieces)))  # out of order
    files = spark.read.format("binaryFile").load(str(tmp_path)).withColumnRenamed("path", "archive")
    whole = WA.read_archives(files).first()
    assert whole.problem is None and bytes(whole.payload) == b"abc" * 2000
    make = lambda parts: WA.read_archives(spark.createDataFrame([("a", b"".join(parts))], "archive string, content binary")).first().problem
    assert make(pieces[:2] + pieces[3:]) == "segment missing" and make(pieces[:-1]) == "length differs from total" and make(pieces[:1]) == "length differs from total"


def test_damaged_records_are_reported(spark):
    """One bad record costs no other."""
    good = WA.record("response", "a", WA.http_message(b"abc"), {"X-Page-ID": "-7", "WARC-Payload-Digest": "sha256:" + hashlib.sha256(b"abc").hexdigest()})
    plain = zlib.decompress(good, 31)
    cases = {
        "header cut short": plain + b"WARC/1.1\r\nContent-Le", "content length missing": b"WARC/1.1\r\nWARC-Type: response\r\n\r\n" + plain, "record cut short": plain + plain[:-10],
        "archive cut short": good + good[:-20], "archive damaged": good[:40] + b"\0\0\0" + good[43:] + good, "revisit of nothing": plain + zlib.decompress(WA.record("revisit", "b", b"HTTP/1.1 200 OK\r\n\r\n", {"WARC-Payload-Digest": "sha256:00"}), 31),
        "digest differs": plain + plain.replace(b"abc", b"abd"), "chunk size expected": plain + zlib.decompress(WA.record("response", "c", b"H\r\nTransfer-Encoding: chunked\r\n\r\n-3\r\nabc", {}), 31),
    }
    for problem, content in cases.items():
        found = WA.read_archives(spark.createDataFrame([("a", content)], "archive string, content binary")).collect()
        assert sorted(str(r.problem) for r in found) == sorted(["None", problem]), problem
        whole = next(r for r in found if r.problem is None)
        assert (whole.page_id, bytes(whole.payload), whole.payload_bytes) == (-7, b"abc", 3)


@pytest.mark.parametrize("block", [b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc", b"no end", b"H\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabcd\r\n0\r\n\r\n"])
def test_broken_framing(block):
    with pytest.raises(ValueError):
        WA.http_payload(block)


def test_framing():
    assert WA.http_payload(WA.http_message(b"x" * 5000, 7)) == b"x" * 5000 and WA.http_payload(b"H\r\n\r\nplain") == b"plain"
    assert WA.http_payload(b"H\r\ntransfer-encoding: Chunked\r\n\r\nA;ext=1\r\n0123456789\r\n0\r\n\r\n") == b"0123456789"


def test_archives_as_sql(spark):
    folder = f"{DATA}/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = con.sql(registry.oracle_sql()["op8_segment_reassembly"]).fetchall()
    got = registry.queries()["op8_segment_reassembly"](spark, folder).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


# --- web pages

ARTICLE = "<article class='post has-ads'><header><h1>A &amp; B</h1></header><p>First <b>bold</b>\n text &copy; 2&nbsp;3.<br><p>Of.<div class='ad-slot'>Buy now</div><ul><li>one<li>two</ul><section id=comments><p>Nice post!</p></section><p>Last.</article>"


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p>a < b & c &lt; d", "a < b & c < d"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    (f"<html><head><title>t</title><script>var a='<p>no</p>';</script></head><body><nav><a href='/'>Home</a></nav><div class='sidebar'><div>x</div>side</div><!-- <p>c</p> -->{ARTICLE}<aside>more</aside><form>name<input></form><footer>foot</footer></body></html>",
     "A & B\n\nFirst bold text © 2 3.\n\nOf.\n\none\n\ntwo\n\nLast."),
    ("<body><header>Site</header><div id='menu'>m</div><div class='content'><p>" + "word " * 40 + "</p><p>short</p></div><div class='cookie-notice'>We use cookies</div><footer>f</footer>", ("word " * 40).strip() + "\n\nshort"),
    ("<article><p>cut off &am", "cut off &am"), ("<article><p title=\"a>b\">quoted</p><p title=\"bad>half", "quoted\n\nhalf"), ("<ARTICLE><P>upper</P></ARTICLE><script>unclosed <p>no", "upper"),
])
def test_main_text(page, text):
    assert H.main_text(page) == text


LONG = ("word " * 40).strip()


@pytest.mark.parametrize(("page", "text"), [
    (f"<article>Teaser one</article><article>Teaser two</article><div class='content'><p>{LONG}</p><p>short</p></div><article>Teaser</article>", f"{LONG}\n\nshort"),
    (f"<div><p>{LONG}</p></div><article class='comment odd'><p>{LONG} no</p></article><article id=comment-2><p>{LONG} no</p></article>", LONG),
    (f"<aside><article><p>{LONG} no</p></article> no</aside><div><p>{LONG}</p></div><footer><main>{LONG} no</main></footer>", LONG),
    (f"<article><p>One</p><aside><article>{LONG} no</article></aside><p>Two</p></article>", "One\n\nTwo"),
    (f"<nav>menu<article><p>{LONG}</p></article>", LONG), (f"<div class='has-sidebar'><article><p>{LONG}</p></article></div>", LONG),
    (f"<article class='related'><p>{LONG}", LONG), ("<article>" + "a" * 50 + "</article><div>" + "b" * 90 + "</div>", "a" * 50 + "\n\n" + "b" * 90),
])
def test_lengths_choose_the_text_beside_articles(page, text):
    assert H.main_text(page) == text


def test_pages_keep_their_articles(spark):
    """Every block of the article and nothing else, on all given pages."""
    import html
    import re

    folder = f"{DATA}/sf0.01"
    got = {r.page_id: r for r in registry.queries()["op9_line_blocks"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?(?:b|a|i|em)\b[^>]*>|<br>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in re.split(r"</?(?:p|h1|ul|li|div)\b[^>]*>", article)]
        assert got[r.page_id].text == "\n\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_pages_of_messy_rows(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>" + "x " * 100_000, 2), (1, "u", "a", 3)], "page_id long, url string, html string, text int")
    assert Counter((r.page_id, r.n_chars) for r in H.extract(df).collect()) == {(None, 0): 1, (1, 199_999): 1, (1, 1): 1} and H.extract(df.limit(0)).count() == 0


# --- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    larger = f"{DATA}/sf0.01"  # enough labels to learn from
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    one = P.STAGES[0][1](spark, docs, larger)
    kept = {r.doc_id for r in one.collect()}
    clean = {i for i, t in labels.items() if t == 0}
    assert one.columns == docs.columns and len(clean - kept) <= 0.02 * len(clean) and sum(labels.get(i) == 1 for i in kept) <= 0.3 * sum(labels.values())
    folder = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    again = docs.union(docs.limit(5)).union(spark.createDataFrame([(None, "x y z v w", "en", "s", 1)] * 2 + [(9001, None, None, None, None)], docs.schema))
    two = P.STAGES[1][1](spark, again, folder)
    from test_pairs import brute

    texts = {r.doc_id: r.text for r in again.collect() if r.doc_id is not None}
    want = Counter(i for i, (_, c) in brute(texts, 5, 80).items() if i == c) + Counter({None: 2})
    assert Counter(r.doc_id for r in two.collect()) == want and two.columns == docs.columns
    three = P.STAGES[2][1](spark, docs, folder)
    assert three.columns == docs.columns and max(Counter(r.doc_id for r in three.collect()).values()) <= 3
    four = P.STAGES[3][1](spark, three, folder)
    assert four.agg(F.countDistinct("doc_id")).first()[0] == three.agg(F.countDistinct("doc_id")).first()[0]
    empty = docs.limit(0)
    assert all(stage(spark, empty, folder).count() == 0 for _, stage in P.STAGES)


def test_near_copies_by_row_and_not_by_id(spark):
    import corpus_pipeline as P

    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(5, a), (5, b), (5, "clean words of no other text"), (3, a + " more"), (9, b), (9, "x y z"), (9, "x y z"), (7, ""), (7, ""), (None, a), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in P.drop_near_copies(spark, df, "").collect())
    assert got == Counter([(3, a + " more"), (5, b), (5, "clean words of no other text"), (9, "x y z"), (7, ""), (7, ""), (None, a), (2, None)])


def test_pipeline_as_a_whole(spark):
    import corpus_pipeline as P

    out = P.run(spark, f"{DATA}/sf0.001")
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048
