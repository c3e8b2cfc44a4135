"""Media columns: MPEG audio.

`encode` stores any bytes losslessly in a Layer III stream: an ID3v2 tag, a frame with the variable-bitrate table, audio
frames that are silent and carry the bytes as ancillary data (what a frame holds beyond its main data), and an ID3v1
tag. `decode` reads Layer III streams of MPEG 1, 2 and 2.5: it parses the tags and the table (Xing, Info or VBRI) and
compares it with what it finds, finds frame headers (and looks for the next one when bytes are lost), verifies checksums,
and gives the exact duration and the offset of every frame.

Frames are written at 32 kHz, where all lengths are whole: 4.5 bytes for each kbit/s. Long payloads use 320 kbit/s, the
last frame the least rate that holds the rest.

Every row of a table is a stream of its own: null and empty texts are one unit of blanks, rows that repeat give equal
streams, texts of any length are read whole (by one task each), an empty table gives an empty table. Columns other than
doc_id and text, or media, are not looked at, so that none can clash. Broken streams raise nothing: what is wrong
is counted.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import table, utf8

#: Fixed values of the format, Layer III: kbit/s by index for MPEG 1 and for 2 and 2.5; Hz by index for MPEG 1 (half of it
#: for 2, a quarter for 2.5); samples in a frame; bytes of side information for one channel and for two.
RATES = [0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320]
LOW_RATES = [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160]
HERTZ = [44100, 48000, 32000]
SAMPLES, LOW_SAMPLES = 1152, 576
SIDES, LOW_SIDES = (17, 32), (9, 17)
SIDE = SIDES[0]
HEAD = 4 + 2 + SIDE  # header, checksum, side information
UNIT = 192


def crc16(data: bytes) -> int:
    """The format's checksum: polynomial 0x8005, from 0xFFFF."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = ((crc << 1) ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


def header(rate: int, protected: bool = True, hertz: int = 2) -> bytes:
    """Header of a one-channel MPEG-1 Layer III frame; rate and hertz are indexes."""
    return bytes([0xFF, 0xFB & (0xFE if protected else 0xFF), rate << 4 | hertz << 2, 0xC0])


def frame_length(rate: int, hertz: int, padding: int) -> int:
    return 144_000 * RATES[rate] // HERTZ[hertz] + padding


#: A protected frame up to its ancillary data, by rate index.
_STARTS = [b""] + [(h := header(r)) + crc16(h[2:] + bytes(SIDE)).to_bytes(2, "big") + bytes(SIDE) for r in range(1, 15)]
_ROOM = [0] + [frame_length(r, 2, 0) - HEAD for r in range(1, 15)]


def synchsafe(n: int) -> bytes:
    return bytes((n >> s) & 0x7F for s in (21, 14, 7, 0))


def id3v2(fields: dict[str, str]) -> bytes:
    body = b""
    for key, value in fields.items():
        data = b"\x03" + key.encode() + b"\x00" + value.encode()
        body += b"TXXX" + synchsafe(len(data)) + b"\x00\x00" + data
    return b"ID3\x04\x00\x00" + synchsafe(len(body)) + body


def encode(payload: bytes, n_bytes: int | None = None) -> bytes:
    """A stream that holds payload; n_bytes is noted in its tag."""
    room, sizes = _ROOM[14], []
    parts: list[bytes] = []
    for at in range(0, len(payload), room):
        piece = payload[at : at + room]
        rate = 14 if len(piece) == room else next(r for r in range(1, 15) if _ROOM[r] >= len(piece))
        parts += (_STARTS[rate], piece, bytes(_ROOM[rate] - len(piece)))
        sizes.append(HEAD + _ROOM[rate])
    frames, total = len(sizes), sum(sizes)
    first = frame_length(5, 2, 0)
    toc = bytes(min(255, 256 * first // (first + total)) if frames == 0 else 256 * (first + sizes[0] * (k * frames // 100)) // (first + total) for k in range(100))
    table_ = b"Xing" + (7).to_bytes(4, "big") + frames.to_bytes(4, "big") + (first + total).to_bytes(4, "big") + toc
    opening = header(5, protected=False) + bytes(SIDE) + table_
    tag = id3v2({"payload_bytes": str(len(payload)), "text_bytes": str(len(payload) if n_bytes is None else n_bytes)})
    return b"".join([tag, opening, bytes(first - len(opening)), *parts, b"TAG" + bytes(124) + b"\xff"])


def synced(data: bytes) -> bytes:
    """Bytes without the zeros that keep a tag from looking like frames."""
    return data.replace(b"\xff\x00", b"\xff")


def id3_text(data: bytes) -> list[str]:
    """The texts of a text frame: its first byte names the encoding."""
    codec = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(data[0] if data else 3, "latin-1")
    return data[1:].decode(codec, "replace").replace("\ufeff", "").split("\0")


def parse_id3v2(data: bytes) -> tuple[dict[str, str], int]:
    """(text fields, length) of the tag at the start, versions 2.2 to 2.4; ({}, 0) if there is none. User fields go by their
    own names, others by those of their frames.
    """
    if data[:3] != b"ID3" or len(data) < 10 or data[3] not in (2, 3, 4):
        return {}, 0
    version, flags = data[3], data[5]
    whole = lambda b: int.from_bytes(b, "big")
    safe = lambda b: sum((x & 0x7F) << s for x, s in zip(b, (21, 14, 7, 0), strict=False))
    length = safe(data[6:10])
    body = data[10 : 10 + length]
    if flags & 0x80 and version < 4:
        body = synced(body)
    at = 0
    if flags & 0x40 and version == 3:
        at = 4 + whole(body[:4])
    elif flags & 0x40 and version == 4:
        at = safe(body[:4])
    fields: dict[str, str] = {}
    name, head = (3, 6) if version == 2 else (4, 10)
    while at + head <= len(body) and body[at : at + name].isalnum():
        size = whole(body[at + 3 : at + 6]) if version == 2 else (whole if version == 3 else safe)(body[at + 4 : at + 8])
        kind, value = body[at : at + name].decode(), body[at + head : at + head + size]
        if version == 4 and (flags & 0x80 or body[at + 9] & 2):
            value = synced(value)
        if version == 4 and body[at + 9] & 1:
            value = value[4:]  # the length before
        if kind in ("TXX", "TXXX"):
            key, *texts = id3_text(value)
            fields[key] = "\0".join(texts).rstrip("\0")
        elif kind[0] == "T":
            fields[kind] = id3_text(value)[0]
        at += head + size
    return fields, 10 + length + (10 if version == 4 and flags & 0x10 else 0)


class Header(NamedTuple):
    length: int
    hertz: int
    protected: bool
    rate: int
    side: int
    samples: int


def parse_header(data: bytes, at: int) -> Header | None:
    """The Layer III frame at a place; None where there is no header of this kind."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    version, layer, b, channels = data[at + 1] >> 3 & 3, data[at + 1] >> 1 & 3, data[at + 2], 1 if data[at + 3] >> 6 == 3 else 2
    rate, hertz = b >> 4, b >> 2 & 3
    if version == 1 or layer != 1 or not 0 < rate < 15 or hertz == 3:
        return None
    first = version == 3  # of MPEG 1
    hz = HERTZ[hertz] >> {3: 0, 2: 1, 0: 2}[version]
    kbits = (RATES if first else LOW_RATES)[rate]
    samples = SAMPLES if first else LOW_SAMPLES
    return Header(samples // 8 * 1000 * kbits // hz + (b >> 1 & 1), hz, not data[at + 1] & 1, kbits, (SIDES if first else LOW_SIDES)[channels - 1], samples)


def bitrate_table(data: bytes, at: int, head: Header) -> dict | None:
    """The variable-bitrate table in the frame at a place: kind, frames, bytes, toc; None if it holds none. Numbers that the
    table leaves out are None.
    """
    whole = lambda k, n=4: int.from_bytes(data[k : k + n], "big")
    k = at + 4 + 2 * head.protected + head.side
    if data[k : k + 4] in (b"Xing", b"Info"):
        out, flags = {"kind": data[k : k + 4].decode(), "frames": None, "bytes": None, "toc": []}, whole(k + 4)
        k += 8
        for mask, name, size in ((1, "frames", 4), (2, "bytes", 4), (4, "toc", 100)):
            if flags & mask:
                out[name] = list(data[k : k + size]) if name == "toc" else whole(k)
                k += size
        return out
    k = at + 4 + 32  # fixed, whatever the side information
    if data[k : k + 4] == b"VBRI" and at + head.length >= k + 26:
        entries, scale, width = whole(k + 18, 2), whole(k + 20, 2), whole(k + 22, 2)
        return {"kind": "VBRI", "bytes": whole(k + 10), "frames": whole(k + 14), "toc": [whole(k + 26 + i * width, width) * scale for i in range(entries)]}
    return None


def decode(data: bytes) -> dict:
    """Payload, duration, frame offsets and what was found wrong.

    After bytes that are no frame, and where the sampling rate changes, a header counts only if its checksum is right, or
    if another frame of its kind or the end follows it. table_agrees says whether the table's counts are those found (None without a table).
    """
    fields, at = parse_id3v2(data)
    end = len(data) - 128 if data[-128:-125] == b"TAG" and len(data) >= at + 128 else len(data)
    out = {"fields": fields, "vbr": None, "offsets": [], "rates": {}, "bad_crc": 0, "lost_bytes": 0, "hertz": 0, "table_agrees": None}
    pieces, lost, samples, table_at = [], False, {}, 0
    offsets, rates = out["offsets"], out["rates"]
    good: set[bytes] = set()
    while at < end:
        head = parse_header(data, at)
        if head and at + head.length <= end:
            body = at + 4 + 2 * head.protected
            sure = not lost and out["hertz"] in (0, head.hertz)
            if head.protected:
                checked = data[at + 2 : body + head.side]
                right = checked in good or crc16(checked[:2] + checked[4:]) == int.from_bytes(checked[2:4], "big")
                if right:
                    good.add(checked)
            else:
                following = parse_header(data, at + head.length)
                right = sure or at + head.length == end or (following is not None and following.hertz == head.hertz)
            if right or sure:
                if not right:
                    out["bad_crc"] += 1
                table = bitrate_table(data, at, head) if not offsets and out["vbr"] is None else None
                if table:
                    out["vbr"], table_at = table, at
                else:
                    offsets.append(at)
                    rates[head.rate] = rates.get(head.rate, 0) + 1
                    samples[head.hertz] = samples.get(head.hertz, 0) + head.samples
                    pieces.append(data[body + head.side : at + head.length])
                out["hertz"], at, lost = head.hertz, at + head.length, False
                continue
        following = data.find(b"\xff", at + 1)
        following = end if following < 0 or following > end else following
        out["lost_bytes"] += following - at
        at, lost = following, True
    if out["vbr"]:
        out["table_agrees"] = out["vbr"]["frames"] in (None, len(offsets)) and out["vbr"]["bytes"] in (None, end - table_at)
    body = b"".join(pieces)
    out["payload"] = body[: int(fields["payload_bytes"])] if fields.get("payload_bytes", "").isdigit() else body
    seconds = sum((Fraction(n, hz) for hz, n in samples.items()), Fraction(0))
    out["duration"] = (seconds.numerator, seconds.denominator)
    return out


def pad(text: bytes, unit: int = UNIT) -> bytes:
    """The text with spaces appended up to a positive multiple of unit."""
    return text + b" " * ((-len(text)) % unit if text else unit)


def store_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every text as a stream; null texts are empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([encode(pad(t), len(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """Reads the streams of a column `media` back: payload, features, frame offsets, duration in seconds as a fraction, and
    what is wrong; carries doc_id. Null media count as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in batch.column("media").to_pylist():
                data = data or b""
                found = decode(data)
                payload = found["payload"]
                level = np.frombuffer(payload, np.uint8)
                mean, spread = (float(level.mean()), float(level.std())) if len(level) else (0.0, 0.0)
                above = level > mean
                feature = json.dumps({
                    "duration": "{}/{}".format(*found["duration"]), "frames": len(found["offsets"]), "hertz": found["hertz"],
                    "kbps": {str(k): v for k, v in sorted(found["rates"].items())}, "vbr_frames": (found["vbr"] or {}).get("frames"), "table_agrees": found["table_agrees"],
                    "mean": round(mean, 6), "spread": round(spread, 6), "crossings": int((above[1:] != above[:-1]).sum()),
                })
                out.append((int(n) if (n := found["fields"].get("text_bytes", "")).isdigit() else len(payload), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature, found["offsets"], *found["duration"], found["bad_crc"], found["lost_bytes"]))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), TYPES, strict=True)]], names=NAMES)

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frame_offsets array<long>, duration_numerator long, duration_denominator long, bad_checksums int, lost_bytes long")


NAMES = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frame_offsets", "duration_numerator", "duration_denominator", "bad_checksums", "lost_bytes"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def op3_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as an MPEG audio stream and read back, with its duration and frame offsets."""
    return media_features(store_media(table(spark, sf_dir, "documents")))
