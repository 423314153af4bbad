"""MPEG audio columns: frames, tags, variable-bitrate tables, checksums, exact durations and seek offsets."""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_pandas
from .common import beside, table

#: Fixed values of the MPEG audio header: kbit/s by (MPEG-1 or later, layer), Hz by version, samples a frame.
KBPS = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {1.0: (44100, 48000, 32000), 2.0: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
SAMPLES = {(1, 1): 384, (1, 2): 1152, (1, 3): 1152, (2, 1): 384, (2, 2): 1152, (2, 3): 576}
_OWNER = b"payload\0"
_SIDE = 17  # bytes of side information in a mono frame of MPEG-1 layer III
_HEAD = 4 + 2 + _SIDE


@lru_cache(maxsize=65536)
def crc16(data: bytes) -> int:
    """The frame checksum: polynomial 0x8005, start 0xFFFF, most significant bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


@lru_cache(maxsize=4096)
def header(word: int):
    """(version, layer, protected, kbps, Hz, frame bytes, samples, bytes of side information) of a header word, or None if it is none."""
    if word >> 21 != 0x7FF or word >> 19 & 3 == 1 or word >> 17 & 3 == 0 or word >> 12 & 15 in (0, 15) or word >> 10 & 3 == 3:
        return None
    version, layer = {0: 2.5, 2: 2.0, 3: 1.0}[word >> 19 & 3], 4 - (word >> 17 & 3)
    family = 1 if version == 1.0 else 2
    kbps, hertz, pad, samples = KBPS[family, layer][(word >> 12 & 15) - 1], HERTZ[version][word >> 10 & 3], word >> 9 & 1, SAMPLES[family, layer]
    size = (12000 * kbps // hertz + pad) * 4 if layer == 1 else samples // 8 * 1000 * kbps // hertz + pad
    mono = word >> 6 & 3 == 3
    return version, layer, not word >> 16 & 1, kbps, hertz, size, samples, (17 if mono else 32) if family == 1 else (9 if mono else 17)


def _frame_start(index: int) -> bytes:
    """Header, checksum and silent side information of a protected mono frame, 32 kHz, of the given bitrate index."""
    head = struct.pack(">I", 0xFFFA0000 | index << 12 | 2 << 10 | 3 << 6)
    return head + struct.pack(">H", crc16(head[2:] + bytes(_SIDE))) + bytes(_SIDE)


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 127 for s in (21, 14, 7, 0))


def encode(payload: bytes) -> bytes:
    """An MPEG-1 layer III stream that plays as silence and carries the payload as ancillary data of its frames.

    ID3v2.3 tag with the payload's length and CRC-32, a Xing frame with the frame and byte counts and the seek table,
    then full frames of 320 kbit/s and a last one of the least bitrate that holds the rest.
    """
    sizes = [144 * k // 32 for k in KBPS[1, 3]]
    room = sizes[-1] - _HEAD
    full, rest = divmod(len(payload), room)
    body = np.zeros((full, sizes[-1]), dtype=np.uint8)
    body[:, :_HEAD] = np.frombuffer(_frame_start(14), dtype=np.uint8)
    body[:, _HEAD:] = np.frombuffer(payload, dtype=np.uint8, count=full * room).reshape(full, room)
    stream = body.tobytes()
    if rest:
        index = next(i for i, s in enumerate(sizes) if s - _HEAD >= rest)
        stream += (_frame_start(index + 1) + payload[full * room :]).ljust(sizes[index], b"\0")
    total = sizes[0] + len(stream)
    n = full + bool(rest)
    starts = [sizes[0] + sizes[-1] * min(i * n // 100, full) for i in range(100)]
    xing = (_frame_start(1) + b"Xing" + struct.pack(">III", 7, n, total) + bytes(min(255, 256 * s // total) for s in starts)).ljust(sizes[0], b"\0")
    private = _OWNER + struct.pack(">QI", len(payload), zlib.crc32(payload))
    length = b"\0" + str(1000 * n * 1152 // 32000).encode()
    tags = b"PRIV" + struct.pack(">IH", len(private), 0) + private + b"TLEN" + struct.pack(">IH", len(length), 0) + length
    return b"ID3\3\0\0" + _syncsafe(len(tags)) + tags + xing + stream


def _tags(data: bytes) -> tuple[int, dict[str, bytes]]:
    """End of the ID3v2 tag at the start (0 if none) and its frames."""
    if data[:3] != b"ID3" or len(data) < 10:
        return 0, {}
    end, at, found = 10 + sum((b & 127) << s for b, s in zip(data[6:10], (21, 14, 7, 0), strict=True)), 10, {}
    while at + 10 <= min(end, len(data)) and data[at] and data[3] >= 3:
        size = sum((b & 127) << s for b, s in zip(data[at + 4 : at + 8], (21, 14, 7, 0), strict=True)) if data[3] == 4 else int.from_bytes(data[at + 4 : at + 8], "big")
        found[data[at : at + 4].decode("latin-1")] = data[at + 10 : at + 10 + size]
        at += 10 + size
    return end, found


def parse(data: bytes) -> dict:
    """Frames, tags, seek table, checksums, exact duration and payload of a stream; junk between frames is skipped by resynchronising.

    A header counts if another of its kind, or the end, follows its frame, if it is like the one before, or if its checksum is right."""
    at, tags = _tags(data)
    stop = len(data) - 128 if data[-128:-125] == b"TAG" else len(data)
    offsets, spans, kbps = [], [], Counter()
    bad = skipped = samples = 0
    hertz, xing, before = 0, None, None
    word = lambda p: header(int.from_bytes(data[p : p + 4], "big")) if p + 4 <= stop else None
    while at + 4 <= stop:
        h = word(at)
        follows = h and (at + h[5] == stop or (n := word(at + h[5])) and n[:2] == h[:2] and n[4] == h[4])
        known = follows or h and before and h[:2] == before[:2] and h[4] == before[4] or h and h[2] and h[1] == 3 and crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + h[7]]) == int.from_bytes(data[at + 4 : at + 6], "big")
        if not h or at + h[5] > stop or not known:
            nxt = data.find(b"\xff", at + 1, stop)
            skipped += (nxt if nxt >= 0 else stop) - at
            at = nxt if nxt >= 0 else stop
            continue
        before, start = h, at + 4 + 2 * h[2] + (h[7] if h[1] == 3 else 0)
        if h[2] and h[1] == 3:
            bad += crc16(data[at + 2 : at + 4] + data[at + 6 : start]) != int.from_bytes(data[at + 4 : at + 6], "big")
        if not offsets and xing is None and data[start : start + 4] in (b"Xing", b"Info"):
            flags, p, xing = int.from_bytes(data[start + 4 : start + 8], "big"), start + 8, {}
            for bit, name, size in ((1, "frames", 4), (2, "bytes", 4), (4, "table", 100), (8, "quality", 4)):
                if flags & bit:
                    xing[name], p = data[p : p + size] if name == "table" else int.from_bytes(data[p : p + size], "big"), p + size
        else:
            offsets.append(at)
            spans.append((start, at + h[5]))
            samples, hertz = samples + h[6], h[4]
            kbps[h[3]] += 1
        at += h[5]
    payload, intact = b"".join(data[a:b] for a, b in spans), None
    if tags.get("PRIV", b"").startswith(_OWNER):
        size, crc = struct.unpack(">QI", tags["PRIV"][len(_OWNER) :])
        payload = payload[:size]
        intact = len(payload) == size and zlib.crc32(payload) == crc
    return {"payload": payload, "intact": intact, "n_frames": len(offsets), "samples": samples, "sample_rate": hertz, "bad_checksums": int(bad), "skipped_bytes": skipped, "listed_frames": (xing or {}).get("frames"), "seek_table": list((xing or {}).get("table", b"")), "offsets": offsets, "kbps": ",".join(f"{k}x{kbps[k]}" for k in sorted(kbps)), "tags": ",".join(sorted(tags))}


_PARSED = "payload binary, intact boolean, n_frames long, samples long, sample_rate int, bad_checksums long, skipped_bytes long, listed_frames long, seek_table array<int>, offsets array<long>, kbps string, tags string"


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: int = 64) -> DataFrame:
    """doc_id, n_bytes and media: the whole text as UTF-8 (null: empty), zero bytes up to a positive multiple of unit, as MPEG audio.

    Texts of any length are stored whole; equal texts give equal streams, repeated rows are each stored; there are no
    ties. Other columns are left out, so their names can't clash. An empty table gives an empty result.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(parts):
        for part in parts:
            raw = [(t or "").encode("utf-8", "replace") for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": [len(x) for x in raw], "media": [encode(x.ljust(max(unit, -(-len(x) // unit) * unit), b"\0")) for x in raw]})

    return map_pandas(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, n_bytes long, media binary")


def read(stored: DataFrame, media: str = "media") -> DataFrame:
    """stored with what parse() finds in the media column beside its own columns; a result whose name is taken gets an underscore behind it.

    Null media counts as an empty stream: no frames. Repeated rows are each read, equal streams alike; there are no
    ties. Streams of any length are read whole. An empty table gives an empty result.
    """
    names = [x.split()[0] for x in _PARSED.split(", ")]
    ours = beside(stored.columns, names)
    inner = [f"c{i}" for i in range(len(stored.columns))]
    fields = [f"{n} {f.dataType.simpleString()}" for n, f in zip(inner, stored.schema, strict=True)]
    at = inner[stored.columns.index(media)]

    def run(parts):
        for part in parts:
            found = pd.DataFrame([parse(bytes(m) if m is not None else b"") for m in part[at]], index=part.index, columns=names)
            found["listed_frames"] = found["listed_frames"].astype("Int64")
            yield pd.concat([part, found], axis=1)

    read_ = map_pandas(stored.toDF(*inner), run, ", ".join([*fields, _PARSED]))
    return read_.toDF(*stored.columns, *ours)


def op4_mpeg_audio(spark, sf_dir: str) -> DataFrame:
    media, payload = F.col("media"), F.col("payload")
    return read(store(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_bytes", F.length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -64, 64)).alias("tail_crc32"), F.length(media).cast("long").alias("media_bytes"), F.sha2(media, 256).alias("media_sha256"),
        F.concat_ws(";", F.concat(F.lit("samples="), F.col("samples").cast("string")), F.concat(F.lit("rate="), F.col("sample_rate").cast("string")), F.concat(F.lit("kbps="), "kbps"), F.concat(F.lit("bad="), F.col("bad_checksums").cast("string"))).alias("feature"),
        "intact", "n_frames", F.try_element_at("offsets", F.lit(-1)).alias("last_offset"),
    )
