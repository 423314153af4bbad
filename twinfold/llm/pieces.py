"""SentencePiece encoding that keeps byte offsets, and decoding."""

from __future__ import annotations

import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import beside, portions, quoted, table

SPACE = "▁"


def _proto(data: bytes):
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = varint()
        size = {1: 8, 5: 4}.get(key & 7)
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class Normaliser:
    """The model's own normalisation: longest prefixes through its compiled character map, with the source of every byte.

    The map is a double-array trie of source prefixes (32-bit units) followed by the replacement strings. spec is the
    model's normaliser message: 2 the compiled map, 3 whether a space is put in front, 4 whether superfluous spaces go,
    5 whether spaces become a visible character.
    """

    def __init__(self, spec: bytes):
        fields = dict(_proto(spec))
        blob = fields.get(2, b"")
        self.front, self.squeeze, self.escape = bool(fields.get(3, 1)), bool(fields.get(4, 1)), bool(fields.get(5, 1))
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units, self.texts = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else (), blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, int]:
        """(bytes of the longest mapped prefix at this place, place of its replacement), (0, 0) if there is none."""
        units, best = self.units, (0, 0)
        if not units:
            return best
        jump = lambda u: (u >> 10) << ((u & 512) >> 6)
        node = jump(units[0])
        for p in range(at, len(raw)):
            node ^= raw[p]
            unit = units[node]
            if unit & 0x800000FF != raw[p]:
                break
            node ^= jump(unit)
            if unit >> 8 & 1:
                best = p + 1 - at, units[node] & 0x7FFFFFFF
        return best

    def prefixes(self, raw: bytes) -> list[tuple[bytes, int]]:
        """(replacement, its place in the source) of the longest prefixes, one after the other; a character without one is itself."""
        parts, at = [], 0
        while at < len(raw):
            used, found = self.longest(raw, at)
            if used:
                new = self.texts[found : self.texts.index(b"\0", found)]
            else:
                used = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                new = raw[at : at + used]
            parts.append((new, at))
            at += used
        return parts

    def aligned(self, parts: list[tuple[bytes, int]], blank: bool = False) -> tuple[bytearray, list[int]]:
        """The replacements in a row, spaces marked, and the place in the source of each byte; with squeeze no space follows another (or the start, if blank)."""
        mark = SPACE.encode() if self.escape else b" "
        out, source = bytearray(), []
        for new, place in parts:
            for byte in new:
                if byte != 32:
                    out.append(byte)
                    source.append(place)
                elif not (self.squeeze and blank):
                    out += mark
                    source += [place] * len(mark)
                blank = byte == 32
        return out, source

    def stretches(self, text: str) -> np.ndarray:
        """For each byte of the normalised text, and its end, the byte of the source it comes from. For stretches in a row
        that stand inside a text: nothing is put in front, nothing is taken off.

        With an empty map no prefix is longer than a character, each stands for itself, and all are aligned at once."""
        raw = text.encode("utf-8", "replace")
        if self.units or self.squeeze:
            return np.array([*self.aligned(self.prefixes(raw))[1], len(raw)], dtype=np.int64)
        data = np.frombuffer(raw, dtype=np.uint8)
        first = np.maximum.accumulate(np.where(data & 0xC0 != 0x80, np.arange(len(data)), 0))
        return np.append(np.repeat(first, np.where(data == 32, len(SPACE.encode()) if self.escape else 1, 1)), len(raw))

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised text as UTF-8 and, for each of its bytes and its end, the byte of the source it comes from."""
        raw = text.encode("utf-8", "replace")
        parts, end = self.prefixes(raw), len(raw)
        if self.squeeze:
            while parts and not parts[0][0].strip(b" "):
                parts.pop(0)
            if parts:
                parts[0] = (parts[0][0].lstrip(b" "), parts[0][1])
        mark = SPACE.encode() if self.escape else b" "
        out, source = self.aligned(parts, blank=self.squeeze)
        if self.front and parts:
            out, source = bytearray(mark) + out, [parts[0][1]] * len(mark) + source
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                end = source[-len(mark)]
                del source[-len(mark) :]
        return bytes(out), np.array([*source, end], dtype=np.int64)


class Encoder:
    """Encodes whole texts and projects every piece through the normaliser's alignment to the bytes of the source.

    A stretch begins at a space (or is a line feed). No piece of a vocabulary may hold a space mark after another
    character, or a line feed beside another character, so no merge crosses a stretch and encoding them apart equals
    encoding the whole. Each different stretch is normalised and encoded once and remembered with its spans.
    Vocabularies for which that doesn't hold, and texts that hold the space mark themselves, are encoded whole.
    """

    MEMO = 100_000

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            data = f.read()
        fields = [(n, v) for n, v in _proto(data) if n in (2, 3)]
        self.normalise = Normaliser(dict(fields)[3])
        trainer = dict(_proto(dict(fields)[2]))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        special = [p for i, p in enumerate(pieces) if self.model.is_control(i) or self.model.is_unknown(i)]
        plain = [p for p in pieces if p not in special and not re.fullmatch("<0x[0-9A-F]{2}>", p)]
        self.byte_ids = np.array([self.model.is_byte(i) for i in range(len(pieces))])
        self.lengths = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, self.byte_ids, strict=True)], dtype=np.int64)
        by_stretch = trainer.get(3) == 2 and not self.normalise.units and not self.normalise.squeeze and self.normalise.front and self.normalise.escape
        self.by_stretch = by_stretch and self.byte_ids.any() and not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in plain)
        self.cut = re.compile(" +[^ \n]*|[^ \n]+|\n")
        self.line = self.model.encode("\n") if self.by_stretch else []
        self.memo: dict[str, tuple[bytes, int]] = {}  # by stretch: (id, first, end) triples, bytes of the source

    def _learn(self, new: list[str]) -> None:
        # the library puts a space mark in front of what it gets, so every stretch goes in behind a line feed
        found = self.model.encode(["\n" + s for s in new], num_threads=1)
        counts = np.array([len(x) - len(self.line) for x in found])
        ids = np.fromiter(chain.from_iterable(x[len(self.line) :] for x in found), dtype=np.int64, count=counts.sum())
        source, ends = self.normalise.stretches("".join(new)), np.cumsum(self.lengths[ids])
        widths = np.array([len(s.encode("utf-8", "replace")) for s in new])
        base = np.repeat(np.cumsum(widths) - widths, counts)
        triples = np.column_stack([ids, source[ends - self.lengths[ids]] - base, source[ends] - base]).astype(np.int32).tobytes()
        cuts = np.concatenate(([0], 12 * np.cumsum(counts))).tolist()
        self.memo.update(zip(new, zip([triples[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], widths.tolist(), strict=True), strict=True))

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, first byte, end byte in the source of every id) of each text. What the normaliser put in front has no width."""
        if len(self.memo) > self.MEMO:
            self.memo.clear()
        apart = [self.by_stretch and SPACE not in t for t in texts]
        split = [self._stretches(t) for t, yes in zip(texts, apart, strict=True) if yes]
        new = [s for s in dict.fromkeys(chain.from_iterable(split)) if s not in self.memo]
        for at in range(0, len(new), 50_000):
            self._learn(new[at : at + 50_000])
        joined = iter(self._joined(split))
        return [next(joined) if yes else self._whole(t) for t, yes in zip(texts, apart, strict=True)]

    def _stretches(self, text: str) -> list[str]:
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " ":
            return self.cut.findall(" " + text)
        return [" " + x for x in text.split(" ")]  # stretches that keep line feeds inside, which splits faster

    def _joined(self, split: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        found = list(map(self.memo.__getitem__, chain.from_iterable(split)))
        if not found:
            return [(np.array([], dtype=np.int32),) * 3 for _ in split]
        packed = [x for x, _ in found]
        counts = np.array(list(map(len, packed))) // 12
        ids, starts, ends = np.frombuffer(b"".join(packed), dtype=np.int32).reshape(-1, 3).T.copy()
        sizes = np.array(list(map(len, split)))
        widths = np.array([n for _, n in found])
        before = np.cumsum(widths) - widths
        firsts = np.cumsum(sizes) - sizes
        # each text's stretches count from its start; its first one was given a space that the text doesn't have
        before -= np.repeat(np.append(before, 0)[firsts], sizes) + 1
        before = np.repeat(before, counts).astype(np.int32)
        cuts = np.cumsum(np.add.reduceat(np.append(counts, 0), firsts) * (sizes > 0))[:-1]
        return list(zip(*(np.split(x, cuts) for x in (ids, np.maximum(starts + before, 0), ends + before)), strict=True))

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces = self.model.encode(text, return_type="proto").pieces
        ids = np.array([p.id for p in pieces], dtype=np.int32)
        _, source = self.normalise(text)
        # unknown stretches have their own length, other pieces that of the vocabulary
        ends = np.minimum(np.cumsum([1 if self.byte_ids[p.id] else len(p.piece.encode()) for p in pieces]), len(source) - 1).astype(np.int64)
        return ids, source[np.concatenate(([0], ends[:-1])).astype(np.int64)[: len(ids)]].astype(np.int32), source[ends].astype(np.int32)


_own: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process, so that what a task has learnt serves the tasks after it."""
    if path not in _own:
        _own[path] = Encoder(path)
    return _own[path]


def encode_decode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns in keep, then ids, starts, ends (bytes of the source that each id stands for) and decoded, of every whole text.

    Null text counts as empty: no ids, empty decoding. Repeated rows are each encoded; there are no ties. An empty
    table gives an empty result. A result whose name is among keep gets an underscore behind it. model_path must be
    readable on every executor. Memory is bounded by a portion of the texts and a memo of stretches that is emptied at a fixed size.
    """
    inner = [f"keep{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, inner, strict=True)], F.col(quoted(text)).alias("text"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in given.select(*inner).schema] + ["ids array<int>, starts array<int>, ends array<int>, decoded string"])

    def run(batches):
        encoder = encoder_of(model_path)
        lists = lambda parts: pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.array([], np.int32)))
        for whole in batches:
            at = 0
            for texts in portions(whole.column(len(inner)).to_pylist()):
                part = whole.slice(at, len(texts))
                at += len(texts)
                found = encoder(texts)
                decoded = encoder.model.decode([ids.tolist() for ids, _, _ in found], num_threads=1) if texts else []
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(inner))], *[lists([x[i] for x in found]) for i in range(3)], pa.array(decoded, pa.string())], names=[*inner, "ids", "starts", "ends", "decoded"])

    return map_arrow(given, run, schema).toDF(*keep, *beside(list(keep), ["ids", "starts", "ends", "decoded"]))


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    ids = F.col("ids")
    return encoded.select(
        *keep, F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_bytes"),
        F.xxhash64("starts", "ends").alias("spans_hash"),
    )


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id",)), "doc_id")
