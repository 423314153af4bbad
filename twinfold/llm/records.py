"""Length-delimited binary records of token ids with masked checksums and an offset index."""

from __future__ import annotations

import contextlib
import json
import os
import re
import struct
from array import array

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import map_pandas
from ..sources.pages import files
from .bpe import USUAL
from .common import materialise, new_path, table

#: The characters that UTF-8 bytes stand for in byte-level vocabularies: printable Latin-1 as itself, the others from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_CHAR = {b: chr(b) if b in _SHOWN else chr(256 + sum(1 for x in range(b) if x not in _SHOWN)) for b in range(256)}
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PRETOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_BLOCK = 512


class WordTokenizer:
    """Ids of whole texts by the tokenizers library, each different stretch between white space done once.

    A tokenizer that drops white space has no token across it, so stretches can be encoded apart. By the usual rules (see
    bpe.USUAL) stretches of printable ASCII and Latin-1 letters skip the library's normaliser, which can only lower their
    case, and go to its BPE model pretoken by pretoken; all others, and those that may hold a special token, go through
    the library whole. By other rules of normalising and splitting every text goes through the library whole.
    """

    MEMO = 400_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        same = {k: spec.get(k) for k in USUAL} == USUAL and model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        self.apart = same and all(t["content"].startswith("<|") and not t["normalized"] and not t["lstrip"] and not t["rstrip"] and " " not in t["content"] for t in spec["added_tokens"])
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind, self.code = np.dtype(f"<u{self.width}"), {2: "H", 4: "I"}[self.width]
        self.memo: dict[bytes, bytes] = {}
        self.pretokens: dict[str, bytes] = {}

    def _pretoken(self, s: str) -> bytes:
        found = self.pretokens.get(s)
        if found is None:
            shown = "".join(map(_BYTE_CHAR.__getitem__, s.encode())) if not s.isascii() else s
            found = self.pretokens[s] = array(self.code, [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        return found

    def _learn(self, stretches: list[bytes]) -> None:
        odd = []
        for raw in stretches:
            s = raw.decode("utf-8", "replace")
            if raw.isalpha():  # ASCII letters alone are one pretoken
                self.memo[raw] = self._pretoken(s.lower())
            elif _PLAIN.fullmatch(s) and "<|" not in s:
                self.memo[raw] = b"".join([self._pretoken(x) for x in _PRETOKEN.findall(s.lower())])
            else:
                odd.append((raw, s))
        if odd:
            for (raw, _), e in zip(odd, self.tokenizer.encode_batch_fast([s for _, s in odd], add_special_tokens=False), strict=True):
                self.memo[raw] = np.array(e.ids, dtype=self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian ids of self.width bytes."""
        if not self.apart:
            return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        parts = text.encode("utf-8", "replace").split()
        try:
            return b"".join(map(self.memo.__getitem__, parts))
        except KeyError:
            if len(self.memo) > self.MEMO:  # before the missing ones are listed, so that all of this text's are learnt again
                self.memo.clear()
                self.pretokens.clear()
            self._learn([x for x in dict.fromkeys(parts) if x not in self.memo])
            return b"".join(map(self.memo.__getitem__, parts))


_own: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """One tokenizer for each worker process, so that what a task has learnt serves the tasks after it."""
    if path not in _own:
        _own[path] = WordTokenizer(path)
    return _own[path]


def _crc_table() -> np.ndarray:
    """CRC-32C of each byte value followed by 0.._BLOCK-1 zero bytes, from a zero register."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(0x82F63B78), one >> 1)
    rows = [one]
    for _ in range(_BLOCK - 1):
        rows.append(rows[-1] >> 8 ^ one[rows[-1] & 255])
    return np.array(rows, dtype=np.uint32)


_CRC = _crc_table()
_CRC_FLAT = _CRC[::-1].ravel().copy()
_CRC_AT = np.arange(_BLOCK, dtype=np.int64) * 256
_SHIFT = [_CRC[_BLOCK - 1 - i].tolist() for i in range(4)]


def crc32c(data: bytes) -> int:
    """A CRC is linear: blocks are looked up by byte and place at once, then chained by the shift over one block."""
    if len(data) < 4:
        return _crc_small(data)
    raw = np.frombuffer(data, dtype=np.uint8)
    first = -len(raw) % _BLOCK
    padded = np.concatenate((np.zeros(first, dtype=np.uint8), raw))
    padded[first : first + 4] ^= 255
    state = 0
    for block in np.bitwise_xor.reduce(_CRC_FLAT[padded.reshape(-1, _BLOCK) + _CRC_AT], axis=1).tolist():
        state = _SHIFT[0][state & 255] ^ _SHIFT[1][state >> 8 & 255] ^ _SHIFT[2][state >> 16 & 255] ^ _SHIFT[3][state >> 24] ^ block
    return state ^ 0xFFFFFFFF


def _crc_small(data: bytes) -> int:
    state, one = 0xFFFFFFFF, _CRC[0]
    for byte in data:
        state = state >> 8 ^ int(one[(state ^ byte) & 255])
    return state ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    crc = crc32c(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    """u64 length, its masked checksum, the data, its masked checksum; little-endian."""
    head = struct.pack("<Q", len(data))
    return b"".join((head, struct.pack("<I", masked(head)), data, struct.pack("<I", masked(data))))


def unframe(stream: bytes, at: int) -> bytes:
    head = stream[at : at + 8]
    (size,) = struct.unpack("<Q", head)
    data = stream[at + 12 : at + 12 + size]
    if masked(head) != struct.unpack_from("<I", stream, at + 8)[0] or len(data) != size or masked(data) != struct.unpack_from("<I", stream, at + 12 + size)[0]:
        raise ValueError(f"damaged record at {at}")
    return data


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under a name of this attempt, then rename: a task that runs twice leaves the same one file."""
    fs, base = files(folder)
    fs.create_dir(base, recursive=True)
    own = f"{base}/.{name}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(own) as f:
        f.write(data)
    with contextlib.suppress(OSError):
        fs.delete_file(f"{base}/{name}")
    fs.move(own, f"{base}/{name}")


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, shard_bytes: int = 32 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of every whole text, with end_id behind, as record files in ascending doc_id order; returns the shards.

    Rows are range-partitioned and sorted by doc_id (null first, ties by text), so the order of file names is the order
    of records. A record holds a null flag, doc_id, the width of an id, and the ids; name.idx beside name.rec holds the
    (offset, length) pairs of its frames as u64. Files are rolled at shard_bytes, so memory stays bounded. Null text
    counts as empty: a record of end_id alone. folder is a URI that all executors share. An empty table gives no shard.
    """

    def run(parts):
        tokenizer, task = tokenizer_of(tokenizer_path), TaskContext.get().partitionId()
        end, out, index, size, tokens, shard = np.array([end_id], dtype=tokenizer.kind).tobytes(), [], [], 0, 0, 0

        def close():
            nonlocal out, index, size, tokens, shard
            name = f"part-{task:07d}-{shard:05d}"
            _put(folder, f"{name}.rec", b"".join(out))
            _put(folder, f"{name}.idx", np.array(index, dtype="<u8").tobytes())
            row = pd.DataFrame({"shard": [name], "n_records": [len(out)], "n_tokens": [tokens], "n_bytes": [size]})
            out, index, size, tokens, shard = [], [], 0, 0, shard + 1
            return row

        for part in parts:
            for key, body in zip(part["doc_id"], part["text"], strict=True):
                ids = tokenizer.encode(body or "") + end
                record = frame(struct.pack("<?qB", key is None or key != key, 0 if key is None or key != key else int(key), tokenizer.width) + ids)
                index.append((size, len(record)))
                out.append(record)
                size, tokens = size + len(record), tokens + len(ids) // tokenizer.width
                if size >= shard_bytes:
                    yield close()
        if out:
            yield close()

    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return materialise(map_pandas(ordered, run, "shard string, n_records long, n_tokens long, n_bytes long"), "record-shards")


def read(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian u32) of every record, by the offset index, each checksum verified.

    The running start over shards is a window over one small row a shard."""
    from_here = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.select("shard", F.coalesce(F.sum("n_tokens").over(from_here), F.lit(0)).alias("base"))

    def run(parts):
        fs, base = files(folder)
        for part in parts:
            for shard, start in zip(part["shard"], part["base"], strict=True):
                with fs.open_input_stream(f"{base}/{shard}.idx") as f:
                    places = np.frombuffer(f.read(), dtype="<u8").reshape(-1, 2).tolist()
                with fs.open_input_file(f"{base}/{shard}.rec") as f:
                    stream = f.read()
                rows = []
                for at, _ in places:
                    data = unframe(stream, at)
                    missing, key, width = struct.unpack_from("<?qB", data)
                    ids = np.frombuffer(data, dtype=f"<u{width}", offset=10).astype("<u4")
                    rows.append((None if missing else key, start, len(ids), ids.tobytes()))
                    start += len(ids)
                    if len(rows) == 512:
                        yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids"]).astype({"doc_id": "Int64"})
                        rows = []
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids"]).astype({"doc_id": "Int64"})

    tasks = max(1, min(shards.count(), 20_000))  # a number that is asked for isn't coalesced to one task, small as these rows are
    return map_pandas(based.repartition(tasks, F.col("shard")), run, "doc_id long, start long, n_tokens long, ids binary")


def op10_token_records(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_path(spark, "token-records")
    shards = write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, folder, shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
