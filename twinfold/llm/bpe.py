"""Byte-level BPE: greedy longest matches are proposed, adjacent pairs are verified together, failing words are merged exactly."""

from __future__ import annotations

import json
import math
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import beside, portions, quoted, table

_NEVER = np.iinfo(np.int32).max


class Pairs:
    """Whether two tokens may stand side by side, from the merges alone.

    An encoding is the one that merging finds exactly if every token is what merging makes of its own characters and
    every two neighbours are what merging makes of theirs. Two neighbours are not, if some merge across their border
    would have come before the merges that made them. These are undone from the last to the first, for all pairs at once.
    """

    def __init__(self, ids: dict[str, int], merges: list[list[str]]):
        size = max(ids.values(), default=-1) + 1
        self.size = size
        self.made, self.left, self.right = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        keys = np.zeros(len(merges), dtype=np.int64)
        for rank, (a, b) in enumerate(merges):
            whole, a, b = ids[a + b], ids[a], ids[b]
            keys[rank] = a * size + b
            self.made[whole], self.left[whole], self.right[whole] = rank, a, b
        # a token must come from one merge, whose parts were there before
        merged = np.flatnonzero(self.made >= 0)
        before = np.maximum(self.made[self.left[merged]], self.made[self.right[merged]])
        self.proper = len(merged) == len(merges) and bool((before < self.made[merged]).all())
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        fits = self.compatible(self.left[merged], self.right[merged], self.made[merged])
        self.whole = np.ones(size, dtype=bool)  # tokens that merging makes of their own characters
        for token, fit in sorted(zip(merged.tolist(), fits.tolist(), strict=True), key=lambda x: self.made[x[0]]):
            self.whole[token] = fit and self.whole[self.left[token]] and self.whole[self.right[token]]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(a), _NEVER)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = _NEVER) -> np.ndarray:
        """For each pair: no merge across the border comes before limit, or before what it would have to break."""
        fits, at = np.ones(len(a), dtype=bool), np.arange(len(a))
        a, b, limit = a.astype(np.int64), b.astype(np.int64), np.broadcast_to(limit, len(a)).astype(np.int64)
        while len(at):
            early = self.rank(a, b) < limit
            fits[at[early]] = False
            made_a, made_b = self.made[a], self.made[b]
            go = ~early & (np.maximum(made_a, made_b) >= 0)
            at, a, b, made_a, made_b = at[go], a[go], b[go], made_a[go], made_b[go]
            first = made_a > made_b
            # merges of one rank go from left to right: one across the border comes after the left token's and before the right one's
            limit = np.where(first, made_a, made_b + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return fits


#: The rules of normalising and splitting that the short way for ASCII stands for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
USUAL = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_ASCII_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"


class Encoder:
    """Ids and decodings of whole texts, each different stretch between white space done once.

    Normalising, splitting into words, and special tokens are the tokenizers library's, by the file's own rules. The
    file's model must be plain BPE over a byte-level alphabet and its splitting must drop white space, so that no word
    crosses a stretch; other files are turned down.
    """

    MEMO = 200_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or spec.get("decoder") or any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} isn't plain BPE without a decoder: {odd}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if any(self._words(f"a{s}b") != self._words("a b") or self._words(s) for s in " \t\n\r\x0b\x0c"):
            raise ValueError(f"{path} keeps white space")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if any(set(s) & set(" \t\n\r\x0b\x0c") for s in self.specials):
            raise ValueError(f"{path} has special tokens with white space")
        self.ids, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.names = pa.array([self.tokenizer.id_to_token(i) or "" for i in range(1 + max([*self.ids.values(), *(t["id"] for t in spec["added_tokens"])], default=-1))], pa.string())
        self.pairs = Pairs(self.ids, [m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        self.last = {t.removesuffix(self.end): i for t, i in self.ids.items() if t.endswith(self.end)}
        self.longest = max(map(len, self.ids), default=1)
        # for ASCII the usual rules come to this pattern over lower-case text
        rules = {"normalizer": spec["normalizer"], "pre_tokenizer": spec["pre_tokenizer"]}
        self.ascii = re.compile(_ASCII_WORDS) if rules == USUAL else None
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _words(self, stretch: str) -> list[str]:
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(stretch))]

    def _propose(self, word: str) -> list[int] | None:
        """Longest tokens from the left; the last one carries the mark of a word's end. None if there is none somewhere."""
        out, at, n = [], 0, len(word)
        while at < n:
            found = self.last.get(word[at:]) if n - at <= self.longest else None
            if found is not None:
                return [*out, found]
            for end in range(min(n - (self.end != ""), at + self.longest), at, -1):
                found = self.ids.get(word[at:end])
                if found is not None:
                    break
            if found is None:
                return None
            out.append(found)
            at = end
        return out

    def speculate(self, words: list[str]) -> list[list[int] | None]:
        """The proposals that hold, None where one fails: every token and every adjacent pair of all words are tested together."""
        proposed = [self._propose(w) for w in words]
        if not words or not self.pairs.proper:
            return [None] * len(words)
        sizes = np.array([len(p or ()) for p in proposed])
        flat = np.fromiter(chain.from_iterable(p for p in proposed if p), dtype=np.int64, count=sizes.sum())
        owner = np.repeat(np.arange(len(words)), sizes)
        fits = np.array([p is not None for p in proposed])
        fits[owner[~self.pairs.whole[flat]]] = False
        inside = owner[1:] == owner[:-1]
        a, b, owner = flat[:-1][inside], flat[1:][inside], owner[1:][inside]
        different, back = np.unique(a * self.pairs.size + b, return_inverse=True)
        fits[owner[~self.pairs.compatible(different // self.pairs.size, different % self.pairs.size)[back]]] = False
        return [p if ok else None for p, ok in zip(proposed, fits.tolist(), strict=True)]

    def _split(self, stretches: list[str]) -> list[list[str]]:
        """The words of each stretch. Those of one piece go through the library together, with a space between them, which no word crosses."""
        shown = self.tokenizer.normalizer.normalize_str(" ".join(stretches))
        parts = shown.split(" ")
        if len(parts) != len(stretches):  # some stretch has other white space in it
            if len(stretches) == 1:
                return [self._words(stretches[0])]
            half = len(stretches) // 2
            return self._split(stretches[:half]) + self._split(stretches[half:])
        found: list[list[str]] = []
        words, n = iter(self.tokenizer.pre_tokenizer.pre_tokenize_str(shown)), -1
        word, (start, _) = next(words, ("", (math.inf, 0)))
        for part in parts:
            n += 1 + len(part)
            found.append(own := [])
            while start < n:
                own.append(word)
                word, (start, _) = next(words, ("", (math.inf, 0)))
        return found

    def _learn(self, stretches: list[bytes]) -> None:
        shown = b" ".join(stretches).decode("utf-8", "replace").split(" ")
        together = " ".join(shown)
        apart: list[list[str] | None] = [None] * len(shown)
        if any(x in together for x in self.specials):
            for i, s in enumerate(shown):
                if any(x in s for x in self.specials):
                    self.memo[stretches[i]] = array("I", self.tokenizer.encode(s, add_special_tokens=False).ids).tobytes()
                    apart[i] = []
        if self.ascii:
            for i, s in enumerate(shown):
                if s.isascii() and apart[i] is None:
                    s = s.lower()
                    apart[i] = [s] if s.isalpha() else self.ascii.findall(s) if s.isprintable() else None
        left = [i for i, words in enumerate(apart) if words is None]
        for i, words in zip(left, self._split([shown[i] for i in left]), strict=True) if left else ():
            apart[i] = words
        new = list(set().union(*apart).difference(self.words))
        for word, ids in zip(new, self.speculate(new), strict=True):
            self.words[word] = array("I", [t.id for t in self.tokenizer.model.tokenize(word)] if ids is None else ids).tobytes()
        for raw, words in zip(stretches, apart, strict=True):
            if len(words) == 1:
                self.memo[raw] = self.words[words[0]]
            elif raw not in self.memo:
                self.memo[raw] = b"".join(map(self.words.__getitem__, words))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [t.encode("utf-8", "replace").split() for t in texts]
        if len(self.memo) > self.MEMO:  # what isn't asked for until the next time is forgotten
            self.old, self.memo, self.words = self.memo, {}, {}
        new = set().union(*split).difference(self.memo)
        known = new.intersection(self.old)
        self.memo.update(zip(known, map(self.old.__getitem__, known), strict=True))
        if new := list(new - known):
            self._learn(new)
        ids_of = self.memo.__getitem__
        return [b"".join(map(ids_of, stretches)) for stretches in split]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Without a decoder of its own the file's tokens stand with spaces between them, special ones too."""
        tokens = pa.ListArray.from_arrays(ids.offsets, self.names.take(ids.values))
        return pc.binary_join(tokens, " ")


def listed(packed: list[bytes]) -> pa.ListArray:
    """Packed ids of each text as lists."""
    cuts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in packed]))).astype(np.int32)
    return pa.ListArray.from_arrays(cuts, pa.array(np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)))


_own: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process, so that what a task has learnt serves the tasks after it."""
    if path not in _own:
        _own[path] = Encoder(path)
    return _own[path]


def encode_decode(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """The columns in keep, then ids (array<int>, or little-endian unsigned 32-bit integers in a binary if packed) and decoded, of every whole text.

    Null text counts as empty: no ids, empty decoding. Repeated rows are each encoded; there are no ties. An empty
    table gives an empty result. Extra columns don't matter; a result whose name is among keep gets an underscore behind
    it. tokenizer_path must be readable on every executor. Memory is bounded by a portion of the texts and memos that
    are emptied at a fixed size.
    """
    inner = [f"keep{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, inner, strict=True)], F.col(quoted(text)).alias("text"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in given.select(*inner).schema]

    def run(batches):
        encoder = encoder_of(tokenizer_path)
        for whole in batches:
            at = 0
            for texts in portions(whole.column(len(inner)).to_pylist()):
                part = whole.slice(at, len(texts))
                at += len(texts)
                found = encoder(texts)
                ids = listed(found)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(inner))], pa.array(found, pa.binary()) if packed else ids, encoder.decode(ids)], names=[*inner, "ids", "decoded"])

    schema = ", ".join([*kinds, f"ids {'binary' if packed else 'array<int>'}", "decoded string"])
    return map_arrow(given, run, schema).toDF(*keep, *beside(list(keep), ["ids", "decoded"]))


def op11_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=("doc_id",), packed=True)
    return encoded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
