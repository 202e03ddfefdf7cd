"""BPE encoding and decoding with forced boundaries.

Takes the published files of a word-level BPE tokenizer (NFC, lower case, words
split by one pattern, bytes shown as printable characters, a word-end mark). Two
neighbouring characters that no vocabulary token holds side by side can never be
merged, so every such pair is a certain cut: the fragments between cuts are
encoded independently and their ids concatenated. Fragments, words and white
space separated chunks repeat, and each task keeps what it has worked out in
caches of bounded size.

Added tokens (``<|...|>``) are found in the raw text first, as the file lists
them. Symbols outside the vocabulary have no id and are left out. Decoding gives
the ids' tokens joined by one space, special ones included, as a file without a
decoder asks. Letters and numbers are those of Python's own Unicode tables (15.1)
and the later ones listed below. Cases: null and empty texts have no ids and decode to ''; texts of
any length are encoded whole; repeated rows give repeated rows; an empty table
gives none; further columns are not used.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, keep_cache

#: The public tokenizer file that the query uses, and where its kind lies.
VOCABULARY = "word_bpe_49k.json"
TOKENIZERS = os.path.dirname(str(public_tokenizers.path(VOCABULARY)))
#: Entries of a cache's newer half; when it is full it becomes the older half.
CACHED = 200_000
# Characters with the White_Space property.
_WHITE = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Control characters that str.split() takes for white space and the property does not.
_NOT_WHITE = re.compile("[\x1c-\x1f]")
_CHUNKS = re.compile(f"[^{_WHITE}]+")


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(more)
            more += 1
    return [out[b] for b in range(256)]


# Letters and numbers assigned after Unicode 15.1, as ranges of code points, and capitals with the distance to their small letters.
LATER = {
    "L": (
        (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389),
        (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
        (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
    ),
    "N": ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)),
}
LATER_CAPITALS = ((0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B))
_LATER_LOWER = {c: chr(c + far) for a, b, far in LATER_CAPITALS for c in range(a, b + 1)} if unicodedata.category("\u1c89") == "Cn" else {}


@lru_cache(maxsize=4)
def char_class(major: str) -> str:
    """The inside of a character class: ranges of code points of one general category."""
    later = {c for a, b in LATER[major] for c in range(a, b + 1)}
    held = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == major or c in later]
    heads = [c for c, before in zip(held, [-2, *held], strict=False) if c != before + 1]
    tails = [c for c, after in zip(held, [*held[1:], -2], strict=True) if c + 1 != after]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(heads, tails, strict=True))


class Recent(dict):
    """A cache of two halves: what is used again moves to the newer, and the older is dropped in time."""

    def __init__(self, most: int = CACHED):
        super().__init__()
        self.most, self.older = most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is not None:
            self[key] = found
        return found

    def keep(self, key, value):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class ForcedBoundaryBpe:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
        self.tokens = {v: k for k, v in self.vocab.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({v: k for k, v in added.items()})
        self.added = added
        self.added_pattern = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        for name, chars in (("L", char_class("L")), ("N", char_class("N")), ("s", re.escape(_WHITE))):
            pattern = pattern.replace(rf"\p{{{name}}}", chars) if name != "s" else pattern.replace(r"\s", chars)
        self.words = re.compile(pattern.replace("[[", "[").replace("]]", "]"))
        self.shown = byte_characters()
        self.inside = {t[i : i + 2] for t in map(self._bare, self.vocab) for i in range(len(t) - 1)}
        self.pieces, self.by_word, self.by_chunk = Recent(), Recent(), Recent()

    def _bare(self, token: str) -> str:
        return token[: -len(self.end)] if self.end and token.endswith(self.end) else token

    def fragments(self, word: str) -> list[str]:
        """The word cut wherever no token could go on."""
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.inside), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _merge(self, symbols: list[str]) -> list[str]:
        """Merges by least rank, then leftmost, with a heap over a linked list."""
        ranks, n = self.ranks, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = a + b, "", after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get((symbols[i], symbols[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[after[i]]))
            if before[i] >= 0 and (r := ranks.get((symbols[before[i]], symbols[i]))) is not None:
                heapq.heappush(heap, (r, before[i], symbols[before[i]], symbols[i]))
        return [s for s in symbols if s]

    def _piece(self, text: str, last: bool) -> tuple[int, ...]:
        symbols = list(text)
        if last:
            symbols[-1] += self.end
        return tuple(v for s in self._merge(symbols) if (v := self.vocab.get(s)) is not None)

    def encode_word(self, word: str) -> tuple[int, ...]:
        found = self.by_word[word]
        if found is None:
            shown = "".join(self.shown[b] for b in word.encode("utf-8", "replace"))
            parts, ids = self.fragments(shown), []
            for k, part in enumerate(parts):
                key = (part, k == len(parts) - 1)
                piece = self.pieces[key]
                if piece is None:
                    piece = self.pieces.keep(key, self._piece(*key))
                ids += piece
            found = self.by_word.keep(word, tuple(ids))
        return found

    def _chunk(self, chunk: str) -> tuple[str, str]:
        plain = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower().translate(_LATER_LOWER)
        ids = [i for w in self.words.findall(plain) for i in self.encode_word(w)]
        return self.by_chunk.keep(chunk, (" ".join(map(str, ids)), self.decode(ids)))

    def _chunks(self, text: str) -> list[str]:
        return _CHUNKS.findall(text) if _NOT_WHITE.search(text) else text.split()

    def encode_decode(self, text: str) -> tuple[str, str]:
        """The ids as decimals, and the decoded text, both joined by one space."""
        known, out = self.by_chunk, []
        for k, part in enumerate(self.added_pattern.split(text) if self.added_pattern and "<|" in text else (text,)):
            if k % 2:
                out.append((str(self.added[part]), part))
            else:
                out += [known[c] or self._chunk(c) for c in self._chunks(part)]
        return " ".join([a for a, _ in out if a]), " ".join([b for _, b in out if b])

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_decode(text)[0].split()]

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def load(path: str) -> ForcedBoundaryBpe:
    """The tokenizer of a file, once for each Python worker."""
    keep_cache("op8", load.cache_clear)
    with open(path, encoding="utf-8") as f:
        return ForcedBoundaryBpe(json.load(f))


def bpe_encode(docs: DataFrame, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """doc_id, n_tokens, ids (decimals joined by one space) and decoded of each document (doc_id, text).

    The tokenizer file is installed with the software at the same path on every
    executor, as the libraries are.
    """

    def per_batch(batch: pa.RecordBatch):
        bpe = load(path)
        ids, decoded = zip(*(bpe.encode_decode(text.as_py() or "") for text in batch["text"]), strict=True)
        return batch["doc_id"], [x.count(" ") + 1 if x else 0 for x in ids], ids, decoded

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(source, per_batch, "doc_id long, n_tokens long, ids string, decoded string", operator="op8")


def op8_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and digests of its ids and of the decoded text."""
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return bpe_encode(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_tokens", digest("ids").alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))
