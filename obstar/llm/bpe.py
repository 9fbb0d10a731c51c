"""BPE encoding and decoding.

A piece of text starts as one symbol per byte, the last with the end-of-word mark.
The symbols form a doubly linked list; a priority queue holds the merge rank of each
neighbouring pair that the vocabulary can merge. The lowest rank (then the leftmost
pair) is merged first, and queue entries whose pair has changed meanwhile are skipped
when they surface. Decoding joins the vocabulary strings of the ids with one space,
as the file names no decoder.

White space never belongs to a piece, so a text is cut at white space first. Workers keep
the ids of such chunks, and of the pieces they are made of, in dictionaries of bounded
size; only pieces not seen lately go through the queue. No shuffle, one pass; memory is
that of one batch of texts and the dictionaries.

Null or empty texts have no ids and decode to the empty text; texts of any length are
encoded whole; repeated rows give repeated results; other columns are not touched.
Ids are packed as little-endian unsigned 32-bit integers. Letters that Unicode added
after the library's tables were made may be cut differently from the library.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obstar.llm.common import Remembered, only, prepare

#: Half the number of chunks, and half that of pieces, whose ids a worker remembers.
CHUNKS, PIECES_KEPT = 150_000, 350_000

# Pieces of a text, as the vocabulary file states them.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: str.split() takes these for white space, the vocabulary file does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


def byte_symbols() -> list[str]:
    """One printable character per byte: itself where printable, else the next free one above 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.mark = model.get("end_of_word_suffix") or ""
        ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        symbols = byte_symbols()
        self.inner = [ids.get(s) for s in symbols]
        self.last = [ids.get(s + self.mark) for s in symbols]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.special.items()}
        self.strings = np.full(max(strings) + 1, None, dtype=object)
        for i, s in strings.items():
            self.strings[i] = s

    def piece(self, text: str) -> list[int]:
        """Ids of one piece: merges in the order of their ranks."""
        raw = text.encode("utf-8")
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        ids = [i for i in ids if i is not None]
        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for at in range(n - 1):
            found = merges.get((ids[at], ids[at + 1]))
            if found:
                queue.append((found[0], at, found[1]))
        heapq.heapify(queue)
        while queue:
            _, at, merged = heapq.heappop(queue)
            right = after[at]
            if ids[at] < 0 or right >= n:
                continue
            found = merges.get((ids[at], ids[right]))
            if found is None or found[1] != merged:
                continue
            ids[at], ids[right] = merged, -1
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                found = merges.get((merged, ids[beyond]))
                if found:
                    heapq.heappush(queue, (found[0], at, found[1]))
            if (left := before[at]) >= 0:
                found = merges.get((ids[left], merged))
                if found:
                    heapq.heappush(queue, (found[0], left, found[1]))
        return [i for i in ids if i >= 0]

    def decode(self, packed: bytes | None) -> str:
        """The strings of packed ids, joined; ids beyond the vocabulary add nothing."""
        ids = np.frombuffer(packed or b"", "<u4")
        found = self.strings[ids[ids < len(self.strings)]].tolist()
        return " ".join([s for s in found if s is not None])

    def packed(self, piece: str) -> bytes:
        ids = self.piece(piece)
        return struct.pack(f"<{len(ids)}I", *ids)


def chunks(text: str) -> list[str]:
    """A text cut at white space."""
    if any(c in text for c in NOT_SPACE):
        return regex.split(r"\s+", text)
    return text.split()


def normal(text: str) -> str:
    if not text.isascii():
        # letter by letter: no rule for the last letter of a word
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


class Encoder:
    """Texts to packed ids, by chunks between white space and by pieces of these.

    `piece` gives the packed ids of a piece, `special` the packed id of each special token.
    """

    def __init__(
        self,
        piece: Callable[[str], bytes],
        special: dict[str, bytes],
        chunks: int | None = None,
        pieces: int | None = None,
    ):
        self.special = special
        self.pieces = Remembered(piece, pieces or PIECES_KEPT)
        self.chunks = Remembered(self.chunk, chunks or CHUNKS)
        longest_first = sorted(special, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None

    def chunk(self, text: str) -> bytes:
        if self.parts is not None and self.parts.search(text):
            parts = [p for p in self.parts.split(text) if p]
            return b"".join(self.special.get(p) or self.plain(p) for p in parts)
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(normal(text))))

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.chunks.__getitem__, chunks(text))) if text else b""


@lru_cache(maxsize=1)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


def encoder(path: str) -> Encoder:
    def made() -> Encoder:
        known = vocabulary_of(path)
        return Encoder(known.packed, {s: struct.pack("<I", i) for s, i in known.special.items()})

    return only(("bpe", path), made)


def encode(text: Column, vocabulary: str) -> Column:
    """Packed ids of a text column; `vocabulary` is a file every executor has."""

    @F.arrow_udf("binary")
    def bpe_ids(texts: pa.Array) -> pa.Array:
        one = encoder(vocabulary).encode
        return pa.array([one(t.as_py()) for t in texts], pa.binary())

    return bpe_ids(text)


def decode(ids: Column, vocabulary: str) -> Column:
    """Text of a column of packed ids: the vocabulary strings, joined with one space.

    An id that the vocabulary does not have adds nothing; null ids give the empty text.
    """

    @F.arrow_udf("string")
    def bpe_text(packed: pa.Array) -> pa.Array:
        one = vocabulary_of(vocabulary).decode
        return pa.array([one(p.as_py()) for p in packed], pa.string())

    return bpe_text(ids)


def round_trip(text: Column, vocabulary: str) -> Column:
    """A struct of the packed ids and the text they decode to, in one pass of a worker."""

    @F.arrow_udf("ids binary, decoded string")
    def bpe_round_trip(texts: pa.Array) -> pa.Array:
        one, back = encoder(vocabulary).encode, vocabulary_of(vocabulary).decode
        ids = [one(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array([back(i) for i in ids], pa.string())],
            names=["ids", "decoded"],
        )

    return bpe_round_trip(text)


def encoded_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids and decoded text of each document."""
    prepare(documents.sparkSession)
    found = documents.select("doc_id", round_trip(F.col("text"), vocabulary).alias("found"))
    return found.select("doc_id", "found.ids", "found.decoded")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
