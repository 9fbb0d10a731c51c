"""Alignment of the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes. Tokens whose byte ranges overlap belong together; the
groups are the components of that relation. Every token points to the farthest-right
token that overlaps it: the token of the other side that holds its last byte, or itself if
none reaches further. Successor doubling (every pointer becomes the pointer of what it
points to) brings all tokens of a component to its last token in as many rounds as the
logarithm of the longest chain; that token labels the group. All texts of a batch are
laid side by side and doubled at once with numpy.

Links are the pairs of tokens that end together. Of two tokens that end at one byte, the
bytes of one are the end of the bytes of the other. So the vocabularies alone bound the
pairs of ids that can ever be linked: `Pairs` numbers them all, from the suffixes of the
tokens' bytes. A link is then a number below that bound, and the corpus-wide counts are
one array of this fixed length (a few hundred thousand numbers for the vocabularies here),
summed per task, then by number, and handed to the second pass, which takes each
document's links from the stored first pass.

A text of more than `LONG` characters is cut at single spaces between other characters,
where both tokenizers always begin a new token: the byte-level one takes the space with
the word that follows, and no piece of the other has the space mark after another
character (checked when it is loaded; else texts are not cut). Memory is that of a batch
of `BATCH` characters, the links of one document and the array of counts.

Defined results: null and empty texts, and texts whose tokens do not give back their
bytes, have no tokens, zeros and an empty digest; repeated rows give repeated results and
count as often as they occur; null doc_ids are kept; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.llm.bpe import byte_symbols
from obstar.llm.common import only, prepare
from obstar.session import materialize

#: Characters that are aligned at once, and beyond which a text is cut.
BATCH, LONG = 1 << 20, 1 << 18
#: The vocabularies together must keep the array of counts below this many pairs.
MOST_PAIRS = 1 << 24

# Fixed value: how the byte-level vocabulary cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_MARK = "▁"
_SPACE = re.compile(r"(?<=\S) (?=\S)")


class ByteLevel:
    """The byte-level vocabulary of a file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = {s: i for i, s in enumerate(byte_symbols())}
        ids = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if set(token) <= byte_of.keys()}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        made = set(merged)
        for token in [t for t in model["vocab"] if len(t) > 1 and t not in made]:
            ids.pop(bytes(byte_of[c] for c in token), None)  # never comes out of a text
        ranks = [model["vocab"][m] for m in merged]
        if ranks != sorted(ranks):
            raise ValueError("the ids of the byte-level vocabulary must rise with the ranks of its merges")
        self.bytes = [b""] * (max(model["vocab"].values()) + 1)
        for raw, i in ids.items():
            self.bytes[i] = raw
        self._coder = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._coder.encode_ordinary(t) for t in texts]


class Pieces:
    """The pieces of a sentencepiece model."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes = [
            bytes([int(name[3:5], 16)])
            if self._model.is_byte(i)
            else name.replace(SPACE_MARK, " ").encode("utf-8")
            for i, name in enumerate(names)
        ]
        # a piece never begins before a space and ends after it
        self.cuts_at_spaces = not any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class Pairs:
    """All pairs of ids (a, b) that can end together, numbered.

    The bytes of a are an end of those of b or the other way round.
    """

    def __init__(self, a: list[bytes], b: list[bytes]):
        by_bytes: tuple[dict, dict] = ({}, {})
        for known, side in zip(by_bytes, (a, b)):
            for i, raw in enumerate(side):
                if raw:
                    known.setdefault(raw, []).append(i)
        keys = set()
        for raw, ids in by_bytes[0].items():
            for start in range(len(raw)):
                keys.update((i << 32) | j for j in by_bytes[1].get(raw[start:], ()) for i in ids)
        for raw, ids in by_bytes[1].items():
            for start in range(len(raw)):
                keys.update((i << 32) | j for i in by_bytes[0].get(raw[start:], ()) for j in ids)
        if len(keys) > MOST_PAIRS:
            raise ValueError(f"{len(keys)} pairs of ids can be linked, more than {MOST_PAIRS}")
        self.keys = np.array(sorted(keys), np.int64)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, (a.astype(np.int64) << 32) | b).astype(np.int32)

    def best(self, counts: np.ndarray) -> np.ndarray:
        """Whether a pair's count is the highest of its b."""
        b = self.keys & 0xFFFFFFFF
        most = np.zeros(int(b.max(initial=0)) + 1, np.int64)
        np.maximum.at(most, b, counts)
        return counts == most[b]


class Aligner:
    """Both tokenizers, with what is derived from their vocabularies."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = ByteLevel(byte_level), Pieces(pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b))
        self.pairs = Pairs(self.a.bytes, self.b.bytes)

    def parts(self, text: str) -> list[str]:
        """A long text, cut at spaces where both tokenizers begin anew."""
        if len(text) <= LONG or not self.b.cuts_at_spaces:
            return [text]
        found, start = [], 0
        while len(text) - start > LONG:
            space = _SPACE.search(text, start + LONG)
            if not space:
                break
            found.append(text[start : space.start()])
            start = space.end()
        return [*found, text[start:]]

    def aligned(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, links, groups) per text: links as numbers of pairs, groups as bytes.

        None where the tokens do not give back the text.
        """
        a, b = self.a.encode([" " + t for t in texts]), self.b.encode(texts)
        good = []
        for i, text in enumerate(texts):
            raw = (" " + text).encode("utf-8")
            if not (
                raw == b"".join([self.a.bytes[x] for x in a[i]])
                and raw == b"".join([self.b.bytes[x] for x in b[i]])
            ):
                a[i] = b[i] = []
            else:
                good.append(i)
        lengths = [np.array([len(x) for x in side], np.int64) for side in (a, b)]
        ids_a, ids_b = (np.array([i for x in side for i in x], np.int64) for side in (a, b))
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        label_a, label_b, linked_a, linked_b = components(end_a, end_b)
        numbers = self.pairs.numbers(ids_a[linked_a], ids_b[linked_b])
        written, starts = written_groups(ids_a, ids_b, label_a, label_b)

        bounds_a, bounds_b = (np.r_[0, np.cumsum(n)] for n in lengths)
        # links and groups are in the order of the text: those of a document stand together
        links_at = np.searchsorted(linked_a, bounds_a)
        out: list[tuple | None] = [None] * len(texts)
        for i in good:
            first, last = bounds_a[i] + bounds_b[i], bounds_a[i + 1] + bounds_b[i + 1]
            own = numbers[links_at[i] : links_at[i + 1]]
            groups = written[starts[first] : starts[last] - 1].tobytes()
            n_groups = int(label_a[bounds_a[i + 1] - 1] - label_a[bounds_a[i]] + 1)
            out[i] = (int(lengths[0][i]), int(lengths[1][i]), n_groups, own, groups)
        return out


def components(end_a: np.ndarray, end_b: np.ndarray) -> tuple:
    """Groups of tokens that overlap, from where the tokens of both sides end.

    Returns the group of each token of a and of b, numbered in order, and the positions of
    the linked tokens of a and b. Tokens have at least one byte, and both sides cover the
    same bytes.
    """
    n, m = len(end_a), len(end_b)
    in_b = np.searchsorted(end_b, end_a)  # the token of b that holds a's last byte
    in_a = np.searchsorted(end_a, end_b)
    # a token that reaches as far as b's is b's: the last token of a component is one of b
    to = np.concatenate([in_b + n, np.where(end_a[in_a] > end_b, in_a, np.arange(m) + n)]) if m else in_b
    while True:
        further = to[to]
        if (further == to).all():
            break
        to = further
    last, label = np.unique(to, return_inverse=True)
    linked_b = last - n  # tokens that end a component end together with one of a
    linked_a = in_a[linked_b]
    return label[:n], label[n:], linked_a, linked_b


@lru_cache(maxsize=1)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n-1, one byte left over, and how many there are."""
    names = np.array([str(i) for i in range(n)], "S9")
    width = int(np.char.str_len(names[-1:])[0]) + 1
    return np.array(names, f"S{width}").view(np.uint8).reshape(n, width).copy(), np.char.str_len(names)


def written_groups(
    ids_a: np.ndarray, ids_b: np.ndarray, label_a: np.ndarray, label_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All groups as `a1,a2|b1;a3|b2,b3;` and where each token's text begins in it.

    Tokens are in the order in which they are written; the last entry is the whole length.
    """
    n, m = len(ids_a), len(ids_b)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    groups = int(label_a[-1]) + 1
    count_a, count_b = np.bincount(label_a, minlength=groups), np.bincount(label_b, minlength=groups)
    up_to_a, up_to_b = np.cumsum(count_a), np.cumsum(count_b)
    at_a = np.arange(n) + (up_to_b - count_b)[label_a]
    at_b = np.arange(m) + up_to_a[label_b]
    ids = np.empty(n + m, np.int64)
    ids[at_a], ids[at_b] = ids_a, ids_b
    digits, lengths = _decimals(int(ids.max()) + 1)
    end = np.full(n + m, ord(","), np.uint8)
    end[at_a[up_to_a - 1]], end[at_b[up_to_b - 1]] = ord("|"), ord(";")
    cells, used = digits[ids], lengths[ids]
    cells[np.arange(n + m), used] = end
    starts = np.r_[0, np.cumsum(used + 1)]
    return cells[np.arange(cells.shape[1]) <= used[:, None]], starts


def aligner(byte_level: str, pieces: str) -> Aligner:
    return only(("align", byte_level, pieces), lambda: Aligner(byte_level, pieces))


# --- two passes ----------------------------------------------------------------------

_FIRST = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, counts binary"
)


class _Document:
    """What is known of a document while its parts are aligned."""

    def __init__(self, doc_id):
        self.doc_id, self.good = doc_id, True
        self.totals, self.links, self.digest = np.zeros(3, np.int64), [], None

    def add(self, part: tuple | None) -> None:
        if part is None:
            self.good = False
        if not self.good:
            self.links = []
            return
        self.totals += part[:3]
        self.links.append(part[3])
        if self.digest is None:
            self.digest = hashlib.sha256()
        else:
            self.digest.update(b";")
        self.digest.update(part[4])

    def row(self, counts: np.ndarray) -> tuple:
        if not self.good or self.digest is None:
            return (self.doc_id, 0, 0, 0, 0, "", b"", None)
        links = np.concatenate(self.links)
        np.add.at(counts, links, 1)
        return (self.doc_id, *self.totals.tolist(), len(links), self.digest.hexdigest(), packed(links), None)


def packed(links: np.ndarray) -> bytes:
    """Numbers in planes of bytes, the lowest first: the higher planes are nearly constant."""
    return links.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [c.split() for c in _FIRST.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)],
        names=[name for name, _ in fields],
    )


def _first_pass(byte_level: str, pieces: str):
    """Documents to their rows; a task's last row has its counts of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_level, pieces)
        counts = np.zeros(len(both.pairs.keys), np.int64)
        for batch in batches:
            waiting: list[tuple[_Document, str]] = []
            rows: list[_Document] = []
            held = 0

            def work() -> None:
                for (document, _), found in zip(waiting, both.aligned([t for _, t in waiting])):
                    document.add(found)
                waiting.clear()

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.append(_Document(doc_id))
                for part in both.parts(text.as_py() or "") if text.is_valid else ():
                    if part:
                        waiting.append((rows[-1], part))
                        held += len(part)
                    if held >= BATCH:
                        work()
                        held = 0
            work()
            yield _rows([d.row(counts) for d in rows])
        seen = np.flatnonzero(counts)
        if seen.size:
            both_numbers = np.stack([seen, counts[seen]]).astype("<i8").tobytes()
            yield _rows([(None, 0, 0, 0, 0, None, None, both_numbers)])

    return run


def _summed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of many tasks as one row per number."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for data in batch.column(0):
            numbers, counts = np.frombuffer(data.as_py(), "<i8").reshape(2, -1)
            if numbers[-1] >= len(total):
                total = np.r_[total, np.zeros(int(numbers[-1]) + 1 - len(total), np.int64)]
            total[numbers] += counts
    seen = np.flatnonzero(total)
    for at in range(0, len(seen), 1 << 16):
        part = seen[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])


def align(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document.

    `byte_level` is a vocabulary file of the tokenizers library, `pieces` a model of
    sentencepiece; every executor must have both.
    """
    spark = prepare(documents.sparkSession)
    given = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    stored = materialize(given.mapInArrow(_first_pass(byte_level, pieces), _FIRST), "aligned", spark)

    # as many rows as the vocabularies have pairs at most, whatever the corpus is
    parts = stored.where("counts IS NOT NULL").select("counts").mapInArrow(_summed_counts, "pair long, n long")
    known = parts.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    both = Aligner(byte_level, pieces)
    counts = np.zeros(len(both.pairs.keys), np.int64)
    counts[known["pair"].to_numpy()] = known["n"].to_numpy()
    shared = spark.sparkContext.broadcast((counts, np.packbits(both.pairs.best(counts))))

    @F.arrow_udf("n_best long, count_sum long")
    def judged(links: pa.Array) -> pa.Array:
        counts, bits = shared.value
        best = np.unpackbits(bits, count=len(counts)).astype(bool)
        found = [unpacked(x.as_py()) for x in links]
        return pa.StructArray.from_arrays(
            [
                pa.array([int(best[x].sum()) for x in found], pa.int64()),
                pa.array([int(counts[x].sum()) for x in found], pa.int64()),
            ],
            names=["n_best", "count_sum"],
        )

    found = stored.where("counts IS NULL").withColumn("_found", judged("links"))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "_found.n_best", "_found.count_sum", "groups_sha256"
    )
