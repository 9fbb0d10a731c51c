"""Token ids in binary files with Elias-Fano encoded document boundaries.

Documents are laid out in ascending doc_id order. The file format is a Parquet table of
blocks; a block holds the ids of consecutive documents in one array, without separators
(2 bytes an id if the vocabulary allows, else 4), and two Elias-Fano sequences: where each
document ends in the array, and the doc_ids. Elias-Fano keeps the low bits of each value
as they are and the high bits in unary: about 2 + log2(ids / documents) bits a boundary,
where a plain table takes 64. A directory with the number of ones before each 512 bits of
the unary part lets `select` find the i-th boundary by a search in the directory and a
look at 64 bytes. Reading goes by slices of 1024 documents: select finds where a slice
begins and ends, and the values between are decoded together.

Documents are cut into ranges of about as many each (from percentiles of the doc_id column
alone); a doc_id, or null, that holds several ranges' worth of documents is spread over
them by a hash of the text. One task per range takes the packed ids after a single shuffle
and streams its rows into blocks of about `BLOCK_IDS` ids: a task holds one block and one
batch. Where a block starts in the whole array is known from the ranges' totals, one
number per range.

Pieces of text are found from arrays of what each character is, for many texts together;
pieces of one hash, whose characters are compared, are looked up once a batch. The model of
the tokenizers library encodes those that are not known; a worker keeps the ids of pieces
in a dictionary of bounded size.
White space never belongs to a piece, so long texts are cut at spaces.

Defined results: a null or empty text has just the end id; null doc_ids come first;
repeated doc_ids follow each other, ordered by a hash of the text; a document longer than
a block makes a longer block; an empty table gives files without blocks and an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obstar.llm.bpe import PIECES, byte_symbols, normal
from obstar.llm.common import Known, only, powers, prepare, scratch

BLOCK_IDS = 1 << 18
#: Half the number of pieces whose ids a worker remembers.
PIECES_KEPT = 500_000
#: Characters that are encoded at once; longer texts are cut at spaces.
LONG = 1 << 20
#: Characters whose pieces are found together; texts of more than `ENDLESS`, which have an
#: endless word, are encoded piece by piece.
PART, ENDLESS = 1 << 16, 1 << 22
# What a character is.
BLANK, LETTER, NUMBER, OTHER = range(4)
# Fixed value: PIECES for text without other letters, digits and white space than ASCII's.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
_CHUNK = 64  # bytes of the unary part to a directory entry


# --- Elias-Fano ----------------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of numbers from 0 on, in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, directory: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.directory = low, high, directory

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little")
        counts = np.add.reduceat(np.bitwise_count(high).astype(np.int64), np.arange(0, len(high), _CHUNK))
        before = (np.cumsum(counts) - counts).astype("<u4")
        return cls(
            n, low_bits, np.packbits(low.ravel(), bitorder="little").tobytes(), high.tobytes(), before.tobytes()
        )

    def _one(self, i: int) -> int:
        """Where the i-th one of the unary part is."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        before = np.frombuffer(self.directory, "<u4")
        part = int(np.searchsorted(before, i, side="right")) - 1
        window = np.frombuffer(self.high, np.uint8)[part * _CHUNK : (part + 1) * _CHUNK]
        ones = np.flatnonzero(np.unpackbits(window, bitorder="little"))
        return part * _CHUNK * 8 + int(ones[i - int(before[part])])

    def select(self, i: int) -> int:
        """The i-th value."""
        high = self._one(i) - i
        first = i * self.low_bits
        data = np.frombuffer(self.low, np.uint8)[first // 8 : (first + self.low_bits + 7) // 8]
        low = int.from_bytes(data.tobytes(), "little") >> (first % 8) & ((1 << self.low_bits) - 1)
        return high << self.low_bits | low

    def between(self, i: int, j: int) -> np.ndarray:
        """The i-th value to the one before the j-th: select at the bounds, decoded between."""
        if i >= j:
            return np.empty(0, np.uint64)
        first, last = self._one(i), self._one(j - 1)
        window = np.frombuffer(self.high, np.uint8)[first // 8 : last // 8 + 1]
        start = first // 8 * 8
        bits = np.unpackbits(window, bitorder="little")[first - start : last - start + 1]
        found = (np.flatnonzero(bits) + first - np.arange(i, j)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            begin, end = i * self.low_bits, j * self.low_bits
            low = np.frombuffer(self.low, np.uint8)[begin // 8 : (end + 7) // 8]
            low = np.unpackbits(low, bitorder="little")[begin % 8 : begin % 8 + end - begin]
            low = low.reshape(j - i, self.low_bits).astype(np.uint64)
            found |= (low << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return found

    def all(self) -> np.ndarray:
        """Every value, in order."""
        return self.between(0, self.n)


# --- encoding ------------------------------------------------------------------------


@lru_cache(maxsize=1)
def library(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def id_width(path: str) -> int:
    """Bytes that hold every id of the vocabulary."""
    most = max(library(path).get_vocab(with_added_tokens=True).values(), default=0)
    return 2 if most < 1 << 16 else 4


class BatchEncoder:
    """Texts to packed ids, a batch at a time."""

    def __init__(self, path: str, pieces: int = PIECES_KEPT):
        tokenizer, self.kind = library(path), f"<u{id_width(path)}"
        self.model = tokenizer.model
        self.symbols = {i: s for i, s in enumerate(byte_symbols()) if i != ord("\n")}
        added = tokenizer.get_added_tokens_decoder()
        self.special = {t.content: np.array([i], self.kind).tobytes() for i, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.known = Known(self.of_pieces, pieces)

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The library's model takes a piece in the symbols of its bytes."""
        # white space never belongs to a piece
        text = "\n".join(pieces).encode("utf-8").decode("latin-1").translate(self.symbols)
        ids: list[int] = []
        ends = [0]
        for tokens in map(self.model.tokenize, text.split("\n")):
            ids += [token.id for token in tokens]
            ends.append(len(ids))
        packed, width = np.array(ids, self.kind).tobytes(), int(self.kind[2:])
        return [packed[width * a : width * b] for a, b in zip(ends, ends[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text."""
        # special tokens are looked for in the text as it is, and cut it
        runs: list[str] = []
        order: list[list[int | bytes]] = []
        for text in texts:
            order.append([])
            found = self.parts.split(text) if text and self.parts and self.parts.search(text) else [text]
            for run in filter(None, found):
                if run in self.special:
                    order[-1].append(self.special[run])
                    continue
                for part in parts_at_spaces(run, LONG) if len(run) > LONG else (run,):
                    order[-1].append(len(runs))
                    runs.append(part)
        ids: list[bytes] = []
        held, first = 0, 0
        for i, run in enumerate(runs):
            held += len(run)
            if held >= LONG or i == len(runs) - 1:
                ids += self._runs(runs[first : i + 1])
                held, first = 0, i + 1
        return [b"".join([x if isinstance(x, bytes) else ids[x] for x in o]) for o in order]

    def _runs(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text: pieces are found and put together as arrays, and only
        each piece of all texts once is looked up."""
        texts = [normal(t) for t in texts]
        if max(map(len, texts)) > ENDLESS:
            return self._piece_by_piece(texts)
        parts, offset = [], 0
        for group in grouped(texts):
            solid, begin, end, hashes = located("\n".join(group))
            parts.append((solid, begin + offset, end + offset, hashes))
            offset += sum(map(len, group)) + len(group)
        solid, begin, end, hashes = map(np.concatenate, zip(*parts))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not same_pieces(solid, end - begin, first[which]):
            return self._piece_by_piece(texts)
        whole = "\n".join(texts)
        pieces = [whole[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
        packed = self.known.all(pieces)
        width = int(self.kind[2:])
        ids = np.frombuffer(b"".join(packed), self.kind)
        held = np.fromiter(map(len, packed), np.int64, len(packed)) // width
        n = held[which]
        ends = np.cumsum(n)
        ids = ids[np.arange(n.sum()) + np.repeat((np.cumsum(held) - held)[which] - (ends - n), n)].tobytes()
        edges = np.searchsorted(begin, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        edges = (np.concatenate(([0], ends))[edges] * width).tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def _piece_by_piece(self, texts: list[str]) -> list[bytes]:
        cut = [pieces_of(t) for t in texts]
        get = self.known.of(set().union(*cut))
        return [b"".join(map(get, c)) for c in cut]


def grouped(texts: list[str]) -> Iterator[list[str]]:
    """Texts of `PART` characters together, or little more, or a longer one alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > PART:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    yield held


def _kinds(characters: str) -> np.ndarray:
    """What PIECES takes each character for."""
    found = np.full(len(characters), OTHER, np.uint8)
    for kind, pattern in ((BLANK, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        found[[m.start() for m in regex.finditer(pattern, characters)]] = kind
    return found


@lru_cache(maxsize=1)
def _low_kinds() -> np.ndarray:
    return _kinds("".join(map(chr, range(1 << 16))))


def located(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The code points of the pieces of a text in its normal form, where these begin and end,
    and their hashes."""
    kinds = _low_kinds()
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    else:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    places = points.astype(np.intp)
    far = points >= len(kinds)
    if far.any():
        others, which = np.unique(points[far], return_inverse=True)
        places[far] = len(kinds) + which
        kinds = np.concatenate((kinds, _kinds("".join(map(chr, others.tolist())))))
    kind = np.append(kinds.take(places), [BLANK] * 3)
    full = kind != BLANK
    first = kind == NUMBER
    first[0] = full[0]
    first[1:] |= full[1:] & (kind[1:] != kind[:-1])
    # 's and the like are a piece where an apostrophe begins one
    quotes = np.flatnonzero(first[:-3] & (points == ord("'")))
    if len(quotes):
        after = np.append(points, [0, 0, 0])
        one, two = after[quotes + 1], after[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((np.isin(one, [ord(c) for c in "rv"])) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        first[quotes[short | long] + 1] = False
        beyond = np.concatenate((quotes[short] + 2, quotes[long] + 3))
        first[beyond] = full[beyond]
    begin = np.flatnonzero(first)
    end = np.flatnonzero(full[:-1] & (first[1:] | ~full[1:])) + 1
    power, inverse = powers(len(points))
    sums = np.zeros(len(points) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((points + np.uint32(1)) * power[: len(points)], out=sums[1:])
        return points[full[:-3]], begin, end, (sums[end] - sums[begin]) * inverse[begin]


def same_pieces(solid: np.ndarray, size: np.ndarray, other: np.ndarray) -> bool:
    """Whether each piece, of pieces that follow each other, has the characters of another one."""
    if (size != size[other]).any():
        return False
    begin = np.cumsum(size) - size
    its = np.arange(len(solid)) + np.repeat(begin[other] - begin, size)
    return bool((solid == solid[its]).all())


def pieces_of(text: str) -> list[str]:
    """The pieces of a text in its normal form."""
    return (ASCII_PIECES if text.isascii() else PIECES).findall(text)


def parts_at_spaces(text: str, size: int) -> Iterator[str]:
    """A text in parts of at least `size` characters, cut where a space is left out."""
    start = 0
    while len(text) - start > size:
        space = text.find(" ", start + size)
        if space < 0:
            break
        yield text[start:space]
        start = space + 1
    yield text[start:]


def library_encoder(path: str) -> BatchEncoder:
    """Encodes pieces with the tokenizers library."""
    return only(("library", path), lambda: BatchEncoder(path))


def packed_ids(text: Column, vocabulary: str, end_id: int) -> Column:
    """Ids of a text and the end id, in the vocabulary's width."""

    @F.arrow_udf("binary")
    def token_ids(texts: pa.Array) -> pa.Array:
        encode = library_encoder(vocabulary).encode
        end = np.array([end_id], f"<u{id_width(vocabulary)}").tobytes()
        return pa.array([ids + end for ids in encode(texts.to_pylist())], pa.binary())

    return token_ids(text)


# --- files ---------------------------------------------------------------------------

_BLOCKS = (
    "part int, block int, first long, n_docs int, n_ids long, width int, ids binary, n_null int, base long, last long, "
    "end_low_bits int, end_low binary, end_high binary, end_directory binary, "
    "doc_low_bits int, doc_low binary, doc_high binary, doc_directory binary"
)


def _sequence(name: str, s: EliasFano) -> dict:
    return {
        f"{name}_low_bits": s.low_bits,
        f"{name}_low": s.low,
        f"{name}_high": s.high,
        f"{name}_directory": s.directory,
    }


def _block_writer(width: int, block_ids: int):
    """Rows of (part, doc_id, ids), sorted, into blocks."""

    def block(part: int, number: int, first: int, docs: list, ids: list[bytes]) -> dict:
        ends = np.cumsum([len(x) // width for x in ids])
        known = [d for d in docs if d is not None]
        base = known[0] if known else 0
        return {
            "part": part,
            "block": number,
            "first": first,
            "n_docs": len(docs),
            "n_ids": int(ends[-1]),
            "width": width,
            "ids": b"".join(ids),
            "n_null": len(docs) - len(known),
            "base": base,
            "last": known[-1] if known else None,
            **_sequence("end", EliasFano.of(ends)),
            **_sequence("doc", EliasFano.of(np.array([d - base for d in known], np.uint64))),
        }

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema()
        part, number, first, docs, ids, held = None, 0, 0, [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([block(part, number, first, docs, ids)], schema)

        for batch in batches:
            for p, d, x in zip(*(batch.column(i) for i in range(3))):
                p, x = p.as_py(), x.as_py()
                if docs and (p != part or held >= block_ids * width):
                    yield out()
                    number, first = (number + 1, first + held // width) if p == part else (0, 0)
                    docs, ids, held = [], [], 0
                part = p
                docs.append(d.as_py())
                ids.append(x)
                held += len(x)
        if docs:
            yield out()

    return write


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in _BLOCKS.split(", "))])


def write(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int, block_ids: int = BLOCK_IDS
) -> None:
    """Encode all documents and write their ids in ascending doc_id order."""
    spark = prepare(documents.sparkSession)
    doc = F.col("doc_id").cast("long")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    first = F.coalesce(doc, F.lit(np.iinfo(np.int64).min).cast("long"))
    bounds = documents.agg(F.percentile_approx(first, shares, F.lit(10_000)).alias("b")).first()["b"]
    cuts = np.array(sorted(bounds or []), np.int64)
    # of the documents of one doc_id the hash of the text decides, in ranges and in order
    tie = F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 32).cast("int")

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, ties: pa.Array) -> pa.Array:
        """The number of bounds below an id; an id that is a bound, or several, is spread
        over the ranges that meet there."""
        ids, ties = (x.to_numpy(zero_copy_only=False) for x in (ids, ties))
        below, up_to = (np.searchsorted(cuts, ids, side=s) for s in ("left", "right"))
        share = (ties.astype(np.int64) + (1 << 31)) * (up_to - below + 1) >> 32
        return pa.array((below + share).astype(np.int32))

    width = id_width(vocabulary)
    encoded = documents.select(
        range_of(first, tie).alias("part"),
        doc.alias("doc_id"),
        packed_ids(F.col("text"), vocabulary, end_id).alias("ids"),
        tie.alias("tie"),
    )
    placed = encoded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "tie", "ids")
    placed.mapInArrow(_block_writer(width, block_ids), _BLOCKS).write.parquet(folder)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(folder)


def _sequences(row: dict) -> tuple[EliasFano, EliasFano]:
    ends, docs = (
        EliasFano(n, *(row[f"{name}_{x}"] for x in ("low_bits", "low", "high", "directory")))
        for name, n in (("end", row["n_docs"]), ("doc", row["n_docs"] - row["n_null"]))
    )
    return ends, docs


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed in 4 bytes each) of every document in the files."""
    stored = blocks(prepare(spark), folder)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts = list(accumulate((r["n"] for r in totals), initial=0))
    offsets = spark.createDataFrame(
        [(r["part"], s) for r, s in zip(totals, starts)], "part int, offset long"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ends, docs = _sequences(row)
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                n_null = row["n_null"]
                for at in range(0, ends.n, 1024):
                    to = min(at + 1024, ends.n)
                    b = ends.between(at, to).astype(np.int64)
                    a = np.concatenate(([ends.select(at - 1) if at else 0], b[:-1]))
                    known = docs.between(max(at - n_null, 0), max(to - n_null, 0)).astype(np.int64)
                    names = [None] * (to - at - len(known)) + (known + row["base"]).tolist()
                    yield pa.record_batch(
                        [
                            pa.array(names, pa.int64()),
                            pa.array(a + (row["first"] + row["offset"])),
                            pa.array(b - a),
                            pa.array([ids[x:y].tobytes() for x, y in zip(a, b)], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    # one row per range of the files: as many as the shuffle had partitions
    placed = stored.join(F.broadcast(offsets), "part")
    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def find(spark: SparkSession, folder: str, doc_id: int) -> DataFrame:
    """(doc_id, ids) of one document (of each, if the doc_id is repeated), by select."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ends, docs = _sequences(row)
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                low, high = 0, docs.n
                while low < high:  # the first that is not smaller
                    middle = (low + high) // 2
                    if docs.select(middle) + row["base"] < doc_id:
                        low = middle + 1
                    else:
                        high = middle
                while low < docs.n and docs.select(low) + row["base"] == doc_id:
                    at = low + row["n_null"]
                    own = ids[ends.select(at - 1) if at else 0 : ends.select(at)]
                    yield pa.record_batch(
                        [pa.array([doc_id]), pa.array([own.tobytes()], pa.binary())],
                        names=["doc_id", "ids"],
                    )
                    low += 1

    held = blocks(prepare(spark), folder).where((F.col("base") <= doc_id) & (F.col("last") >= doc_id))
    return held.mapInArrow(documents, "doc_id long, ids binary")


def written(documents: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    folder = scratch(documents.sparkSession, "tokens")
    write(documents, folder, vocabulary, end_id)
    return read(documents.sparkSession, folder)


def checksums(found: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32."""
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
