"""Benchmark decontamination by template canonicalisation.

A text is cut into words; a word loses the punctuation about it and its case. Numbers,
names and units become typed slots: a number is a word that begins with a digit or is a
listed number word, a unit is a listed word after a number, a name is a word of two
letters or more with a capital among them. A capital at the start of a sentence may be a
name's or not, and case may differ, so there are three templates: with numbers and units
left open, with names inside sentences too, and with all names.

Words are found and judged for many texts at a time, from arrays of what each character
is: a dictionary of words would be looked up, and missed, once a word. Words with
characters of unusual case, or with a hyphen inside, are judged one by one.

A window is `window` tokens in a row; it is looked for word for word, and as each template
that differs. A template with more slots than words would match too much: such a window is
made longer, to its right and to its left, until it holds half a window of words. Texts
with fewer words than that, and items shorter than a window with more slots than words,
are found word for word only.

The windows of documents are hash-joined with those of the benchmark and compared as
text. All documents' windows need not be shuffled for that: a bitmap of the benchmark's
window hashes, of fixed size (`FILTER_BITS`) however large the benchmark is, goes to the
tasks, and windows that it rules out are not sent. A larger benchmark only makes it let
more windows through; the join that follows is an ordinary one.

Slot consistency: windows of a document and an item that have the same offset belong to
one alignment. In it, and for each kind of template with the kinds before it, each value of an item's slot must stand for one value in the
document, and the other way round; the templates of an alignment where Anna is once Mary
and once Tom are dropped as coincidence, its windows word for word stay. What is left catches items word for word, and items asked again
with other numbers, names and units. A document is contaminated by an item if consistent
alignments cover at least `least` of the item's tokens (all, if it has fewer).

Defined results: null, empty and blank texts have no windows; texts of any length are
searched whole; items of fewer than `SHORTEST` tokens cannot be told from ordinary prose
inside a text and are found, word for word, where they are all of a document; items
shorter than a window are looked for as a whole; items of
the same tokens count as the one with the smallest id; rows that repeat a doc_id are
searched each, and the largest coverage counts; a null doc_id or item_id is a value like
any other; empty tables give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.llm.common import BASE, powers, prepare
from obstar.session import materialize

WINDOW, LEAST, SHORTEST = 8, 13, 5
TEMPLATES = 3
FILTER_BITS = 1 << 23

# Units of measure.
UNITS = frozenset(
    """mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t oz lb lbs pound
    pounds ton tons ml cl l litre litres liter liters gallon gallons ms s sec second seconds min
    minute minutes h hr hour hours day days week weeks month months year years percent % cent cents
    euro euros dollar dollars usd eur gbp hz khz mhz ghz w kw mw kwh v volt volts a amp amps j kj cal
    kcal pa kpa bar k c f degree degrees byte bytes kb mb gb tb bit bits kmh mph""".split()
)

# Words for numbers.
NUMBER_WORDS = frozenset(
    """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
    sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred
    thousand million billion trillion dozen half""".split()
)
_TENS = frozenset("twenty thirty forty fifty sixty seventy eighty ninety".split())

EMPTY, NUMBER, CAPITAL, UNIT, STOP = 1, 2, 4, 8, 16
STOPS = frozenset(".!?:…")
CLOSING = "\"')]»”’"
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_GLUED = re.compile(r"(?<=\d)(?=[^\W\d_]|%)|(?<=[$€£])(?=\d)")
_SPACE, _WORD = re.compile(r"\s"), re.compile(r"\S+")
_SLOTS = {1: "<num>", 2: "<name>", 3: "<unit>"}


#: The listed words, and what they may be.
_LISTED = {w: (NUMBER if w in NUMBER_WORDS else 0) | (UNIT if w in UNITS else 0) for w in NUMBER_WORDS | UNITS}

#: Characters that are looked at together; texts are cut at white space for that. Parts of
#: more than `ENDLESS`, which have an endless word, are looked at word by word.
PART, ENDLESS = 1 << 16, 1 << 20

# What a character is.
BLANK, DECIMAL, LETTER, CURRENCY, INNER, UPPER, ODD, HYPHEN = (1 << i for i in range(8))


def normal(word: str) -> str:
    low = word.lower()
    return low if low == "%" else _EDGES.sub("", low)


def code(word: str) -> tuple[int, str]:
    """What a word may be, and its normal form."""
    low, bare = normal(word), _EDGES.sub("", word)
    flags = _LISTED.get(low, 0) if low else EMPTY
    if low[:1].isdigit() or ("-" in low and low.partition("-")[0] in _TENS):
        flags |= NUMBER
    if word.rstrip(CLOSING)[-1:] in STOPS:
        flags |= STOP
    if len(bare) > 1 and bare != bare.lower():
        flags |= CAPITAL
    return flags, low


def _character(c: str) -> tuple[int, int]:
    """What a character is, and its lower case.

    It is odd if its lower case depends on other characters, is not one character, or is
    of another kind, or if it is a digit that is not decimal.
    """
    low = c.lower()
    odd = c == "Σ" or len(low) != 1 or c.isalnum() != low.isalnum() or c.isdigit() != c.isdecimal()
    found = (
        (BLANK, c.isspace()),
        (DECIMAL, c.isdecimal()),
        (LETTER, c == "%" or c.isalnum() and not c.isdecimal()),
        (CURRENCY, c in "$€£"),
        (INNER, c.isalnum()),
        (UPPER, low != c),
        (ODD, odd),
        (HYPHEN, c == "-"),
    )
    return sum(bit for bit, there in found if there), ord(low[0])


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """What each character below 65536 is, and its lower case."""
    kinds, lows = zip(*(_character(chr(i)) for i in range(1 << 16)))
    return np.array(kinds, np.uint8), np.array(lows, np.uint64)


def _mixed(sums: np.ndarray) -> np.ndarray:
    sums = (sums ^ (sums >> np.uint64(32))) * BASE
    return sums ^ (sums >> np.uint64(29))


def _literal(low: str) -> np.uint64:
    """The hash of a word's normal form, as `_words` has it."""
    if len(low) > ENDLESS:
        return np.uint64(xxhash.xxh64_intdigest(low.encode("utf-8", "replace")))
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    with np.errstate(over="ignore"):
        return _mixed((points * powers(len(points))[0][: len(points)]).sum(dtype=np.uint64, keepdims=True))[0]


@lru_cache(maxsize=1)
def _listed() -> tuple[np.ndarray, ...]:
    """The listed words by their hash: what the hash may begin with, hashes, lengths, characters, flags."""
    words = sorted(_LISTED, key=_literal)
    hashes = np.array([_literal(w) for w in words], np.uint64)
    begins = np.zeros(1 << 16, bool)
    begins[hashes >> np.uint64(48)] = True
    lengths = np.array([len(w) for w in words])
    letters = np.zeros((len(words), lengths.max()), np.uint64)
    for row, word in zip(letters, words):
        row[: len(word)] = [ord(c) for c in word]
    return begins, hashes, lengths, letters, np.array([_LISTED[w] for w in words], np.uint8)


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _words_one_by_one(text: str) -> Found:
    spans = []
    for word in _WORD.finditer(text):
        cuts = [m.start() for m in _GLUED.finditer(text, word.start(), word.end())]
        spans += zip([word.start(), *cuts], [*cuts, word.end()])
    found = [code(text[a:b]) for a, b in spans]
    begin, end = np.array(spans, np.int64).reshape(-1, 2).T
    literal = np.array([_literal(low) for _, low in found], np.uint64)
    return begin, end, np.array([flags for flags, _ in found], np.uint8), literal


def _words(text: str) -> Found:
    """Where the words of a text begin and end, what they may be, and hashes of their normal forms.

    All words together, from what the characters are; `code` has the rules, and looks at
    the words that have odd characters or a hyphen inside.
    """
    kinds, lows = _characters()
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8).astype(np.intp)
    else:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.intp)
        far = points >= len(kinds)
        if far.any():
            others, place = np.unique(points[far], return_inverse=True)
            more = [_character(chr(i)) for i in others.tolist()]
            points[far] = len(kinds) + place
            kinds = np.concatenate((kinds, np.array([k for k, _ in more], np.uint8)))
            lows = np.concatenate((lows, np.array([low for _, low in more], np.uint64)))
    kind, low = kinds.take(points), lows.take(points)

    first = (kind & BLANK) == 0
    last = first.copy()
    first[1:] &= ~last[:-1]
    last[:-1] &= (kind[1:] & BLANK) > 0
    digits = np.flatnonzero(kind & DECIMAL)
    if len(digits):
        # a number's unit, and a price's currency, are words of their own
        after, before = digits[digits + 1 < len(kind)] + 1, digits[digits > 0]
        cuts = np.concatenate((after[(kind[after] & LETTER) > 0], before[(kind[before - 1] & CURRENCY) > 0]))
        first[cuts], last[cuts - 1] = True, True
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(begin):
        return begin, end, np.empty(0, np.uint8), np.empty(0, np.uint64)

    # the normal form is from the first letter or digit to the last
    inner = (kind & INNER) > 0
    places = np.append(np.flatnonzero(inner), 0)
    count = np.zeros(len(kind) + 1, np.int32)
    np.cumsum(inner, out=count[1:])
    n_begin, n_end = count[begin], count[end]
    some = n_end > n_begin
    a = np.where(some, places[n_begin], begin)
    z = np.where(some, places[n_end - 1] + 1, begin)
    percent = np.flatnonzero((end - begin == 1) & (low[begin] == ord("%")))
    z[percent] = end[percent]
    power, inverse = powers(len(kind))
    sums = np.zeros(len(kind) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(low * power[: len(low)], out=sums[1:])
        literal = _mixed((sums[z] - sums[a]) * inverse[a])

    flags = np.where(z > a, 0, EMPTY).astype(np.uint8)
    flags[some & ((kind[a] & DECIMAL) > 0)] |= NUMBER
    mark = end - 1
    closing, stops = ([ord(c) for c in x] for x in (CLOSING, STOPS))
    maybe = np.flatnonzero((kind[mark] & INNER) == 0)
    at = mark[maybe]
    shut = np.isin(low[at], closing) & (at > begin[maybe])
    open_ = np.append(np.flatnonzero(~np.isin(low, closing)), 0) if shut.any() else None
    if open_ is not None:
        back = np.searchsorted(open_[:-1], at[shut]) - 1
        at[shut] = np.where(back >= 0, np.maximum(open_[back], begin[maybe][shut]), begin[maybe][shut])
    flags[maybe[np.isin(low[at], stops)]] |= STOP
    upper = np.flatnonzero(kind & UPPER)
    word = np.searchsorted(begin, upper, side="right") - 1
    upper = word[(a[word] <= upper) & (upper < z[word]) & (z[word] - a[word] > 1)]
    flags[upper] |= CAPITAL

    begins, hashes, lengths, letters, meant = _listed()
    maybe = np.flatnonzero(begins[literal >> np.uint64(48)])
    which = np.minimum(np.searchsorted(hashes, literal[maybe]), len(hashes) - 1)
    same = (hashes[which] == literal[maybe]) & (lengths[which] == (z - a)[maybe])
    maybe, which = maybe[same], which[same]
    reach = np.arange(letters.shape[1])
    there = low[np.minimum(a[maybe][:, None] + reach, len(low) - 1)] == letters[which]
    same = (there | (reach >= lengths[which][:, None])).all(axis=1)
    flags[maybe[same]] |= meant[which[same]]

    odd = np.flatnonzero(kind & (ODD | HYPHEN))
    if len(odd):
        word = np.searchsorted(begin, odd, side="right") - 1
        for i in np.unique(word[((kind[odd] & ODD) > 0) | ((a[word] < odd) & (odd < z[word]))]).tolist():
            flags[i], form = code(text[begin[i] : end[i]])
            literal[i] = _literal(form)
    return begin, end, flags, literal


def _located(text: str) -> Found:
    """The words of a text of any length, in parts that are cut at white space."""
    found, start = [], 0
    while start < len(text) or not found:
        space = _SPACE.search(text, start + PART) if len(text) - start > PART else None
        stop = space.start() if space else len(text)
        part = text[start:stop]
        begin, end, *rest = (_words if len(part) <= ENDLESS else _words_one_by_one)(part)
        found.append((begin + start, end + start, *rest))
        start = stop
    return found[0] if len(found) == 1 else tuple(map(np.concatenate, zip(*found)))


class Tokens:
    """The tokens of texts, one text after the other: words, literal hashes, slot types (0:
    none) of each template. The tokens of the i-th text are those from edges[i] on."""

    def __init__(self, *texts: str | None):
        self.text = "\n".join([t or "" for t in texts])
        begin, end, flags, literal = _located(self.text)
        offsets = np.cumsum([0, *(len(t or "") + 1 for t in texts)])
        edges = np.searchsorted(begin, offsets)
        starts = np.ones(len(begin) + 1, bool)
        starts[1:] = (flags & STOP) > 0
        starts[edges] = True
        is_used = (flags & EMPTY) == 0
        used = np.flatnonzero(is_used)
        self.edges = np.concatenate(([0], np.cumsum(is_used)))[edges]
        self.begin, self.end, starts, found = begin[used], end[used], starts[used], flags[used]
        number = (found & NUMBER) > 0
        after = np.zeros(len(found) + 1, bool)
        after[1:] = number
        after[self.edges] = False
        unit = ((found & UNIT) > 0) & after[:-1] & ~number
        name = ((found & CAPITAL) > 0) & ~number & ~unit
        numbers = np.where(number, 1, np.where(unit, 3, 0)).astype(np.int8)
        inside = np.where(name & ~starts, np.int8(2), numbers)
        self.kinds = [np.zeros(len(found), np.int8), numbers, inside, np.where(name, np.int8(2), numbers)]
        self.literal = literal[used]
        self.sums: dict[int, np.ndarray] = {}

    def words(self, at: int, end: int) -> list[str]:
        """Some tokens in their normal forms."""
        spans = zip(self.begin[at:end].tolist(), self.end[at:end].tolist())
        return [normal(self.text[a:b]) for a, b in spans]

    def __len__(self) -> int:
        return len(self.begin)

    def windows(
        self, size: int, longer: bool, whole: bool = False
    ) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Where windows begin and end, with their hashes: as they are (0), and by template.

        They are of `size` tokens; with `longer`, those of too few words are longer; with
        `whole`, only those that are all of a text. A window is there for a template only if
        it differs from that of the one before.
        """
        held = np.diff(self.edges)
        from_, to = np.repeat(self.edges[:-1], held), np.repeat(self.edges[1:], held)
        begin = self.edges[:-1][held == size] if whole else np.flatnonzero(np.arange(size, len(self) + size) <= to)
        if not len(begin):
            return []
        end = begin + size
        found = [(0, begin, end, self.hashed(0, begin, end))]
        for level in range(1, len(self.kinds)):
            is_open = self.kinds[level] > 0
            new = self.kinds[level] != self.kinds[level - 1]
            if not new.any():
                continue
            before = np.concatenate(([0], np.cumsum(is_open)))
            added = np.concatenate(([0], np.cumsum(new)))
            few = 2 * (before[end] - before[begin]) > size
            first, last = begin[~few], end[~few]
            if longer and few.any():
                plain, words = np.flatnonzero(~is_open), size - size // 2
                more = self.lengthened(plain, begin[few], end[few], words, from_[begin[few]], to[begin[few]])
                first, last = np.concatenate((first, more[0])), np.concatenate((last, more[1]))
            kept = added[last] > added[first]
            first, last = first[kept], last[kept]
            if len(first):
                found.append((level, first, last, self.hashed(level, first, last)))
        return found

    @staticmethod
    def lengthened(
        plain: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int, from_: np.ndarray, to: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The windows with as many plain words as asked for that begin, or end, where these do,
        in the texts that go from `from_` to `to`."""
        if len(plain) < least:
            return begin[:0], end[:0]
        right = np.searchsorted(plain, begin) + least - 1
        fits = (right < len(plain)) & (plain[np.minimum(right, len(plain) - 1)] < to)
        left = np.searchsorted(plain, end) - least
        reaches = (left >= 0) & (plain[np.maximum(left, 0)] >= from_)
        return (
            np.concatenate((begin[fits], plain[left[reaches]])),
            np.concatenate((plain[right[fits]] + 1, end[reaches])),
        )

    def hashed(self, level: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hashes of windows of any size, from running sums of the tokens' hashes."""
        power, inverse = powers(len(self))
        with np.errstate(over="ignore"):
            if level not in self.sums:
                kind = self.kinds[level]
                tokens = np.where(kind > 0, kind.astype(np.uint64), self.literal) if level else self.literal
                sums = np.zeros(len(tokens) + 1, np.uint64)
                np.cumsum(tokens * power[: len(tokens)], out=sums[1:])
                self.sums[level] = sums
            sums = self.sums[level]
            total = (sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64)
            return ((total ^ (total >> np.uint64(31))) * BASE).view(np.int64)

    def shown(self, at: int, end: int, level: int) -> tuple[str, list[str]]:
        """The window as text, and its open slots as type and value."""
        plain = self.words(at, end)
        if not level:
            return " ".join(plain), []
        kinds = self.kinds[level][at:end].tolist()
        slots = [f"{_SLOTS[k]}{w}" for k, w in zip(kinds, plain) if k]
        return " ".join(_SLOTS[k] if k else w for k, w in zip(kinds, plain)), slots


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, size, shown, item_id, item_at, item_level, item_slots, tokens) of every item's windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = Tokens(text)
                size = min(window, len(tokens))
                if not size:
                    continue
                whole = " ".join(tokens.words(0, len(tokens)))
                key = xxhash.xxh64_intdigest(whole.encode(), 1) >> 1
                for level, begin, ends, hashes in tokens.windows(size, size == window):
                    if level and size < SHORTEST:
                        continue
                    for at, end, h in zip(begin.tolist(), ends.tolist(), hashes.tolist()):
                        shown, slots = tokens.shown(at, end, level)
                        out.append((h, end - at, shown, item, key, at, level, slots, len(tokens)))
            names = ["h", "size", "shown", "item_id", "same", "item_at", "item_level", "item_slots", "tokens"]
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, _ITEM_TYPES)], names=names
            )

    found = benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
        rows,
        "h long, size int, shown string, item_id long, same long, item_at int, "
        "item_level int, item_slots array<string>, tokens int",
    )
    return (
        found.groupBy("h", "size", "shown", "same", "item_at", "item_slots", "tokens")
        .agg(F.min("item_id").alias("item_id"), F.min("item_level").alias("item_level"))
        .drop("same")
    )


_ITEM_TYPES = [
    pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(),
    pa.int32(), pa.list_(pa.string()), pa.int32(),
]


def window_filter(items: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """A bitmap of the windows' hashes: of fixed size, whatever the benchmark's."""
    place = F.pmod(F.col("h"), F.lit(bits)) + 1
    parts = (
        items.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("map"))
        .collect()
    )
    one = 32768 // 8
    found = bytearray(bits // 8)
    for row in parts:
        start = (row["part"] - 1) * one
        found[start : start + len(row["map"])] = row["map"]
    return bytes(found)


def groups(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts that are looked at together, with the number of the first: of `PART` characters
    or little more, or a longer one alone."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text.as_py()
        if held and size + len(text or "") > PART:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text or "") + 1
    if held:
        yield first, held


def document_windows(
    documents: DataFrame, sizes: list[int], passing: bytes, window: int = WINDOW
) -> DataFrame:
    """(doc_id, text_hash, h, size, shown, at, level, slots) of the windows the filter lets through."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(passing, np.uint8)
        most = np.int64(len(bitmap) * 8)
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for first, texts in groups(batch.column(2)):
                tokens = Tokens(*texts)
                for size in sizes:
                    # only a document's whole text is an item of few tokens
                    for level, begin, ends, found in tokens.windows(size, size == window, size < SHORTEST):
                        bit = found % most
                        hits = np.flatnonzero((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                        begin = begin[hits]
                        text = np.searchsorted(tokens.edges, begin, side="right") - 1
                        passed = zip(text.tolist(), begin.tolist(), ends[hits].tolist(), found[hits].tolist())
                        for i, at, end, h in passed:
                            shown, slots = tokens.shown(at, end, level)
                            own = at - int(tokens.edges[i])
                            out.append((ids[first + i], hashes[first + i], h, end - at, shown, own, level, slots))
            names = ["doc_id", "text_hash", "h", "size", "shown", "at", "level", "slots"]
            columns = list(zip(*out)) or [[]] * len(names)
            types = [
                pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(),
                pa.int32(), pa.list_(pa.string()),
            ]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    plain = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    return plain.mapInArrow(
        rows,
        "doc_id long, text_hash long, h long, size int, shown string, at int, level int, slots array<string>",
    )


def contaminated(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, least: int = LEAST
) -> DataFrame:
    """(doc_id, item_id, covered, item_tokens, reworded): a row per document and item found in it."""
    spark = prepare(documents.sparkSession)
    items = materialize(item_windows(benchmark, window), "items", spark)
    # a few window sizes: the usual one, and those of items shorter than it
    sizes = sorted(r["size"] for r in items.select("size").where(F.col("size") <= window).distinct().collect())
    passing = document_windows(documents, sizes, window_filter(items), window)
    met = materialize(passing.join(items, ["h", "size", "shown"]).drop("h", "shown"), "met", spark)

    alignment = ["doc_id", "text_hash", "item_id", "shift"]
    kind = [*alignment, "level"]
    aligned = met.withColumn("shift", F.col("at") - F.col("item_at")).withColumn(
        "level", F.greatest("level", "item_level")
    )
    is_open = F.array_size("item_slots") > 0
    # the slots of a kind of template count for those with more slots, too
    pairs = (
        aligned.where(is_open)
        .select(*kind, F.explode(F.arrays_zip("item_slots", "slots")).alias("slot"))
        .select(*kind, "slot.item_slots", "slot.slots")
        .distinct()
        .withColumn("level", F.explode(F.sequence("level", F.lit(TEMPLATES))))
    )
    unsound = (
        pairs.groupBy(*kind)
        .agg(
            F.count_distinct("item_slots").alias("n_item"),
            F.count_distinct("slots").alias("n_doc"),
            F.count_distinct("item_slots", "slots").alias("n_pairs"),
        )
        .where("n_pairs > n_item OR n_pairs > n_doc")
    )
    # only open windows may be coincidence; what stands there word for word is kept
    templates = aligned.where(is_open)
    clash = [templates[c].eqNullSafe(unsound[c]) for c in kind]
    sound = templates.join(unsound, clash, "left_anti").unionByName(aligned.where(~is_open))
    covered = sound.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("tokens").alias("item_tokens"),
        F.array_size(
            F.array_distinct(
                F.flatten(
                    F.collect_set(
                        F.sequence(F.col("item_at"), F.col("item_at") + F.col("size") - F.lit(1))
                    )
                )
            )
        ).alias("covered"),
        F.bool_or(F.col("item_slots") != F.col("slots")).alias("reworded"),
    )
    return (
        covered.where(F.col("covered") >= F.least(F.lit(least), F.col("item_tokens")))
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("covered").cast("long").alias("covered"),
            F.max("item_tokens").cast("long").alias("item_tokens"),
            F.bool_and("reworded").alias("reworded"),
        )
    )


def without_benchmark(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item of the benchmark, all columns as they are.

    Their ids are written first: the planner then knows how many they are, and shuffles
    the documents only if they are too many to broadcast.
    """
    found = contaminated(documents, benchmark).select(F.col("doc_id").alias("_found")).distinct()
    found = materialize(found, "contaminated", documents.sparkSession)
    return documents.join(found, F.col("doc_id").eqNullSafe(F.col("_found")), "left_anti")
