"""Language identification with a bit-sliced Bloom filter over n-grams.

For each language a filter holds its `grams` most frequent character trigrams. The
filters have the same size and hash functions and are stored across: slot i is a bitmask
with one bit per language. The AND of an n-gram's slots is the set of all languages that
(seem to) have it, in one look-up for all of them. A text's n-grams are counted per
language; of n looked-up n-grams a filter of false positive rate p is expected to accept
p of those it does not hold, so its true count is (count - n * p) / (1 - p). The language
of the highest corrected count wins, and the score is that count as a part of n.

Trigrams are of letters in lower case; what is not a letter ends a word, and a word has
one blank on either side. Learning reads a sample of about `per_language` labelled
documents of each language (a parameter that bounds it; taken by a hash of doc_id);
prediction is one pass over all texts, without a shuffle. The filter's size is fixed by
`slots` and the number of languages, and does not grow with the input.

Defined results: null or a text without a letter: `und`, score 0; no n-gram known: the
language with the most learned documents, score 0; nothing to learn from: `und` for all;
equal counts: the first language by name. Texts of any length count whole. Documents with
a null label or text are not learned from; a null doc_id is neither learned from nor held
out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obstar.llm.common import prepare

UNKNOWN = "und"
#: Code points looked at together; longer batches are cut between texts, longer texts between words.
_AT_ONCE = 1 << 20
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_PLACES = 0x110000
#: Surely no letter; texts without one are not cut.
_NO_LETTER = re.compile(r"[\s\d.,;:!?]")


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point -> the letter in lower case, 0 for what is not a letter."""
    table = np.zeros(_PLACES, np.uint32)
    for c in range(_PLACES):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the trigrams of all texts, and the number of each text's."""
    joined = "\n" + "\n".join((t or "").replace("\n", " ") for t in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = letters()[points]
    middle = np.flatnonzero(folded[1:-1]) + 1
    wide = folded.astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = wide[middle - 1] * _MIX[0] + wide[middle] * _MIX[1] + wide[middle + 1] * _MIX[2]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX[1]
        mixed ^= mixed >> np.uint64(32)
    ends = np.flatnonzero(points == 10)
    counts = np.diff(np.searchsorted(middle, ends))
    return mixed, counts


def parts_of(text: str | None) -> Iterator[str | None]:
    """A long text, cut before characters that are no letters: no trigram is centred there,
    and those beside it see the end of a text as they see it."""
    start = 0
    while text and len(text) - start > _AT_ONCE:
        cut = _NO_LETTER.search(text, start + _AT_ONCE)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def blocks(texts: Sequence[str | None]) -> Iterator[list[str | None]]:
    """Parts of texts in order, a bounded number of characters at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= _AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Filters:
    """Bit-sliced Bloom filters: one row of language bits per slot."""

    languages: list[str]
    usual: int
    bits: np.ndarray
    rates: np.ndarray
    hashes: int

    @classmethod
    def build(
        cls, grams: dict[str, np.ndarray], documents: dict[str, int], slots: int, hashes: int
    ) -> Filters:
        languages = sorted(grams)
        bits = np.zeros((slots, (len(languages) + 7) // 8), np.uint8)
        rates = np.zeros(len(languages))
        for i, language in enumerate(languages):
            held = np.zeros(slots, bool)
            for at in cls.places(grams[language], slots, hashes):
                held[at] = True
            bits[:, i // 8] |= held.astype(np.uint8) << np.uint8(i % 8)
            rates[i] = held.mean() ** hashes
        usual = max(range(len(languages)), key=lambda i: (documents[languages[i]], -i), default=0)
        return cls(languages, usual, bits, rates, hashes)

    @staticmethod
    def places(grams: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
        first = grams & np.uint64(0xFFFFFFFF)
        step = (grams >> np.uint64(32)) | np.uint64(1)
        return [
            ((first + np.uint64(i) * step) % np.uint64(slots)).astype(np.int64) for i in range(hashes)
        ]

    def holders(self, grams: np.ndarray) -> np.ndarray:
        """The languages that hold each n-gram, as rows of bits."""
        slots = self.places(grams, len(self.bits), self.hashes)
        found = self.bits[slots[0]]
        for at in slots[1:]:
            found &= self.bits[at]
        return found

    def held(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of n-grams of each text, and of those that each language's filter has."""
        grams, sizes = trigrams(texts)
        masks = self.holders(grams)
        sums = np.zeros((len(self.languages), len(grams) + 1), np.int64)
        for i in range(len(self.languages)):
            np.cumsum((masks[:, i // 8] >> np.uint8(i % 8)) & 1, out=sums[i, 1:])
        ends = np.cumsum(sizes)
        return sizes, sums[:, ends] - sums[:, ends - sizes]

    def counts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of n-grams of each text, and the corrected count per language."""
        parts = [(i, part) for i, text in enumerate(texts) for part in parts_of(text)]
        sizes, raw = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.languages)), np.int64)
        at = 0
        for block in blocks([part for _, part in parts]):
            owners = [i for i, _ in parts[at : at + len(block)]]
            at += len(block)
            n, found = self.held(block)
            np.add.at(sizes, owners, n)
            np.add.at(raw, owners, found.T)
        true = (raw.T - sizes * self.rates[:, None]) / np.maximum(1 - self.rates[:, None], 1e-9)
        return sizes, np.maximum(true, 0)

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages or not len(texts):
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        names, scores = [], []
        sizes, true = self.counts(texts)
        best = true.argmax(axis=0)
        for n, i, count in zip(sizes.tolist(), best.tolist(), true.max(axis=0).tolist()):
            names.append(UNKNOWN if not n else self.languages[i if count > 0 else self.usual])
            scores.append(round(min(1.0, count / n), 6) if n else 0.0)
        return names, scores


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    documents: DataFrame,
    per_language: int = 2000,
    grams: int = 4000,
    slots: int = 1 << 17,
    hashes: int = 3,
) -> Filters:
    """Learn from labelled documents that are not held out."""
    labelled = documents.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Filters.build({}, {}, slots, hashes)
    share = F.lit(0.0)
    for language, n in sizes.items():
        share = F.when(F.col("lang") == language, min(1.0, per_language / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = labelled.where(F.col("text").isNotNull() & (draw < share)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            found, sizes = trigrams(batch.column("text").to_pylist())
            owner = np.repeat(names, sizes)
            for name in set(names.tolist()):
                own, n = np.unique(found[owner == name], return_counts=True)
                yield pa.record_batch(
                    [pa.array([name] * len(own), pa.string()), pa.array(own.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    totals = (
        sample.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("place", F.row_number().over(order)).where(F.col("place") <= grams)
    kept: dict[str, list[int]] = {name: [] for name in sizes}
    # at most `grams` rows for each language
    for row in best.select("lang", "gram").collect():
        kept[row["lang"]].append(row["gram"])
    arrays = {name: np.array(found, np.int64).view(np.uint64) for name, found in kept.items()}
    return Filters.build(arrays, sizes, slots, hashes)


def detect(text: Column, filters: Filters) -> Column:
    """A struct of `lang` and `score`."""

    @F.arrow_udf("lang string, score double")
    def language(texts: pa.Array) -> pa.Array:
        names, scores = filters.predict(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"]
        )

    return language(text)


def predictions(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    prepare(documents.sparkSession)
    filters = fit(documents)
    found = documents.select("doc_id", detect(F.col("text"), filters).alias("found"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def known_language(documents: DataFrame) -> DataFrame:
    """The documents whose text has a language, all columns as they are."""
    prepare(documents.sparkSession)
    filters = fit(documents)
    return documents.where(detect(F.col("text"), filters)["lang"] != UNKNOWN)
