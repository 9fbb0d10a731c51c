import random
import zlib

import numpy as np
from obstar.llm import language

WORDS = {"aa": "kana moko tuli rapa", "bb": "stch gruf pflz knrr", "cc": "über größe straße öl"}


def text(name, n, draw):
    return " ".join(draw.choices(WORDS[name].split(), k=n))


def test_held_out_accuracy(docs):
    draw = random.Random(1)
    rows = [(i, text(name, draw.randint(3, 30), draw), name) for i in range(150) for name in [draw.choice("aa bb cc".split())]]
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !!", "aa"), (1003, "ZZZZ", None), (None, "kana moko", "zz")]
    odd += [(1004, "KANA MOKO " * 20_000, None), (0, *rows[0][1:])]
    found = language.predictions(docs(*rows, *odd)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) + len(odd)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found if r["doc_id"] is not None)
    held = [r for r in rows if by_id[r[0]]["held_out"]]
    assert len(held) > 20 and all(by_id[i]["lang_pred"] == name for i, _, name in held)
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002)] == [language.UNKNOWN] * 3
    assert by_id[1003]["lang_pred"] in WORDS and by_id[1003]["score"] == 0
    assert by_id[1004]["lang_pred"] == "aa" and by_id[None]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = language.known_language(docs(*rows, *odd))
    assert kept.columns == docs().columns
    assert kept.count() == len(rows) + len(odd) - 3


def test_nothing_to_learn_from(docs):
    found = language.predictions(docs((1, "some text", None), (2, None, None))).collect()
    assert [r["lang_pred"] for r in found] == [language.UNKNOWN] * 2
    assert language.predictions(docs()).collect() == []


def test_many_languages_and_false_positives():
    draw = np.random.default_rng(3)
    grams = {f"l{i:02}": draw.integers(0, 1 << 63, 500).astype(np.uint64) for i in range(11)}
    filters = language.Filters.build(grams, dict.fromkeys(grams, 1), 1 << 12, 2)
    assert filters.bits.shape == (1 << 12, 2)
    for i, own in enumerate(grams.values()):
        assert ((filters.holders(own)[:, i // 8] >> (i % 8)) & 1).all()
    strange = draw.integers(0, 1 << 63, 20_000).astype(np.uint64)
    bits = np.unpackbits(filters.holders(strange), axis=1, bitorder="little")[:, :11]
    assert np.allclose(bits.mean(axis=0), filters.rates, atol=0.01) and filters.rates.min() > 0.02


def test_blocks_give_what_single_texts_give(monkeypatch):
    texts = ["kana moko", None, "", "a", "Über\nalles", "x" * 50, "ÉA"]
    whole = language.trigrams(texts)
    single = [language.trigrams([t])[0].tolist() for t in texts]
    assert whole[0].tolist() == [g for s in single for g in s]
    assert whole[1].tolist() == [len(s) for s in single]


def test_long_texts_are_looked_at_in_parts(monkeypatch):
    texts = ["kana moko, tuli! " * 40, None, "", "überall " * 30, "x" * 200, "a1b2c3 " * 50]
    grams = {"aa": language.trigrams(["kana moko tuli"])[0], "bb": language.trigrams(["überall abc"])[0]}
    filters = language.Filters.build(grams, dict.fromkeys(grams, 1), 1 << 12, 2)
    whole = filters.counts(texts), filters.predict(texts)
    monkeypatch.setattr(language, "_AT_ONCE", 25)
    assert len(list(language.parts_of(texts[0]))) > 10 and "".join(language.parts_of(texts[0])) == texts[0]
    parts = filters.counts(texts), filters.predict(texts)
    assert [x.tolist() for x in parts[0]] == [x.tolist() for x in whole[0]] and parts[1] == whole[1]


def test_against_sets_of_trigrams(spark):
    """The same decision with whole sets in place of Bloom filters, trigram by trigram."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table.collect()]

    def grams_of(text):
        low = [c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or ""]
        padded = [" ", *low, " "]
        return ["".join(padded[i - 1 : i + 2]) for i in range(1, len(padded) - 1) if padded[i] != " "]

    counts, documents = {}, {}
    for doc_id, text, lang in rows:
        if lang is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            documents[lang] = documents.get(lang, 0) + 1
            own = counts.setdefault(lang, {})
            for gram in grams_of(text):
                own[gram] = own.get(gram, 0) + 1
    # all trigrams of the sample are kept: which of equally frequent ones are is then no question
    known = {lang: set(own) for lang, own in counts.items()}
    most = max(len(own) for own in known.values())
    filters = language.fit(table, grams=most, slots=1 << 20)
    names, scores = filters.predict([text for _, text, _ in rows])
    for (_, text, _), name, score in zip(rows, names, scores):
        found = grams_of(text)
        held = {lang: sum(g in own for g in found) for lang, own in known.items()}
        best = max(held.values(), default=0)
        if not found:
            assert (name, score) == (language.UNKNOWN, 0.0)
            continue
        assert held[name] >= best - 0.002 * len(found)
        assert abs(score - best / len(found)) < 0.002
