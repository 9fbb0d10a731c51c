import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from obstar.llm import tokenfile
from obstar.llm.common import scratch
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 1 << 40), max_size=300), st.booleans())
def test_elias_fano_round_trip(values, small):
    values = sorted(v % 50 if small else v for v in values)
    one = tokenfile.EliasFano.of(np.array(values, np.uint64))
    assert one.all().tolist() == values
    assert [one.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        one.select(len(values))


@given(st.lists(st.integers(0, 1 << 40), max_size=2000), st.booleans(), st.integers(0, 2000), st.integers(0, 2000))
def test_values_between_two_selects(values, small, i, j):
    values = sorted(v % 50 if small else v for v in values)
    one = tokenfile.EliasFano.of(np.array(values, np.uint64))
    i, j = min(i, len(values)), min(j, len(values))
    assert one.between(i, j).tolist() == values[i:j]


def test_slices_of_a_block(spark, docs):
    rows = [(None, f"no id {i}") for i in range(1500)] + [(i, f"text {i}") for i in range(2000)]
    found = tokenfile.written(docs(*rows).repartition(3), PATH).collect()
    assert sorted(repr(r["doc_id"]) for r in found) == sorted(repr(d) for d, _ in rows)
    start = 0
    for row in sorted(found, key=lambda r: r["start"]):
        assert row["start"] == start and len(row["ids"]) == 4 * row["n_tokens"]
        start += row["n_tokens"]


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000)).astype(np.uint64)
    one = tokenfile.EliasFano.of(values)
    bits = 8 * (len(one.low) + len(one.high) + len(one.directory))
    assert bits / len(values) < 2 + np.log2(values[-1] / len(values)) + 0.5


@pytest.mark.parametrize("block_ids", [1, 50, tokenfile.BLOCK_IDS])
def test_files_and_back(spark, docs, block_ids):
    library = Tokenizer.from_file(PATH)
    rows = [(i * 7 % 101, f"text number {i} " * (i % 9)) for i in range(100)]
    rows += [(500, None), (501, ""), (502, "long " * 20_000), (None, "no id"), (3, "again"), (-5, "before all")]
    df = docs(*rows).repartition(5)
    folder = scratch(spark, "test")
    tokenfile.write(df, folder, PATH, 2, block_ids)
    found = tokenfile.read(spark, folder).collect()

    def ids(text):
        return library.encode(text or "", add_special_tokens=False).ids + [2]

    def packed(text):
        return np.array(ids(text), "<u4").tobytes()

    assert sorted((repr(r["doc_id"]), bytes(r["ids"])) for r in found) == sorted(
        (repr(d), packed(t)) for d, t in rows
    )
    placed = sorted(found, key=lambda r: r["start"])
    order = [-(1 << 60) if r["doc_id"] is None else r["doc_id"] for r in placed]
    assert order == sorted(order)
    start = 0
    for row in placed:
        assert row["start"] == start
        start += row["n_tokens"]
    sums = {r["start"]: r["ids_crc32"] for r in tokenfile.checksums(tokenfile.read(spark, folder)).collect()}
    assert all(sums[r["start"]] == zlib.crc32(bytes(r["ids"])) for r in found)
    one = tokenfile.find(spark, folder, 3).collect()
    assert sorted(bytes(r["ids"]) for r in one) == sorted(packed(t) for d, t in rows if d == 3)
    assert tokenfile.find(spark, folder, 999).collect() == []


def test_empty(docs):
    assert tokenfile.written(docs(), PATH).collect() == []


def test_hot_and_null_ids_are_spread(spark, docs, tmp_path):
    rows = [(None, f"null {i}") for i in range(60)] + [(7, f"seven {i}") for i in range(60)] + [(i, "x") for i in range(20)]
    folder = str(tmp_path / "hot")
    tokenfile.write(docs(*rows), folder, PATH, 2)
    held = tokenfile.blocks(spark, folder)
    parts = {r["part"] for r in held.where("n_null > 0").select("part").collect()}
    assert len(parts) > 1
    found = tokenfile.read(spark, folder).orderBy("start").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == [None] * 60 + sorted(d for d, _ in rows[60:])
    assert [r["start"] for r in found] == [sum(x["n_tokens"] for x in found[:i]) for i in range(len(found))]
    whole = tokenfile.library_encoder(PATH)
    wanted = sorted((d is not None, d or 0, len(x) // 2 + 1) for (d, _), x in zip(rows, whole.encode([t for _, t in rows])))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in found) == wanted
    assert tokenfile.find(spark, folder, 7).count() == 61


def test_special_tokens_and_long_texts(monkeypatch):
    texts = ["a <|endoftext|>b <|EndOfText|> ΑΣ it's 12 ...", None, "", "word " * 3000 + "end.", "\x1c\x85x"] * 3
    whole = [tokenfile.library(PATH).encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokenfile, "LONG", 100)
    encoder = tokenfile.BatchEncoder(PATH, pieces=5)
    for _ in range(3):
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == whole


def test_pieces_are_found_together_and_looked_up_once(monkeypatch):
    asked = []
    monkeypatch.setattr(tokenfile, "pieces_of", lambda text: asked.append(text) or [])
    monkeypatch.setattr(tokenfile, "PART", 40)
    texts = ["it's 12 don'ts ''s \"'s 5's 'll 'lx x'", "İ ΑΣ é 𝟏𝒜 日本 ½Ⅷ \x1c\x85\x00 'RE we've", None, "", " ", "it's 1e5", "'"] * 4
    encoder = tokenfile.BatchEncoder(PATH)
    of, wanted = encoder.known.of, []
    monkeypatch.setattr(encoder.known, "of", lambda pieces: wanted.append(pieces) or of(pieces))
    whole = [tokenfile.library(PATH).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == whole
    assert asked == [] and len(wanted) == 1


@pytest.mark.parametrize("endless", [True, False])
def test_endless_words_and_equal_hashes(monkeypatch, endless):
    texts = ["one two one", None, "three two " * 9, "it's"]
    whole = [tokenfile.library(PATH).encode(t or "", add_special_tokens=False).ids for t in texts]
    if endless:
        monkeypatch.setattr(tokenfile, "ENDLESS", 10)
    else:
        located = tokenfile.located
        monkeypatch.setattr(tokenfile, "located", lambda text: (*(found := located(text))[:3], found[3] * np.uint64(0)))
    encoder = tokenfile.BatchEncoder(PATH)
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == whole
