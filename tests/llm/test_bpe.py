import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from obstar.llm import bpe
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "It's a small world, isn't it? 2024!!", "<|startoftext|>hi<|endoftext|>there", "ΟΔΥΣΣΕΥΣ ΣΑΣ", "Über̈ é",
    "a\x1cb\x85c\xa0d e", "日本語のテキスト 👩‍👩‍👧 ½ ٣", "x" * 5000, "<|", "'S 'LL I'Ve", " \n\t ", "",
]


def ids(text):
    return np.frombuffer(bpe.encoder(PATH).encode(text), "<u4").tolist()


def test_as_the_library():
    for text in TEXTS:
        assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids, text


# letters of the library's own tables
@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x52F, exclude_categories=["Cs", "Cn"]), max_size=40))
def test_any_text_as_the_library(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_column(docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (0, TEXTS[0]), (None, "the end")]
    found = bpe.encoded_documents(docs(*rows), PATH).collect()
    assert len(found) == len(rows)
    for row, (doc, text) in zip(found, rows):
        want = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert row["doc_id"] == doc
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
        assert bpe.vocabulary_of(PATH).decode(bytes(row["ids"])) == row["decoded"]
        assert row["decoded"] == LIBRARY.decode(want, skip_special_tokens=False)
    assert bpe.digests(bpe.encoded_documents(docs(), PATH)).count() == 0


def test_encode_and_decode_one_after_the_other(docs):
    df = docs(*enumerate(TEXTS))
    ids = df.select("doc_id", bpe.encode(F.col("text"), PATH).alias("ids"))
    found = ids.select("doc_id", "ids", bpe.decode(F.col("ids"), PATH).alias("decoded")).collect()
    assert found == bpe.encoded_documents(df, PATH).collect()
    strange = df.limit(1).select(F.lit(b"\xff\xff\xff\x7f\x01\0\0\0").alias("ids"))
    assert strange.select(bpe.decode(F.col("ids"), PATH).alias("t")).first()["t"] == '"'


def test_dictionaries_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNKS", 10)
    monkeypatch.setattr(bpe, "PIECES_KEPT", 10)
    one = bpe.Encoder(bpe.vocabulary_of(PATH).packed, {})
    text = " ".join(f"w{i % 37},v{i % 3}" for i in range(200))
    assert one.encode(text) == bpe.encoder(PATH).encode(text)
    for held in (one.chunks, one.pieces):
        assert len(held) <= 10 and len(held.older) <= 10
