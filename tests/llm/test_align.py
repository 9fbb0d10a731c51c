import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from obstar.llm import align
from obstar.llm.bpe import byte_symbols
from obstar.llm.queries import BYTE_LEVEL, PIECES

TEXTS = [
    "Hello world, it's 1234 times a test.", "été über <|endoftext|> <s> <unk> <0x41> x", "  two  spaces\n\nand\tlines ",
    "漢字 😀 ñandú", "a", " ", "\n", "▁mark", "aaaaaaaaaaaaaaaaaaaaaa" * 30, " no-break thin", "x\x00y", "'s 'LL don't",
]


@pytest.fixture(scope="module")
def known():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    byte_of = {s: i for i, s in enumerate(byte_symbols())}
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def bytes_b(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def cut(text):
        """Tokens of both sides as (id, end)."""
        sides = []
        for ids, raw in (
            (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(byte_of[c] for c in a.id_to_token(i))),
            (b.encode(text), bytes_b),
        ):
            out, at, joined = [], 0, b""
            for i in ids:
                joined += raw(i)
                out.append((i, len(joined)))
            sides.append(out if joined == (" " + text).encode() else None)
        return sides if text and None not in sides else ([], [])

    return cut


def by_hand(cut, texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, digest per text, by the definition."""
    links, out, counts = [], [], Counter()
    for text in texts:
        a, b = cut(text or "")
        ends = sorted({e for _, e in a} & {e for _, e in b})
        own = [(i, j) for i, e in a for j, f in b if e == f] if len(a) < 500 else None
        if own is None:
            at = defaultdict(list)
            for j, f in b:
                at[f].append(j)
            own = [(i, j) for i, e in a for j in at[e]]
        counts.update(own)
        links.append(own)
        groups = []
        for start, end in zip([0, *ends], ends):
            sides = [",".join(str(i) for i, e in side if start < e <= end) for side in (a, b)]
            groups.append("|".join(sides))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append([len(a), len(b), len(groups), len(own), digest])
    most = defaultdict(int)
    for (i, j), n in counts.items():
        most[j] = max(most[j], n)
    return [
        (*row[:4], sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), row[4])
        for row, own in zip(out, links)
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(df):
    return sorted(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in df.collect())


def test_against_the_definition(spark, docs, known):
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    texts = [*TEXTS, *[r["text"][:3000] for r in sample], None, "", TEXTS[0], TEXTS[0]]
    got = found(align.align(docs(*enumerate(texts)).repartition(3), BYTE_LEVEL, PIECES))
    assert got == [(i, *row) for i, row in enumerate(by_hand(known, texts))]
    zeros = [r for r in got if r[0] in (len(TEXTS) + len(sample), len(TEXTS) + len(sample) + 1)]
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in zeros)


def test_long_texts_are_cut_where_both_begin_anew(spark, docs, known, monkeypatch):
    both = align.aligner(BYTE_LEVEL, PIECES)
    text = "\n".join(TEXTS[:4]) * 40
    whole = both.aligned([text])[0]
    monkeypatch.setattr(align, "LONG", 50)
    parts = both.parts(text)
    assert len(parts) > 20 and " ".join(parts) == text
    found = both.aligned(parts)
    assert tuple(map(sum, zip(*[f[:3] for f in found]))) == whole[:3]
    assert np.concatenate([f[3] for f in found]).tolist() == whole[3].tolist()
    assert b";".join(f[4] for f in found) == whole[4]


@given(st.lists(st.integers(0, 1), min_size=1, max_size=60), st.lists(st.integers(0, 1), min_size=1, max_size=60))
@settings(max_examples=300, deadline=None)
def test_components(cuts_a, cuts_b):
    """Random cuts of one stretch: groups end where both sides end."""
    size = max(len(cuts_a), len(cuts_b)) + 1
    ends = [np.array(sorted({i + 1 for i, x in enumerate(c) if x} | {size})) for c in (cuts_a, cuts_b)]
    label_a, label_b, linked_a, linked_b = align.components(*ends)
    common = np.intersect1d(*ends)
    assert (label_a == np.searchsorted(common, ends[0])).all()
    assert (label_b == np.searchsorted(common, ends[1])).all()
    assert (ends[0][linked_a] == common).all() and (ends[1][linked_b] == common).all()


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_any_text(known, text):
    both = align.aligner(BYTE_LEVEL, PIECES)
    if not text or any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    got = both.aligned([text])[0]
    a, b = known(text)
    assert (got is None) == (not a)
    if got:
        assert got[:2] == (len(a), len(b))
        numbers = both.pairs.keys[got[3]]
        assert [(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in numbers] == [(i, j) for i, e in a for j, f in b if e == f]


def test_packed():
    links = np.array([0, 1, 70_000, 2**24 + 5], np.int32)
    assert align.unpacked(align.packed(links)).tolist() == links.tolist()
    assert align.unpacked(b"").size == 0


def test_null_ids_and_empty(spark, docs):
    assert align.align(docs(), BYTE_LEVEL, PIECES).collect() == []
    rows = align.align(docs((None, "some words"), (None, None), (1, "some words")), BYTE_LEVEL, PIECES).collect()
    assert sorted((r["doc_id"] is None, r["n_a"]) for r in rows) == [(False, 2), (True, 0), (True, 2)]
    assert all(r["count_sum"] == 2 * r["n_links"] for r in rows)
