import random

import numpy as np
import pytest
import xxhash
from obstar.llm import simhash
from obstar.llm.components import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One two", "a b c", "É X É", "w " * 50, "x y z " * 40_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("cell", [4, 50, simhash.CELL])
def test_links_join_what_brute_force_joins(spark, cell):
    draw = np.random.default_rng(5)
    centre = draw.integers(0, 1 << 63, 12).astype(np.uint64)
    near = [
        c ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 7), replace=False))
        for c in centre.tolist()
        for _ in range(25)
    ]
    prints = np.unique(np.array([*near, 0, 1, 7, 15, (1 << 64) - 1], np.uint64))
    signed = prints.view(np.int64).tolist()
    links = [
        (signed[i], signed[j])
        for i in range(len(prints))
        for j in range(i)
        if int(prints[i] ^ prints[j]).bit_count() <= 3
    ]
    assert len(links) > 300
    found = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, cell)
    rows = [tuple(r) for r in found.collect()]
    assert {tuple(sorted(r)) for r in rows} <= {tuple(sorted(x)) for x in links}
    want = plain_components(signed, links)
    assert plain_components(signed, rows) == want
    spread = {r["node"]: r["component"] for r in components(found).collect()}
    assert spread == {n: c for n, c in want.items() if n in spread}
    assert set(spread) == {n for link in links for n in link}


def test_long_chain_and_empty(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    assert {r["component"] for r in components(chain).collect()} == {0}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_documents(docs):
    draw = random.Random(1)
    base = [f"word{draw.randint(0, 99)}" for _ in range(400)]
    copy = " ".join(base)
    rows = [(5, copy), (3, copy.upper()), (9, " ".join([*base[:-1], "other"])), (7, "quite another text"), (8, None), (6, "")]
    rows += [(5, copy), (None, "quite another text"), (20, "z " * 30_000)]
    found = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs(*rows)).collect()}
    prints = {doc: plain_fingerprint(text) for doc, text in rows}
    near = 3 if (prints[9] ^ prints[5]).bit_count() <= 3 else 9
    assert found == {(5, 3), (3, 3), (9, near), (7, 7), (8, 6), (6, 6), (None, 7), (20, 20)}
    stay = {r["doc_id"] for r in simhash.representatives(docs(*rows)).collect()}
    assert stay == {c for _, c in found}
    assert simhash.near_duplicates(docs()).collect() == []
