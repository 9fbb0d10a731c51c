import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from obstar.llm import trie
from obstar.llm.trie import DoubleArray, Sequences

COLUMNS = "conv_id long, turn long, role string, text string, row string, token string, at string, n string"


@pytest.fixture
def conversations(spark, docs):
    def make(*rows):
        return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], COLUMNS)

    return make


def truncated(a, b):
    return a - int(a / b) * b


def order(turn):
    number, role, text = turn
    known = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    return (number is not None, number or 0, role, known)


def by_hand(rows, rebuild=True):
    own = defaultdict(list)
    for c, number, role, text in rows:
        if c is not None:
            own[c].append((number, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - truncated(c, 5), [])[:h] + turns[h:] if rebuild else turns
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(str(c))
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        size = len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * size
    return sorted(
        (
            who[0], len(node), members[node[:-1]][0] if node else None, len(who), children[node], leaves[node],
            saved[node], hashlib.sha256(",".join(ends[node]).encode()).hexdigest(),
        )
        for node, who in members.items()
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2] + (r[7],))


def made(n, seed, longest=7, texts=3):
    r = random.Random(seed)
    return [
        (c, t, r.choice(["user", "assistant"]), "é" * r.randrange(texts) + r.choice("ab"))
        for c in r.sample(range(-n, 2 * n), n)
        for t in range(r.randint(1, longest))
    ]


@pytest.mark.parametrize("seed", range(3))
def test_rebuilt_against_brute_force(conversations, seed):
    rows = made(60, seed)
    got = found(trie.conversation_trie(conversations(*rows)))
    assert got == sorted(by_hand(rows), key=lambda r: r[:2] + (r[7],))


@pytest.mark.parametrize("segment,shard", [(1, 4), (2, 5), (3, 1000), (4, 1), (256, 7)])
def test_many_small_tries_and_segments(conversations, segment, shard):
    rows = made(50, segment, longest=9, texts=2)
    rows += [(1000 + i, t, "user", "hot") for i in range(30) for t in range(4)]
    rows += [(2000, t, "user", f"long {t}") for t in range(25)]
    turns = trie.rebuilt(conversations(*rows))
    got = found(trie.nodes(turns, segment, shard))
    assert got == sorted(by_hand(rows), key=lambda r: r[:2] + (r[7],))


def test_nulls_ties_repeats_and_turnless(conversations):
    rows = [
        (0, None, None, None), (0, None, "user", "b"), (0, 0, "user", "a"), (0, 0, "user", "a"), (0, 1, "user", None),
        (7, 0, "user", "only"), (8, None, None, "x"), (8, 2, "z", "y"), (None, 0, "user", "nobody"), (5, 0, "u", "q" * 100_000),
    ]
    got = found(trie.conversation_trie(conversations(*rows)))
    assert got == sorted(by_hand(rows), key=lambda r: r[:2] + (r[7],))
    # 1 has no source and fewer turns than it gives up: a member of the root only
    alone = next(c for c in range(11, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    got = found(trie.conversation_trie(conversations((alone, 0, "user", "gone"))))
    assert got == by_hand([(alone, 0, "user", "gone")]) and len(got) == 1


def test_empty(conversations):
    assert trie.conversation_trie(conversations()).collect() == []
    assert trie.conversation_trie(conversations((None, 1, "user", "a"))).collect() == []


def test_streamed_digests_over_chunks(conversations):
    ids = [*range(0, 30_000, 3), *range(100_000, 100_050), -5, -4096]
    rows = [(c, 0, "user", "same") for c in ids]
    got = found(trie.nodes(trie.rebuilt(conversations(*rows), parts=1)))
    whole = ",".join(map(str, sorted(ids)))
    assert [(r[1], r[3]) for r in got] == [(0, len(ids)), (1, len(ids))]
    assert got[1][7] == hashlib.sha256(whole.encode()).hexdigest()


@pytest.mark.parametrize("seed", range(4))
def test_double_array(seed):
    r = random.Random(seed)
    words = sorted({tuple(r.randrange(1, 40 + 400 * seed) for _ in range(r.randint(1, 6))) for _ in range(2000)})
    known = Sequences(np.array([s for w in words for s in w]), np.array([len(w) for w in words]))
    prefixes = {w[:d] for w in words for d in range(1, len(w) + 1)}
    assert int((known.trie.check >= 0).sum()) == len(prefixes)
    ends = {}
    for rows, at, nodes in known.walk():
        assert (nodes > 0).all()
        ends |= {words[row]: node for row, node in zip(rows.tolist(), nodes.tolist())}
    assert len(set(ends.values())) == len(words)
    # what is not in the trie is not found
    step = known.trie.step(np.zeros(1, np.int64), np.array([10**6]))
    assert step.tolist() == [-1]


def test_shards_are_cut_and_copies_pre_aggregated(spark, conversations):
    rows = [(c, t, "user", f"same {t}") for c in range(500) for t in range(3)]
    found_segments = trie.segments(trie.rebuilt(conversations(*rows), parts=1))
    assert found_segments.count() == 500
    assert found_segments.select("tokens").distinct().count() == 1
