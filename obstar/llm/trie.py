"""Prefix trie of conversations, by double-array tries.

A conversation is a sequence of turns (role, text). Its prefixes are the nodes of a trie;
what is returned per node are its members and the totals of its subtree.

A turn is a token of 20 bytes: the MD5 of role and text, and the size of the text. Turns
are numbered by a range-partitioned sort, so a conversation of any length is not gathered
in one task; its tokens are packed in segments of `SEGMENT` turns. A segment is known by
its place and the hash of all before it, so equal segments after equal beginnings are one
row with a count before anything is sorted: copies of a conversation cost one row.

The distinct segments are range-partitioned and sorted by their bytes, which puts a hot
beginning into as many prefix shards as its rows need. A task reads its rows as a stream
and makes a trie of each `TURNS` turns: dense ids for the turns, and BASE and CHECK, where
the child of node s by turn id c is t = BASE[s] + c if CHECK[t] = s. Sequences are walked
through the arrays to collect members, and the arrays are folded from the deepest nodes
upwards for the totals of subtrees.

In sorted rows a node can be in two tries only if it lies on the path of a trie's first or
last sequence; the same holds for nodes that go on in another segment. These upper nodes
(two paths a trie) are merged globally by their hash, with what hangs below them in each
trie, and summed along the merged tree by pointer jumping, whose rounds grow with the
logarithm of its depth. All other nodes are complete where they are.

The members that end at a node are digested as a stream of sorted chunks of at most 4096
ids; SHA-256 reads its input in order, so one node's ids pass one task, chunk by chunk.

Defined results: turns without a conv_id belong to no conversation; null turns come first;
turns of one number are ordered by role, then by the MD5 of role and text; repeated rows
are repeated turns; null role or text is empty; an empty table has no nodes; other columns
are not looked at. Texts are hashed whole and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obstar.llm.common import prepare
from obstar.operators.numbering import dense_ids
from obstar.session import materialize

#: Turns in a segment, and turns in a trie: they bound what a row and a task hold.
SEGMENT, TURNS = 256, 100_000
#: Free places that are tried before the array is made longer.
TRIES = 32
WIDTH = 20
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- double array --------------------------------------------------------------------


class DoubleArray:
    """A trie in two arrays. Node 0 is the root; symbols are numbers from 0 on."""

    def __init__(self):
        self.base = np.zeros(1, np.int64)
        self.check = np.full(1, -1, np.int64)
        self._used = bytearray(b"\1")
        self._low = 1  # no free place below
        self._random = np.random.default_rng(0)

    def _lengthen(self, size: int) -> None:
        more = size - len(self._used)
        if more > 0:
            self._used.extend(bytes(max(more, len(self._used) // 2)))

    def _fitting(self, offsets: np.ndarray) -> int:
        """A place from which all offsets (the least is 0) are free."""
        spread = int(offsets.max())
        used = np.frombuffer(self._used, np.uint8)
        near = self._low + np.flatnonzero(used[self._low : self._low + 4 * TRIES] == 0)[:TRIES]
        far = self._random.integers(self._low, max(len(used) - spread, self._low + 1), TRIES)
        for place in (*near.tolist(), *far.tolist()):
            if place + spread < len(used) and not used[place + offsets].any():
                return place
        return len(used)

    def _free(self, n: int) -> np.ndarray:
        """The first n free places."""
        while True:
            used = np.frombuffer(self._used, np.uint8)
            found = self._low + np.flatnonzero(used[self._low :] == 0)
            if len(found) >= n:
                return found[:n]
            del used
            self._lengthen(len(self._used) + n - len(found))

    def _take(self, places: np.ndarray) -> None:
        self._lengthen(int(places.max()) + 1)
        np.frombuffer(self._used, np.uint8)[places] = 1
        while self._low < len(self._used) and self._used[self._low]:
            self._low += 1

    def add(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Give nodes all their children at once; rows of one parent stand together.

        Returns the children's places.
        """
        starts = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        counts = np.diff(np.r_[starts, len(parents)])
        least = np.minimum.reduceat(symbols, starts)
        bases = np.empty(len(starts), np.int64)
        for g in np.flatnonzero(counts > 1).tolist():
            offsets = symbols[starts[g] : starts[g] + counts[g]] - least[g]
            place = self._fitting(offsets)
            self._take(place + offsets)
            bases[g] = place - least[g]
        alone = counts == 1
        if alone.any():
            places = self._free(int(alone.sum()))
            self._take(places)
            bases[alone] = places - least[alone]
        if len(self.base) < len(self._used):
            more = len(self._used) - len(self.base)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]
        self.base[parents[starts]] = bases
        children = np.repeat(bases, counts) + symbols
        self.check[children] = parents
        return children

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of nodes by symbols, -1 where there is none."""
        found = self.base[nodes] + symbols
        inside = (nodes >= 0) & (found >= 0) & (found < len(self.check))
        found = np.where(inside, found, 0)
        return np.where(inside & (self.check[found] == nodes), found, -1)


class Sequences:
    """Distinct sequences of symbols, sorted so that equal beginnings stand together.

    `symbols` has all sequences behind each other, `lengths` their lengths; symbols are
    numbered anew in the order in which a walk by levels meets them, so that the children
    of a node mostly have neighbouring numbers.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.given, self.lengths = symbols, lengths
        self.starts = np.cumsum(lengths) - lengths
        self.dense = np.full(int(symbols.max(initial=-1)) + 1, -1, np.int64)
        self.trie = DoubleArray()
        self._build()

    def levels(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sequences that go on, their places in `given`) per level."""
        rows, level = np.arange(len(self.lengths)), 0
        while True:
            rows = rows[self.lengths[rows] > level]
            if not rows.size:
                return
            yield rows, self.starts[rows] + level
            level += 1

    def _build(self) -> None:
        nodes, known = np.zeros(len(self.lengths), np.int64), 0
        for rows, at in self.levels():
            given, parents = self.given[at], nodes[rows]
            first = np.r_[True, (given[1:] != given[:-1]) | (parents[1:] != parents[:-1])]
            new, where = np.unique(given[first][self.dense[given[first]] < 0], return_index=True)
            self.dense[new[np.argsort(where)]] = np.arange(known, known + len(new))
            known += len(new)
            children = self.trie.add(parents[first], self.dense[given[first]])
            nodes[rows] = children[np.cumsum(first) - 1]

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(sequences, places in `given`, nodes) per level, by BASE and CHECK."""
        nodes = np.zeros(len(self.lengths), np.int64)
        for rows, at in self.levels():
            nodes[rows] = self.trie.step(nodes[rows], self.dense[self.given[at]])
            yield rows, at, nodes[rows]


# --- nodes of a shard ----------------------------------------------------------------

_NODES = (
    "shared boolean, id binary, up binary, parent_conv_id long, depth long, conv_id long, "
    "n_convs long, size long, n_children long, n_leaves long, saved_tokens long, ends string"
)
_ARROW = pa.schema(
    [
        (name, {"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[kind])
        for name, kind in (c.split() for c in _NODES.split(", "))
    ]
)


class _Shard:
    """Rows of a prefix shard, and the nodes of their trie."""

    def __init__(self, segment: int):
        self.segment, self.turns = segment, 0
        self.rows: list[tuple] = []

    def nodes(self) -> pa.RecordBatch:
        """One row per node; for upper nodes, what this trie has of them."""
        p1, p2, place, tokens, n, least, goes_on, e1, e2, ends = zip(*self.rows)
        lengths = np.array([len(t) // WIDTH for t in tokens], np.int64)
        place, n, least = (np.array(x, np.int64) for x in (place, n, least))
        before = np.stack([np.array(p1, np.int64), np.array(p2, np.int64)], axis=1).astype(">i8")
        block = np.cumsum(np.r_[True, (before[1:] != before[:-1]).any(axis=1)]) - 1

        # the beginning that a segment stands after is its first symbol
        packed = np.frombuffer(b"".join(tokens), np.uint8).reshape(-1, WIDTH)
        _, turn = np.unique(np.ascontiguousarray(packed[:, :16]).view("S16").ravel(), return_inverse=True)
        sizes = np.ascontiguousarray(packed[:, 16:]).view(">u4").ravel().astype(np.int64)
        heads = np.cumsum(lengths + 1) - lengths - 1
        symbols = np.empty(len(turn) + len(lengths), np.int64)
        size_of = np.zeros(len(symbols), np.int64)
        inner = np.ones(len(symbols), bool)
        inner[heads] = False
        symbols[heads], symbols[inner], size_of[inner] = block + len(turn), turn, sizes
        known = Sequences(symbols, lengths + 1)
        check = known.trie.check

        members, first, depth, size = (np.zeros(len(check), np.int64) for _ in range(4))
        first[:] = np.iinfo(np.int64).max
        shared = np.zeros(len(check), bool)
        marked = np.array(goes_on, bool)
        marked[[0, -1]] = True
        names: dict[int, bytes] = {}
        last, order = np.zeros(len(lengths), np.int64), []
        for level, (rows, at, nodes) in enumerate(known.walk()):
            np.add.at(members, nodes, n[rows])
            np.minimum.at(first, nodes, least[rows])
            depth[nodes] = place[rows] * self.segment + level
            size[nodes] = size_of[at]
            last[rows] = nodes
            order.append(np.unique(nodes))
            for row, node in zip(rows.tolist(), nodes.tolist()) if not level else _pairs(rows, nodes, marked):
                if node not in names:
                    shared[node] = True
                    names[node] = self._name(before[row].tobytes(), tokens[row], level, e1[row], e2[row])
        digest = np.full(len(check), None, object)
        digest[last] = ends

        # from the deepest nodes upwards; upper nodes keep what hangs below them
        children, leaves, saved = (np.zeros(len(check), np.int64) for _ in range(3))
        for nodes in order[::-1]:
            own = nodes[~shared[nodes]]
            leaves[own] += children[own] == 0
            saved[own] += (members[own] - 1) * size[own]
            for total, value in ((children, 1), (leaves, leaves[own]), (saved, saved[own])):
                np.add.at(total, check[own], value)

        nodes = np.concatenate(order)
        parents, links = check[nodes], (depth[nodes] > 0) & (check[nodes] == 0)
        below = shared[nodes] & links  # the node itself belongs to the segment before
        members[nodes[below]] = 0
        parent_conv = [None if s or p == 0 else c for s, p, c in zip(shared[parents], parents, first[parents].tolist())]
        columns = [
            pa.array(shared[nodes]),
            pa.array([names.get(x) for x in nodes.tolist()], pa.binary()),
            pa.array([names.get(x) for x in parents.tolist()], pa.binary()),
            pa.array(parent_conv, pa.int64()),
            pa.array(depth[nodes]),
            pa.array(first[nodes], mask=below),
            *(pa.array(x[nodes]) for x in (members, size, children, leaves, saved)),
            pa.array(digest[nodes], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    def _name(self, before: bytes, tokens: bytes, level: int, e1: int, e2: int) -> bytes:
        """The hash of a node's prefix: as the segment after it knows it, where there may be one."""
        if level == 0:
            return before
        if level == self.segment:
            return np.array([e1, e2], ">i8").tobytes()
        return hashlib.blake2b(before + tokens[: level * WIDTH], digest_size=16).digest()


def _pairs(rows: np.ndarray, nodes: np.ndarray, marked: np.ndarray) -> Iterator[tuple[int, int]]:
    here = marked[rows]
    return zip(rows[here].tolist(), nodes[here].tolist())


def _tries(segment: int, turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(segment)
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                shard.rows.append(row)
                shard.turns += 1 + len(row[3]) // WIDTH
                if shard.turns >= turns:
                    yield shard.nodes()
                    shard = _Shard(segment)
        if shard.rows:
            yield shard.nodes()

    return run


# --- from turns to segments ----------------------------------------------------------


def _token(role: Column, text: Column) -> Column:
    """MD5 of role and text and the size of the text, as 40 hexadecimal digits."""
    size = F.octet_length(text)
    known = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.concat(known, F.lpad(F.lower(F.hex(size)), 8, "0"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, token): turns numbered over the whole table in the order of their conversations."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        role.alias("role"),
        _token(role, text).alias("token"),
        F.monotonically_increasing_id().alias("place"),  # spreads rows that are the same
    )
    return dense_ids(turns, ["conv_id", "turn", "role", "token", "place"], "at").select("conv_id", "at", "token")


def rebuilt(conversations: DataFrame, group: int = 5, parts: int = 9) -> DataFrame:
    """(conv_id, position, token, length): conversations that begin as the first of their group does.

    Conversation c takes the first h turns of c - c % group, where h is the CRC-32 of c's
    decimal digits modulo `parts`, then its own turns after its first h. A conversation
    without turns has one row with a null position.
    """
    turns = ordered_turns(conversations)
    found = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    convs = materialize(
        found.select(
            "*",
            (F.col("conv_id") - F.col("conv_id") % group).alias("source"),
            (F.crc32(F.col("conv_id").cast("string").cast("binary")) % parts).alias("h"),
        ),
        "conversations",
    )
    sources = convs.select(F.col("conv_id").alias("source"), F.col("n").alias("n_source"))
    taken = F.least("h", F.coalesce("n_source", F.lit(0)))
    convs = convs.join(sources, "source", "left").select(
        "conv_id", "source", "first", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
    )
    placed = turns.join(convs, "conv_id").withColumn("own", F.col("at") - F.col("first"))
    own = placed.where("own >= h").select(
        "conv_id", (F.col("own") - F.col("h") + F.col("taken")).alias("position"), "token", "length"
    )
    # at most parts - 1 turns of each source
    heads = placed.where(F.col("own") < parts - 1).select(F.col("conv_id").alias("source"), "own", "token")
    takers = convs.where("taken > 0").select("conv_id", "source", "taken", "length")
    borrowed = takers.join(heads, "source").where("own < taken").select("conv_id", F.col("own").alias("position"), "token", "length")
    empty = convs.where("length = 0").select("conv_id", F.lit(None).cast("long").alias("position"), F.lit(None).cast("string").alias("token"), "length")
    return own.unionByName(borrowed).unionByName(empty)


def segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Rows of (conv_id, position, token, length) as packed segments.

    Returns (conv_id, place, tokens, final, p1, p2, e1, e2): p1 and p2 stand for all turns
    before the segment, e1 and e2 for these and the segment.
    """
    place = F.coalesce(F.expr(f"position div {segment}"), F.lit(0)).alias("place")
    gathered = turns.groupBy("conv_id", place).agg(
        F.array_sort(F.collect_list(F.when(F.col("position").isNotNull(), F.struct("position", "token")))).alias("t"),
        F.max("length").alias("length"),
    )
    tokens = F.unhex(F.array_join(F.transform("t", lambda x: x["token"]), ""))
    found = gathered.select("conv_id", "place", tokens.alias("tokens"), "length")
    found = materialize(
        found.select(
            "*",
            (F.col("place") == F.expr(f"greatest(length - 1, 0) div {segment}")).alias("final"),
            F.xxhash64("place", "tokens").alias("h1"),
            F.xxhash64(F.lit(1), "tokens", "place").alias("h2"),
        ),
        "segments",
    )
    # only the hashes of segments of conversations of several are put in order
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    several = F.col("length") > segment
    chains = found.where(several).select(
        F.col("conv_id").alias("c"),
        F.col("place").alias("s"),
        *[F.expr(f"bit_xor(h{i})").over(before).alias(f"p{i}") for i in (1, 2)],
    )
    zero = F.lit(0).cast("long")
    short = found.where(~several).withColumns({"p1": zero, "p2": zero})
    long = found.where(several).join(chains, (F.col("conv_id") == F.col("c")) & (F.col("place") == F.col("s"))).drop("c", "s")
    both = short.unionByName(long.withColumns({p: F.coalesce(p, zero) for p in ("p1", "p2")}))
    return both.select(
        "conv_id", "place", "tokens", "final", "p1", "p2",
        F.col("p1").bitwiseXOR(F.col("h1")).alias("e1"),
        F.col("p2").bitwiseXOR(F.col("h2")).alias("e2"),
    )


# --- digests of the members that end -------------------------------------------------


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks (e1, e2, chunk, ids) to one digest per (e1, e2)."""
    key, state = None, None
    for batch in batches:
        done = []
        for e1, e2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (e1, e2) == key:
                state.update(b",")
            else:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (e1, e2), hashlib.sha256()
            state.update(ids.encode())
        yield _digest_rows(done)
    if key:
        yield _digest_rows([(*key, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("e1", pa.int64()), ("e2", pa.int64()), ("ends", pa.string())])
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)


def _ends(found: DataFrame) -> DataFrame:
    """(e1, e2, ends): the digest of the conv_ids that end with a segment, in ascending order."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    chunks = found.where("final").groupBy("e1", "e2", F.shiftright("conv_id", 12).alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))
    sorted_chunks = chunks.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "chunk")
    return sorted_chunks.mapInArrow(_streamed_digests, "e1 long, e2 long, ends string")


# --- the whole trie ------------------------------------------------------------------


def _summed(upper: DataFrame) -> DataFrame:
    """Totals of n_leaves and saved_tokens over the subtrees of (id, up, …).

    After k rounds a node has the totals of what is less than 2**k below it, and points
    2**k up.
    """
    totals = ("n_leaves", "saved_tokens")
    current = materialize(upper.select("id", F.col("up").alias("to"), *totals), "upper")
    while not current.where("to IS NOT NULL").isEmpty():
        sums = current.where("to IS NOT NULL").groupBy(F.col("to").alias("id"))
        sums = sums.agg(*[F.sum(t).alias(f"more_{t}") for t in totals])
        beyond = current.select(F.col("id").alias("to"), F.col("to").alias("beyond"))
        current = materialize(
            current.join(sums, "id", "left").join(beyond, "to", "left").select(
                "id", F.col("beyond").alias("to"),
                *[(F.col(t) + F.coalesce(f"more_{t}", F.lit(0))).alias(t) for t in totals],
            ),
            "upper",
        )
    return current.select("id", *totals)


def nodes(turns: DataFrame, segment: int = SEGMENT, shard_turns: int = TURNS) -> DataFrame:
    """The nodes of the trie of (conv_id, position, token, length), one row each.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    found = segments(turns, segment)
    same = ("p1", "p2", "place", "tokens", "e1", "e2")
    distinct = found.groupBy(*same).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max(~F.col("final")).alias("goes_on")
    )
    ended = distinct.join(_ends(found), ["e1", "e2"], "left")
    key = ("p1", "p2", "place", "tokens")
    shards = ended.select(*key, "n", "least", "goes_on", "e1", "e2", "ends").repartitionByRange(*key).sortWithinPartitions(*key)
    parts = materialize(shards.mapInArrow(_tries(segment, shard_turns), _NODES), "nodes")

    upper = parts.where("shared").groupBy("id").agg(
        *[F.max(c).alias(c) for c in ("up", "depth", "size", "ends")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    upper = materialize(upper, "upper")
    kids = upper.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("upper_children"))
    n_children = F.col("n_children") + F.coalesce("upper_children", F.lit(0))
    whole = upper.join(kids, "id", "left").withColumn("n_children", n_children)
    whole = whole.withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size"),
        }
    )
    whole = materialize(whole, "upper")
    whole = whole.drop("n_leaves", "saved_tokens").join(_summed(whole), "id")

    columns = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    parents = upper.select(F.col("id").alias("up"), F.col("conv_id").alias("upper_conv"))
    below = parts.where("NOT shared").select("up", "parent_conv_id", *columns)
    both = below.unionByName(whole.select("up", F.lit(None).cast("long").alias("parent_conv_id"), *columns))
    return both.join(parents, "up", "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "upper_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations."""
    prepare(conversations.sparkSession)
    return nodes(rebuilt(conversations))
