import random
import re

import pytest
from obstar.llm import lines

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACES))

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        own = -1 if doc is None else doc
        all_lines = (text or "").split("\n")
        kept = [
            x
            for x in all_lines
            if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == own
        ]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df, **options):
    found = lines.dedup_lines(df, ["doc_id"], **options)
    return sorted(
        (tuple(r) for r in found.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr
    )


@pytest.mark.parametrize("batches, fan_in", [(1, 2), (4, 2), (5, 3)])
def test_against_brute_force(docs, batches, fan_in):
    draw = random.Random(3)
    shared = [f"Shared line number {i} of the Collection" for i in range(6)] + ["short", "", "   "]
    rows = []
    for doc in range(60):
        own = [f"a line that only document {doc} has, {i}" for i in range(draw.randint(0, 3))]
        own += [draw.choice([str.upper, str.strip, lambda s: "\t" + s + " \r"])(draw.choice(shared)) for _ in range(3)]
        own += [shared[0]] * draw.randint(0, 2)
        draw.shuffle(own)
        rows.append((doc, "\n".join(own)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, shared[1]), (5, rows[5][1]), (6, shared[2] + "\nother")]
    rows += [(80, "Ünïcode LINE that is LONG enough É"), (81, "Ünïcode line that is long enough É")]
    rows += [(82, "ünïcode line that is long enough É"), (90, "\n".join(shared[:6] * 500))]
    assert got(docs(*rows), batches=batches, fan_in=fan_in) == brute(rows)


def test_fewer_documents_than_needed_and_empty(docs):
    line = "the same long line in two documents"
    assert got(docs((1, line), (2, line))) == [(1, 1, 0, line), (2, 1, 0, line)]
    assert got(docs((1, line), (2, line), (2, line))) == [(1, 1, 0, line), (2, 1, 0, line), (2, 1, 0, line)]
    assert got(docs()) == []


def test_runs_are_levelled(spark, docs):
    store = lines.LineRuns(spark, min_docs=2, fan_in=2)
    sizes = []
    for at in range(5):
        batch = docs((at, "a line that is long enough to count"), (at, f"only in document number {at}"))
        store.add(lines.hashed_lines(batch, 20).select("h1", "h2", "doc"))
        sizes.append([len(level) for level in store.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    assert [r["last"] for r in store.repeated().collect()] == [4]
    plan = store.levels[2][0].join(store.levels[0][0], lines.HASH)._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan
    store.forget()
