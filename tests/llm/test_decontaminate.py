import random

from obstar.llm import decontaminate as d

ITEM = "Anna buys 12 apples for 3 euros each and gives Anna the 12 apples before noon, says Ben"


def found(df, items):
    return {(r["doc_id"], r["item_id"]): (r["covered"], r["item_tokens"], r["reworded"]) for r in d.contaminated(df, items).collect()}


def items(spark, *rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "item_id long, text string, h string, doc_id string")


def test_words_and_reparameterised_questions(spark, docs):
    filler = "It was a quiet evening in the harbour and nobody spoke of the weather that day."
    other = ITEM.replace("Anna", "Mary").replace("12", "75").replace("3 euros", "9 dollars").replace("Ben", "Tom")
    clash = other.replace("gives Mary", "gives Tom")
    glued = ITEM.replace("3 euros", "3euros")
    df = docs(
        (1, f"{filler} {ITEM}. {filler}"), (2, f"{filler} He said: {other}."), (3, f"{filler} He said: {clash}."),
        (4, filler * 3), (5, None), (6, ""), (7, ITEM.upper()), (8, f"{filler} {glued}"), (None, ITEM), (1, filler),
        (9, f"{ITEM} {filler} " * 400), (10, " ".join(ITEM.split()[:8])),
    )
    got = found(df, items(spark, (7, ITEM), (9, ITEM), (8, None), (11, ""), (12, "too short")))
    assert {doc for doc, _ in got} == {1, 2, 7, 8, 9, None}
    assert {item for _, item in got} == {7}
    assert got[1, 7] == (18, 18, False) and got[2, 7][2] and not got[8, 7][2]


def test_slots_of_numbers_alone_keep_their_values(spark, docs):
    table = " ".join(str(i) for i in range(100, 130))
    df = docs((1, " ".join(str(i) for i in range(200, 230))), (2, f"see {table} there"))
    assert {doc for doc, _ in found(df, items(spark, (1, table)))} == {2}


def test_an_altered_repeat_leaves_the_words_around_it(spark, docs):
    words = " ".join(f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz")
    item = f"in 2019 the report says {words} and again in 2019 it was 7 to 8 that they agreed on this and on nothing else"
    changed = item.replace("again in 2019", "again in 2020")
    merged = item.replace("7 to 8", "2019 to 8")
    df = docs((1, changed), (2, merged), (3, item))
    got = found(df, items(spark, (1, item)))
    assert {doc for doc, _ in got} == {1, 2, 3}
    assert not got[1, 1][2] and got[3, 1][0] == got[3, 1][1]


def test_names_and_numbers_of_many_kinds(spark, docs):
    asked = {
        1: ("Tom has 12 apples. Tom gives Anna 5. How many apples does Tom have?",
            "Mary has 9 apples. Mary gives Ben 4. How many apples does Mary have?"),
        2: ("In the yard NASA and McDonald built three rockets with Jean-Luc before seven of them left for good",
            "In the yard ESA and O'Neill built 14 rockets with Anne-Marie before twenty-two of them left for good"),
        3: ("The scores were 3 4 5 6 7 8 9 10 11 12 13 14 15 and then 16 17 18 19 20 at last",
            "The scores were 31 42 53 64 75 86 97 108 119 120 131 142 153 and then 164 175 186 197 208 at last"),
        4: ("The train to Paris left the old station with 9 people and came back with 8 of them",
            "She said that the train to London left the old station with 31 people and came back with 27 of them"),
    }
    clash = "Mary has 9 apples. Sue gives Ben 4. How many apples does Joe have?"
    rows = [(i, f"It was late. {other}") for i, (_, other) in asked.items()]
    rows += [(11, f"It was late. {clash}"), (14, asked[4][1].lower().replace("london", "paris"))]
    got = found(docs(*rows), items(spark, *((i, item) for i, (item, _) in asked.items())))
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (14, 4)}
    assert all(got[i, i][2] for i in asked)


def test_windows_of_any_size_hash_alike(spark):
    filler = "and so the long story goes on without an end "
    dense = "Tom paid 1 2 3 4 5 6 7 8 9 10 11 for it at noon with Anna"
    one = d.Tokens(dense)
    two = d.Tokens(f"{filler * 3}. {dense}. {filler * 2000}")
    for level, begin, end, hashes in one.windows(d.WINDOW, True):
        shown = {one.shown(a, b, level)[0]: h for a, b, h in zip(begin.tolist(), end.tolist(), hashes.tolist())}
        other = next(w for w in two.windows(d.WINDOW, True) if w[0] == level)
        there = {two.shown(a, b, level)[0]: h for a, b, h in zip(*(x[:60].tolist() for x in other[1:]))}
        assert shown and all(there.get(k, h) == h for k, h in shown.items())
        assert len(shown.keys() & there.keys()) == len(shown) if level else True


def test_against_brute_force(spark, docs):
    draw = random.Random(6)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    passages = [" ".join(draw.choices(words, k=draw.randint(5, 40))) for _ in range(12)]
    rows = []
    for doc in range(80):
        parts = [" ".join(draw.choices(words, k=draw.randint(0, 60)))]
        if doc % 4 == 0:
            parts.insert(draw.randint(0, 1), passages[doc // 4 % 12])
        rows.append((doc, " ".join(parts)))
    want = set()
    for doc, text in rows:
        tokens = text.split()
        for item, passage in enumerate(passages):
            own = passage.split()
            size, covered = min(d.WINDOW, len(own)), set()
            spots = {tuple(own[i : i + size]): i for i in range(len(own) - size + 1)}
            for at in range(len(tokens) - size + 1):
                i = spots.get(tuple(tokens[at : at + size]))
                if i is not None:
                    covered |= set(range(i, i + size))
            if len(covered) >= min(d.LEAST, len(own)):
                want.add((doc, item))
    got = found(docs(*rows), items(spark, *enumerate(passages)))
    assert set(got) == want and len(want) >= 20


def test_documents_without_and_empty(spark, docs):
    df = docs((1, ITEM), (2, "a clean text"), (None, "another clean text"), (2, "a clean text"))
    kept = d.without_benchmark(df, items(spark, (1, ITEM)))
    assert kept.columns == df.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == ["2", "2", "None"]
    assert found(docs(), items(spark, (1, ITEM))) == {}
    assert found(df, items(spark)) == {}


def test_shortest_items_are_found_as_whole_documents(spark, docs):
    benchmark = spark.createDataFrame([(1, "What is Go?"), (2, "Why?"), (3, "..."), (4, None)], "item_id long, text string")
    df = docs(
        (1, "what is GO"), (2, "He asked: what is Go? Nobody knew."), (3, "Why"), (4, "why not"), (5, "?"), (6, ""), (None, "WHY?"),
        (7, "What is Java?"),
    )
    rows = d.contaminated(df, benchmark).collect()
    assert sorted((repr(r["doc_id"]), r["item_id"], r["covered"]) for r in rows) == [("1", 1, 3), ("3", 2, 1), ("None", 2, 1)]


def test_ordinary_words_are_looked_at_together(monkeypatch):
    asked, code = [], d.code
    monkeypatch.setattr(d, "code", lambda word: asked.append(word) or code(word))
    tokens = d.Tokens("Anna buys 12 apples for 3kg each, says Ben. Über 50% a day!", "in twenty-two days")
    assert asked == ["twenty-two"]
    assert tokens.edges.tolist() == [0, 15, 18]
    assert tokens.words(4, 8) == ["for", "3", "kg", "each"]
    assert tokens.kinds[3].tolist() == [2, 0, 1, 0, 0, 1, 3, 0, 0, 2, 2, 1, 3, 0, 0, 0, 1, 3]


def test_words_together_and_one_by_one(monkeypatch):
    draw = random.Random(3)
    bits = """Anna 12 3kg $5 €7m 50% % %. twenty-two co-op x² ² Σ ΟΔΟΣ İstanbul ǅ … ." !) a in U.S. 日本語 １２km 𝟏𝟐kg 𝒜bc
    _x_ -- O’Neill 5 Zero » (5) ٣٤ ⅷ Ω Kg. 9-to-5 thirty–one \0 half m""".split()
    gaps = [" ", " ", "\n", "\x1c", " ", ""]
    texts = ["".join(draw.choice(bits) + draw.choice(gaps) for _ in range(draw.randint(0, 30))) for _ in range(300)]
    apart = [d.Tokens(t) for t in [*texts, None]]

    def all_of(many):
        return [x for one in many for x in zip(one.words(0, len(one)), one.literal.tolist(), *(k.tolist() for k in one.kinds))]

    want = all_of(apart)
    assert len({w for w, *_ in want}) == len({h for _, h, *_ in want}) > 100
    assert all_of([d.Tokens(*texts, None)]) == want
    monkeypatch.setattr(d, "PART", 7)
    assert all_of([d.Tokens(*texts, None)]) == want
    monkeypatch.setattr(d, "ENDLESS", 0)
    assert [w[0] for w in all_of(d.Tokens(t) for t in texts)] == [w[0] for w in want]
    assert [w[2:] for w in all_of(d.Tokens(t) for t in texts)] == [w[2:] for w in want]


def test_windows_stay_within_their_texts():
    texts = ["one two", "Tom paid 1 2 3 4 5 6 7 8 9 to Anna", "", "a b c d e f g h i", "b c d e f g h i j Ben 1 2 3 4"]
    together, found = d.Tokens(*texts), []
    for size, whole in ((d.WINDOW, False), (5, False), (2, True)):
        alone = set()
        for i, text in enumerate(texts):
            one = d.Tokens(text)
            for level, begin, end, hashes in one.windows(size, size == d.WINDOW, whole):
                first = int(together.edges[i])
                alone |= set(zip([level] * len(begin), (begin + first).tolist(), (end + first).tolist(), hashes.tolist()))
        both = {
            x
            for level, *rest in together.windows(size, size == d.WINDOW, whole)
            for x in zip([level] * len(rest[0]), *(r.tolist() for r in rest))
        }
        assert both == alone
        found.append(len(both))
    assert found[2] == 1 and found[0] > 5
