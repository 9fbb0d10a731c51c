from obstar.llm import licenses


def scanned(df, templates):
    return sorted((r["doc_id"], r["license"], r["found"], r["shingles"]) for r in licenses.scan(df, templates).collect())


def test_notices_anywhere_in_long_texts(spark, docs):
    filler = " ".join(f"word{i}" for i in range(300))
    rows = []
    for at, (name, text) in enumerate(licenses.NOTICES.items()):
        rows.append((at, f"{filler[: 13 * at]} {text.upper()} {filler}"))
    found = scanned(docs(*rows), licenses.notices(spark))
    names = list(licenses.NOTICES)
    assert {(d, names[d]) for d in range(len(names))} <= {(d, n) for d, n, _, _ in found}


def test_containment_decides(spark, docs):
    words = [f"w{i}" for i in range(84)]  # 80 shingles
    templates = spark.createDataFrame([("own", " ".join(words))], "license string, text string")
    whole = " ".join(words)
    without_end = " ".join(words[:68])  # 64 of 80
    too_little = " ".join(words[:67])
    df = docs((1, whole), (2, without_end), (3, too_little), (4, None), (5, ""), (6, "w0 w1"), (None, whole), (1, "x"))
    found = licenses.scan(df, templates).collect()
    assert sorted((repr(r["doc_id"]), r["found"]) for r in found) == [("1", 80), ("2", 64), ("None", 80)]


def test_without_the_literal_set_the_result_is_the_same(spark, docs, monkeypatch):
    df = docs((1, "x y z Released under the MIT License. a b c"), (2, "nothing to see in this text at all"))
    before = scanned(df, licenses.notices(spark))
    monkeypatch.setattr(licenses, "LITERALS", 0)
    assert scanned(df, licenses.notices(spark)) == before == [(1, "MIT", 1, 1)]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "license string, text string")
    assert scanned(docs(), licenses.notices(spark)) == []
    assert scanned(docs((1, "Released under the MIT License.")), none) == []


def test_templates_shorter_than_a_shingle(spark, docs):
    templates = spark.createDataFrame([("short", "MIT License"), ("none", "..."), ("null", None)], "license string, text string")
    df = docs((1, "mit -- LICENSE."), (2, "the MIT License"), (3, "MIT"), (4, ""), (5, None), (None, "MIT license"), (1, "mit license"))
    found = licenses.scan(df, templates).collect()
    assert sorted((repr(r["doc_id"]), r["license"], r["found"], r["shingles"]) for r in found) == [("1", "short", 1, 1), ("None", "short", 1, 1)]


def test_whole_texts_tell_licenses_apart(spark, docs):
    rows = list(enumerate(licenses.TEMPLATES.items()))
    filler = " ".join(f"word{i}" for i in range(200))
    found = licenses.scan(docs(*[(i, f"{filler} {text} {filler}") for i, (_, text) in rows]), licenses.notices(spark)).collect()
    whole = {(r["doc_id"], r["license"]) for r in found if r["containment"] == 1}
    assert {(i, name) for i, (name, _) in rows} <= whole
