import corpus_pipeline
from obstar.llm import bpe
from obstar.llm.queries import VOCABULARY
from obstar.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages_on_what_is_left(spark, docs):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    line = "a line that three documents share"
    prose = " ".join(f"word{i * i}" for i in range(300))
    rows = [(1, f"{line}\nfirst"), (2, f"{line}\nsecond text"), (3, f"{line}\nthird one"), (4, None), (5, "12 34")]
    rows += [(6, prose), (7, prose), (8, f"some words before {item} and some after"), (9, "a clean text")]
    df = docs(*rows)
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = materialize(stage(spark, df, SF), name, spark)
        left.append({r["doc_id"]: r["text"] for r in df.collect()})
        assert df.columns == docs().columns
    languages, lines, groups, clean = left
    assert set(languages) == {1, 2, 3, 6, 7, 8, 9}
    assert (lines[1], lines[2], lines[3]) == ("first", "second text", f"{line}\nthird one")
    assert set(groups) == {1, 2, 3, 6, 8, 9} and set(clean) == {1, 2, 3, 6, 9}
    ids = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    encoder = bpe.encoder(VOCABULARY)
    assert {r["doc_id"]: r["n_tokens"] for r in ids} == {d: len(encoder.encode(t)) // 4 for d, t in clean.items()}


def test_run_and_empty(spark, docs):
    assert corpus_pipeline.run(spark, SF).count() > 100
    df = docs()
    for name, stage in corpus_pipeline.STAGES:
        df = materialize(stage(spark, df, SF), name, spark)
    assert df.count() == 0


def test_repeated_and_null_ids_and_long_texts(spark, docs):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    prose = " ".join(f"letter{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} and" for i in range(400))
    long = " ".join(f"w{i}ord" for i in range(60_000))
    rows = [(1, prose), (1, prose), (2, prose), (1, "another text of document one"), (3, long), (4, long + " end")]
    rows += [(None, "a text without a number"), (None, None), (5, f"before {item} after"), (5, "a clean row of the same document")]
    rows += [(6, "a text without a number"), (None, "a null row alone, unlike all others here")]
    df = docs(*rows)
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = materialize(stage(spark, df, SF), name, spark)
        left.append(sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect()))
    languages, lines, groups, clean = left
    assert len(languages) == len(rows) - 1 and len(lines) == len(languages)  # the null text goes first
    ids = [d for null, d, _ in groups if not null]
    assert ids.count(1) == 3 and 2 not in ids  # its rows stay together, the copy under 2 goes
    assert (3 in ids) and (4 not in ids)
    assert [d for null, d, _ in clean if not null and d == 5] == []  # and both rows of 5
    found = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    assert len(found) == len(clean) and max(r["n_tokens"] for r in found) > 60_000
