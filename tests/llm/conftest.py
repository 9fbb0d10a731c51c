import pytest

CLASHES = "row kept fp words h1 key part found text_hash _text w lang_pred bands blocks".split()


@pytest.fixture(scope="session")
def docs(spark):
    """documents from (doc_id, text[, lang]), with columns whose names operators use themselves."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", __file__.rsplit("/tests/", 1)[0])

    def make(*rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None, *["x"] * len(CLASHES)) for r in rows
        ]
        columns = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, columns + "".join(f", {c} string" for c in CLASHES))

    return make
