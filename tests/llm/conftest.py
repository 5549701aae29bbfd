import pytest


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns
    named as operators name theirs."""
    long = " ".join(f"wörd{i % 977} the" for i in range(30_000))
    texts = [
        "a plain text of some words", None, "", " \t\n", long, "a plain text of some words",
        "Ünïcode Σας ΣΑΣ İstanbul", "x" * 70_000, "one two", "1 2 3 ... !?", "日本語 テキスト\u00a0x",
    ]
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), 1, "s", 0.5, "h") for i, t in enumerate(texts)]
    rows += [(0, texts[0], "en", "src0", 26, 2, "s", 0.5, "h")] * 3
    rows += [(None, "no id at all here", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, slot string, score double, fp string",
    )
