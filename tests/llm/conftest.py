import pytest

from sluice.llm.queries import documents, tokenizer

LONG = "".join(f"wörd{i % 977} " for i in range(9000))


@pytest.fixture(scope="session")
def docs(spark, data):
    return documents(spark, data)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="session")
def byte_path():
    return tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_path():
    return tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and names that the operators use themselves."""
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, "a tie"), (6, "a tie"), (7, "one"), (7, "one"),
        (None, "no id"), (None, None), (8, LONG), (9, "<|endoftext|> x <|endoftext|>"), (10, "ẹ́ 한국어 \x1c\x1d 日本語 　 é"),
        (11, "x" * 5000), (12, "  two  spaces \n\n and\tmore  "), (13, LONG + "tail"),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, id string, row string, bucket string,"
        " fingerprint string, text_sha256 string, _maybe string, _row string, _id string, _runs string, length string"
    )
    return spark.createDataFrame([(i, t, *[None] * 2, None, *["x"] * 10) for i, t in texts], schema).repartition(3)


@pytest.fixture(scope="session")
def odd_rows(odd):
    return [(r["doc_id"], r["text"]) for r in odd.collect()]


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
