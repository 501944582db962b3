import pytest

from upswing.llm.queries import tokenizer_path


@pytest.fixture(scope="session")
def tokenizer():
    return tokenizer_path()


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# A null, an empty text, a blank, control strings, repeated rows, and a very long text.
ODD_TEXTS = [
    None, "", " \n\t", "word", "word", "<|endoftext|> a <|endoftext|>", "Ünïcode — “quotes” 日本語 𝒳",
    "can't we'll  \n\n x", "9" * 4000, "a" * 20_000, "la vie est belle " * 4000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, text, None, f"s{i}") for i, text in enumerate(ODD_TEXTS)] + [(3, "word", None, "s3")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
