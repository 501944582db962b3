import random

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from upswing.llm import token_counts as token_counts_module
from upswing.llm.token_counts import counter, load, token_counts


def test_every_code_point_counts_as_the_library_counts_it(tokenizer):
    library, count = Tokenizer.from_file(tokenizer), counter(tokenizer, {})
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}b  {c}{c}\n{c}1" for c in points]
    expected = library.encode_batch(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, expected) if len(e.ids) != count(t)] == []


def test_random_texts(tokenizer):
    library, count = Tokenizer.from_file(tokenizer), counter(tokenizer, {"the": 1, " the": 1})
    pick = random.Random(1)
    parts = ["the", " the", "'s", "'LL", "  ", "\n", "<|endoftext|>", "é", "12", "!?", "　", "x" * 70]
    for _ in range(500):
        text = "".join(pick.choices(parts, k=pick.randint(0, 30)))
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_documents_and_odd_rows(docs, odd_docs, no_docs, tokenizer):
    library, _, _ = load(tokenizer)
    for table in (docs, odd_docs):
        rows = token_counts(table.withColumn("n_tokens", F.lit("old")), tokenizer).collect()
        assert len(rows) == table.count()
        for row in rows:
            expected = len(library.encode(row["text"] or "", add_special_tokens=False).ids)
            assert row["n_tokens"] == expected
    assert token_counts(no_docs, tokenizer).count() == 0


def test_no_shuffle_of_the_counted_rows(docs, tokenizer):
    plan = token_counts(docs, tokenizer)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_table_has_the_most_frequent_pieces_wherever_they_are(spark, tokenizer):
    rows = [("alpha beta",)] * 300 + [("gamma",)] * 100 + [("x" * 70,)] * 50 + [(None,)]
    docs = spark.createDataFrame(rows, "text string").orderBy("text")
    known = token_counts_module.frequent_lengths(docs, tokenizer, rows=10**6, size=2)
    assert set(known) == {"alpha", " beta"} and all(n >= 1 for n in known.values())
    assert "gamma" in token_counts_module.frequent_lengths(docs, tokenizer, rows=10**6, size=3)
