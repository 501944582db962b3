import numpy as np
from pyspark.sql import functions as F

from upswing.llm import toxicity


def area(scores, labels):
    """Share of pairs of a toxic and an ordinary row that are in the right order."""
    toxic, ordinary = scores[labels == 1], scores[labels == 0]
    return (
        (toxic[:, None] > ordinary).mean() + (toxic[:, None] == ordinary).mean() / 2
    )


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = toxicity.train(docs, labels.filter(~held_out))
    rows = toxicity.score(docs.join(labels.filter(held_out), "doc_id"), model).collect()
    scores, truth = (np.array([r[c] for r in rows]) for c in ("toxicity", "toxic"))
    assert len(rows) > 700 and area(scores, truth) > 0.9
    assert ((scores >= 0.5) == truth).mean() > 0.94


def test_windows_cover_the_whole_text():
    for n in (0, 1, 47, 95, 96, 97, 144, 145, 1000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        found = toxicity.windows(text)
        covered = {i * toxicity.STRIDE + j for i, w in enumerate(found) for j in range(len(w))}
        assert covered == set(range(n)) and found


def test_odd_texts_and_labels(spark, docs, sf_dir, odd_docs, no_docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, 1, None)], labels.schema))
    model = toxicity.train(docs, odd)
    rows = toxicity.score(odd_docs.withColumn("toxicity", F.lit("x")), model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["toxicity"] <= 1 for r in rows)
    assert toxicity.score(no_docs, model).count() == 0


def test_one_class_or_none(docs):
    for rows in ([], [("fine", 0), ("good", 0), ("well", 0)]):
        scores = [r["toxicity"] for r in toxicity.score(docs.limit(3), toxicity.fit(rows)).collect()]
        assert len(set(scores)) == 1 and scores[0] <= 0.5


def test_words_of_a_small_language_are_learnt():
    numbers = np.random.default_rng(5)

    large, small = (["".join(numbers.choice(list(x), 5)) for _ in range(60)] for x in ("abcdefg", "mnopqrs"))

    def texts(n, language, *words):
        return [" ".join([*numbers.choice(language, 60), *words]) for _ in range(n)]

    toxic = texts(800, large, "trashy") + texts(18, small, "nopsrom")  # 2 % of the class
    ordinary = texts(900, large) + texts(140, small) + texts(10, small, "nopsrom")
    rows = [(t, label) for label, group in ((1, toxic), (0, ordinary)) for t in group]
    model = toxicity.fit([rows[i] for i in numbers.permutation(len(rows))])
    assert b" trashy " in model.toxic and b" nopsrom " in model.toxic
