import math
import unicodedata
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from upswing.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = language.train(docs.filter(~held_out))
    long_enough = language.predict(docs.filter(held_out & (F.length("text") > 40)), model)
    right, total = long_enough.agg(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert total > 150 and right / total > 0.99


def test_scoring_many_long_texts_takes_little_memory():
    model = language.Model(["a", "b"], np.zeros((2, language.BUCKETS)), np.zeros(2))
    texts = pa.array(["la vie est belle, they say " * 60] * 400)
    language.posteriors(model, texts.slice(0, 1))
    tracemalloc.start()
    language.posteriors(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15_000_000


def test_rare_languages_are_learnt_from_all_their_rows():
    assert language._shares([100, 100], 50) == [0.25, 0.25]
    assert language._shares([10**9, 7, 30], 100) == [63 / 10**9, 1.0, 1.0]
    assert language._shares([5, 5], 50) == [1.0, 1.0]


def test_priors_are_those_of_all_rows(docs):
    model = language.train(docs, max_rows=40)
    totals = Counter(r["lang"] for r in docs.filter("lang IS NOT NULL AND text IS NOT NULL").collect())
    assert model.languages == sorted(totals)
    expected = [math.log(totals[x] / totals.total()) for x in model.languages]
    assert np.allclose(model.log_prior, expected)


def grams(text):
    """Runs of letters and marks, each behind a blank; all pieces of one to three characters that are not
    a lone blank."""
    def inside(c):
        return unicodedata.category(c)[0] in "LM"

    kept, text = "", text.lower()
    for i, c in enumerate(text):
        if inside(c):
            kept += c
        elif i + 1 < len(text) and inside(text[i + 1]):
            kept += " "
    return [kept[i : i + n] for n in (1, 2, 3) for i in range(len(kept) - n + 1) if kept[i : i + n] != " "]


def bucket(gram):
    code = len(gram)
    for c in gram:
        code = (code << 21 | ord(c)) & (2**64 - 1)
    return int(language.mix(np.array([code], np.uint64))[0] % np.uint64(language.BUCKETS))


def test_same_as_a_plain_naive_bayes(spark, docs):
    rows = [r for r in docs.select("doc_id", "text", "lang").collect() if r["text"] and len(r["text"]) < 900]
    texts = [r["text"] for r in rows[:60]] + ["Ünï\u0301 x1y", "é", "123 a", "ß—z  q"]
    train = [(r["text"], r["lang"]) for r in rows if r["lang"]]
    sums = defaultdict(Counter)
    for text, lang in train:
        sums[lang].update(map(bucket, grams(text)))
    totals = Counter(lang for _, lang in train)
    expected = []
    for text in texts:
        found = [bucket(g) for g in grams(text)]
        weight = min(len(found), language.EVIDENCE) / max(1, len(found))
        logs = {}
        for lang, n in totals.items():
            whole = sums[lang].total() + language.SMOOTHING * language.BUCKETS
            likelihood = sum(math.log((sums[lang][b] + language.SMOOTHING) / whole) for b in found)
            logs[lang] = weight * likelihood + math.log(n / totals.total())
        best = max(sorted(logs), key=logs.get)
        expected.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    labelled = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(train)], "doc_id long, text string, lang string")
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = language.predict(asked, language.train(labelled)).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == [b for b, _ in expected]
    assert np.allclose([r["score"] for r in got], [s for _, s in expected])


def test_marks_alone_are_no_letters(spark, docs):
    texts = ["\u0301\u0302 \u0300", "\u0903", "a\u0301"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = language.predict(rows, language.train(docs)).orderBy("doc_id").collect()
    assert [r["lang_pred"] == "und" for r in found] == [True, True, False]


def test_odd_texts(spark, docs, odd_docs, no_docs):
    model = language.train(docs)
    rows = language.predict(odd_docs.withColumn("score", F.lit("old")), model).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters) and 0 <= row["score"] <= 1
    assert language.predict(no_docs, model).count() == 0
    kept = language.known_language(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.filter("text is null").count() == 0


def test_nothing_learnt(docs, no_docs):
    model = language.train(no_docs)
    assert {r["lang_pred"] for r in language.predict(docs, model).collect()} == {"und"}


def test_neighbours_in_a_block_do_not_matter(docs):
    model = language.train(docs)
    together = {r["doc_id"]: r["score"] for r in language.predict(docs, model).collect()}
    alone = language.predict(docs.filter("doc_id % 7 = 0"), model).collect()
    assert all(abs(together[r["doc_id"]] - r["score"]) < 1e-9 for r in alone)
