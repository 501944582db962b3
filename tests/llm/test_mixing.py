import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from upswing.llm import mixing as M
from upswing.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, text string"


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Level by repeated sharing out of what capped sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = sum(w for s, w in weight.items() if s not in capped)
        target = {
            s: most * sizes[s] if s in capped else left * weight[s] / free for s in order
        }
        over = {s for s in order if s not in capped and target[s] >= most * sizes[s]}
        if not over:
            return target
        capped |= over


def brute(rows, weight=lambda row: 1.0):
    """(doc_id, size, source_size, target, taken) by sorting each source as a whole."""
    by_source = defaultdict(list)
    for doc_id, source, text in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        digest = "" if text is None else hashlib.md5(text.encode()).hexdigest()
        name = f"mix:{'' if doc_id is None else doc_id}:{digest}"
        u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        by_source[source].append((-math.log(u) / weight(doc_id), doc_id, size))
    sizes = {s: sum(d[2] for d in docs) for s, docs in by_source.items()}
    wanted = brute_targets(sizes)
    out = []
    for source, docs in by_source.items():
        epochs = int(wanted[source] // sizes[source]) if sizes[source] else 0
        rest = int(wanted[source]) - epochs * sizes[source]
        for _, doc_id, size in sorted(docs, key=lambda d: d[0]):
            given = max(0, min(size, rest))
            rest -= given
            out.append((doc_id, size, sizes[source], wanted[source], epochs * size + given))
    return out


def same(found, expected):
    rounded = lambda rows: sorted((r[:3] + (round(r[3], 6), r[4]) for r in rows), key=str)
    assert rounded(map(tuple, found)) == rounded(expected)


def made_rows(n=400):
    sizes = [1 + (i * 7919) % 97 for i in range(n)]
    return [(i, f"s{i * i % 5}" if i % 7 else None, "w " * size) for i, size in enumerate(sizes)]


@pytest.mark.parametrize("few", [1, 20_000])
def test_same_as_sorting_whole_sources(spark, monkeypatch, few):
    monkeypatch.setattr(M, "FEW_KEYS", few)
    monkeypatch.setattr(M, "DIGIT_BITS", 3)
    rows = made_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    weight = F.when(F.col("id") % 3 == 0, 4.0).otherwise(0.25)
    weights = docs.select(F.col("doc_id").alias("id")).withColumn("weight", weight)
    found = M.mix(docs, document_weights=weights, keep=["doc_id"])
    same(found.collect(), brute(rows, lambda i: 4.0 if i % 3 == 0 else 0.25))


def test_targets_stop_at_twice_the_size_and_add_up(spark):
    for sizes in (
        {"a": 10, "b": 1000, "c": 5, None: 70}, {"a": 0, "b": 3}, {"a": 0}, {"x": 7},
        {f"s{i}": i * i for i in range(40)}, {"a": 100, "b": 100, "c": 100},
    ):
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r["source"]: r["target"] for r in M.targets(table).collect()}
        expected = brute_targets(sizes)
        assert found == pytest.approx(expected)
        assert sum(found.values()) == pytest.approx(1.5 * sum(sizes.values()))
        assert all(found[s] <= 2 * sizes[s] for s in sizes)


def test_taken_words_reach_the_target_and_runs_agree(spark):
    rows = made_rows()
    first = M.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    second = M.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, second), key=str)
    taken, target = defaultdict(int), {}
    for r in first:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(taken[s] == int(target[s]) for s in target)


def test_heavier_documents_come_first(spark):
    rows = [(i, "ab"[i >= 3000], "w") for i in range(6000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    # Of 1.5 times all words, b gets 1.5 * 6000 / 4 = 2250 of its 3000.
    heavy_ones = docs.filter("doc_id % 2 = 0").selectExpr("doc_id AS id", "8.0D AS weight")
    mixed = M.mix(docs, document_weights=heavy_ones, weights=(3, 1))
    chosen = [r["doc_id"] for r in mixed.filter("source = 'b' AND taken = 1").collect()]
    heavy = sum(i % 2 == 0 for i in chosen)
    # Exponential races: the share taken by time t is 1 - exp(-w t); both add up to 2250 at t = 0.695.
    assert abs(heavy - 1500 * (1 - math.exp(-8 * 0.6955))) < 25


def test_odd_rows_weights_and_names(spark):
    rows = [(1, None, None), (2, "a", ""), (3, "a", " \t"), (4, "b", "x y"), (4, "b", "x y"), (None, "b", "z"),
            (5, "\U0001d4b3", "p q r"), (6, "￿", "s t")]
    docs = spark.createDataFrame([(*r, 7, 8, 9) for r in rows], SCHEMA + ", size int, key int, cell int")
    odd = [(4, float("nan")), (5, -1.0), (6, None), (None, 2.0)]
    found = M.mix(docs, document_weights=spark.createDataFrame(odd, "id long, weight double"))
    assert found.columns == ["doc_id", "source", "text", "key", "cell", *M._ADDED]
    got = found.collect()
    assert len(got) == len(rows) and {r["key"] for r in got} == {8}
    assert all(r["taken"] <= 2 * r["size"] and (r["size"] > 0 or r["taken"] == 0) for r in got)
    by_id = {r["source"]: r["target"] for r in got}
    assert by_id == pytest.approx(
        brute_targets({None: 0, "a": 0, "b": 5, "\U0001d4b3": 3, "￿": 2})
    )
    assert M.mix(docs.limit(0)).count() == 0


def test_equal_rows_share_what_falls_on_them(spark):
    docs = spark.createDataFrame([(1, "a", "w " * 10)] * 30, SCHEMA)
    taken = [r["taken"] for r in M.mix(docs).collect()]
    assert taken == [15] * 30


def test_copies_hold_the_taken_words(spark):
    mixed = M.mix(spark.createDataFrame(made_rows(60), SCHEMA))
    copies = M.repeated(mixed).withColumn("words", M.word_count(F.col("text")))
    totals = copies.groupBy("doc_id").agg(F.sum("words").alias("words"))
    expected = {r["doc_id"]: r["taken"] for r in mixed.filter("taken > 0").collect()}
    assert {r["doc_id"]: r["words"] for r in totals.collect()} == expected


def test_query_near_its_targets(spark, sf_dir):
    rows = QUERIES["op11_source_mix"](spark, sf_dir).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source_size"], r["target"]] += r["taken"]
    assert rows and all(abs(total - key[1]) < 1 for key, total in taken.items())
