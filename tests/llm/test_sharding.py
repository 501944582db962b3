import random
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from upswing.llm import sharding
from upswing.llm.sharding import communication_matrix, hypergeometric, uniform_shards


@pytest.mark.parametrize("good, bad, drawn", [(5, 7, 4), (1, 9, 10), (0, 3, 2), (6, 0, 3), (40, 25, 30)])
def test_draws_follow_the_hypergeometric_law(spark, good, bad, drawn):
    n = 20_000
    uniform = (F.col("id") + 0.5) / n
    draw = hypergeometric(F.lit(good), F.lit(bad), F.lit(drawn), uniform)
    seen = Counter(r[0] for r in spark.range(n).select(draw).collect())
    for k in range(drawn + 1):
        p = comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn) if k <= good else 0
        assert abs(seen.get(k, 0) - p * n) <= 2, (k, p)


def test_large_draw_is_centred(spark):
    draw = hypergeometric(F.lit(10**9), F.lit(10**9), F.lit(10**6), F.lit(0.0))
    assert spark.range(1).select(draw).first()[0] == 500_000


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_matrix_has_exact_margins(spark, levels):
    sizes = spark.createDataFrame([(0, 1003), (1, 0), (2, 77), (5, 250)], "block long, n long")
    sizes = sizes.filter(F.col("block") < (1 << levels))
    expected = {r["block"]: r["n"] for r in sizes.collect()}
    rows = communication_matrix(sizes, levels, 16, 7).collect()
    assert len(rows) == 1 << levels
    assert all(sum(r["counts"]) == expected.get(r["block"], 0) for r in rows)
    columns = [sum(c) for c in zip(*(r["counts"] for r in rows))]
    assert max(columns) - min(columns) <= 1 and min(min(r["counts"]) for r in rows) >= 0


def test_shards_are_even_gapless_whole_and_repeatable(docs):
    rows = docs.select("doc_id", F.lit("x").alias("shard"), "lang")
    one = uniform_shards(rows, ["doc_id"], block_rows=20)
    found = sorted((r["doc_id"], r["shard"], r["slot"]) for r in one.collect())
    assert [f[0] for f in found] == sorted(r["doc_id"] for r in docs.collect())
    sizes = Counter(s for _, s, _ in found)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert {(s, slot) for _, s, slot in found} == {(s, i) for s, n in sizes.items() for i in range(n)}
    again = uniform_shards(rows.repartition(3), ["doc_id"], block_rows=20)
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in again.collect()) == found


def test_odd_tables(odd_docs, no_docs, spark):
    assert uniform_shards(no_docs, ["doc_id"]).count() == 0
    nulls = spark.createDataFrame([(None, None)] * 40, "doc_id long, text string")
    found = uniform_shards(nulls, ["doc_id", "text"]).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in found) == [2] * 8 + [3] * 8
    assert uniform_shards(odd_docs, ["doc_id", "text"]).count() == odd_docs.count()


def test_matrix_by_parts_has_the_margins_of_the_whole(spark, monkeypatch):
    pick = random.Random(1)
    expected = {b: pick.choice([0, 3, 50, 700]) for b in range(64) if b % 5}
    sizes = spark.createDataFrame(list(expected.items()), "block long, n long")
    for at_once in (12, 4):
        monkeypatch.setattr(sharding, "LEVELS_AT_ONCE", at_once)
        rows = communication_matrix(sizes, 6, 16, 7).collect()
        assert sorted(r["block"] for r in rows) == list(range(64))
        assert all(sum(r["counts"]) == expected.get(r["block"], 0) for r in rows)
        columns = [sum(c) for c in zip(*(r["counts"] for r in rows))]
        assert max(columns) - min(columns) <= 1 and min(min(r["counts"]) for r in rows) >= 0
    plan = communication_matrix(sizes, 6, 16, 7)._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_columns_with_clashing_names(spark):
    names = ["_bounds", "_block", "_place", "_cell", "block", "place", "bounds", "cell", "row", "within", "a.b"]
    rows = [(i, *(f"{n}{i}" for n in names)) for i in range(200)]
    docs = spark.createDataFrame(rows, ["doc_id", *names])
    found = uniform_shards(docs, ["doc_id"], block_rows=10)
    assert found.columns == ["doc_id", *names, "shard", "slot"]
    assert sorted(tuple(r)[:-2] for r in found.collect()) == rows


def test_a_shard_is_a_random_sample(spark):
    """Positions of the rows of each shard are spread like those of a uniform shuffle."""
    found = uniform_shards(spark.range(8000), ["id"], block_rows=2000).collect()
    for shard in range(16):
        own = [r["id"] for r in found if r["shard"] == shard]
        assert len(own) == 500 and abs(sum(own) / 500 - 3999.5) < 5 * 8000 / (12 * 500) ** 0.5
        slots = sorted((r["slot"], r["id"]) for r in found if r["shard"] == shard)
        rises = sum(a[1] < b[1] for a, b in zip(slots, slots[1:]))
        assert 180 < rises < 320
