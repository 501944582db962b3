from fractions import Fraction

import numpy as np
import pytest

from upswing.llm import top_k as T

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k=5):
    def codes(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return [int(np.floor(256 * float(np.float32(x)))) for x in v]

    usable = [(i, codes(v)) for i, v, *_ in rows if i is not None and codes(v) is not None]
    out = set()
    for q, a in usable:
        if asked(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("per_block", [7, 100, 1024])
def test_same_as_brute_force_with_ties_and_odd_vectors(spark, monkeypatch, per_block):
    monkeypatch.setattr(T, "CANDIDATES_PER_BATCH", per_block)
    monkeypatch.setattr(T, "QUERIES_PER_BATCH", 5)
    monkeypatch.setattr(T, "QUERIES_PER_PASS", 11 if per_block == 7 else 10_000)
    made = np.random.default_rng(3).normal(0, 0.3, (160, 12)).round(1).tolist()
    rows = [(i, v, 0) for i, v in enumerate(made)] + [(200 + i, made[4], 0) for i in range(30)]
    rows += [(300, None, 1), (301, [0.1, None], 1), (302, [float("nan")] * 12, 1), (303, [], 1)]
    rows += [(304, [float("inf")] * 12, 1), (305, [0.5, 0.25], None), (None, made[0], 1)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = T.top_k(vectors, vectors.filter("vec_id % 5 = 0"))
    assert {tuple(r) for r in found.collect()} == brute(rows, lambda q: q % 5 == 0)


def test_few_rows_and_no_rows(spark):
    rows = [(0, [1.0], 0), (1, [2.0], 0)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in T.top_k(vectors, vectors).collect()} == brute(rows, lambda q: True)
    assert T.top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    assert T.top_k(vectors, vectors.limit(0)).count() == 0


def whole(x):
    """floor(256 * x) without doubles."""
    return int(Fraction(float(x)) * 256 // 1)


def exact(rows, k=5):
    """Ranks by Python's whole numbers; scores beyond a long are null."""
    out = set()
    codes = [(i, list(map(whole, v))) for i, v in rows]
    for q, a in codes:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in codes if i != q)
        out |= {
            (q, r, i, -s if -(2**63) <= -s < 2**63 else None)
            for r, (s, i) in enumerate(scored[:k], 1)
        }
    return out


def found(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return {tuple(r) for r in T.top_k(vectors, vectors).collect()}


def test_scores_beyond_exact_doubles(spark):
    big = float(2**20)
    rows = [(0, [big, 1.0]), (1, [big, 3.0]), (2, [big, 2.0])]
    got = found(spark, rows)
    assert got == exact(rows)
    score = {(q, i): s for q, _, i, s in got}
    assert score[0, 1] - score[0, 2] == 256 * 256 and score[0, 1] > 2**53


@pytest.mark.parametrize("scale", [2.0**18, 2.0**30, 1e15, 1e120])
def test_pruned_ranks_beyond_doubles_and_longs(spark, scale):
    rng = np.random.default_rng(7)
    values = (rng.normal(0, 1, (60, 6)) * scale).tolist()
    values += [[v + 0.01 for v in values[0]], [v - 0.01 for v in values[0]], values[1], [-v for v in values[2]]]
    rows = list(enumerate(values))
    assert found(spark, rows) == exact(rows)
    lists = T.Lists(np.arange(64), np.floor(np.array(values) * 256))
    alive = lists.left(np.arange(64), lists.values, 5)
    assert alive.sum() < 0.7 * alive.size


def test_components_beyond_longs_and_doubles(spark):
    rows = [(0, [1e20]), (1, [2e20]), (2, [3e19]), (3, [-1e25]), (4, [1.0])]
    assert found(spark, rows + [(5, [1e307]), (6, [float("inf")])]) == exact(rows)
