import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from upswing.llm import periodic_runs as P
from upswing.llm.queries import QUERIES


def brute(words, least=24, exponent=3):
    """Every period, every maximal stretch; a stretch counts under its smallest period."""
    n, found = len(words), {}
    for period in range(1, n // exponent + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j + period - i
            inner = any(
                all(words[x] == words[x + q] for x in range(i, i + length - q))
                for q in range(1, period)
            ) if j > i and length >= max(least, exponent * period) else True
            if not inner:
                found[i, period] = length
            i = max(j, i + 1)
    return sorted((s, length, p) for (s, p), length in found.items())


def made_words(rng, letters):
    words = []
    while len(words) < rng.randint(0, 90):
        block = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
        words += block * rng.randint(1, 6) + block[: rng.randint(0, len(block))]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
@pytest.mark.parametrize("least, exponent", [(24, 3), (3, 3), (9, 3), (10, 4)])
def test_same_as_brute_force(letters, least, exponent):
    rng = random.Random(letters * 100 + least)
    some = 0
    for _ in range(250):
        words = made_words(rng, letters)
        expected = brute(words, least, exponent)
        assert P.runs_of(words, least, exponent) == expected
        if words:
            assert P.runs_within(words, least, exponent) == expected
        some += bool(expected)
    assert some > 50


def test_extensions_are_common_prefixes():
    rng = random.Random(5)
    words = made_words(rng, 3) + made_words(rng, 2)
    ahead = P.Extensions([w + 1 for w in words], 4)
    for _ in range(400):
        a, b = rng.sample(range(len(words)), 2)
        common = 0
        while max(a, b) + common < len(words) and words[a + common] == words[b + common]:
            common += 1
        assert ahead(P.np.array([a]), P.np.array([b]))[0] == common


def test_long_texts_take_linear_work():
    block = [f"w{i}" for i in range(7000)]
    assert P.runs_of(block * 9) == [(0, 63_000, 7000)]
    assert P.runs_of(["a"] * 50_000) == [(0, 50_000, 1)]
    assert P.runs_of([f"w{i % 30_000}" for i in range(60_000)]) == []


def test_odd_rows_and_clashing_columns(spark):
    line = "one two three "
    rows = [
        (1, None, 5, "x"), (2, "", 5, "x"), (3, " \t\n", 5, "x"), (4, line * 8, 5, "x"),
        (4, line * 8, 5, "x"), (5, " ".join(["a"] * 40), 5, "x"), (6, "é\n" * 24 + "end", 5, "x"),
        (None, "b " * 23, 5, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, `a.b` string")
    found = P.periodic_runs(docs)
    assert found.columns == ["doc_id", "text", "a.b", "runs", "collapsed"]
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()]
    nbsp = " ".join(["a"] * 40)
    assert sorted(got, key=str) == sorted(
        [
            (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 24, 3)], "one two three"),
            (4, [(0, 24, 3)], "one two three"), (5, [], nbsp), (6, [(0, 24, 1)], "é end"),
            (None, [], " ".join("b" * 23)),
        ],
        key=str,
    )
    assert P.periodic_runs(docs.limit(0)).count() == 0
    only = P.periodic_runs(docs.select(F.col("text").alias("collapsed")), text="collapsed")
    assert only.columns == ["runs", "collapsed"] and only.count() == len(rows)


def test_query_is_what_brute_force_gives(spark, sf_dir, docs):
    def expected(doc_id, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, hashed = len(words), zlib.crc32(str(doc_id).encode())
        if hashed % 10 == 0 and n:
            start = hashed // 10 % n
            period = 1 + (n - start) // (3 + hashed // 10 % 8)
            words = words[:start] + [words[start + (i - start) % period] for i in range(start, n)]
        runs = brute(words)
        dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
        left = " ".join(w for i, w in enumerate(words) if i not in dropped)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        return (
            doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
        )

    short = [r for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(found) == docs.count()
    assert any(found[r["doc_id"]][1] for r in short)
    for row in short:
        assert found[row["doc_id"]] == expected(row["doc_id"], row["text"])
