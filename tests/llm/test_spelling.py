import random
import re
import zlib
from collections import Counter

import pytest

from upswing.llm import spelling as S
from upswing.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def brute(counts, least=3):
    """All pairs of words that share a one-letter hole or differ by one letter, checked one by one."""
    words = {w: n for w, n in counts.items() if n >= least}
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
        for i in range(len(w) + 1):
            holes.setdefault((w[:i], w[i:]), []).append(w)
    near = {w: set() for w in words}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return {
        (w, forms[w], root(w), n, len(near[w]), words.get(forms[w])) for w, n in words.items()
    }


def found(spark, counts, **options):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {tuple(r) for r in S.spelling_groups(rows, **options).collect()}


@pytest.mark.parametrize("seed, letters, small", [(1, "ab", True), (2, "abcé", False)])
def test_same_as_brute_force(spark, monkeypatch, seed, letters, small):
    if small:  # several passes over filters of several segments
        monkeypatch.setattr(S, "SEGMENT_BLOCKS", 16)
        monkeypatch.setattr(S, "BROADCAST_SEGMENTS", 2)
        monkeypatch.setattr(S, "CELLS", 64)
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(1, 10))) for _ in range(600)}
    counts = {w: int(2 ** (rng.random() * 12)) for w in sorted(words)}
    expected = brute(counts)
    assert found(spark, counts) == expected
    assert any(root != form for _, form, root, *_ in expected if form)


def test_long_words_ties_and_letters_beyond_the_first_plane(spark):
    long = "x" * 30_000
    counts = {
        long: 100, long + "x": 3, long[:-1] + "y": 7, "ab" * 40: 9, "ab" * 40 + "c": 4,
        "tie": 4, "tia": 10, "tib": 10, "𝒳bcde": 8, "bcde": 3, "zbcde": 8, "": 50,
    }
    got = {r[0]: r for r in found(spark, counts)}
    assert "" not in got and got[long + "x"][1] == long and got[long[:-1] + "y"][1] == long
    assert got["tie"][1:] == ("tia", "tia", 4, 2, 10)
    assert got["bcde"][1:] == ("zbcde", "zbcde", 3, 2, 8)
    assert got["ab" * 40 + "c"][1] == "ab" * 40


def test_no_words_and_odd_rows(spark):
    rows = [(None, 5, "a"), ("word", None, "a"), ("alone", 3, "a"), ("rare", 2, "a")]
    counts = spark.createDataFrame(rows, "word string, n long, form string")
    assert {tuple(r) for r in S.spelling_groups(counts).collect()} == {
        ("alone", None, "alone", 3, 0, None)
    }
    assert S.spelling_groups(counts.limit(0)).count() == 0


def test_collisions_of_the_filters_are_settled_by_the_words(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCKS_PER_WORD", 1e-9)  # one block a filter: nearly all bits are set
    rng = random.Random(9)
    counts = {"".join(rng.choices("abc", k=6)): rng.randint(3, 50) for _ in range(150)}
    assert found(spark, counts) == brute(counts)


def test_counts_of_odd_texts(spark, odd_docs, no_docs):
    counts = {r["word"]: r["n"] for r in S.word_counts(odd_docs, shortest=2).collect()}
    assert counts["word"] == 3 and counts["a" * 20_000] == 1 and counts["Ünïcode"] == 1
    assert counts["vie"] == 4000 and "9999" not in counts
    assert S.word_counts(no_docs).count() == 0
    null_id = odd_docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "1 AS word", "2 AS n")
    assert S.word_counts(null_id, typo_divisor=1).count() > 0


def test_query_is_what_brute_force_gives(spark, sf_dir, docs):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    for row in docs.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            run = run.translate(lower)
            hashed = zlib.crc32(f"{row['doc_id']}:{run}".encode())
            if hashed % 97 == 0:
                at = hashed % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    got = QUERIES["op12_spelling_variants"](spark, sf_dir).collect()
    assert {tuple(r) for r in got} == brute(counts) and len(got) == len(set(map(tuple, got)))
