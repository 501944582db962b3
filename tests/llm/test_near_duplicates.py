import random
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from upswing.llm import hashing
from upswing.llm import near_duplicates as N
from upswing.llm.components import connected_components


def exact(rows, size, percent=80):
    """Component of every id, by comparing all pairs."""
    sets = {i: N._shingle_set(t or "", size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if not x or not y or min(len(x), len(y)) < 0.7 * max(len(x), len(y)):
            continue
        common = len(x & y)
        if 100 * common >= percent * (len(x) + len(y) - common):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def found(df, size):
    rows = N.near_duplicates(df, shingle_words=size).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}


def variants(seed, originals=6, copies=25, length=60):
    """Texts with chains of copies that differ in one to a few words."""
    pick, rows = random.Random(seed), []
    for _ in range(originals):
        text = [f"w{pick.randrange(400)}" for _ in range(pick.randint(5, length))]
        for _ in range(copies):
            own = list(text)
            for _ in range(pick.randrange(4)):
                own[pick.randrange(len(own))] = f"x{pick.randrange(50)}"
            rows.append((len(rows), " ".join(own)))
            if pick.random() < 0.3:
                text = own
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_generated_documents(docs, size):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, size) == exact(rows, size)


@pytest.mark.parametrize("seed, rounds, hot", [(1, 3, 0.1), (2, 0, 0.05), (3, 1, 1.0)])
def test_chains_of_copies(spark, monkeypatch, seed, rounds, hot):
    monkeypatch.setattr(N, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(N, "HOT_SHARE", hot)
    monkeypatch.setattr(N, "HOT_ROWS", 3)
    monkeypatch.setattr(N, "MEMBERS_PER_GROUP", 3)
    rows = variants(seed)
    pick = random.Random(seed)
    rows += [(1000 + i, rows[pick.randrange(20)][1].upper()) for i in range(10)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), 2) == exact(rows, 2)


def test_classes_that_share_many_buckets_meet_once(spark):
    """Twenty buckets of the same six classes; and five whose classes differ, which would make more pairs
    together than apart."""
    same = [(bucket, False, rep, 1 if rep < 5 else rep) for bucket in range(20) for rep in range(1, 7)]
    other = [
        (100 + i, i == 0, rep, component)
        for i in range(5)
        for rep, component in ((100 + 10 * i, 100), (101 + 10 * i, 100), (200 + i, 200 + i))
    ]
    members = spark.createDataFrame(same + other, "bucket long, hot boolean, rep long, component long")
    met = [tuple(r) for r in N._meetings(members).collect()]
    assert sorted(r for r in met if r[0] == 1) == [
        (1, -1, rep, 1 if rep < 5 else rep, 1, 1) for rep in range(1, 7)
    ]
    assert sorted(r for r in met if r[0] == 100) == sorted(
        (100, bucket, rep, component, 1, 1) for bucket, _, rep, component in other
    )


def test_odd_texts(odd_docs, no_docs):
    rows = sorted(
        (r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
        for r in N.near_duplicates(odd_docs).collect()
    )
    assert len(rows) == odd_docs.count() and rows.count((3, 1, 3, True)) == 2
    assert (4, 1, 3, False) in rows and (0, 0, 0, True) in rows and (1, 0, 1, True) in rows
    assert N.near_duplicates(no_docs).count() == 0


def test_null_ids_are_kept(spark):
    table = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string")
    rows = {tuple(r) for r in N.near_duplicates(table).collect()}
    assert rows == {(None, 1, None, True), (1, 1, 1, True), (2, 1, 1, False)}


def test_one_of_each_group_stays_with_its_columns(odd_docs):
    kept = N.without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 4 not in ids and ids.count(3) == 2 and set(range(3)) <= set(ids)


def test_registers_merge_and_estimate():
    elements = np.random.default_rng(1).integers(0, 1 << 55, 900).astype(np.uint64)
    owner = np.zeros(600, np.int64)
    a, b, both = (
        N.sketch(np.zeros(len(e), np.int64), e, 1)
        for e in (elements[:600], elements[300:], elements)
    )
    assert (np.maximum(a, b) == both).all() and len(owner) == 600
    n = np.array([600.0])
    assert abs(N.estimate_overlap(a, b, n, n)[0] - 1 / 3) < 0.12
    assert N.estimate_overlap(a, a, n, n)[0] == 1.0
    large = N.estimate_overlap(a, both, n, np.array([900.0]))[0]
    assert abs(large - 2 / 3) < 0.12


def test_sketch_does_not_depend_on_the_block():
    made = np.random.default_rng(2).integers(0, 1 << 55, 50).astype(np.uint64)
    owner = np.repeat(np.arange(5), 10)
    together = N.sketch(owner, made, 5)
    for i in range(5):
        assert (N.sketch(np.zeros(10, np.int64), made[i * 10 : i * 10 + 10], 1)[0] == together[i]).all()


def test_sets_of_many_long_texts_are_made_in_little_memory():
    pick = random.Random(7)
    text = " ".join(f"w{pick.randrange(5000)}" for _ in range(1500))
    texts = pa.array([f"{i} {text}" for i in range(250)])
    tracemalloc.start()
    for _, data, offsets in N.blocks(texts, N.SIGN_BYTES):
        N.sketch(*N.block_sets(data, offsets, 5), len(offsets) - 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000


def test_hashing_a_short_text_keeps_little_memory():
    hashing._powers.cache_clear()
    data = np.frombuffer(b"some words " * 100, np.uint8)
    tracemalloc.start()
    hashing.words(data, np.array([0, len(data)]), hashing.WHITE_SPACE)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 6_000_000


def test_no_table_comes_from_python_rows(spark, monkeypatch):
    """Such rows are made by Python workers of their own, which stay in memory beside the others."""
    rows = [(i, f"one two three four five six seven eight {i // 2}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def refuse(*args, **more):
        raise AssertionError("a table of Python rows")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    found = N.near_duplicates(docs, 2).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(i, i // 2 * 2) for i in range(8)]


def test_components(spark):
    pick = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3)]
    links += [(pick.randrange(300, 400), pick.randrange(300, 400)) for _ in range(60)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    parent = {r["id"]: r["component"] for r in rows}
    assert len(parent) == len(rows)
    assert all(parent[i] == 0 for i in range(41)) and parent[249] == 100
    assert all(parent[a] == parent[b] for a, b in links if a is not None and a != b)
    assert all(c <= i and parent[c] == c for i, c in parent.items())
    empty = connected_components(spark.createDataFrame([], "a long, b long"))
    assert empty.count() == 0


@pytest.mark.parametrize("turned", [False, True])
def test_an_id_with_several_texts_loses_no_link(spark, turned):
    pick = random.Random(3)
    one, two, three = ([f"{p}{pick.randrange(10**6)}" for _ in range(40)] for p in "xyz")
    copy = lambda words: " ".join([*words[:-1], "end"])
    texts = [" ".join(one), " ".join(two), " ".join(three)]
    first = [(1, texts[0]), (1, texts[1])]
    rows = first[::-1] if turned else first
    rows = rows + [(2, copy(one)), (3, copy(two)), (7, texts[2]), (7, texts[0]), (5, copy(three)), (9, texts[2])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in N.near_duplicates(table, 2).collect())
    assert found == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (5, 5, True), (7, 1, False),
        (7, 5, False), (9, 5, False),
    ]


def test_small_sets_share_a_band_as_often_as_independent_registers_do():
    """Pairs that share four of five shingles: 40,000 of them, none without a common band."""
    rng = np.random.default_rng(11)
    missed = 0
    for _ in range(10):
        shared = rng.integers(0, 1 << 55, (4000, 4), dtype=np.uint64)
        extra = rng.integers(0, 1 << 55, (4000, 1), dtype=np.uint64)
        owner = np.repeat(np.arange(4000), 4)
        one = N.sketch(owner, shared.ravel(), 4000)
        both = np.hstack((shared, extra))
        other = N.sketch(np.repeat(np.arange(4000), 5), both.ravel(), 4000)
        used = N.BANDS * N.BAND_REGISTERS
        agrees = (one[:, :used] == other[:, :used]).reshape(-1, N.BANDS, N.BAND_REGISTERS).all(axis=2)
        missed += int((~agrees.any(axis=1)).sum())
        rate = agrees.mean()
    assert missed == 0 and abs(rate - 0.8**6) < 0.01


def test_hubs_of_many_links_are_split(spark, monkeypatch):
    from upswing.llm import hot

    monkeypatch.setattr(hot, "HOT_SHARE", 0.05)
    monkeypatch.setattr(hot, "HOT_ROWS", 3)
    links = [(0, i) for i in range(1, 400)] + [(399, i) for i in range(500, 900)] + [(900, 901)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["component"] for r in rows if r["id"] < 900} == {0}
    assert {r["component"] for r in rows if r["id"] >= 900} == {900}
