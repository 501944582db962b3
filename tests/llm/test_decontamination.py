import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from upswing.llm import decontamination as D


def brute(docs, items, similarity=0.8, size=5):
    """Best similarity of each item over all windows of its length."""

    def split(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def bag(words, span):
        return Counter(tuple(words[i : i + span]) for i in range(len(words) - span + 1))

    out = {}
    for d, text in docs:
        own = split(text)
        for i, item in items:
            want = split(item)
            if not want or not own:
                continue
            span, length = min(size, len(want)), min(len(want), len(own))
            target = bag(want, span)
            best = 0.0
            for start in range(len(own) - length + 1):
                window = bag(own[start : start + length], span)
                common = sum((window & target).values())
                best = max(best, common / max(1, sum((window | target).values())))
            if best >= similarity:
                out[d, i] = round(best, 9)
    return out


def found(docs, items, **options):
    rows = D.contaminated(docs, items, **options).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in rows}) == len(rows)
    return {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows}


def test_generated_tables(docs, spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = found(docs, items)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect() if r["n_chars"] < 1800]
    expected = brute(pairs, [(r["item_id"], r["text"]) for r in items.collect()])
    short = {d for d, _ in pairs}
    assert expected and {k: v for k, v in got.items() if k[0] in short} == expected


def test_changed_passages_and_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 600)
    pick = random.Random(4)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("ala", "ero", "iti", "une")]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.randint(3, 50)))) for i in range(30)]
    docs = []
    for n in range(80):
        passage = items[pick.randrange(30)][1].split()
        for _ in range(pick.randrange(3)):
            passage[pick.randrange(len(passage))] = pick.choice(vocabulary)
        if n % 4 == 0:
            passage = [w.upper() + "," for w in passage]
        around = [pick.choices(vocabulary, k=pick.randrange(60)) for _ in range(2)]
        docs.append((n, " ".join(around[0] + passage + around[1])))
    got = found(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert got == brute(docs, items) and len(got) > 20


def test_every_fingerprint_within_the_radius_is_found():
    numbers = np.random.default_rng(7)
    index = D.ItemIndex(list(range(60)), [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(60)])
    items = index.prepared["prints"]
    windows = np.repeat(items, 3, axis=0)
    flips = numbers.random(windows.shape) < numbers.choice([0.1, 0.2, 0.28], len(windows))[:, None]
    windows = windows ^ flips
    distance = (windows[:, None, :] != items[None]).sum(axis=2)
    window, item, exact = index.near(windows)
    assert set(zip(window, item)) == set(zip(*np.nonzero(distance <= D.RADIUS)))
    assert (distance[window, item] == exact).all()


def test_odd_tables(odd_docs, no_docs, spark):
    items = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "Word!", 0), (None, "x", 0), (5, "la vie est belle la vie", 0), (6, "Word", 1)],
        "item_id long, text string, doc_id int",
    )
    rows = D.contaminated(odd_docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(3, 3), (4, 3), (3, 6), (4, 6), (10, 5)}
    assert len(rows) == 7
    kept = D.without_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 5, 6, 7, 8, 9]
    assert D.contaminated(no_docs, items).count() == 0
    assert D.contaminated(odd_docs, items.limit(0)).count() == 0
    assert D.without_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_a_common_phrase_takes_bounded_work():
    """4,000 items that begin with the same twelve words, and a text that has these 500 times."""
    pick = random.Random(2)
    phrase = "which of the following is the best answer to the question below".split()
    items = [" ".join(phrase + [f"w{pick.randrange(10**6)}" for _ in range(20)]) for _ in range(4000)]
    text = " ".join(" ".join([*phrase, f"x{i}"]) for i in range(500)) + " " + items[1234]
    index = D.ItemIndex(list(range(4000)), items)
    assert index.prepared
    tracemalloc.start()
    begun = time.process_time()
    for first, data, offsets in D.blocks(D._normal(pa.array([text, "nothing", items[7].upper()]))):
        hits = index.leaks(data, offsets)
    took, peak = time.process_time() - begun, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(t, i, s) for t, i, _, _, s, _ in hits] == [(0, 1234, 1.0), (2, 7, 1.0)]
    assert took < 4 and peak < 300e6


def test_items_of_little_but_a_common_phrase(monkeypatch):
    monkeypatch.setattr(D, "PARCEL", 50)
    monkeypatch.setattr(D, "WINDOWS_AT_ONCE", 7)
    phrase = "one two three four five six seven eight nine ten eleven twelve".split()
    items = [(i, " ".join([*phrase, f"w{i}"])) for i in range(40)] + [(99, "one two three four five " * 4)]
    texts = [" ".join(phrase * 6), " ".join([*phrase, "w3", "w4", *phrase, "w5"]), "one two three four five " * 9]
    index = D.ItemIndex([i for i, _ in items], [t for _, t in items])
    hits = []
    for first, data, offsets in D.blocks(D._normal(pa.array(texts))):
        hits += [(first + t, i, round(s, 9)) for t, i, _, _, s, _ in index.leaks(data, offsets)]
    expected = brute(list(enumerate(texts)), items)
    assert {(t, i): s for t, i, s in hits} == expected and len(expected) > 40
