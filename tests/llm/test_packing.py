import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from upswing.llm import packing


def test_ids_are_the_librarys(tokenizer, docs, odd_docs):
    library, encode = Tokenizer.from_file(tokenizer), packing.encoder(tokenizer)
    texts = [r["text"] or "" for r in docs.unionByName(odd_docs, allowMissingColumns=True).collect()]
    texts += [f"a{chr(c)} {chr(c)}b" for c in range(1, 0x3200) if not 0xD800 <= c < 0xE000]
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encode(text) == expected.ids, text[:50]


def test_white_space_needs_no_look_ahead(tokenizer):
    assert "(?!" not in packing._WITHOUT_LOOK_AHEAD
    assert [*packing.between_spaces("a  b\n\n\tc d  ")] == ["a ", " b\n\n", "\tc d  "]
    library, encode = Tokenizer.from_file(tokenizer), packing.encoder(tokenizer)
    spaces, pick = " \t\n\r\x0b\x0c\x1c\x85\xa0\u2003\u2028\u3000", np.random.default_rng(3)
    texts = ["", " ", "  ", "\n a", " 's", "  's", "<|endoftext|>  <|endoftext|> \n"]
    for _ in range(3000):
        drawn = pick.integers(0, 2 * len(spaces) + 8, pick.integers(1, 14))
        texts.append("".join((spaces * 2 + "ab1'sé.\u0301")[i] for i in drawn.tolist()))
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encode(text) == expected.ids, repr(text)


def test_few_lists_are_made_for_documents_that_never_are_seeds(docs, tokenizer, monkeypatch):
    encode, asked, best = packing.encoder(tokenizer), [], packing.Bm25.best
    held = [packing._array(encode(r["text"])) for r in docs.orderBy("doc_id").collect()]
    monkeypatch.setattr(
        packing.Bm25, "best", lambda self, seeds, *more: asked.append(len(seeds)) or best(self, seeds, *more)
    )
    windows = len({sequence for _, _, _, sequence, _ in packing.pack(held)})
    assert sum(asked) < windows


def check(table, tokenizer, window=1024):
    library = Tokenizer.from_file(tokenizer)
    expected = sorted(
        (r["doc_id"] if r["doc_id"] is not None else -1,
         np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
        for r in table.collect()
    )
    pieces = packing.packed(table, tokenizer, window).collect()
    by_sequence, by_doc = {}, {}
    for p in pieces:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault((p["doc_id"] if p["doc_id"] is not None else -1, p["doc_tokens"]), []).append((p["start"], p["ids"]))
    short = 0
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= window
        short += end < window
    made = []
    for (doc_id, total), parts in by_doc.items():
        copies = sum(start == 0 for start, _ in parts)
        if copies == 1:
            text = b"".join(ids for _, ids in sorted(parts))
            assert len(text) == 4 * total
            made.append((doc_id, text))
        else:
            assert sum(len(ids) for _, ids in parts) == 4 * total * copies
            made += [e for e in expected if e[0] == doc_id and len(e[1]) == 4 * total]
    assert sorted(made) == expected
    return short, len(by_sequence)


def test_generated_documents_fill_their_windows(docs, tokenizer):
    short, sequences = check(docs, tokenizer)
    assert short <= 1 and sequences > 100


def test_many_shards(docs, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 20_000)
    short, sequences = check(docs.drop("n_chars").withColumn("ids", F.lit(1)), tokenizer, 512)
    assert short <= sequences / 10


def test_odd_tables(odd_docs, no_docs, spark, tokenizer):
    check(odd_docs, tokenizer)
    assert packing.packed(no_docs, tokenizer).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, None), (1, "")], "doc_id long, text string")
    rows = packing.packed(nulls, tokenizer).collect()
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows) == [(0, 1), (0, 3), (1, 1)]


def test_seeds_get_their_nearest_neighbours():
    numbers = np.random.default_rng(1)
    topics = [numbers.integers(100 * t, 100 * t + 100, (12, 60)).astype("<u4") for t in range(6)]
    docs = [d for row in zip(*topics) for d in row]  # topics alternate
    owner = {}
    for doc, _, _, sequence, _ in packing.pack(docs, window=240):
        owner.setdefault(sequence, []).append(doc % 6)
    pure = sum(len(set(t)) == 1 for t in owner.values())
    assert pure >= len(owner) * 0.7


@pytest.mark.parametrize("lengths", [[1], [5, 5], [1, 1, 1, 1], [100, 1, 37]])
def test_every_token_is_packed_once(lengths):
    docs = [np.arange(n, dtype="<u4") for n in lengths]
    pieces = list(packing.pack(docs, window=8))
    for doc, n in enumerate(lengths):
        covered = [i for d, start, length, _, _ in pieces if d == doc for i in range(start, start + length)]
        assert sorted(covered) == list(range(n))
    ends = {}
    for _, _, length, sequence, offset in pieces:
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert all(ends[s] == 8 for s in range(max(ends)))


def test_a_seed_asks_with_all_its_terms():
    numbers = np.random.default_rng(2)
    docs = [numbers.zipf(1.3, 200).clip(max=400).astype("<u4") for _ in range(40)]
    index, mean = packing.Bm25(docs), 200
    df = {t: sum(t in d for d in docs) for t in set(np.concatenate(docs).tolist())}
    for seed in (0, 7):
        expected = []
        for d in docs:
            tf = [(df[t], int((d == t).sum())) for t in np.unique(docs[seed]).tolist()]
            norm = packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
            expected.append(sum(np.log1p((40 - n + 0.5) / (n + 0.5)) * f * (packing.K1 + 1) / (f + norm) for n, f in tf))
        assert len(np.unique(docs[seed])) > 30 and np.allclose(index.scores(np.array([seed]))[0], expected)


def test_statistics_are_those_of_all_documents(docs, tokenizer):
    made = packing.staged(packing.encoded(docs.repartition(5), tokenizer), "encoded")
    own = [packing._wide(r["ids"]) for r in made.filter("NOT counted").collect()]
    whole, expected = packing._statistics(made), packing.statistics(own)
    assert (whole.df == expected.df).all()
    assert (whole.documents, whole.mean_length) == (expected.documents, expected.mean_length)
    part, asked = packing.Bm25(own[:50], whole), np.array([3, 11])
    before = part.scores(asked)
    assert np.allclose(before, packing.Bm25(own).scores(asked)[:, :50])
    wanted = np.arange(50) % 3 == 0
    part.keep(wanted)
    assert np.allclose(part.scores(asked), before[:, wanted])


def plain_pack(docs, window, whole, most=32):
    """Pieces by asking for one seed at a time, with the scores of all documents."""
    df, mean = whole.df, whole.mean_length
    idf = np.log1p((whole.documents - df + 0.5) / (df + 0.5))
    weights = []
    for d in docs:
        terms, tf = np.unique(d, return_counts=True)
        norm = packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
        weights.append(dict(zip(terms.tolist(), (idf[terms] * tf * (packing.K1 + 1) / (tf + norm)).tolist())))
    unused, pieces, neighbours = set(range(len(docs))), [], []
    sequence = offset = 0
    while unused:
        current = neighbours.pop(0) if neighbours else min(unused)
        unused.discard(current)
        start, total = 0, len(docs[current])
        while start < total:
            if offset == 0:
                asked = set(docs[current].tolist())
                scores = {d: round(sum(weights[d].get(t, 0.0) for t in asked), 9) for d in unused}
                found = sorted((-s, d) for d, s in scores.items() if s > 0)
                neighbours = [d for _, d in found[:most]]
            length = min(total - start, window - offset)
            pieces.append((current, start, length, sequence, offset))
            start, offset = start + length, offset + length
            if offset == window:
                sequence, offset = sequence + 1, 0
    return pieces


@pytest.mark.parametrize("wide, listed, batch", [(1 / 24, 256, 64), (0.9, 33, 3), (0.001, 40, 7)])
def test_pieces_are_those_of_asking_one_by_one(docs, tokenizer, monkeypatch, wide, listed, batch):
    monkeypatch.setattr(packing, "WIDE_SHARE", wide)
    monkeypatch.setattr(packing, "LISTED", listed)
    monkeypatch.setattr(packing, "SEEDS_PER_BATCH", batch)
    encode = packing.encoder(tokenizer)
    own = [np.array([*encode(r["text"]), 0], "<u4") for r in docs.limit(120).collect()]
    own += [own[3], own[5], own[3], np.zeros(1, "<u4")]
    whole = packing.statistics(own + [own[0]] * 30)
    for window in (64, 1024):
        assert list(packing.pack(own, window, whole)) == plain_pack(own, window, whole)


def test_like_documents_share_cells():
    numbers = np.random.default_rng(3)
    topics = [numbers.integers(100 * t, 100 * t + 100, (40, 80)).astype("<u4") for t in range(8)]
    docs = [d for row in zip(*topics) for d in row]
    whole = packing.statistics(docs)
    x = np.array([packing.likeness(d, whole) for d in docs])
    cells = packing.Cells(x, np.full(len(docs), 80.0), 8)
    found = cells.of(x)
    assert sorted(set(found.tolist())) == list(range(8))
    assert all(np.bincount(found[t::8]).max() >= 35 for t in range(8))
    one = packing.Cells(x[:1].repeat(9, axis=0), np.ones(9), 4)  # copies only
    assert 0 <= one.of(x[:1])[0] < 4


def test_dealing_brings_topics_together(spark, tokenizer, monkeypatch):
    numbers = np.random.default_rng(4)
    words = [["".join(numbers.choice(list("abcdefghijklmnop"), 7)) for _ in range(40)] for _ in range(4)]
    rows = [(i, " ".join(numbers.choice(words[i % 4], 60))) for i in range(400)]
    monkeypatch.setattr(packing, "SHARD_TOKENS", 25_000)
    pieces = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer).collect()
    shards = {}
    for p in pieces:
        shards.setdefault(p["sequence_id"] >> 40, []).append(p["doc_id"] % 4)
    assert len(shards) >= 3
    assert sum(max(map(t.count, range(4))) for t in shards.values()) >= 0.6 * len(pieces)
