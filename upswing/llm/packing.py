"""Lexical retrieval packing: windows of related documents, filled to the last token.

Documents are encoded once and dealt into shards by a tree of planes over vectors of their weighted
tokens, so that lexically close documents come together and a shard stays small. Each shard has a BM25
inverted index of its own, with document frequencies and mean length of all documents; a seed asks with
all its terms. A window's seed is its first document; the index returns the seed's unused neighbours, best
first, and they fill the window in that order. The one that does not fit is cut; what is left of it
opens the next window and is its seed. Only a shard's last window can be short.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.hashing import mix
from upswing.llm.token_counts import PATTERN, SPACE
from upswing.sources.tables import staged

WINDOW = 1024
SEPARATOR = 0
SHARD_TOKENS = 2_000_000
AXES = 128  # of a likeness vector
CELLS, SAMPLED, MOST_SAMPLED = 4, 64, 40_000  # cells and sampled documents of a shard; sampled at most
K1, B = 1.2, 0.75
MOST_NEIGHBOURS, LISTED = 32, 160  # of a seed: taken at most, and in a list
# Seeds asked together, and scores they make; of a larger batch more documents never become seeds.
SEEDS_PER_BATCH, BATCH_CELLS = 16, 1 << 20
# Terms that so many of a shard's documents have are held as rows of a matrix, within these bounds.
WIDE_SHARE, WIDE_TERMS, WIDE_CELLS = 1 / 12, 2000, 1 << 22
_ID = np.dtype("<u4")
# The pattern without its look ahead, which only parts a white-space run of several characters
# from its last one, and where it does so.
_WITHOUT_LOOK_AHEAD = PATTERN.replace(f"[{SPACE}]+(?![^{SPACE}])|", "")
_LONG_SPACE = re.compile(f"[{SPACE}][{SPACE}]+(?=[^{SPACE}])")


@lru_cache(maxsize=2)
def encoder(path: str):
    """Function from a text to the ids that the tokenizer file at `path` gives, special strings included
    and none added. The merges run in tiktoken, which gives the same ids several times faster."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    special = {entry["content"]: entry["id"] for entry in content["added_tokens"]}
    plain = tiktoken.Encoding(
        "plain", pat_str=_WITHOUT_LOOK_AHEAD, mergeable_ranks=ranks, special_tokens={}
    )
    found = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def ordinary(text: str) -> list[int]:
        ids: list[int] = []
        for part in between_spaces(text):
            ids += plain.encode_ordinary(part)
        return ids

    def encode(text: str | None) -> list[int]:
        text = text or ""
        if found is None or not found.search(text):
            return ordinary(text)
        parts = found.split(text)
        return [
            i for part in parts
            for i in ([special[part]] if part in special else ordinary(part))
        ]

    return encode


def between_spaces(text: str) -> Iterator[str]:
    """Parts of a text, cut before the last character of each run of several white-space characters that
    something follows. No pre-token goes over such a cut, and inside the parts the pattern needs no
    look ahead, which takes tiktoken's regular expressions a fifth of its time."""
    first = 0
    for run in _LONG_SPACE.finditer(text):
        yield text[first : run.end() - 1]
        first = run.end() - 1
    yield text[first:]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id, ids` (32-bit, with the separator at the end), and two hashes to deal documents by. Rows
    with `counted` say for a token id in how many of a task's documents it is (`doc_id` and `low`); -1
    stands for the number of documents and -2 for that of tokens."""
    names = ["counted", "doc_id", "ids", "low", "next_low"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        df, documents, tokens = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                made = [_array(ids_of(text.as_py())) for text in part.column(1)]
                low, next_low = _smallest_hashes(made)
                seen = _document_frequencies(made)
                if len(seen) > len(df):
                    df = np.concatenate((df, np.zeros(len(seen) - len(df), np.int64)))
                df[: len(seen)] += seen
                documents, tokens = documents + len(made), tokens + sum(map(len, made))
                columns = [
                    pa.array(np.zeros(len(made), bool)), part.column(0),
                    pa.array([_narrow(ids) for ids in made], pa.binary()), pa.array(low), pa.array(next_low),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        term = np.flatnonzero(df)
        terms = pa.array([*term.tolist(), -1, -2], pa.int64())
        counts = pa.array([*df[term].tolist(), documents, tokens], pa.int64())
        none, flags = pa.nulls(len(terms), pa.binary()), pa.array(np.ones(len(terms), bool))
        yield pa.RecordBatch.from_arrays([flags, terms, none, counts, counts], names=names)

    return docs.select("doc_id", "text").mapInArrow(
        encode, "counted boolean, doc_id long, ids binary, low long, next_low long"
    )


def _smallest_hashes(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the next smallest hash of each document's ids; equal if there is only one."""
    hashes = mix(np.concatenate(docs).astype(np.uint64) + np.uint64(1)) >> np.uint64(1)
    lengths = np.array([len(d) for d in docs])
    starts = np.cumsum(lengths) - lengths
    low = np.minimum.reduceat(hashes, starts)
    rest = np.where(hashes > np.repeat(low, lengths), hashes, np.uint64((1 << 64) - 1))
    next_low = np.minimum.reduceat(rest, starts)
    next_low = np.where(next_low == np.uint64((1 << 64) - 1), low, next_low)
    return low.astype(np.int64), next_low.astype(np.int64)


def _document_frequencies(docs: list[np.ndarray]) -> np.ndarray:
    """In how many of at most 256 documents each token id is."""
    if not docs:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(docs), dtype=np.uint64), [len(d) for d in docs])
    key = (np.concatenate(docs).astype(np.uint64) << np.uint64(8)) | owner
    if key.max() < 1 << 32:
        key = key.astype(np.uint32)
    key.sort()
    first = np.concatenate(([True], key[1:] != key[:-1]))
    return np.bincount((key[first] >> 8).astype(np.int64))


def _array(ids: list[int]) -> np.ndarray:
    """The ids of a document, with the separator at the end."""
    made = array("I", ids)
    made.append(SEPARATOR)
    return np.frombuffer(made, np.uint32).astype(_ID, copy=False)


def _narrow(ids: np.ndarray) -> bytes:
    """Ids in two bytes each if all fit, after a byte that tells the width."""
    small = ids.max() < 1 << 16
    return (b"\2" if small else b"\4") + ids.astype("<u2" if small else "<u4").tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[:1] == b"\2" else "<u4", offset=1).astype(_ID)


@dataclass(frozen=True)
class Statistics:
    """In how many of all documents each token id is, how many they are, and their mean length."""

    df: np.ndarray
    documents: int
    mean_length: float

    @cached_property
    def idf(self) -> np.ndarray:
        return np.log1p((self.documents - self.df + 0.5) / (self.df + 0.5))

    @cached_property
    def axes(self) -> tuple[np.ndarray, np.ndarray]:
        """Each id's place in a likeness vector, and its weight there with a sign."""
        hashes = mix(np.arange(len(self.df), dtype=np.uint64) + np.uint64(1))
        sign = 1.0 - 2.0 * (hashes >> np.uint64(63)).astype(float)
        return (hashes % np.uint64(AXES)).astype(np.int64), sign * self.idf


def statistics(docs: list[np.ndarray]) -> Statistics:
    df = np.zeros(max((int(d.max()) for d in docs), default=0) + 1, np.int64)
    for d in docs:
        df[np.unique(d)] += 1
    return Statistics(df, len(docs), sum(map(len, docs)) / max(1, len(docs)))


def likeness(ids: np.ndarray, whole: Statistics) -> np.ndarray:
    """Unit vector of a document's weighted tokens; like documents have a large inner product."""
    place, weight = whole.axes
    vector = np.bincount(place[ids], weights=weight[ids], minlength=AXES)
    return (vector / (np.sqrt(vector @ vector) + 1e-12)).astype(np.float32)


class Cells:
    """Tree of planes, each between the two halves of the documents that reach it, so that like documents
    come to the same cell or one near it in number. Learnt from a sample; either side gets cells in
    proportion to its tokens."""

    def __init__(self, vectors: np.ndarray, tokens: np.ndarray, cells: int):
        self.planes, self.cuts, self.below = [], [], []
        self.root = self._split(vectors, tokens, 0, cells)

    def _split(self, x: np.ndarray, tokens: np.ndarray, first: int, cells: int) -> int:
        """Number of a node, or -1 - number of a cell."""
        if cells < 2 or len(x) < 2:
            return -1 - first
        one = x[(x @ x.mean(axis=0)).argmin()]
        pair = np.stack((one, x[(x @ one).argmin()]))
        for _ in range(8):
            side = (x @ (pair[0] - pair[1])) < 0
            if side.all() or not side.any():
                break
            pair = np.stack((x[~side].mean(axis=0), x[side].mean(axis=0)))
        plane = pair[1] - pair[0]
        along = x @ plane
        cut = (pair[1] @ pair[1] - pair[0] @ pair[0]) / 2  # as near to one centre as to the other
        share = tokens[along < cut].sum() / tokens.sum()
        if not 0.2 < share < 0.8:
            order = np.argsort(along, kind="stable")
            until = np.cumsum(tokens[order])
            cut, share = along[order[np.searchsorted(until, until[-1] / 2)]], 0.5
        left = min(cells - 1, max(1, round(cells * share)))
        node = len(self.planes)
        self.planes.append(plane)
        self.cuts.append(cut)
        self.below.append(None)
        low = along < cut
        self.below[node] = (
            self._split(x[low], tokens[low], first, left),
            self._split(x[~low], tokens[~low], first + left, cells - left),
        )
        return node

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Cells of many vectors, a level of the tree at a time."""
        node = np.full(len(vectors), self.root, np.int64)
        planes = np.array(self.planes, np.float32).reshape(-1, AXES)
        cuts, below = np.array(self.cuts), np.array(self.below, np.int64).reshape(-1, 2)
        while True:
            inner = np.flatnonzero(node >= 0)
            if not len(inner):
                return -1 - node
            here = node[inner]
            along = np.einsum("ij,ij->i", vectors[inner], planes[here])
            node[inner] = below[here, (along >= cuts[here]).astype(np.int64)]


class Bm25:
    """Inverted index over the token ids of a shard's documents, weighted by the statistics of all.

    Only postings are kept, sorted by term and document. Seeds are asked for many at a time: the postings
    of terms that many documents have make one matrix product, those of the others are added up."""

    def __init__(self, docs: list[np.ndarray], whole: Statistics | None = None):
        whole = whole or statistics(docs)
        self.docs, self.size = docs, len(docs)
        lengths = np.array([len(d) for d in docs])
        key = np.concatenate(docs).astype(np.uint64)
        key <<= np.uint64(32)
        key |= np.repeat(np.arange(len(docs), dtype=np.uint32), lengths)
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        tf = np.diff(first, append=len(key))
        key = key[first]
        self.posting_doc = key.astype(np.uint32).astype(np.int32)
        key >>= np.uint64(32)
        self.of_term = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        terms = key[self.of_term[:-1]].astype(np.uint32)
        df = np.diff(self.of_term)
        norm = K1 * (1 - B + B * lengths[self.posting_doc] / whole.mean_length)
        self.posting_weight = np.repeat(whole.idf[terms], df) * (tf * (K1 + 1) / (tf + norm))
        # The terms of each document, by number.
        narrow = self.posting_doc.astype(np.uint16 if len(docs) < 1 << 16 else np.uint32)
        order = np.argsort(narrow, kind="stable")
        self.doc_terms = np.repeat(np.arange(len(terms), dtype=np.int32), df)[order]
        self.of_doc = np.searchsorted(narrow[order], np.arange(len(docs) + 1))
        self.wide = np.full(len(terms), -1, np.int64)
        self.held = np.arange(self.size)
        self._widen()

    def _widen(self) -> None:
        """Lay out the weights of the most frequent terms as rows of a matrix over the held documents."""
        df, column = np.diff(self.of_term), np.zeros(self.size, np.int64)
        column[self.held] = np.arange(len(self.held))
        most = max(1, min(WIDE_TERMS, WIDE_CELLS // max(1, len(self.held))))
        chosen = np.flatnonzero(df >= max(1, len(self.held) * WIDE_SHARE))
        chosen = chosen[np.argsort(-df[chosen], kind="stable")[:most]]
        self.wide[:] = -1
        self.wide[chosen] = np.arange(len(chosen))
        self.weights = np.zeros((len(chosen), len(self.held)))
        at = _ranges(self.of_term[chosen], df[chosen])
        self.weights[np.repeat(np.arange(len(chosen)), df[chosen]), column[self.posting_doc[at]]] = (
            self.posting_weight[at]
        )
        self.column = column

    def keep(self, wanted: np.ndarray) -> None:
        """Drop the postings of other documents; their scores are 0 from now on."""
        held = wanted[self.posting_doc]
        self.of_term = np.concatenate(([0], np.cumsum(held)))[self.of_term]
        self.posting_doc, self.posting_weight = self.posting_doc[held], self.posting_weight[held]
        self.held = np.flatnonzero(wanted)
        self._widen()

    def scores(self, seeds: np.ndarray) -> np.ndarray:
        """BM25 scores of the held documents for all distinct terms of each seed (a row each), to nine
        digits, so that equal documents have equal scores."""
        count = self.of_doc[seeds + 1] - self.of_doc[seeds]
        terms = self.doc_terms[_ranges(self.of_doc[seeds], count)]
        row = np.repeat(np.arange(len(seeds)), count)
        wide = self.wide[terms]
        asked = np.zeros((len(seeds), len(self.weights)))
        asked[row[wide >= 0], wide[wide >= 0]] = 1.0
        found = asked @ self.weights
        row, terms = row[wide < 0], terms[wide < 0]
        postings = self.of_term[terms + 1] - self.of_term[terms]
        at = _ranges(self.of_term[terms], postings)
        place = np.repeat(row * len(self.held), postings) + self.column[self.posting_doc[at]]
        found += np.bincount(place, self.posting_weight[at], found.size).reshape(found.shape)
        return np.round(found, 9, out=found)

    def best(self, seeds: np.ndarray, most: int, wanted: np.ndarray) -> list[list[int]]:
        """For each seed the `most` wanted documents with the highest scores above 0, itself left out, the
        best first and ties in order."""
        score = self.scores(seeds)
        score[:, ~wanted[self.held]] = 0.0
        own = np.flatnonzero(np.isin(seeds, self.held))
        score[own, self.column[seeds[own]]] = 0.0
        most = min(most, len(self.held))
        if not most:
            return [[] for _ in seeds]
        bar = np.partition(score, score.shape[1] - most, axis=1)[:, score.shape[1] - most]
        row, column = np.nonzero(score >= np.maximum(bar, np.nextafter(0.0, 1.0))[:, None])
        order = np.lexsort((column, -score[row, column], row))
        row, docs = row[order], self.held[column[order]]
        bounds = np.searchsorted(row, np.arange(len(seeds) + 1)).tolist()
        return [docs[a : min(b, a + most)].tolist() for a, b in zip(bounds, bounds[1:])]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one after the other."""
    first = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - first, lengths)


class Neighbours:
    """The unused neighbours of seeds, best first.

    A list is made for many documents together, the longest first, as these become seeds; it holds more
    than a window takes. A seed whose list was used up is asked again, so that lists are never short."""

    def __init__(self, docs: list[np.ndarray], whole: Statistics | None, unused: np.ndarray):
        self.index, self.unused = Bm25(docs, whole), unused
        self.longest = self.waiting = np.argsort([-len(d) for d in docs], kind="stable")
        self.lists: dict[int, list[int]] = {}

    def of(self, seed: int) -> Iterator[int]:
        """Up to `MOST_NEIGHBOURS` documents that are unused when they are taken."""
        given = 0
        while given < MOST_NEIGHBOURS:
            if seed not in self.lists:
                self._ask(seed)
            listed = self.lists.pop(seed)
            for doc in listed:
                if self.unused[doc]:
                    yield doc
                    given += 1
                    if given == MOST_NEIGHBOURS:
                        return
            if len(listed) < LISTED:
                return

    def _ask(self, seed: int) -> None:
        held = int(self.unused.sum())
        if held < 0.9 * len(self.index.held):
            self.index.keep(self.unused)
        batch = max(1, min(SEEDS_PER_BATCH, BATCH_CELLS // max(1, len(self.index.held))))
        self.waiting = self.waiting[self.unused[self.waiting]]
        if not len(self.waiting):  # all have been asked for: once more, as lists have been used up
            self.waiting = self.longest = self.longest[self.unused[self.longest]]
        seeds = np.concatenate(([seed], self.waiting[: batch - 1]))
        seeds = seeds[np.sort(np.unique(seeds, return_index=True)[1])]
        self.waiting = self.waiting[batch - 1 :]
        for one, listed in zip(seeds.tolist(), self.index.best(seeds, LISTED, self.unused)):
            self.lists[one] = listed


def pack(
    docs: list[np.ndarray], window: int = WINDOW, whole: Statistics | None = None
) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a shard."""
    unused = np.ones(len(docs), bool)
    index = Neighbours(docs, whole, unused)
    in_order, sequence, offset = 0, 0, 0
    neighbours: Iterator[int] = iter(())
    for _ in range(len(docs)):
        current = next(neighbours, -1)
        if current < 0:
            while not unused[in_order]:
                in_order += 1
            current = in_order
        unused[current] = False
        start, total = 0, len(docs[current])
        while start < total:
            if offset == 0:  # the first document of a window is its seed
                neighbours = index.of(current)
            length = min(total - start, window - offset)
            yield current, start, length, sequence, offset
            start += length
            offset += length
            if offset == window:
                sequence, offset = sequence + 1, 0


def _statistics(made: DataFrame) -> Statistics:
    """Of all documents, out of what the tasks have counted: a row per token id is sent."""
    counted = made.filter("counted").groupBy("doc_id").agg(F.sum("low").alias("n"))
    found = {r["doc_id"]: r["n"] for r in counted.collect()}
    documents, tokens = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(max(found, default=0) + 1, np.int64)
    df[list(found)] = list(found.values())
    return Statistics(df, documents, tokens / max(1, documents))


class Dealing:
    """Which shard a document belongs to: documents in the order of their cell, then of their hashes and
    id, are cut where a bounded sample says that a shard is full. A cell, or a group of equal documents, of
    any size is cut like that, too. A document counts by its tokens and as much as a mean one besides, so
    that a shard has neither very many tokens nor very many documents."""

    def __init__(self, rows: list[tuple], shards: int):
        """`rows` of the sample: (two hashes, id, likeness vector, tokens)."""
        x = np.array([row[3] for row in rows], np.float32).reshape(-1, AXES)
        tokens = np.array([row[4] for row in rows], float)
        self.cells = Cells(x, tokens, CELLS * shards)
        keys = [
            (cell, *key[:2], _order(key[2])) for cell, key in zip(self.cells.of(x).tolist(), rows)
        ]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        until = np.cumsum((tokens + tokens.mean())[order]) if len(order) else np.zeros(0)
        bounds = until[-1] / shards * np.arange(1, shards) if len(order) else np.zeros(0)
        self.bounds = [keys[order[i]] for i in np.searchsorted(until, bounds).tolist()]

    def of(self, cells: list[int], low: list[int], next_low: list[int], ids: list) -> list[int]:
        return [
            bisect(self.bounds, (cell, a, b, _order(doc_id)))
            for cell, a, b, doc_id in zip(cells, low, next_low, ids)
        ]


def _order(doc_id: int | None) -> tuple:
    return (doc_id is not None, doc_id or 0)


def _dealing(made: DataFrame, whole: Statistics, shards: int) -> Dealing:
    """Learnt from a bounded sample of the documents."""
    if shards < 2:
        return Dealing([], 1)
    share = min(1.0, min(SAMPLED * shards, MOST_SAMPLED) / whole.documents)
    order = F.pmod(F.xxhash64("doc_id", "low", "next_low"), F.lit(1 << 30))
    shared = made.sparkSession.sparkContext.broadcast(whole)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [_wide(raw.as_py()) for raw in batch.column("ids")]
            made = [likeness(i, shared.value).tobytes() for i in ids]
            columns = [
                batch.column("low"), batch.column("next_low"), batch.column("doc_id"),
                pa.array(made, pa.binary()), pa.array([len(i) for i in ids], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["low", "next_low", "doc_id", "vector", "tokens"])

    sample = made.filter(order < int(share * (1 << 30))).mapInArrow(
        vectors, "low long, next_low long, doc_id long, vector binary, tokens long"
    )
    rows = [(*r[:3], np.frombuffer(r[3], np.float32), r[4]) for r in sample.collect()]
    rows.sort(key=lambda r: (r[0], r[1], _order(r[2])))
    return Dealing(rows, shards)


def packed(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """`doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`, and `ids` if wanted: the pieces
    of all documents (`doc_id`, `text`, others are ignored), every token in exactly one.

    A document's tokens are those of its whole text and the separator; a null text counts as empty, so
    each document has a piece. A null doc_id stays null, and rows that repeat are packed each. Sequences
    are full but for the last of a shard. An empty table gives an empty table.
    """
    written = staged(encoded(docs, path), "encoded")
    whole = _statistics(written)
    made = written.filter("NOT counted").drop("counted")
    shards = max(1, -(-int(whole.mean_length * whole.documents) // SHARD_TOKENS))
    shared = docs.sparkSession.sparkContext.broadcast((whole, _dealing(made, whole, shards)))
    own = "doc_id long, ids binary, low long, next_low long, cell long, shard int"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, dealing = shared.value
        for batch in batches:
            vectors = [likeness(_wide(raw.as_py()), whole) for raw in batch.column("ids")]
            cells = dealing.cells.of(np.array(vectors).reshape(-1, AXES)).tolist()
            key = [batch.column(name).to_pylist() for name in ("low", "next_low", "doc_id")]
            made = [pa.array(cells, pa.int64()), pa.array(dealing.of(cells, *key), pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], names=[*batch.schema.names, "cell", "shard"]
            )

    if shards > 1:
        placed = made.mapInArrow(place, own)
    else:
        placed = made.withColumns({"cell": F.lit(0).cast("long"), "shard": F.lit(0)})
    keys = ["cell", "low", "next_low", "doc_id"]
    dealt = placed.repartitionById(shards, "shard").sortWithinPartitions(*keys, "ids")
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
        " offset long" + (", ids binary" if with_ids else "")
    )
    names = [field.split()[0] for field in schema.split(", ")]

    def write(ids: list, docs: list[np.ndarray], sequences: int) -> tuple[pa.RecordBatch, int]:
        pieces = list(pack(docs, window, shared.value[0]))
        cut = [docs[doc][start : start + length] for doc, start, length, _, _ in pieces]
        doc, start, length, sequence, offset = np.array(pieces, np.int64).T
        sizes = np.array([len(d) for d in docs], np.int64)
        columns = [
            pa.array([ids[d] for d in doc.tolist()], pa.int64()), start, length,
            pa.array([zlib.crc32(c) for c in cut], pa.int64()), sizes[doc], sequences + sequence, offset,
        ]
        if with_ids:
            columns.append(pa.array([c.tobytes() for c in cut], pa.binary()))
        table = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
        return table, sequences + int(sequence.max()) + 1

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = TaskContext.get().partitionId() << 40
        ids, held, size = [], [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                held.append(_wide(raw.as_py()))
                size += len(held[-1])
                if size >= 2 * SHARD_TOKENS:  # long documents: pack what is held, and go on
                    table, sequences = write(ids, held, sequences)
                    yield table
                    ids, held, size = [], [], 0
        if held:
            yield write(ids, held, sequences)[0]

    return dealt.select("doc_id", "ids").mapInArrow(shard, schema)
