"""Passages of benchmark items in documents, by SimHash of item-sized windows.

A window that is similar enough to an item lacks few of its shingles, so it has one of any few more. A
document and an item meet only if the document has one of the item's rarest shingles, so many that a
similar window cannot lack them all; a phrase that many items share brings nobody together. For such
pairs windows are laid wherever the document has any shingle of the item, aligned as in the item and as
long as it; windows that items lay in the same place are one. Each window gets a
128-bit SimHash of its shingles. The items' fingerprints are indexed by `PARTS` parts of their bits: two
fingerprints within `RADIUS` bits differ in some part by no more than `PART_RADIUS` bits, so probing
every part with all such changes finds every item within the radius. What is found is verified by
weighted Jaccard similarity of the shingles (weights: how often a shingle occurs).

Items come in blocks of bounded size, one broadcast and one pass each, and one at a time; documents are
never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.hashing import NOT_ALPHANUMERIC, blocks, mix, shingles, words
from upswing.sources.tables import discard, staged

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCK_BYTES = 16 << 20  # text of the items that are broadcast together
BITS, PARTS, RADIUS = 128, 13, 38
PART_RADIUS = RADIUS // PARTS
PARCEL, WINDOWS_AT_ONCE = 1 << 18, 1024  # places and windows that are looked at together
_PREFILTER_BITS = 22
_BOUNDS = np.linspace(0, BITS, PARTS + 1).astype(int)


def _normal(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one after the other."""
    first = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - first, lengths)


def fingerprints(features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """SimHash, as 0/1 per bit, of successive runs of features; a run has at least one."""
    pair = np.stack([mix(features), mix(~features)], axis=1)
    bits = np.unpackbits(pair.view(np.uint8).reshape(len(features), 16), axis=1)
    sums = np.add.reduceat(bits, np.cumsum(lengths) - lengths, axis=0, dtype=np.int64)
    return (2 * sums > lengths[:, None]).astype(np.uint8)


def _parts(prints: np.ndarray) -> list[np.ndarray]:
    return [
        prints[:, a:b].astype(np.int64) @ (1 << np.arange(b - a))
        for a, b in zip(_BOUNDS, _BOUNDS[1:])
    ]


class ItemIndex:
    """Shingles and fingerprints of one block of items. Items without words are left out."""

    def __init__(
        self,
        ids: list[int],
        texts: list[str | None],
        size: int = SHINGLE_WORDS,
        similarity: float = SIMILARITY,
    ):
        self.size, self.similarity = size, similarity
        self.ids, self.lengths, self.features = [], [], []
        column = _normal(pa.array(texts, pa.string()))
        for first, data, offsets in blocks(column):
            owner, hashes = words(data, offsets, NOT_ALPHANUMERIC)
            for local in np.unique(owner):
                own = hashes[owner == local]
                span = min(size, len(own))
                _, made = shingles(np.zeros(len(own), np.int64), own, span)
                self.ids.append(ids[first + int(local)])
                self.lengths.append(len(own))
                self.features.append(made)

    @cached_property
    def prepared(self) -> dict:
        lengths = np.array(self.lengths)
        counts = np.array([len(f) for f in self.features])
        flat = np.concatenate(self.features)
        item = np.repeat(np.arange(len(lengths)), counts)
        rare = self._rarest(flat, item, counts)
        rare = rare[np.argsort(flat[rare], kind="stable")]
        table = np.zeros(1 << _PREFILTER_BITS, bool)
        table[flat[rare] >> np.uint64(64 - _PREFILTER_BITS)] = True
        prints = fingerprints(flat, counts)
        indexed = []
        for part, (a, b) in zip(_parts(prints), zip(_BOUNDS, _BOUNDS[1:])):
            at = np.argsort(part, kind="stable")
            starts = np.searchsorted(part[at], np.arange((1 << (b - a)) + 1))
            indexed.append((at, starts))
        return {
            "lengths": lengths, "counts": counts, "first": np.cumsum(counts) - counts, "flat": flat,
            "rare": flat[rare], "rare_item": item[rare], "table": table, "prints": prints, "parts": indexed,
            "bags": [Counter(f.tolist()) for f in self.features],
            "spans": sorted({min(self.size, n) for n in self.lengths}),
        }

    def _rarest(self, flat: np.ndarray, item: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Places of each item's shingles that fewest items have: one more than a window of at least
        `similarity` may lack."""
        values, number = np.unique(flat, return_inverse=True)
        pairs = np.unique(number.astype(np.int64) * len(counts) + item)
        held_by = np.bincount(pairs // len(counts), minlength=len(values))
        order = np.lexsort((flat, held_by[number], item))
        position = _ranges(np.zeros(len(counts), np.int64), counts)
        needed = np.floor((1 - self.similarity) * counts + 1e-9).astype(np.int64) + 1
        return order[position < np.repeat(needed, counts)]

    def near(
        self, prints: np.ndarray, text: np.ndarray | None = None, pairs: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window, item, distance) within the radius; given the windows' texts, only of `pairs`."""
        p = self.prepared
        n_items = len(self.ids)
        found = []
        for value, (at, starts), a, b in zip(_parts(prints), p["parts"], _BOUNDS, _BOUNDS[1:]):
            for changes in range(PART_RADIUS + 1):
                for bits in combinations(range(b - a), changes):
                    probe = value ^ sum(1 << bit for bit in bits)
                    count = starts[probe + 1] - starts[probe]
                    hit = np.flatnonzero(count)
                    items = at[_ranges(starts[probe[hit]], count[hit])]
                    window = np.repeat(hit, count[hit])
                    if pairs is not None:
                        met = _among(text[window] * n_items + items, pairs)
                        window, items = window[met], items[met]
                    found.append(window * n_items + items)
            found = [np.unique(np.concatenate(found))]
        window, item = np.divmod(found[0], n_items)
        distance = (prints[window] != p["prints"][item]).sum(axis=1)
        close = distance <= RADIUS
        return window[close], item[close], distance[close]

    def leaks(
        self, data: np.ndarray, offsets: np.ndarray
    ) -> list[tuple[int, int, int, int, float, int]]:
        """(text, item, first word, words, similarity, distance) of the best window of every item that
        a text of the block holds."""
        p = self.prepared
        owner, hashes = words(data, offsets, NOT_ALPHANUMERIC)
        first_word = np.searchsorted(owner, np.arange(len(offsets)))
        best: dict[tuple[int, int], tuple] = {}
        for span in p["spans"]:
            at, made = shingles(owner, hashes, span)
            pairs = self._meetings(owner[at], made, span)
            if not len(pairs):
                continue
            windows = self._windows(pairs, at, made, owner, first_word)
            for part in range(0, windows.shape[1], WINDOWS_AT_ONCE):
                start, length = windows[:, part : part + WINDOWS_AT_ONCE]
                text, counts = owner[start], length - span + 1
                where = np.searchsorted(at, start)
                features, before = made[_ranges(where, counts)], np.cumsum(counts) - counts
                window, item, distance = self.near(fingerprints(features, counts), text, pairs)
                bags: dict[int, Counter] = {}
                for w, i, d in zip(window.tolist(), item.tolist(), distance.tolist()):
                    if w not in bags:
                        bags[w] = Counter(features[before[w] : before[w] + counts[w]].tolist())
                    common = sum((bags[w] & p["bags"][i]).values())
                    score = common / (counts[w] + p["counts"][i] - common)
                    if score >= self.similarity:
                        t = int(text[w])
                        row = (score, -int(start[w] - first_word[t]), int(length[w]), d)
                        best[t, i] = max(best.get((t, i), row), row)
        return [
            (t, self.ids[i], -start, length, score, d)
            for (t, i), (score, start, length, d) in sorted(best.items())
        ]

    def _meetings(self, text: np.ndarray, made: np.ndarray, span: int) -> np.ndarray:
        """Sorted numbers (text times items plus item) of the pairs that share one of the item's rarest
        shingles."""
        p = self.prepared
        likely = np.flatnonzero(p["table"][made >> np.uint64(64 - _PREFILTER_BITS)])
        low = np.searchsorted(p["rare"], made[likely])
        count = np.searchsorted(p["rare"], made[likely], "right") - low
        likely, low, count = likely[count > 0], low[count > 0], count[count > 0]
        if not len(likely):
            return np.zeros(0, np.int64)
        # A shingle counts once in a text, however often it is there.
        once = np.unique(np.stack([text[likely], low]), axis=1, return_index=True)[1]
        likely, low, count = likely[once], low[once], count[once]
        found = []
        for part in _parcels(count):
            item = p["rare_item"][_ranges(low[part], count[part])]
            pair = np.repeat(text[likely[part]], count[part]) * len(self.ids) + item
            found.append(np.unique(pair[np.minimum(p["lengths"][item], self.size) == span]))
        return np.unique(np.concatenate(found))

    def _windows(
        self, pairs: np.ndarray, at: np.ndarray, made: np.ndarray, owner: np.ndarray, first_word: np.ndarray
    ) -> np.ndarray:
        """Start and length, each once, of the windows that the items of `pairs` lay in their texts."""
        p = self.prepared
        text, item = np.divmod(pairs, len(self.ids))
        # Where a text has a shingle, by a hash of both; another text's would lay a needless window.
        here = np.flatnonzero(np.isin(owner[at], text))
        key = mix(made[here] ^ mix(owner[at[here]].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        here, key = here[order], key[order]
        found = [np.zeros((2, 0), np.int64)]
        for some in _parcels(p["counts"][item]):
            count = p["counts"][item[some]]
            entry = _ranges(p["first"][item[some]], count)
            own = np.repeat(some, count)
            asked = mix(p["flat"][entry] ^ mix(text[own].astype(np.uint64) + np.uint64(1)))
            low = np.searchsorted(key, asked)
            times = np.searchsorted(key, asked, "right") - low
            offset = entry - p["first"][item[own]]
            for part in _parcels(times):
                pair = np.repeat(own[part], times[part])
                place = at[here[_ranges(low[part], times[part])]]
                start = first_word[text[pair]]
                end = first_word[text[pair] + 1]
                length = np.minimum(p["lengths"][item[pair]], end - start)
                start = np.clip(place - np.repeat(offset[part], times[part]), start, end - length)
                found.append(np.unique(np.stack([start, length]), axis=1))
        return np.unique(np.concatenate(found, axis=1), axis=1)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array `known`, which is not empty."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _parcels(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Positions in groups whose counts add up to about `PARCEL` at most, a single one aside."""
    total = np.cumsum(counts)
    start = 0
    while start < len(counts):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + PARCEL, "right")))
        yield np.arange(start, stop)
        start = stop


def item_indexes(benchmark: DataFrame, size: int, similarity: float) -> Iterator[ItemIndex]:
    """Indexes of all items, one after the other, in blocks of about `BLOCK_BYTES` of text: whatever is
    on the driver and broadcast at once is bounded, however many items there are."""
    usable = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    total = usable.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    for number in range(count):
        own = usable.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        rows = own.orderBy("item_id", "text").collect()
        index = ItemIndex([r["item_id"] for r in rows], [r["text"] for r in rows], size, similarity)
        if index.ids:
            yield index


def _by_block(
    start: DataFrame, benchmark: DataFrame, size: int, similarity: float, step
) -> DataFrame:
    """`step(result, shared index)` for one block of items after the other. If a block is followed by
    another, its result is written and its index released before the next one is made."""
    spark, result, shared, written = start.sparkSession, start, None, None
    for index in item_indexes(benchmark, size, similarity):
        if shared is not None:
            result, before = staged(result, "decontaminated"), written
            written = result
            shared.destroy()
            if before is not None:
                discard(spark, before.inputFiles()[0].rsplit("/", 1)[0])
        shared = spark.sparkContext.broadcast(index)
        result = step(result, shared)
    return result


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """`doc_id, item_id, first_word, n_words, similarity, distance`: the window of each document that
    is most similar to each item of `benchmark` (`item_id`, `text`), where that reaches `similarity`.

    Words are runs of letters and digits, case aside. An item or document shorter than a shingle counts
    as one shingle of all its words. Null and empty texts match nothing; a null doc_id comes back as
    null; rows that repeat come back each; equal items are found each. Other columns are ignored. No
    items or no documents give an empty table.
    """
    rows = docs.select("doc_id", "text")
    schema = (
        "doc_id long, item_id long, first_word long, n_words long, similarity double, distance int"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64()] * 4 + [pa.float64(), pa.int32()]

    def found_in(result: DataFrame, shared) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, data, offsets in blocks(_normal(batch.column(1))):
                    hits = shared.value.leaks(data, offsets)
                    if hits:
                        ids = batch.column(0).take(pa.array([first + h[0] for h in hits]))
                        columns = [list(c) for c in zip(*hits)][1:]
                        made = [pa.array(c, t) for c, t in zip(columns, types[1:])]
                        yield pa.RecordBatch.from_arrays([ids.cast(types[0]), *made], names=names)

        return result.unionByName(rows.mapInArrow(find, schema))

    nothing = docs.sparkSession.createDataFrame([], schema)
    return _by_block(nothing, benchmark, shingle_words, similarity, found_in)


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """Rows of `docs` that hold no item, with their own columns; they stay where they are."""
    at = docs.columns.index("text")

    def clean_of(result: DataFrame, shared) -> DataFrame:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, data, offsets in blocks(_normal(batch.column(at))):
                    for hit in shared.value.leaks(data, offsets):
                        keep[first + hit[0]] = False
                yield batch.filter(pa.array(keep))

        return result.mapInArrow(clean, result.schema)

    return _by_block(docs, benchmark, shingle_words, similarity, clean_of)
