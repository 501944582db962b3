"""Periodic runs of words: stretches that repeat a block of words three times or more.

A suffix tree of the words (Ukkonen) and one of the reversed words give longest common extensions: the
Euler tour of a tree, kept as the branching depth between neighbouring leaves, answers the depth of the
lowest common ancestor of two leaves in constant time from a sparse table. Each run contains a Lyndon
root that is the longest Lyndon word at its start, for the order of words or for its reverse, so two
candidates per position, extended in both directions, give all runs.

Trees are built only over stretches that can hold a run: in a run of `least` words and `exponent`
periods, each window of `least // exponent` words stands again within a period's distance, which is
at most the stretch's length through `exponent`. Windows are compared by a hash, so a collision only
keeps a stretch that could have been left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

LEAST_WORDS = 24
LEAST_EXPONENT = 3
RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ROUNDS = 12  # of narrowing a stretch; what is left then is searched as it is
_MULTIPLIER = 0x9E3779B97F4A7C15

Run = tuple[int, int, int]


def suffix_tree(codes: list[int], sigma: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's tree of `codes`, whose last one, 0, stands nowhere else: edges as
    `node * sigma + first code -> child`, and where each node's edge label starts and ends."""
    n = len(codes)
    edges: dict[int, int] = {}
    left, right, link = [0], [0], [0]
    node, edge, length, waiting = 0, 0, 0, 0
    for i, code in enumerate(codes):
        waiting += 1
        last = 0
        while waiting:
            if not length:
                edge = i
            key = node * sigma + codes[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(left)
                left.append(i)
                right.append(n)
                link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                begin = left[child]
                span = right[child] - begin
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if codes[begin + length] == code:
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(left)
                edges[key] = split
                edges[split * sigma + codes[begin + length]] = child
                edges[split * sigma + code] = split + 1
                left += (begin, i)
                right += (begin + length, n)
                link += (0, 0)
                left[child] = begin + length
                if last:
                    link[last] = split
                last = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return edges, left, right


class Extensions:
    """Longest common extensions of two positions of a sequence, by its suffix tree."""

    def __init__(self, codes: list[int], sigma: int):
        """`codes` are positive and below `sigma`."""
        n = len(codes) + 1
        edges, left, right = suffix_tree([*codes, 0], sigma)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        child = np.fromiter(edges.values(), np.int64, len(edges))
        del edges
        order = np.argsort(keys)
        nodes = len(left)
        begin = np.searchsorted(keys[order] // sigma, np.arange(nodes + 1)).tolist()
        child = child[order].tolist()
        above = [0] * nodes
        leaves, branching = [], []
        stack, low = [0], 0
        while stack:
            v = stack.pop()
            if v < 0:  # not its parent's first child: the tour came back to the parent
                v = ~v
                low = above[v]
            first, end = begin[v], begin[v + 1]
            if first == end:
                leaves.append(left[v] - above[v])
                branching.append(low)
                continue
            depth = above[v] + right[v] - left[v]
            for k in range(end - 1, first, -1):
                c = child[k]
                above[c] = depth
                stack.append(~c)
            c = child[first]
            above[c] = depth
            stack.append(c)
        self.rank = np.empty(n, np.int64)
        self.rank[leaves] = np.arange(n)
        self.table = [np.array(branching, np.int32)]
        width = 1
        while 2 * width <= n:
            row = self.table[-1]
            self.table.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at different positions."""
        a, b = self.rank[first], self.rank[second]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            found[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return found


def next_ranks(rank: list[int]) -> tuple[list[int], list[int]]:
    """For each position the next one of smaller and the next one of greater rank, -1 if none: the
    ends of the longest Lyndon words that start there, for an order and for its reverse."""
    smaller, greater = [-1] * len(rank), [-1] * len(rank)
    below, over = [], []
    for i, r in enumerate(rank):
        while below and rank[below[-1]] > r:
            smaller[below.pop()] = i
        while over and rank[over[-1]] < r:
            greater[over.pop()] = i
        below.append(i)
        over.append(i)
    return smaller, greater


def runs_within(words: list, least: int, exponent: int) -> list[Run]:
    """All runs of a word list, by its two suffix trees."""
    n = len(words)
    number: dict = {}
    codes = [number.setdefault(word, len(number) + 1) for word in words]
    sigma = len(number) + 1
    ahead = Extensions(codes, sigma)
    smaller, greater = next_ranks(ahead.rank.tolist())
    start = np.concatenate([np.arange(n), np.arange(n)])
    follow = np.array(smaller[:n] + greater[:n], np.int64)
    period = follow - start
    fits = (follow > 0) & (exponent * period <= n)
    start, follow, period = start[fits], follow[fits], period[fits]
    end = follow + ahead(start, follow)
    # The first Lyndon root of a run starts within its first period.
    shortest = np.maximum(least, exponent * period)
    fits = end - follow > shortest - 2 * period
    start, follow, period, end = start[fits], follow[fits], period[fits], end[fits]
    if not len(start):
        return []
    del ahead
    behind = Extensions(codes[::-1], sigma)
    inner = start > 0
    before = np.zeros(len(start), np.int64)
    before[inner] = behind(n - start[inner], n - follow[inner])
    length = end - start + before
    fits = length >= np.maximum(least, exponent * period)
    found = zip((start - before)[fits].tolist(), length[fits].tolist(), period[fits].tolist())
    return sorted(set(found), key=lambda run: (run[0], run[2]))


def stretches(words: list, least: int, exponent: int) -> list[tuple[int, int]]:
    """Parts (from, to) of a word list that can hold a run; each run lies wholly in one."""
    window = least // exponent
    n = len(words) - window + 1
    if len(words) < least:
        return []
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    multiplier = np.uint64(_MULTIPLIER)
    windows = hashed[:n].copy()
    for k in range(1, window):
        windows *= multiplier
        windows += hashed[k : k + n]
    order = np.argsort(windows, kind="stable")
    equal = np.flatnonzero(windows[order[1:]] == windows[order[:-1]])
    if not len(equal):
        return []
    again = np.full(n, len(words), np.int64)  # distance to the nearest equal window
    gap = order[equal + 1] - order[equal]
    again[order[equal]] = gap
    again[order[equal + 1]] = np.minimum(again[order[equal + 1]], gap)
    found, open_parts = [], [(0, n)]
    for turn in range(_ROUNDS):
        narrower = []
        for a, b in open_parts:
            words_there = b - a + window - 1
            inside = again[a:b] <= words_there // exponent
            edges = np.flatnonzero(np.diff(inside, prepend=False, append=False)) + a
            parts = [
                (x, y)
                for x, y in zip(edges[::2].tolist(), edges[1::2].tolist())
                if y - x + window - 1 >= least
            ]
            if parts == [(a, b)] or turn == _ROUNDS - 1:
                found += parts
            else:
                narrower += parts
        open_parts = narrower
    return sorted((a, b + window - 1) for a, b in found)


def runs_of(words: list, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[Run]:
    """(start, length, period) of all runs of a word list, by start, then period."""
    found = []
    for a, b in stretches(words, least, exponent):
        inner = runs_within(words[a:b], least, exponent)
        found += [(a + start, length, period) for start, length, period in inner]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed_words(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    least: int = LEAST_WORDS,
    exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """All columns of `docs`, `runs` and `collapsed`.

    Words are what lies between the bytes 0x20 and 0x09 to 0x0D, numbered from 0. A run is a stretch of
    words with a smallest period q (words q apart are equal) of at least `least` words and `exponent`
    (3 or more) times q that no neighbouring word extends; `runs` has start, length and period of each, by
    start, then period. `collapsed` is the text without what runs hold after their first period, its words
    joined by one blank.

    A null or empty text, or one of blanks only, has no runs and an empty `collapsed`. Rows that repeat
    are searched each. Columns `runs` and `collapsed` that `docs` already has are replaced; other columns
    are left alone whatever their names. An empty table gives an empty table.

    Rows never move. A text is searched whole in one task, in memory that grows with its length: some 70
    bytes a word, and some 600 a word of its stretches that nearly repeat.
    """
    if exponent < 3 or least < exponent:
        raise ValueError("exponent has to be 3 or more, and least no less than exponent")
    names = [name for name in docs.columns if name not in ("runs", "collapsed")]
    sent = docs.select(
        F.struct(F.lit(0).alias(""), *(F.col(_quoted(name)) for name in names)).alias("row"),
        F.col(_quoted(text)).cast("binary").alias("text"),
    )
    schema = StructType(
        [
            sent.schema["row"],
            *StructType.fromDDL(f"runs {RUN_TYPE}").fields,
            StructField("collapsed", BinaryType()),
        ]
    )
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def search(batches: Iterator) -> Iterator:
        for batch in batches:
            found, left = [], []
            for value in batch.column(1):
                words = (value.as_py() or b"").split()
                runs = runs_of(words, least, exponent)
                found.append([dict(zip(("start", "length", "period"), run)) for run in runs])
                left.append(b" ".join(collapsed_words(words, runs)))
            columns = [batch.column(0), pa.array(found, run_type), pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    made = sent.mapInArrow(search, schema)
    return made.select(
        *(F.col("row").getField(name).alias(name) for name in names),
        "runs",
        F.col("collapsed").cast("string").alias("collapsed"),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
