"""Exact top-k inner products by threshold aggregation without random access.

The collection is read in batches; in a batch every component has its list of candidates sorted by
value. A query reads all lists in step, each from the end that its own component favours. What it has
read of a candidate gives a lower and an upper bound of the score: components not read yet lie between
the list's end and its reading position. Reading stops when k lower bounds are not below the upper
bound of any other candidate; the scores of those that are left are then resolved. Queries of one batch
run together, so that a step is a few matrix products.

Queries go to the candidates: a bounded number of them is broadcast at a time, a task keeps the best k
of each over all candidates it reads, and only these are merged. Candidates never move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.sources.tables import staged

K = 5
SCALE = 256
CANDIDATES_PER_BATCH = 1024
QUERIES_PER_BATCH = 512
QUERIES_PER_PASS = 16_384  # broadcast together
DEPTHS = (0.5, 0.75, 0.9)  # share of every list that has been read when bounds are compared
_EXACT = float(1 << 53)
_LONG = 1 << 63
_FOUND = "query_id long, vec_id long, tier int, size string, score long"


def _usable(vector: Column) -> Column:
    # 256 times a component has to be a double, too.
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) != float("inf")))
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def _floor(x: Column) -> Column:
    """A double that is a whole number; from 2^53 on every double is one, and longs would end."""
    return F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x)


def quantised(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """`vec_id` and `codes` = floor(256 * x) for the vectors that take part."""
    vector = F.col(vector_column).cast("array<double>")
    return vectors.filter(F.col(id_column).isNotNull() & _usable(vector)).select(
        F.col(id_column).alias("vec_id"),
        F.transform(vector, lambda x: _floor(x * float(SCALE))).alias("codes"),
    )


def _padded(codes, width: int) -> np.ndarray:
    out = np.zeros((len(codes), width))
    for row, values in enumerate(codes):
        out[row, : len(values)] = values
    return out


class Lists:
    """The sorted lists of a batch of candidates."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        n = len(ids)
        order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(n)[:, None], axis=0)
        self.largest = np.abs(values).max(initial=0.0)

    def left(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
        """Which candidates (rows) may be among the `k` best of which queries (columns); never a query's
        own id. Where sums of products can be rounded, bounds are wider by what that can amount to."""
        n, width = self.values.shape
        own = self.ids[:, None] == query_ids[None, :]
        alive = ~own
        largest = self.largest * np.abs(queries).max(initial=0.0) * max(1, width)
        if n <= 4 * k or not largest < 1e300:
            return alive
        margin = 0.0 if largest < _EXACT else 8 * (width + 4) * 2.0**-53 * largest
        low, high = self.sorted[0], self.sorted[-1]
        positive, negative = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        for depth in DEPTHS:
            read = int(n * depth)
            if not 0 < read < n:
                continue
            from_top, from_bottom = self.rank >= n - read, self.rank < read
            next_top, next_bottom = self.sorted[n - read - 1], self.sorted[read]
            seen = (self.values * from_top) @ positive + (self.values * from_bottom) @ negative
            most = seen + (~from_top * next_top) @ positive + (~from_bottom * next_bottom) @ negative
            least = seen + (~from_top * low) @ positive + (~from_bottom * high) @ negative
            least[own] = -np.inf
            kth = np.partition(least, n - k, axis=0)[n - k]
            alive &= most + margin >= kth - margin
            if alive.sum() <= 2 * k * len(query_ids):
                break
        return alive

    def scores(self, candidate: np.ndarray, query: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Exact scores of pairs: longs, or Python's whole numbers where doubles would round."""
        largest = self.largest * np.abs(queries).max(initial=0.0)
        if largest * self.values.shape[1] < _EXACT:
            return np.einsum("ij,ij->i", self.values[candidate], queries[query]).astype(np.int64)
        whole = [list(map(int, row)) for row in self.values.tolist()]
        asked = [list(map(int, row)) for row in queries.tolist()]
        return np.array(
            [
                sum(a * b for a, b in zip(whole[c], asked[q]))
                for c, q in zip(candidate.tolist(), query.tolist())
            ],
            object,
        )


class Best:
    """The best `k` (score, id, row) of each query over the candidates seen so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows = k, [[] for _ in range(queries)]

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        order = np.argsort(query, kind="stable")
        bounds = np.flatnonzero(np.diff(query[order], prepend=-1, append=-1))
        for start, stop in zip(bounds[:-1], bounds[1:]):
            part = order[start:stop]
            rows = self.rows[query[part[0]]]
            rows += zip((-scores[part]).tolist(), ids[part].tolist())
            rows.sort()
            del rows[self.k :]


def _row(query_id: int, minus_score: int, vec_id: int) -> tuple:
    """A result row. A score that a long cannot hold is null; `tier` and `size` (hexadecimal, after its
    length, complemented below zero) order it among the others."""
    score = -minus_score
    if -_LONG <= score < _LONG:
        return query_id, vec_id, 0, "", score
    digits = f"{abs(score):x}"
    size = f"{len(digits):05d}" + digits
    if score > 0:
        return query_id, vec_id, 1, size, None
    turned = "".join(f"{15 - int(c, 16):x}" if c in "0123456789abcdef" else c for c in size)
    return query_id, vec_id, -1, turned, None


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the `k` candidates with the highest integer inner product of
    each query, its own id excluded; ties go to the smaller id, and fewer rows than `k` come back
    where there are fewer candidates.

    Ranks are by exact whole numbers of any size; a score beyond the range of a long comes back as null.
    Vectors that are null or hold null or non-finite components (also after the multiplication by 256),
    and rows without id, take no part. A vector that is shorter than another counts as zero beyond its
    end. Repeated rows compete each on their own; queries with equal ids share one ranking. Other columns
    are ignored. An empty table gives an empty table.
    """
    candidates = staged(quantised(vectors, id_column, vector_column), "candidates")
    asked = staged(quantised(queries, id_column, vector_column), "queries")
    passes = -(-asked.count() // QUERIES_PER_PASS)
    spark = vectors.sparkSession
    if not passes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    number = F.pmod(F.xxhash64(F.lit("pass"), "vec_id"), F.lit(passes))
    order = Window.partitionBy("query_id").orderBy(
        F.desc("tier"), F.desc("size"), F.desc("score"), "vec_id"
    )
    results = []
    for one in range(passes):
        found = _search(candidates, asked.filter(number == one), k)
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked = ranked.select("query_id", "rank", "vec_id", "score")
        results.append(ranked if passes == 1 else staged(ranked, "ranked"))
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def _search(candidates: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best `k` of each query in each task's candidates."""
    rows = asked.orderBy("vec_id", "codes").collect()  # QUERIES_PER_PASS on average
    width = max((len(r["codes"]) for r in rows), default=0)
    asked_ids = np.array([r["vec_id"] for r in rows], np.int64)
    asked_values = _padded([r["codes"] for r in rows], width)
    shared = candidates.sparkSession.sparkContext.broadcast((asked_ids, asked_values))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, values = shared.value
        best = Best(len(ids), k)
        for batch in batches:
            for first in range(0, len(batch), CANDIDATES_PER_BATCH):
                part = batch.iloc[first : first + CANDIDATES_PER_BATCH]
                wide = max(width, part["codes"].map(len).max())
                lists = Lists(part["vec_id"].to_numpy(), _padded(part["codes"], wide))
                for start in range(0, len(ids), QUERIES_PER_BATCH):
                    some = slice(start, start + QUERIES_PER_BATCH)
                    own = np.pad(values[some], ((0, 0), (0, wide - width)))
                    candidate, query = np.nonzero(lists.left(ids[some], own, k))
                    scores = lists.scores(candidate, query, own)
                    best.add(start + query, lists.ids[candidate], scores)
        made = [_row(int(q), *row) for q, rows in zip(ids, best.rows) for row in rows]
        table = pd.DataFrame(made, columns=["query_id", "vec_id", "tier", "size", "score"])
        yield table.astype({"score": "Int64"})

    return candidates.mapInPandas(search, _FOUND)
