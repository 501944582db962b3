"""Toxicity by compression distance: one zstandard dictionary per class, compared window by window.

Both dictionaries start with the same text, which zstandard's trainer picks from windows of both
classes, so that ordinary prose costs the same with either. To it each adds the segments (words and word
beginnings) that documents of its class hold far more often than those of the other with a like
vocabulary, so that a language's few toxic documents count against its own. The shorter of the two lists
is filled up to the same length, so that offsets agree. A window's gain is its compressed length with
the ordinary dictionary less that with the toxic one. How large the gains of a document have to be is
calibrated on labelled documents that the dictionaries have not seen.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

TRAIN_PER_CLASS = 2000  # learnt from about so many labelled documents of a class at most
WINDOW, STRIDE = 96, 48  # bytes
SHARED_BYTES = 4000
SEGMENT_BYTES = 1500  # for each vocabulary
VOCABULARIES, WORD_BUCKETS = 16, 512
SEGMENT_LENGTHS = (4, 5, 6, 7, 8)
MIN_DOCS, MIN_DEVIATIONS = 4, 6.0
SAME_SHARE = 0.8  # a longer segment in so many of a shorter one's documents replaces it
CALIBRATION_SHARE = 3  # every third document calibrates
_WORD = re.compile(rb"[^\s.,;:!?|\"()]+")


@dataclass(frozen=True)
class Model:
    """Dictionaries, and the weights of the calibrated features."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def windows(text: str | None) -> list[bytes]:
    """The whole text in overlapping windows; an empty text is one empty window."""
    data = (text or "").lower().encode()
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - WINDOW + STRIDE), STRIDE)]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=4, min_match=5, target_length=16,
        strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=settings)


def features(text: str | None, ordinary, toxic) -> list[float]:
    """What the gains of a text's windows look like: the largest, their mean, how many are large."""
    gains = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)], float)
    top = np.sort(np.concatenate((gains, np.zeros(3))))[::-1]
    size = np.log(len(gains))
    return [
        1.0, top[0], top[1], top[2], gains.mean(), np.maximum(gains - 2, 0).mean(),
        np.maximum(gains - 4, 0).mean(), size, top[0] * size,
        (gains >= 3).mean(), (gains >= 5).mean(), (gains >= 7).mean(), (gains <= -3).mean(),
    ]


def _segments(text: str) -> set[bytes]:
    found = {w for w in _WORD.findall(text.lower().encode()) if len(w) >= SEGMENT_LENGTHS[0]}
    return {w[:n] for w in found for n in (*SEGMENT_LENGTHS, len(w))}


def _vocabularies(texts: list[str], basis: list[str]) -> np.ndarray:
    """For each text the number of the vocabulary it is nearest to; those are clusters of `basis`."""

    def vectors(rows: list[str]) -> np.ndarray:
        out = np.zeros((len(rows), WORD_BUCKETS), np.float32)
        for row, text in zip(out, rows):
            for word, n in Counter(_WORD.findall(text.lower().encode())).items():
                row[zlib.crc32(word) % WORD_BUCKETS] += n
        out = np.sqrt(out)
        return out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-9)

    x = vectors(basis)
    centres = x.mean(axis=0, keepdims=True)
    while len(centres) < min(VOCABULARIES, len(x)):  # the text that is least like any centre is the next
        centres = np.vstack((centres, x[(x @ centres.T).max(axis=1).argmin()]))
    for _ in range(10):
        nearest = (x @ centres.T).argmax(axis=1)
        for k in np.unique(nearest):
            mean = x[nearest == k].mean(axis=0)
            centres[k] = mean / (np.linalg.norm(mean) + 1e-9)
    return (vectors(texts) @ centres.T).argmax(axis=1)


def _distinctive(
    own: list[str], others: list[str], own_kinds: np.ndarray, other_kinds: np.ndarray
) -> list[bytes]:
    """Segments that documents of `own` hold more often than `others` of the same vocabulary do, by
    `MIN_DEVIATIONS` standard deviations; the best last, where a dictionary's content is cheapest to
    refer to. No bar depends on the share of a vocabulary in its class, and each has `SEGMENT_BYTES`."""
    mine, theirs = defaultdict(Counter), defaultdict(Counter)
    for texts, kinds, counts in ((own, own_kinds, mine), (others, other_kinds, theirs)):
        for text, kind in zip(texts, kinds.tolist()):
            for segment in _segments(text):
                counts[segment][kind] += 1
    sizes, other_sizes = Counter(own_kinds.tolist()), Counter(other_kinds.tolist())
    total = {s: sum(counts.values()) for s, counts in mine.items()}
    surplus = {}
    for segment, counts in mine.items():
        if total[segment] < MIN_DOCS:
            continue
        elsewhere = theirs.get(segment, Counter())
        expected = variance = 0.0
        for kind in counts.keys() | elsewhere.keys():
            a, b, n = sizes[kind], other_sizes[kind], counts[kind] + elsewhere[kind]
            expected += n * a / (a + b)
            variance += n * a * b * (a + b - n) / ((a + b) ** 2 * max(1, a + b - 1))
        surplus[segment] = (total[segment] - expected) / np.sqrt(variance + 0.05)
    kept: set[bytes] = set()
    for segment in sorted((s for s, z in surplus.items() if z >= MIN_DEVIATIONS), key=lambda s: (len(s), s)):
        shorter = [segment[:n] for n in range(len(segment)) if segment[:n] in kept]
        if all(total[segment] >= SAME_SHARE * total[s] for s in shorter):
            kept.difference_update(shorter)  # the longer one stands for its beginnings
            kept.add(segment)
    chosen, used = [], Counter()
    for segment in sorted(kept, key=lambda s: (-surplus[s], s)):
        kind = max(mine[segment], key=lambda k: (mine[segment][k], -k))
        if used[kind] + len(segment) + 1 <= SEGMENT_BYTES:
            used[kind] += len(segment) + 1
            chosen.append(segment)
    return chosen[::-1]


def _dictionaries(ordinary: list[str], toxic: list[str]) -> tuple[bytes, bytes]:
    samples = [w for text in ordinary + toxic for w in windows(text)]
    try:
        shared = zstandard.train_dictionary(SHARED_BYTES, samples, k=48, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        shared = b" ".join(samples)
    plain, hot = _vocabularies(ordinary, ordinary), _vocabularies(toxic, ordinary)
    own = [
        b" " + b" ".join(_distinctive(*sides)) + b" "
        for sides in ((ordinary, toxic, plain, hot), (toxic, ordinary, hot, plain))
    ]
    longest = max(map(len, own))
    # Bytes that UTF-8 text never has, so that they match nothing.
    filler = bytes(0xF8 + i * i % 7 for i in range(longest + 8))
    shared = shared[-SHARED_BYTES:] + filler[:8]
    return tuple(shared + filler[: longest - len(o)] + o for o in own)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        weights = weights + np.linalg.solve(hessian, x.T @ (y - p) - penalty * weights)
    return weights


def fit(rows: list[tuple[str, int]], odds: float | None = None) -> Model:
    """A model from (text, toxic 0 or 1); `odds` of toxic to ordinary where the rows are to be scored,
    if not as in `rows`. With no row of one class it scores every text alike, by the odds in `rows`."""
    fitting = [r for i, r in enumerate(rows) if i % CALIBRATION_SHARE]
    ordinary, toxic = ([t for t, label in fitting if label == k] for k in (0, 1))
    zeros = np.zeros(13)
    zeros[0] = np.log((sum(l for _, l in rows) + 0.5) / (sum(1 - l for _, l in rows) + 0.5))
    if not ordinary or not toxic:
        return Model(b" " * 8, b" " * 8, np.zeros(13), np.ones(13), zeros)
    first, second = _dictionaries(ordinary, toxic)
    pair = compressor(first), compressor(second)
    calibrating = rows[::CALIBRATION_SHARE]
    x = np.array([features(t, *pair) for t, _ in calibrating])
    y = np.array([label for _, label in calibrating], float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    mean[0], scale[0] = 0.0, 1.0
    weights = _logistic((x - mean) / scale, y)
    if odds:
        weights[0] += np.log(odds) - np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    return Model(first, second, mean, scale, weights)


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> Model:
    """Learn from the rows of `labels` (`doc_id`, `toxic`) with a text in `docs`.

    Of more than `per_class` documents of a class an even share by a hash of the id is taken; only that
    bounded sample is sent, first its ids to the texts, then its texts to the driver.
    """
    usable = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").distinct()
    totals = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    order = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for label, total in totals.items():
        share = int(min(1.0, per_class / total) * (1 << 30))
        chosen = chosen | ((F.col("toxic") == label) & (order < share))
    sample = docs.select("doc_id", "text").join(F.broadcast(usable.filter(chosen)), "doc_id")
    rows = sample.dropna().dropDuplicates(["doc_id", "text", "toxic"]).collect()
    rows.sort(key=lambda r: (hash_order(r["doc_id"]), r["text"], r["toxic"]))
    both = totals.get(0) and totals.get(1)
    return fit([(r["text"], int(r["toxic"])) for r in rows], totals[1] / totals[0] if both else None)


def hash_order(number: int) -> int:
    return number * 0x9E3779B97F4A7C15 % (1 << 64)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` with `toxicity` (0 to 1, higher: likelier toxic), from the whole text alone.

    Null and empty texts are scored as one empty window. A column of that name is replaced. An empty
    table gives an empty table.
    """
    rows = docs.drop("toxicity")
    shared, at = docs.sparkSession.sparkContext.broadcast(model), rows.columns.index(text)
    schema = StructType([*rows.schema.fields, StructField("toxicity", DoubleType())])

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        pair = compressor(own.ordinary), compressor(own.toxic)
        for batch in batches:
            x = np.array([features(t.as_py(), *pair) for t in batch.column(at)]).reshape(-1, len(own.mean))
            odds = np.clip((x - own.mean) / own.scale @ own.weights, -30, 30)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-odds)))], names=schema.names)

    return rows.mapInArrow(estimate, schema)
