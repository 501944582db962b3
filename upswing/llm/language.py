"""Language identification: multinomial naive Bayes over hashed character n-grams.

The log-probability matrix (languages x buckets) has a fixed size and is broadcast; a task scores its
texts in numpy, block by block.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from upswing.llm.hashing import blocks, mix

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
TRAIN_ROWS = 20_000  # learnt from about so many labelled rows at most
SMOOTHING = 0.5
EVIDENCE = 60  # n-grams overlap, so a text counts as no more than so many independent ones
BLOCK_BYTES = 1 << 16  # a character takes some hundred bytes while its n-grams are scored
UNDETERMINED = "und"
MIN_SCORE = 0.5


@dataclass(frozen=True)
class Model:
    """`log_likelihood[l, b]` of bucket b in language l, and log priors."""

    languages: list[str]
    log_likelihood: np.ndarray
    log_prior: np.ndarray


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point whether it belongs to a word: letters, and the marks written on them."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


@lru_cache(maxsize=1)
def marks() -> np.ndarray:
    """For every code point whether it is a mark, which is no letter by itself."""
    return np.array([unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)])


def ngram_blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: first row, number of rows, text number and bucket of every n-gram, letters per text.

    Texts are lower-cased and every run of other characters counts as one space; n-grams of spaces
    alone are left out.
    """
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    table = letters()
    for first, data, offsets in blocks(lowered, BLOCK_BYTES):
        count = len(offsets) - 1
        text = data.tobytes()
        points = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = (data & 0xC0) != 0x80
        bounds = np.concatenate(([0], np.cumsum(starts)))[offsets]
        owner = np.repeat(np.arange(count), np.diff(bounds))
        letter = table[points]
        alphabetic = np.bincount(owner[letter & ~marks()[points]], minlength=count)
        kept = letter.copy()
        # The character before a letter, if it is of the same text, stands for the space.
        kept[:-1] |= letter[1:] & (owner[1:] == owner[:-1])
        points = np.where(letter, points, 32)[kept].astype(np.uint64)
        owner = owner[kept]
        owners, buckets = [], []
        for size in SIZES:
            runs = len(points) - size + 1
            if runs <= 0:
                continue
            code = np.full(runs, size, np.uint64)
            for step in range(size):
                code = (code << np.uint64(21)) | points[step : step + runs]
            same = owner[:runs] == owner[size - 1 :]
            if size == 1:
                same &= points != 32
            owners.append(owner[:runs][same])
            buckets.append((mix(code[same]) % np.uint64(BUCKETS)).astype(np.int64))
        empty = np.zeros(0, np.int64)
        yield (
            first, count, np.concatenate(owners) if owners else empty,
            np.concatenate(buckets) if buckets else empty, alphabetic,
        )


def training_counts(sample: DataFrame) -> DataFrame:
    """n-gram counts per language and bucket; pre-summed in each task, so little is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, part in batch.groupby("lang"):
                own = sums.setdefault(language, np.zeros(BUCKETS, np.int64))
                for _, _, _, buckets, _ in ngram_blocks(pa.array(part["text"], pa.string())):
                    own += np.bincount(buckets, minlength=BUCKETS)
        for language, own in sums.items():
            used = np.flatnonzero(own)
            yield pd.DataFrame({"lang": language, "bucket": used, "n": own[used]})

    counted = sample.mapInPandas(count, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS) -> Model:
    """Learn from `labelled` (doc_id, text, lang); rows without text or language are ignored.

    n-grams are counted in `max_rows` rows on average, an equal number of each language or all it has, by
    a hash of the id, so that a rare language is learnt, too. Priors are those of all rows. The model has
    languages x `BUCKETS` numbers, whatever the input.
    """
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    totals = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0))
    limit = 1 << 30
    shares = [
        min(limit, int(limit * share)) for share in _shares([totals[x] for x in languages], max_rows)
    ]
    share = F.element_at(
        F.map_from_arrays(*(F.array(*map(F.lit, x)) for x in (languages, shares))), F.col("lang")
    )
    chosen = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(limit)) < share
    counts = training_counts(usable.filter(chosen).select("text", "lang")).toPandas()
    number = {language: i for i, language in enumerate(languages)}
    sums = np.zeros((len(languages), BUCKETS))
    rows = counts["lang"].map(number).to_numpy(np.int64)
    sums[rows, counts["bucket"].to_numpy(np.int64)] = counts["n"].to_numpy()
    smooth = sums + SMOOTHING
    prior = np.array([totals[x] for x in languages], float)
    return Model(
        languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)), np.log(prior / prior.sum())
    )


def _shares(totals: list[int], most: int) -> list[float]:
    """The part of each language's rows that is taken, so that all have equal numbers, or all their rows
    where these are fewer, and together `most`."""
    left, open_languages = most, sorted(totals)
    while open_languages and open_languages[0] * len(open_languages) <= left:
        left -= open_languages.pop(0)
    level = left / len(open_languages) if open_languages else float("inf")
    return [min(1.0, level / total) for total in totals]


def posteriors(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Best language number (-1: none) and its probability for every text."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if not model.languages:
        return best, score
    for first, count, owner, buckets, alphabetic in ngram_blocks(texts):
        grams = np.bincount(owner, minlength=count)
        weight = np.minimum(grams, EVIDENCE) / np.maximum(grams, 1)
        logs = np.stack(
            [np.bincount(owner, weights=row[buckets], minlength=count) for row in model.log_likelihood],
            axis=1,
        )
        logs = logs * weight[:, None] + model.log_prior
        logs -= logs.max(axis=1, keepdims=True)
        odds = np.exp(logs)
        top = odds.argmax(axis=1)
        rows = slice(first, first + count)
        known = alphabetic > 0
        best[rows] = np.where(known, top, -1)
        score[rows] = np.where(known, odds[np.arange(count), top] / odds.sum(axis=1), 0.0)
    return best, score


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` with `lang_pred` and `score` (0 to 1), from nothing but the text.

    A null text, or one without letters (marks alone are none), gets `und` and 0. Columns of these names are replaced. A
    model that has seen no row predicts `und` throughout. An empty table gives an empty table.
    """
    rows = docs.drop("lang_pred", "score")
    shared, at = docs.sparkSession.sparkContext.broadcast(model), rows.columns.index(text)
    schema = StructType(
        [*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )

    def score(batches: Iterator) -> Iterator:
        own = shared.value
        names = np.array([*own.languages, UNDETERMINED], object)
        for batch in batches:
            best, probability = posteriors(own, batch.column(at))
            made = [pa.array(names[best], pa.string()), pa.array(probability, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return rows.mapInArrow(score, schema)


def known_language(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of `docs` whose language is recognised, with their own columns only."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, probability = posteriors(shared.value, batch.column(at))
            yield batch.filter(pa.array((best >= 0) & (probability >= min_score)))

    return docs.mapInArrow(keep, docs.schema)
