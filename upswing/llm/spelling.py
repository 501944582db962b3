"""Spelling variants: words one inserted, deleted or replaced letter apart, grouped by frequency.

Each vocabulary word generates its one-letter edits as hashes, never as strings: a word's hash is a sum
over its letters, so an edit's hash follows from the word's in a few operations. Only edits that Bloom
filters over the vocabulary know are kept. The filters are sharded by word length, blocked (one 64-bit
block per word, so a probe reads one number) and broadcast, as many at a time as a fixed size allows. What
they let through is joined with the vocabulary by hash, and the words themselves settle it.

Being near is symmetric, so a pair is generated from one side only: from the longer word by deleting a
letter, or from the word with the smaller letter by replacing it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.hashing import mix
from upswing.sources.tables import staged

SHORTEST = 5
LEAST_COUNT = 3
LEAD = 2
BLOCKS_PER_WORD = 24 / 64
BITS = 4  # set per word
SEGMENT_BLOCKS = 1 << 16  # a piece of a filter that one task builds: 512 KB
BROADCAST_SEGMENTS = 96  # of filters that are broadcast at a time: 48 MB
LONGEST_SHARD = 48  # words of this length and more share a filter
HELD_WORDS = 200_000  # distinct words that a task adds up before it sends them on
CELLS = 30_000  # letters of words whose edits are made at a time: few enough for the processor's cache
SENT_ROWS = 100_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_RUN = re.compile("[a-zÀ-ÿ]+")


def word_counts(
    docs: DataFrame,
    document_id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    typo_divisor: int | None = None,
) -> DataFrame:
    """`word, n` over all texts: maximal runs of A-Z, a-z and U+00C0 to U+00FF, with only A-Z lower-cased,
    that have at least `shortest` code points.

    With `typo_divisor`, where it divides the crc32 of `<document id>:<run>`, the run loses its code point
    crc32 % length before it is counted: misspellings made on purpose. A null text has no words, a null id
    counts as an empty one, repeated rows count each, other columns are ignored.
    """
    sent = docs.select(
        F.coalesce(F.col(document_id).cast("string"), F.lit("")).cast("binary").alias("id"),
        F.col(text).cast("binary").alias("text"),
    )
    runs = re.compile(_RUN.pattern[:-1] + "{%d,}" % shortest)

    def table(counts: Counter) -> pa.RecordBatch:
        words, numbers = pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())
        return pa.RecordBatch.from_arrays([words, numbers], names=["word", "n"])

    def count(batches: Iterator) -> Iterator:
        total: Counter[str] = Counter()
        for batch in batches:
            for one_id, one_text in zip(batch.column(0), batch.column(1)):
                lowered = (one_text.as_py() or b"").lower()  # of bytes: A-Z only
                found = Counter(runs.findall(lowered.decode("utf-8", "replace")))
                if typo_divisor is None:
                    total.update(found)
                else:
                    start = zlib.crc32(one_id.as_py() + b":")
                    for run, times in found.items():
                        hashed = zlib.crc32(run.encode(), start)
                        if hashed % typo_divisor == 0:
                            at = hashed % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < shortest:
                                continue
                        total[run] += times
                if len(total) > HELD_WORDS:
                    yield table(total)
                    total.clear()
        yield table(total)

    parts = sent.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _letters(words: list[str], length: int) -> np.ndarray:
    joined = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32).reshape(len(words), length).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    out = np.ones(length, np.uint64)
    out[1:] = _BASE
    return np.multiply.accumulate(out)


def hashes(words: pd.Series) -> np.ndarray:
    """The sum of each letter's random number times a power of its place."""
    out = np.zeros(len(words), np.uint64)
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        powers = _powers(length)
        step = max(1, CELLS // length)
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            letters = _letters(words.iloc[some].tolist(), length)
            out[some] = (mix(letters) * powers).sum(axis=1, dtype=np.uint64)
    return out


def edits(words: list[str], alphabet: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For words of one length: what they become by one deletion, and by one replacement with a greater
    letter, as places (row times length plus the letter's place), hashes and length. No word gives the
    same edit twice."""
    length = len(words[0])
    codes = _letters(words, length)
    powers = _powers(length)
    terms = mix(codes) * powers
    whole = terms.sum(axis=1, dtype=np.uint64)
    if length > 1:
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        behind = whole[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
        ahead = whole[:, None] - behind - terms
        first = np.ones(codes.shape, bool)  # of equal letters in a row
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        yield np.flatnonzero(first), (ahead + behind * inverse)[first], length - 1
    rest = (whole[:, None] - terms).ravel()
    factors = np.tile(powers, len(words))
    flat = codes.astype(np.uint32).ravel()
    for letter in alphabet:
        places = np.flatnonzero(flat < letter)
        new = mix(np.array([letter], np.uint64))[0]
        yield places, rest[places] + new * factors[places], length


def _shard(length: int) -> int:
    return min(length, LONGEST_SHARD)


def _places(keys: np.ndarray, length: np.ndarray | int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key in a filter, and the number that its bits are taken from."""
    with np.errstate(over="ignore"):
        mixed = mix(keys + np.asarray(length).astype(np.uint64) * np.uint64(_BASE))
    block = ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return block.view(np.int64), mixed


def _bit(mixed: np.ndarray, k: int) -> np.ndarray:
    return (mixed >> np.uint64(6 * k)) & np.uint64(63)


def _known(words: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Where all bits are set in the blocks; most keys fail at the first one."""
    one = np.uint64(1)
    hits = np.flatnonzero((words >> _bit(mixed, 0)) & one)
    for k in range(1, BITS):
        hits = hits[(words[hits] >> _bit(mixed[hits], k)) & one != 0]
    return hits


def _filters(vocabulary: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The filters in segments (`shard, segment, blocks`), and the number of blocks by shard."""
    shard = F.least("length", F.lit(LONGEST_SHARD))
    counted = vocabulary.groupBy(shard.alias("shard")).count().collect()  # at most LONGEST_SHARD rows
    blocks = {row["shard"]: max(1, int(row["count"] * BLOCKS_PER_WORD)) for row in counted}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["length"].to_numpy()
            shards = np.minimum(lengths, LONGEST_SHARD)
            for one in np.unique(shards).tolist():
                at = shards == one
                keys = batch["key"].to_numpy()[at].view(np.uint64)
                block, mixed = _places(keys, lengths[at], blocks[one])
                bits = np.zeros(len(mixed), np.uint64)
                for k in range(BITS):
                    bits |= np.uint64(1) << _bit(mixed, k)
                yield pd.DataFrame(
                    {
                        "shard": one,
                        "segment": block // SEGMENT_BLOCKS,
                        "block": block % SEGMENT_BLOCKS,
                        "bits": bits.view(np.int64),
                    }
                )

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        one, segment = key
        size = min(SEGMENT_BLOCKS, blocks[one] - segment * SEGMENT_BLOCKS)
        filled = np.zeros(size, np.uint64)
        np.bitwise_or.at(filled, group["block"].to_numpy(), group["bits"].to_numpy().view(np.uint64))
        return pd.DataFrame({"shard": [one], "segment": [segment], "blocks": [filled.tobytes()]})

    placed = vocabulary.select("length", "key").mapInPandas(
        place, "shard int, segment long, block long, bits long"
    )
    merged = placed.groupBy("shard", "segment", "block").agg(F.bit_or("bits").alias("bits"))
    built = merged.groupBy("shard", "segment").applyInPandas(
        build, "shard int, segment long, blocks binary"
    )
    return staged(built, "spelling-filters"), blocks


def _passes(blocks: dict[int, int]) -> list[dict[int, tuple[int, int]]]:
    """Which segments (from, to) of which shards are broadcast together."""
    passes: list[dict[int, tuple[int, int]]] = []
    room = 0
    for shard in sorted(blocks):
        segments = -(-blocks[shard] // SEGMENT_BLOCKS)
        start = 0
        while start < segments:
            if not room:
                passes.append({})
                room = BROADCAST_SEGMENTS
            taken = min(room, segments - start)
            passes[-1][shard] = (start, start + taken)
            start += taken
            room -= taken
    return passes


def _positives(
    vocabulary: DataFrame,
    filters: DataFrame,
    blocks: dict[int, int],
    part: dict[int, tuple[int, int]],
    alphabet: list[int],
) -> DataFrame:
    """`key, length, from_key`: edits that the filters of one pass know, and the hash of their word."""
    wanted = F.lit(False)
    for shard, (start, stop) in part.items():
        wanted |= (F.col("shard") == shard) & F.col("segment").between(start, stop - 1)
    arrays: dict[int, np.ndarray] = {}
    known = {
        (row["shard"], row["segment"]): row["blocks"] for row in filters.filter(wanted).collect()
    }
    for shard, (start, stop) in part.items():
        stop_block = min(stop * SEGMENT_BLOCKS, blocks[shard])
        arrays[shard] = np.zeros(stop_block - start * SEGMENT_BLOCKS, np.uint64)
        for segment in range(start, stop):
            if (shard, segment) in known:
                values = np.frombuffer(known[shard, segment], np.uint64)
                at = (segment - start) * SEGMENT_BLOCKS
                arrays[shard][at : at + len(values)] = values
    shared = vocabulary.sparkSession.sparkContext.broadcast(arrays)

    def hits(words: list[str], keys: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Hash and length of the edits that the filters know, and their words' hashes."""
        length, filled = len(words[0]), shared.value
        for places, key, size in edits(words, alphabet):
            shard = _shard(size)
            if shard not in filled or not len(key):
                continue
            block, mixed = _places(key, size, blocks[shard])
            if len(filled[shard]) == blocks[shard]:
                hit = _known(filled[shard][block], mixed)
            else:  # a part of the filter
                block = block - part[shard][0] * SEGMENT_BLOCKS
                here = np.flatnonzero((block >= 0) & (block < len(filled[shard])))
                hit = here[_known(filled[shard][block[here]], mixed[here])]
            yield key[hit].view(np.int64), size, keys[places[hit] // length]

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple[str, int]]] = {}  # words and hashes by length, until they are many
        found: list[tuple[np.ndarray, int, np.ndarray]] = []

        def ask(length: int) -> None:
            words, keys = zip(*held.pop(length))
            found.extend(hits(list(words), np.array(keys, np.int64)))

        def table() -> pd.DataFrame:
            sizes = [np.full(len(key), size, np.int32) for key, size, _ in found]
            columns = {
                "key": np.concatenate([key for key, _, _ in found]),
                "length": np.concatenate(sizes),
                "from_key": np.concatenate([own for _, _, own in found]),
            }
            found.clear()
            return pd.DataFrame(columns)

        for batch in batches:
            for word, key in zip(batch["word"].tolist(), batch["key"].tolist()):
                length = len(word)
                if _shard(length) not in part and _shard(length - 1) not in part:
                    continue
                held.setdefault(length, []).append((word, key))
                if len(held[length]) * length >= CELLS:
                    ask(length)
            if sum(len(key) for key, _, _ in found) >= SENT_ROWS:
                yield table()
        for length in list(held):
            ask(length)
        if found:
            yield table()

    shards = [F.lit(shard) for shard in part]
    shard_of = lambda size: F.least(size, F.lit(LONGEST_SHARD)).isin(*shards)
    asked = vocabulary.filter(shard_of(F.col("length")) | shard_of(F.col("length") - 1))
    return asked.select("word", "key").mapInPandas(probe, "key long, length int, from_key long")


def vocabulary_of(counts: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """`word, n, length, key` of the words with at least `least` occurrences, written down."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["length"] = batch["word"].str.len().astype(np.int32)
            batch["key"] = hashes(batch["word"]).view(np.int64)
            yield batch

    often = counts.filter((F.col("n") >= least) & (F.col("word") != "")).select("word", "n")
    return staged(often.mapInPandas(keyed, "word string, n long, length int, key long"), "spelling")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """`word, n, other, other_n` for all pairs of near words, each in both directions."""
    spark = vocabulary.sparkSession
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).distinct()
    # As many rows as the vocabulary has different letters.
    alphabet = sorted(ord(row["letter"]) for row in letters.collect() if row["letter"])
    filters, blocks = _filters(vocabulary)
    found = [
        staged(_positives(vocabulary, filters, blocks, part, alphabet), "spelling-positives")
        for part in _passes(blocks)
    ]
    if not found:
        empty = "word string, n long, other string, other_n long"
        return spark.createDataFrame([], empty)
    positives = found[0]
    for more in found[1:]:
        positives = positives.unionByName(more)
    target = vocabulary.select("key", "length", F.col("word").alias("other"), F.col("n").alias("other_n"))
    origin = vocabulary.select(F.col("key").alias("from_key"), "word", "n")
    met = positives.join(target, ["key", "length"]).join(origin, "from_key")
    true = met.filter(F.levenshtein("word", "other", 1) == 1)
    pair = [F.struct("word", "n", "other", "other_n"),
            F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"),
                     F.col("word").alias("other"), F.col("n").alias("other_n"))]
    both = true.select(F.inline(F.array(*pair)))
    return both.dropDuplicates(["word", "other"])


def _roots(forms: DataFrame) -> DataFrame:
    """`word, root` out of `word, form`: the last word that forms lead to, by doubling. A form is more
    frequent than its word, so paths end, and as it is so at least `LEAD` times, they are short."""
    reached = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = reached.join(onward, "root", "left")
        step = joined.select(
            "word",
            F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved"),
        )
        doubled = staged(step, "spelling-roots")
        reached = doubled.drop("moved")
        if doubled.filter("moved").isEmpty():
            return reached


def spelling_groups(counts: DataFrame, least: int = LEAST_COUNT, lead: float = LEAD) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for each word with at least `least` occurrences.

    Words are near if one inserted, deleted or replaced code point makes one from the other. A word's form
    is its near word with the most occurrences (ties: the first in code point order) if it has at least
    `lead` (above 1) times as many as the word, else null; `root` is where forms lead to, the word itself
    if it has none; `n_near` is the number of near words, 0 if none.

    `counts` has one row per word (`word, n`); rows without a word or a number take no part, and other
    columns are ignored. An empty table gives an empty table.
    """
    if lead <= 1:
        raise ValueError("lead has to be above 1")
    vocabulary = vocabulary_of(counts, least)
    best = near_words(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("minus_n"), "other")).alias("best"),
    )
    found = vocabulary.select("word", "n").join(best, "word", "left")
    leads = -F.col("best.minus_n") >= F.lit(lead) * F.col("n")
    formed = staged(
        found.select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, F.col("best.other")).alias("form"),
            F.when(leads, -F.col("best.minus_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
