"""Token counts by a two-tier lookup of pre-token lengths.

Tier one is a table of frequent pre-tokens with their numbers of tokens, broadcast once; tier two is
a bounded cache in each worker, filled by the tokenizer. Rows never move: there is no shuffle.

The table only saves work. It is learnt from a sample of about `SAMPLE_ROWS` rows of the whole table, and
any pre-token that it lacks is encoded by the library, so counts do not depend on it.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

SAMPLE_ROWS = 2000
TABLE_SIZE = 50_000
CACHE_SIZE = 200_000
LONGEST_CACHED = 64
# Fixed value: the pre-token pattern of byte-level BPE. `\s` is spelt out as Unicode's White_Space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+"
    % ((SPACE,) * 4)
)


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Tokenizer, regex.Pattern, regex.Pattern | None]:
    """Tokenizer, pattern of pre-tokens, and pattern of the strings that are tokens of their own."""
    with open(path, encoding="utf-8") as file:
        added = [entry["content"] for entry in json.load(file)["added_tokens"]]
    special = regex.compile("|".join(map(regex.escape, added))) if added else None
    return Tokenizer.from_file(path), regex.compile(PATTERN), special


def pieces(text: str, pattern: regex.Pattern, special: regex.Pattern | None) -> tuple[list, int]:
    """Pre-tokens of a text, and how many special strings stand in it."""
    if special is None or not special.search(text):
        return pattern.findall(text), 0
    parts = special.split(text)
    return [piece for part in parts for piece in pattern.findall(part)], len(parts) - 1


class _Lengths(dict):
    """Pre-token to number of tokens; what is missing is encoded, and kept while there is room."""

    def __init__(self, known: dict[str, int], tokenizer: Tokenizer):
        super().__init__(known)
        self.tokenizer, self.room = tokenizer, len(known) + CACHE_SIZE
        self.known = known

    def __missing__(self, piece: str) -> int:
        length = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= self.room:
                self.clear()
                self.update(self.known)
            self[piece] = length
        return length


def counter(path: str, known: dict[str, int]) -> Callable[[str | None], int]:
    tokenizer, pattern, special = load(path)
    lengths = _Lengths(known, tokenizer)

    def count(text: str | None) -> int:
        found, extra = pieces(text or "", pattern, special)
        return sum(map(lengths.__getitem__, found)) + extra

    return count


def frequent_lengths(
    docs: DataFrame, path: str, rows: int = SAMPLE_ROWS, size: int = TABLE_SIZE
) -> dict[str, int]:
    """The `size` most frequent pre-tokens of about `rows` rows of `text`, with their lengths.

    Rows are drawn by a hash of the text from the whole table, whatever its order. Tasks count their pre-
    tokens; only the table itself, `size` entries of at most `LONGEST_CACHED` characters, is collected.
    """
    texts = docs.select("text").dropna()
    share = min(1.0, rows / max(1, texts.count()))
    drawn = F.pmod(F.xxhash64(F.lit("pre-tokens"), "text"), F.lit(1 << 30)) < int(share * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, pattern, special = load(path)
        for batch in batches:
            seen: Counter[str] = Counter()
            for text in batch.column(0):
                found = pieces(text.as_py(), pattern, special)[0]
                seen.update(p for p in found if len(p) <= LONGEST_CACHED)
            columns = [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "n"])

    counted = texts.filter(drawn).mapInArrow(count, "piece string, n long")
    summed = counted.groupBy("piece").agg(F.sum("n").alias("n"))
    top = [r["piece"] for r in summed.orderBy(F.desc("n"), "piece").limit(size).collect()]
    encoded = load(path)[0].encode_batch(top, add_special_tokens=False)
    return {piece: len(one.ids) for piece, one in zip(top, encoded)}


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of `docs` and `n_tokens`: the tokens of the whole text, as the library gives them
    without added special tokens; special strings in a text count as one token each.

    A null or empty text has 0 tokens. Rows that repeat are counted each. A column `n_tokens` that
    `docs` already has is replaced. An empty table gives an empty table.
    """
    known = frequent_lengths(docs.select(F.col(text).alias("text")), path)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    rows = docs.drop("n_tokens")
    schema = StructType([*rows.schema.fields, StructField("n_tokens", LongType())])
    at = rows.columns.index(text)

    def count(batches: Iterator) -> Iterator:
        number = counter(path, shared.value)
        for batch in batches:
            lengths = pa.array([number(t.as_py()) for t in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, lengths], names=schema.names)

    return rows.mapInArrow(count, schema)
