"""Near-duplicate groups with SetSketch registers.

Each text's set of word shingles becomes `REGISTERS` registers: a register is the floor of the
logarithm (to a base near 1) of the smallest of exponentially spaced values, truncated to 16 bits.
Registers of a union are the maxima of its parts' registers, and two sets agree in a register about as
often as they overlap. Sets that agree in all registers of some band are candidates; the overlap of a
candidate pair is estimated from both register arrays by likelihood, and what may reach the threshold
is verified on the full sets.

Groups never become all their pairs: sets that are equal are one class; in a bucket all members are
compared with one hub, and after that only members of different components are compared any further,
within tasks of bounded size that give back nothing but links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswing.llm.components import connected_components
from upswing.llm.hashing import WHITE_SPACE, blocks, mix, shingles, words
from upswing.llm.hot import HOT_ROWS, join_by_key
from upswing.sources.tables import staged

SHINGLE_WORDS = 5
PERCENT = 80  # links need 100 * intersection >= PERCENT * union
# 50 bands of 6 independent registers miss a pair of similarity 0.8 with probability 3e-7.
REGISTERS, BANDS, BAND_REGISTERS = 307, 50, 6
LOG_BASE = float(np.log(1.001))
RATE = 20.0
# A pair at the threshold has an estimate within 0.15 of it but for 6 standard deviations.
ESTIMATE_MARGIN = 0.15
STAR_ROUNDS = 2
MEMBERS_PER_GROUP = 64
# A bucket with more than this share of all classes is hot; each class is in one bucket of every band,
# so there are at most BANDS / HOT_SHARE of them, however large the input is.
HOT_SHARE = 0.001
CELL_MEMBERS = 256
# Up to so many rows (of a few numbers each) are sent to where the texts are; beyond, texts are shuffled.
BROADCAST_ROWS = 200_000
SIGN_BYTES = 1 << 18  # a byte of text takes some forty while its set is made
TURN_CELLS = 1 << 16  # numbers that are drawn at a time
_BAND_BITS = 6  # the low bits of a bucket tell its band
_TOGETHER = (1 << _BAND_BITS) - 1  # no band has this number, which the bucket -1 tells
_SLACK = 6.0
_ELEMENT_BITS = 55  # with 512 texts in a block, 9 bits tell the text
_STEP = np.uint64(0xD1342543DE82EF95)
_SALTS = (_STEP, np.uint64(0xC2B2AE3D27D4EB4F))


def block_sets(
    data: np.ndarray, offsets: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Text number and element of every set of a block, sorted. A text with fewer words than `size`
    has its whole word sequence as its only element."""
    upper = (data >= 65) & (data <= 90)
    owner, hashes = words(np.where(upper, data + np.uint8(32), data), offsets, WHITE_SPACE)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    owners, elements = [], []
    for length in range(1, size + 1):
        if length < size and not (counts == length).any():
            continue
        at, made = shingles(owner, hashes, length)
        chosen = slice(None) if length == size else counts[owner[at]] == length
        owners.append(owner[at][chosen])
        elements.append(made[chosen])
    owner, element = np.concatenate(owners), np.concatenate(elements)
    bits = np.uint64(_ELEMENT_BITS)
    key = np.unique((owner.astype(np.uint64) << bits) | (element >> (np.uint64(64) - bits)))
    return (key >> bits).astype(np.int64), key & ((np.uint64(1) << bits) - np.uint64(1))


def _lower(
    minima: np.ndarray, owner: np.ndarray, element: np.ndarray, limit: np.ndarray
) -> None:
    """Let every element lower the registers of its set. Its values rise by exponential steps, and each
    goes to a register drawn anew, until one is beyond `limit`: a Poisson process that is dealt out at
    random, so that an element's first values in different registers are independent of each other."""
    value, turn = np.zeros(len(element)), 1
    while len(element):
        turns = max(1, min(64, TURN_CELLS // len(element)))
        salts = np.arange(turn, turn + turns, dtype=np.uint64) * _STEP
        drawn = mix(element[:, None] + salts[None, :])
        uniform = ((drawn >> np.uint64(24)) + 0.5) * 2.0**-40
        values = value[:, None] + np.cumsum(-np.log(uniform) / REGISTERS, axis=1)
        register = ((drawn & np.uint64(0xFFFFFF)) * np.uint64(REGISTERS)) >> np.uint64(24)
        within = values <= limit[:, None]
        place = owner[:, None] * REGISTERS + register.astype(np.int64)
        np.minimum.at(minima, place[within], values[within])
        value, turn = values[:, -1], turn + turns
        active = within[:, -1]
        if not active.all():
            owner, element, value, limit = owner[active], element[active], value[active], limit[active]


def sketch(owner: np.ndarray, element: np.ndarray, sets: int) -> np.ndarray:
    """Registers (uint16) of each of `sets` sets; an empty set has zeros.

    Values beyond a limit that all registers of a set stay below with probability 0.998 are left out
    at first; sets where that was wrong are done again with a higher one, so registers are exact.
    """
    count = np.bincount(owner, minlength=sets)
    minima = np.full(sets * REGISTERS, np.inf)
    limit = (np.log(REGISTERS) + _SLACK) / np.maximum(count, 1)
    again = np.ones(len(owner), bool)
    while again.any():
        _lower(minima, owner[again], element[again], limit[owner[again]])
        open_sets = np.isinf(minima.reshape(sets, REGISTERS)).any(axis=1)
        limit = np.where(open_sets, 2 * limit, limit)
        again = open_sets[owner]
    with np.errstate(divide="ignore"):
        exponent = np.floor(1.0 - np.log(minima / RATE) / LOG_BASE)
    return np.clip(exponent, 0, 65535).astype(np.uint16).reshape(sets, REGISTERS)


def _binary(rows: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(rows)
    size = raw.dtype.itemsize * raw.shape[1]
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(
        pa.binary(), len(raw), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())]
    )


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per document: a hash of its text, the number of shingles, two 64-bit sums that stand for the set,
    registers."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in blocks(batch.column(1), SIGN_BYTES):
                sets = len(offsets) - 1
                owner, element = block_sets(data, offsets, size)
                sums = []
                for salt in _SALTS:
                    total = np.zeros(sets, np.uint64)
                    np.add.at(total, owner, mix(element ^ salt))
                    sums.append(pa.array(total.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, sets),
                        batch.column(2).slice(first, sets),
                        pa.array(np.bincount(owner, minlength=sets).astype(np.int64)),
                        *sums,
                        _binary(sketch(owner, element, sets)),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "sum_1", "sum_2", "registers"],
                )

    schema = "doc_id long, text_key long, n_shingles long, sum_1 long, sum_2 long, registers binary"
    return docs.select("doc_id", "text", _text_key()).mapInArrow(sign, schema)


def _text_key() -> Column:
    return F.xxhash64("text").alias("text_key")


def _named(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """`rows` with the document that stands for their class `rep`: its id and a hash of its text, as an
    id may stand for several texts."""
    return rows.join(classes.select("rep", "doc_id", "text_key"), "rep")


def _texts(docs: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of a written table, named as above, with the `text` of their class."""
    keyed = docs.select("doc_id", "text", _text_key())
    return keyed.join(_sent(named), ["doc_id", "text_key"]).drop("doc_id", "text_key")


def _bands(sketches: DataFrame) -> DataFrame:
    """`bucket`, `rep` and the size of its set, one row per band of each class."""

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            used = _registers(batch.column(1))[:, : BANDS * BAND_REGISTERS].astype(np.uint64)
            used = used.reshape(-1, BANDS, BAND_REGISTERS)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), used.shape[:2])
            for i in range(BAND_REGISTERS):
                key = mix(key * _STEP + used[:, :, i])
            bits = np.uint64(_BAND_BITS)
            key = (key << bits) | np.arange(BANDS, dtype=np.uint64)
            own = (np.repeat(batch.column(i).to_numpy(), BANDS) for i in (0, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)), *map(pa.array, own)],
                names=["bucket", "rep", "n_shingles"],
            )

    return sketches.select("rep", "registers", "n_shingles").mapInArrow(
        band, "bucket long, rep long, n_shingles long"
    )


def estimate_overlap(
    one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray
) -> np.ndarray:
    """Jaccard similarity of pairs by maximum likelihood, given the exact set sizes: the numbers of
    registers that are larger, smaller and equal follow a trinomial law that depends on it."""
    larger = (one > other).sum(axis=1)[:, None]
    smaller = (one < other).sum(axis=1)[:, None]
    equal = REGISTERS - larger - smaller
    u = (n_one / (n_one + n_other))[:, None]
    v = 1.0 - u
    similarity = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    scale = -np.expm1(-LOG_BASE)

    def chance(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.maximum(x, 0.0) * scale) / LOG_BASE, 1e-12)

    first, second = chance(u - v * similarity), chance(v - u * similarity)
    rest = np.maximum(1.0 - first - second, 1e-12)
    likelihood = larger * np.log(first) + smaller * np.log(second) + equal * np.log(rest)
    return np.take_along_axis(similarity, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (`a`, `b`) whose estimate does not rule the threshold out."""
    floor = percent / 100 - ESTIMATE_MARGIN

    def side(name: str) -> DataFrame:
        return sketches.select(
            F.col("rep").alias(name), F.col("n_shingles").alias(f"n_{name}"),
            F.col("registers").alias(f"r_{name}"),
        )

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, n_a, n_b = (batch.column(c) for c in ("a", "b", "n_a", "n_b"))
            overlap = estimate_overlap(
                _registers(batch.column("r_a")), _registers(batch.column("r_b")),
                n_a.to_numpy().astype(float), n_b.to_numpy().astype(float),
            )
            kept = pa.array(overlap >= floor)
            yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], names=["a", "b"])

    joined = side("a").join(_sent(pairs), "a").join(side("b"), "b")
    return joined.mapInArrow(estimate, "a long, b long")


def _sent(rows: DataFrame) -> DataFrame:
    """Rows of a written table, to be broadcast if they are few; else joined however Spark sees fit."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _shingle_set(text: str, size: int) -> frozenset:
    found = text.encode().lower().split()
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[i:] for i in range(size))))


def _linked(one: frozenset, other: frozenset, percent: int) -> bool:
    common = len(one & other)
    return 100 * common >= percent * (len(one) + len(other) - common) > 0


def _verified(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int
) -> DataFrame:
    """The pairs that are links by their full sets. The text of `a` is sent once to each group of at
    most about `MEMBERS_PER_GROUP` of its partners, so a hub with many partners is spread."""
    crowd = pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn(
        "groups", F.ceil(F.col("n") / MEMBERS_PER_GROUP)
    )
    dealt = join_by_key(pairs, crowd, "a", "n", pairs.count()).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("part")
    )
    ends = dealt.select("a", "part", F.lit(0).alias("role"), F.col("a").alias("rep")).distinct()
    ends = ends.unionByName(
        dealt.select("a", "part", F.lit(1).alias("role"), F.col("b").alias("rep"))
    )
    named = staged(_named(ends, classes), "ends")
    sent = _texts(docs, named).repartition("a", "part")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, hub = None, frozenset()
        for batch in batches:
            found = []
            for a, part, role, rep, text in zip(
                batch["a"], batch["part"], batch["role"], batch["rep"], batch["text"]
            ):
                own = _shingle_set(text, size)
                if role == 0:
                    key, hub = (a, part), own
                elif key == (a, part) and _linked(hub, own, percent):
                    found.append((a, rep))
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    ordered = sent.sortWithinPartitions("a", "part", "role", "rep")
    return ordered.select("a", "part", "role", "rep", "text").mapInPandas(
        compare, "a long, b long"
    )


def _with_bucket(members: DataFrame, values: DataFrame) -> DataFrame:
    """`members` with what `values` has for their `bucket` and `hot`; members of other buckets go.

    The few hot buckets are sent to their members, which stay where they are, so that no bucket with a
    large part of all rows gets into one task; the others are joined by key."""
    key = ["bucket", "hot"]
    sent = members.filter("hot").join(F.broadcast(values.filter("hot")), key)
    return sent.unionByName(members.filter("NOT hot").join(values.filter("NOT hot"), key))


def _hub(turn: int) -> Column:
    order = F.struct(F.xxhash64(F.lit(turn), "rep").alias("order"), "rep", "n_shingles")
    return F.min(order).alias("hub")


def _similar_size(one: Column | str, other: Column | str, percent: int) -> Column:
    """Sets that overlap by `percent` differ in size by no more than that."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _meetings(members: DataFrame) -> DataFrame:
    """`main`, `bucket`, `rep`, `component` of everyone who meets others there, with the number of `columns`
    and `rows` of cells. `main` is the largest component of a bucket.

    A class may be in a bucket of every band with the same others. Buckets with the same largest component
    are taken together, as bucket -1 with each class once, if that makes no more pairs of an outsider
    and a member than the buckets do.
    """
    parts = members.groupBy("bucket", "hot", "component").agg(F.count("*").alias("n"))
    whole = staged(
        parts.groupBy("bucket", "hot")
        .agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"))
        .select(
            "bucket", "hot", F.col("main.component").alias("main"), "n",
            (F.col("n") - F.col("main.n")).alias("out"),
        ),
        "open-buckets",
    )
    placed = staged(
        _with_bucket(members.select("bucket", "hot", "rep", "component"), whole).drop("hot"), "placed"
    )
    once = staged(placed.select("main", "rep", "component").distinct(), "placed-once")
    pairs = F.col("n").cast("double") * F.col("out")
    apart = whole.groupBy("main").agg(F.sum(pairs).alias("pairs"))
    together = once.groupBy("main").agg(
        F.count("*").alias("n"), F.count_if(F.col("component") != F.col("main")).alias("out")
    )
    fewer = staged(
        together.join(apart, "main").filter(pairs <= F.col("pairs")), "together"
    )

    def cells(name: str) -> Column:
        return F.ceil(F.col(name) / CELL_MEMBERS).cast("int")

    kept = ["main", "bucket", "rep", "component", cells("n").alias("columns"), cells("out").alias("rows")]
    merged = join_by_key(
        once, fewer.select("main", "n", "out", F.col("n").alias("met")), "main", "met", once.count()
    )
    merged = merged.withColumn("bucket", F.lit(-1).cast("long")).select(*kept)
    return placed.join(fewer.select("main"), "main", "left_anti").select(*kept).unionByName(merged)


def _across(
    members: DataFrame, sketches: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links (`a`, `b`) between members of a bucket that are in different components.

    Every member outside the bucket's largest component (an outsider) meets every member. Both sides
    are dealt into cells of about `CELL_MEMBERS` each; a cell works on its pairs in memory and gives
    back verified links only. A pair is looked at in the first band in which it agrees, or where its
    buckets are taken together.
    """
    floor = percent / 100 - ESTIMATE_MARGIN
    dealt = _named(_meetings(members), classes).withColumn(
        "outsider", F.col("component") != F.col("main")
    )

    def own(name: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(name), "rep"), F.col(name)).cast("int")

    def every(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    shared = ["rep", "component", "outsider"]
    name = ["doc_id", "text_key"]
    cells = dealt.select(
        "main", "bucket", own("columns").alias("x"), every("rows").alias("y"), F.lit(False).alias("asks"), *shared, *name
    )
    asking = dealt.filter("outsider").select(
        "main", "bucket", every("columns").alias("x"), own("rows").alias("y"), F.lit(True).alias("asks"), *shared, *name
    )
    cells = staged(cells.unionByName(asking), "cells")
    key = ["main", "bucket", "x", "y", "asks", *shared]
    no_text, no_registers = F.lit(None).cast("string"), F.lit(None).cast("binary")
    sides = sketches.join(_sent(cells.drop(*name)), "rep").select(
        *key, "n_shingles", "registers", no_text.alias("text")
    )
    texts = _texts(docs, cells).select(
        *key, F.lit(0).cast("long").alias("n_shingles"), no_registers.alias("registers"), "text"
    )

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        band = int(cell["bucket"].iloc[0]) & ((1 << _BAND_BITS) - 1)
        text_of = dict(cell.loc[cell["registers"].isna(), ["rep", "text"]].itertuples(index=False))
        known = cell[cell["registers"].notna()].sort_values("rep")
        asks = known["asks"].to_numpy(bool)
        one, other = known[asks], known[~asks]
        if not len(one) or not len(other):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")

        def registers(rows: pd.DataFrame) -> np.ndarray:
            return np.frombuffer(b"".join(rows["registers"]), np.uint16).reshape(-1, REGISTERS)

        table, table_sizes = registers(other), other["n_shingles"].to_numpy(float)
        ids, components = other["rep"].to_numpy(), other["component"].to_numpy()
        outside = other["outsider"].to_numpy(bool)
        sets: dict[int, frozenset] = {}

        def set_of(rep: int) -> frozenset:
            if rep not in sets:
                sets[rep] = _shingle_set(text_of[rep], size)
            return sets[rep]

        found, joined = [], set()
        for rep, component, count, row in zip(
            one["rep"], one["component"], one["n_shingles"].to_numpy(float), registers(one)
        ):
            chosen = np.flatnonzero((components != component) & (~outside | (ids > rep)))
            agrees = (table[chosen, : BANDS * BAND_REGISTERS] == row[: BANDS * BAND_REGISTERS])
            agrees = agrees.reshape(len(chosen), BANDS, BAND_REGISTERS).all(axis=2)
            # A pair that agrees nowhere meets only where buckets are taken together.
            chosen = chosen[agrees.any(axis=1) if band == _TOGETHER else agrees.argmax(axis=1) == band]
            near = np.minimum(count, table_sizes[chosen]) * 100 >= percent * np.maximum(count, table_sizes[chosen])
            chosen = chosen[near]
            if not len(chosen):
                continue
            overlap = estimate_overlap(
                np.broadcast_to(row, (len(chosen), REGISTERS)), table[chosen],
                np.full(len(chosen), count), table_sizes[chosen],
            )
            for i in chosen[overlap >= floor][np.argsort(-overlap[overlap >= floor])]:
                pair = frozenset((component, components[i]))
                if pair not in joined and _linked(set_of(rep), set_of(ids[i]), percent):
                    joined.add(pair)
                    found.append((rep, ids[i]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return sides.unionByName(texts).groupBy("main", "bucket", "x", "y").applyInPandas(compare, "a long, b long")


def _links(
    members: DataFrame, sketches: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int
) -> DataFrame:
    """`id` and `component` of every class that is linked to another one.

    `members` are the rows of all buckets with more than one class. In each round a bucket's hub is
    compared with all others; then the hub leaves, and buckets whose other members are of one component
    are done. What is left after `STAR_ROUNDS` rounds is compared across components, so that no pair
    that shares a bucket goes unseen.
    """
    # Empty without createDataFrame, whose rows come from Python workers that stay beside the others.
    known = members.select(F.col("rep").alias("id"), F.col("rep").alias("component")).limit(0)
    kept = ["bucket", "hot", "rep", "n_shingles"]
    members = members.withColumn("component", F.col("rep"))

    def extended(new: DataFrame) -> DataFrame:
        new = staged(new, "verified")
        if new.isEmpty():
            return known
        old = known.select(F.col("id").alias("a"), F.col("component").alias("b"))
        return connected_components(old.unionByName(new))

    for turn in range(STAR_ROUNDS):
        hubs = members.groupBy("bucket", "hot").agg(_hub(turn))
        members = staged(_with_bucket(members.select(*kept), hubs), "members")
        met = members.filter(
            (F.col("rep") != F.col("hub.rep"))
            & _similar_size("n_shingles", "hub.n_shingles", percent)
        )
        pairs = staged(met.select(F.col("hub.rep").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
        likely = staged(_likely(pairs, sketches, percent), "likely")
        if not likely.isEmpty():
            known = extended(_verified(likely, docs, classes, size, percent))
        rest = members.filter("rep <> hub.rep").select(*kept)
        labelled = rest.join(known, rest["rep"] == known["id"], "left").select(
            *kept, F.coalesce("component", "rep").alias("component")
        )
        mixed = labelled.groupBy("bucket", "hot").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        members = staged(
            _with_bucket(labelled, mixed.filter("low < high").select("bucket", "hot")), "open"
        )
        if members.isEmpty():
            return known
    return extended(_across(members, sketches, docs, classes, size, percent))


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `docs` (`doc_id`, `text`, others are
    ignored). Words are runs of bytes that are not ASCII white space, with A-Z lower-cased.

    Documents are linked if their sets of word shingles overlap by `percent` or more; `component_id`
    is the smallest id reachable, `kept` tells whether it is the document's own. Null and empty texts
    have no shingles and no links. A text with fewer words has its word sequence as its only shingle.
    A null id has a null component and is kept. Rows that repeat an id are documents of their own: with the
    same set they share a component, with another text they are linked as that text is. Every row comes
    back. An empty table gives an empty table.
    """
    return _groups(docs, shingle_words, percent).drop("text_key")


def _groups(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    signed = staged(signatures(docs, shingle_words), "signatures")
    usable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "sum_1", "sum_2"]
    firsts = usable.groupBy(*same).agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.count("*").alias("n")
    )
    # A class is known by a number of its own, as an id may have several texts.
    classes = staged(
        firsts.select(*same, "first.*", "n", F.monotonically_increasing_id().alias("rep")), "classes"
    )
    sketches = staged(
        signed.join(classes.drop("n"), ["doc_id", "text_key", *same])
        .select("rep", "n_shingles", "registers").dropDuplicates(["rep"]), "sketches",
    )
    bands = _bands(sketches)
    hot = F.col("n") > HOT_SHARE * sketches.count()
    crowded = bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket", hot.alias("hot"))
    crowded = staged(crowded, "crowded")
    few = F.broadcast(crowded.filter("hot").select("bucket", F.lit(True).alias("known_hot")))
    flagged = bands.join(few, "bucket", "left").withColumn("hot", F.coalesce("known_hot", F.lit(False)))
    members = staged(_with_bucket(flagged.drop("known_hot"), crowded), "buckets")
    linked = _links(members, sketches, docs, classes, shingle_words, percent)
    of_class = staged(_first_ids(classes, linked).select(*same, "component_id", "n"), "component-ids")
    found = _of_sets(usable.select("doc_id", "text_key", *same), of_class, same)
    alone = signed.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id")
    )
    both = found.select("doc_id", "text_key", "n_shingles", "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _first_ids(classes: DataFrame, linked: DataFrame) -> DataFrame:
    """`classes` with `component_id`, the smallest id of a class of their component."""
    met = classes.join(linked, classes["rep"] == linked["id"], "left").drop("id")
    met = staged(met.withColumn("component", F.coalesce("component", "rep")), "components")
    several = met.groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("members")
    )
    return join_by_key(met, several, "component", "members", met.count())


def _of_sets(rows: DataFrame, of_class: DataFrame, same: list[str]) -> DataFrame:
    """Rows with the component of their set. Sets that a large part of all rows has are sent to them."""
    hot = F.col("n") > max(HOT_ROWS, HOT_SHARE * rows.count())
    few = of_class.filter(hot).drop("n")
    met = rows.join(F.broadcast(few), same, "left")
    rest = met.filter("component_id IS NULL").select(*rows.columns)
    return met.filter("component_id IS NOT NULL").unionByName(
        rest.join(of_class.filter(~hot).drop("n"), same)
    )


def without_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs` that are the first of their group, with their own columns."""
    groups = _groups(docs, shingle_words, percent)
    dropped = groups.filter(~F.col("kept")).select("doc_id", "text_key").distinct()
    dropped = dropped.withColumnsRenamed({"doc_id": "dropped_id", "text_key": "dropped_key"})
    same = (docs["doc_id"] == F.col("dropped_id")) & (
        F.xxhash64(docs["text"]) == F.col("dropped_key")
    )
    return docs.join(dropped, same, "left_anti")
