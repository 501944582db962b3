"""Uniform shuffle into shards of exact sizes, through a hypergeometric communication matrix.

Rows lie in blocks of bounded size (by a hash). For every block the number of rows that go to each
shard is drawn from the multivariate hypergeometric law that a uniform shuffle of all rows follows, by
halving the range of blocks again and again: how many rows of a shard come from the left half is one
draw. Rows are permuted within their block and cut by the drawn counts, sent to their shard, and
permuted again there. All of it is DataFrame functions; the only collected figure is the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.sources.tables import staged

SHARDS = 16
BLOCK_ROWS = 16_384
SEED = 20_240_131
LEVELS_AT_ONCE = 12
_WIDTH = 12  # a draw looks this many standard deviations around the mode


def _let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1, by Stirling's series at x + 8."""
    product = x
    for step in range(1, 8):
        product = product * (x + step)

    def series(z: Column) -> Column:
        inverse = F.lit(1.0) / z
        square = inverse * inverse
        tail = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
        return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + tail

    return series(x + 8.0) - F.log(product)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)


def hypergeometric(good: Column, bad: Column, drawn: Column, uniform: Column) -> Column:
    """How many of `drawn` rows, taken from `good` + `bad`, are good: inversion from the mode outwards.

    `uniform` in [0, 1) picks the value. Outcomes are visited in the order mode, mode + 1, mode - 1,
    mode + 2 ... until their probabilities add up to it.
    """
    good, bad, drawn = (c.cast("double") for c in (good, bad, drawn))

    def from_mode(mode: Column) -> Column:
        first = F.exp(
            _log_choose(good, mode) + _log_choose(bad, drawn - mode)
            - _log_choose(good + bad, drawn)
        )
        spread = F.sqrt(drawn * good * bad / F.greatest(good + bad, F.lit(1.0)) ** 2)
        steps = F.least(F.ceil(spread * _WIDTH).cast("int") + 40, drawn.cast("int") + 1)
        state = F.struct(
            (uniform - first).alias("left"), mode.alias("found"),
            mode.alias("up"), first.alias("p_up"), mode.alias("down"), first.alias("p_down"),
        )

        def step(s: Column, _: Column) -> Column:
            up, down = s["up"], s["down"]
            p_up = s["p_up"] * (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            p_down = s["p_down"] * down * (bad - drawn + down) / (
                (good - down + 1) * (drawn - down + 1)
            )
            p_up = F.when((up < good) & (up < drawn), p_up).otherwise(0.0)
            p_down = F.when((down > 0) & (drawn - down < bad), p_down).otherwise(0.0)
            moved = F.transform(
                F.array(F.struct(p_up.alias("u"), p_down.alias("d"))),
                lambda p: F.struct(
                    (s["left"] - p["u"] - p["d"]).alias("left"),
                    F.when((s["left"] < p["u"]) & (p["u"] > 0), up + 1)
                    .when((s["left"] < p["u"] + p["d"]) & (p["d"] > 0), down - 1)
                    .otherwise(s["found"])
                    .alias("found"),
                    (up + 1).alias("up"), p["u"].alias("p_up"),
                    (down - 1).alias("down"), p["d"].alias("p_down"),
                ),
            )[0]
            return F.when(s["left"] < 0, s).otherwise(moved)

        return F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), state, step)["found"]

    mode = F.floor((drawn + 1) * (good + 1) / (good + bad + 2)).cast("double")
    mode = F.least(F.greatest(mode, drawn - bad, F.lit(0.0)), good, drawn)
    drawn_good = _let(mode, from_mode)
    return F.when((good == 0) | (drawn == 0), 0.0).when(bad == 0, drawn).otherwise(
        drawn_good
    ).cast("long")


def _uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that depends on nothing but its parts."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / float(1 << 53)


def _left_share(capacities: Column, drawn: Column, node: Column, shards: int, seed: int) -> Column:
    """How many rows of every shard lie in the left half of a node's blocks: multivariate
    hypergeometric, one shard after the other."""
    start = F.struct(
        drawn.cast("long").alias("drawn"),
        F.aggregate(capacities, F.lit(0).cast("long"), lambda a, c: a + c).alias("pool"),
        F.array().cast("array<bigint>").alias("counts"),
    )

    def next_shard(s: Column, shard: Column) -> Column:
        own = F.get(capacities, shard)
        draw = hypergeometric(own, s["pool"] - own, s["drawn"], _uniform(seed, node, shard))
        return _let(
            draw,
            lambda d: F.struct(
                (s["drawn"] - d).alias("drawn"), (s["pool"] - own).alias("pool"),
                F.concat(s["counts"], F.array(d)).alias("counts"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, next_shard)["counts"]


def communication_matrix(sizes: DataFrame, levels: int, shards: int, seed: int) -> DataFrame:
    """Per block (2 ** `levels` of them, `block` and `n`): array `counts`, its rows for each shard.

    Row sums are the block sizes; column sums are the shard sizes, at most one apart. The tree of draws
    goes down `LEVELS_AT_ONCE` levels at a time from nodes that each hold the sizes below them; more
    levels start from the matrix of the larger blocks above them, so no row holds more than 2 **
    `LEVELS_AT_ONCE` sizes.
    """
    return _matrix(sizes, levels, shards, seed).select("block", "counts")


def _matrix(sizes: DataFrame, levels: int, shards: int, seed: int) -> DataFrame:
    spark = sizes.sparkSession
    here = min(levels, LEVELS_AT_ONCE)
    every = spark.range(1 << levels).withColumnRenamed("id", "block").join(sizes, "block", "left")
    filled = every.select("block", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    above = F.shiftright("block", here)
    within = F.sort_array(F.collect_list(F.struct("block", "n")))["n"]
    grouped = filled.groupBy(above.alias("above")).agg(within.alias("sizes"))
    if levels == here:
        total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
        even = F.transform(
            F.sequence(F.lit(0), F.lit(shards - 1)),
            lambda s: F.floor(total / shards) + F.when(s < total % shards, 1).otherwise(0),
        )
        nodes = grouped.select(F.lit(1).cast("long").alias("node"), "sizes", even.alias("counts"))
    else:
        sums = filled.groupBy(above.alias("block")).agg(F.sum("n").alias("n"))
        larger = staged(_matrix(sums, levels - here, shards, seed), "larger-blocks")
        nodes = grouped.join(larger, grouped["above"] == larger["block"]).select(
            (F.col("above") + (1 << (levels - here))).alias("node"), "sizes", "counts"
        )
    for level in range(here):
        half = 1 << (here - level - 1)
        left = F.slice("sizes", 1, half)
        drawn = F.aggregate(left, F.lit(0).cast("long"), lambda a, n: a + n)
        if level == 6 and levels == here:  # enough nodes for many tasks
            nodes = nodes.repartition(64, "node")
        nodes = nodes.withColumn(
            "left_counts", _left_share(F.col("counts"), drawn, F.col("node"), shards, seed)
        )
        rest = F.zip_with("counts", "left_counts", lambda a, b: a - b)
        nodes = nodes.select(
            F.inline(
                F.array(
                    F.struct(
                        (F.col("node") * 2).alias("node"), left.alias("sizes"),
                        F.col("left_counts").alias("counts"),
                    ),
                    F.struct(
                        (F.col("node") * 2 + 1).alias("node"),
                        F.slice("sizes", half + 1, half).alias("sizes"), rest.alias("counts"),
                    ),
                )
            )
        )
    return nodes.select((F.col("node") - (1 << levels)).alias("block"), "counts")


def uniform_shards(
    docs: DataFrame,
    id_columns: list[str],
    shards: int = SHARDS,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """All columns of `docs` with `shard` (0 to `shards` - 1) and `slot` (from 0 without gaps).

    Shard sizes differ by one at most. `id_columns` tell rows apart for the random order; rows that
    agree in all of them get neighbouring places in any order, and a block holds all of them. Nulls in
    any column are values like others. Columns named `shard` or `slot` are replaced, others are left alone
    whatever their names. An empty table gives an empty table.
    """
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.struct(*(F.col(_quoted(c)) for c in names)).alias("row"))
    total = rows.count()
    levels = max(0, (max(1, total // block_rows) * 2 - 1).bit_length() - 1)
    key = [F.col("row").getField(c) for c in id_columns]

    def order(name: str) -> list[Column]:
        return [F.xxhash64(F.lit(seed), F.lit(name), *key), *key]

    block = F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), *key), F.lit(1 << levels))
    rows = rows.withColumn("block", block)
    sizes = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    matrix = staged(communication_matrix(sizes, levels, shards, seed), "communication")
    place = F.row_number().over(Window.partitionBy("block").orderBy(*order("within block")))
    bounds = F.aggregate(
        "counts", F.array(F.lit(0).cast("long")), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))
    )
    passed = matrix.select("block", bounds.alias("bounds"))
    dealt = rows.withColumn("place", place).join(passed, "block")
    shard = F.size(F.filter("bounds", lambda b: b < F.col("place"))) - 1
    # Within a shard rows fall into cells of about a block's size, and are ordered within the cell.
    cells = max(1, -(-total // (shards * block_rows)))
    cell = F.pmod(F.xxhash64(F.lit(seed), F.lit("cell"), *key), F.lit(cells))
    dealt = dealt.select("row", shard.cast("int").alias("shard"), cell.alias("cell"))
    within = F.row_number().over(
        Window.partitionBy("shard", "cell").orderBy(*order("within shard"))
    )
    if cells == 1:
        numbered = dealt.withColumn("slot", (within - 1).cast("long"))
    else:
        filled = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
        earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(
            Window.unboundedPreceding, -1
        )
        before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
        starts = staged(filled.select("shard", "cell", before), "cells")
        numbered = dealt.withColumn("within", within).join(starts, ["shard", "cell"])
        numbered = numbered.withColumn("slot", F.col("before") + F.col("within") - 1)
    own = [F.col("row").getField(c).alias(c) for c in names]
    return numbered.select(*own, "shard", "slot")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
