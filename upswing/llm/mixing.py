"""Mixing sources to target weights: Efraimidis-Spirakis sampling without replacement.

A source that is to give more than it holds first gives whole epochs. Of the rest it gives documents
in the order of exponential keys, k = -ln(u) divided by the document's weight, until the words taken
reach the budget; the document at the budget is cut there. u comes from a hash of the document's id and
text, so runs agree and the order does not depend on how rows are dealt. Keys are kept as k / (1 + k),
which has the same order and lies between 0 and 1.

The prefix sums need no sort of a whole source. Words are added up by source and leading digits of the
key; the digit in which the budget falls is looked at again by its next digits, until few keys are left.
Only those are ranked. So a source of any size is never in one task, and documents do not move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.sources.tables import staged

SHARE = 1.5
MOST_EPOCHS = 2.0
SOURCE_WEIGHTS = (3, 1, 2)
DIGIT_BITS = 12
MOST_DIGITS = 4
FEW_KEYS = 20_000  # keys of one source that are ranked in one task
WORD = r"[^\x20\x09-\x0D]+"
_ADDED = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(document_id: Column, digest: Column, seed: str) -> Column:
    """A number in (0, 1) out of an md5 sum: 52 bits, never 0 or 1. `digest` is the text's md5."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (document_id, digest)]
    sum_ = F.md5(F.concat_ws(":", F.lit(seed), *parts))
    return (F.conv(F.substring(sum_, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """`source, source_size, target` out of one row per source. The weights go to the sources in code
    point order, null last, over and over. A source that would pass `most` times its size stays there,
    and what it leaves goes to the others by weight until none is above.

    Sources that stop at their bound are those with the smallest bound per weight: with sources in that
    order, the first ones stop as long as the level that the others would reach lies above their bound.
    One row per source is ordered in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int"))
    bounded = sizes.withColumn("weight", weight).withColumn("bound", F.col("source_size") * most)
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    so_far = by_level.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * float(share)
    levels = bounded.withColumn(
        "level",
        (wanted - F.coalesce(F.sum("bound").over(so_far), F.lit(0.0)))
        / F.sum("weight").over(from_here),
    )
    stops = F.col("bound") <= F.col("level") * F.col("weight")
    # The level of the first source that does not stop holds for all after it.
    free = levels.withColumn("free_level", F.first(F.when(~stops, F.col("level")), ignorenulls=True)
                             .over(by_level.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.col("free_level") * F.col("weight"), F.col("bound"))
    return free.select("source", "source_size", F.least(target, "bound").alias("target"))


def _digits(count: int) -> Column:
    """The first `count` digits of a key as a whole number."""
    return F.floor(F.col("key") * float(1 << (DIGIT_BITS * count))).cast("long")


def _cuts(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Per source the key up to which documents are taken whole, and what is left for those that have
    exactly this key: `source, cut_key, cut_words, cut_size`; nothing for sources that need no key."""
    plans = plans.filter("rest > 0").select("source", "rest")
    open_rows = rows.select("source", "key", "size").filter("size > 0")
    here = plans.select("source", "rest", F.lit(0).cast("long").alias("cell"))
    for count in range(1, MOST_DIGITS + 1):
        inner = _within(open_rows, here, count - 1)
        by_digit = inner.groupBy("source", "rest", _digits(count).alias("cell")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("keys")
        )
        here = staged(_crossing(by_digit, "cell"), "mix-cells")
        most = here.agg(F.max("keys")).first()[0]
        if most is None or most <= FEW_KEYS:
            break
    last = _within(open_rows, here.drop("keys", "words"), count)
    by_key = last.groupBy("source", "rest", "key").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("keys")
    )
    return _crossing(by_key, "key").select(
        F.col("source").alias("cut_source"),
        F.col("key").alias("cut_key"),
        F.col("rest").alias("cut_words"),
        F.col("words").alias("cut_size"),
    )


def _within(rows: DataFrame, here: DataFrame, count: int) -> DataFrame:
    """Rows of the cells that the budgets fall into, with what is left of the budget there."""
    there = here.select(F.col("source").alias("cell_source"), "rest", "cell")
    same = F.col("source").eqNullSafe(F.col("cell_source"))
    if not count:
        return rows.join(there, same).drop("cell_source", "cell")
    dealt = rows.withColumn("own_cell", _digits(count))
    met = dealt.join(there, same & (F.col("own_cell") == F.col("cell")))
    return met.drop("cell_source", "cell", "own_cell")


def _crossing(sums: DataFrame, column: str) -> DataFrame:
    """Per source the row in which the running sum reaches `rest`, with what is left before it."""
    order = Window.partitionBy("source").orderBy(column)
    before = F.coalesce(
        F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    left = sums.withColumn("rest", F.col("rest") - before)
    return left.filter((F.col("rest") > 0) & (F.col("rest") <= F.col("words")))


def mix(
    docs: DataFrame,
    source: str = "source",
    document_id: str = "doc_id",
    text: str = "text",
    document_weights: DataFrame | None = None,
    keep: Sequence[str] | None = None,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """The columns `keep` of `docs` (all, if not given), and `size`, `source_size`, `target`, `taken`.

    `size` is the number of words of the text. All sources together are to give `share` times their
    words; `targets` says how much each gives. `taken` is how many words of the document are taken, repeats
    counted: whole epochs times its size, and for documents chosen beyond these their size once more.
    The taken words of a source add up to its target, rounded down. `document_weights` (`id, weight`, one
    row per id) raises the chance to be chosen early: documents that it lacks weigh 1, and null, zero,
    negative or NaN weights count as 1e-9. It is joined after texts have become sizes and checksums.

    A null or empty text has size 0 and takes nothing. A null source is a source of its own, a null id
    counts as an empty one. Rows equal in id and text have equal keys; where the budget falls among them,
    each gives an equal share of it, rounded down. Columns of `docs` with the added names are replaced;
    other names never clash. An empty table gives an empty table.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in _ADDED]
    measured = docs.select(
        F.struct(*names).alias("row"),
        F.col(source).alias("source"),
        F.col(document_id).alias("id"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.col(text)).alias("digest"),
    )
    weight = F.lit(1.0)
    if document_weights is not None:
        own = document_weights.select(
            F.col("id").alias("weighted_id"), F.col("weight"), F.lit(True).alias("weighted")
        )
        measured = measured.join(own, F.col("id") == F.col("weighted_id"), "left")
        given = F.greatest(F.coalesce(F.nanvl("weight", F.lit(0.0)), F.lit(0.0)), F.lit(1e-9))
        weight = F.when(F.col("weighted"), given).otherwise(weight)
    wait = -F.log(uniform(F.col("id"), F.col("digest"), seed)) / weight
    rows = staged(measured.select("row", "source", "size", (wait / (1 + wait)).alias("key")), "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    plans = staged(
        targets(sizes, weights, share, most)
        .withColumn("epochs", epochs.cast("long"))
        .withColumn(
            "rest", F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
        ),
        "mix-plans",
    )
    cuts = _cuts(rows, plans)
    known = plans.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    known = staged(known.drop("cut_source").withColumnRenamed("source", "plan_source"), "mix-plans")
    met = rows.join(known, F.col("source").eqNullSafe(F.col("plan_source")))
    # Rows with the cut's key are equal, so what is left goes to them in equal parts.
    at_cut = F.floor(F.col("cut_words") * F.col("size") / F.col("cut_size")).cast("long")
    chosen = (
        F.when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(F.col("key") == F.col("cut_key"), at_cut)
        .otherwise(F.lit(0))
    )
    taken = F.col("epochs") * F.col("size") + chosen
    return met.select(
        *(F.col("row").getField(name).alias(name) for name in names),
        "size", "source_size", "target", taken.alias("taken"),
    )


def repeated(mixed: DataFrame, text: str = "text") -> DataFrame:
    """One row per copy of a document that the mix takes, with `epoch` (from 0) and the text; the last
    copy holds the words it may still give, joined by blanks. Documents that give nothing have no row."""
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = mixed.filter("taken > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), copies - 1))
    )
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size")).cast("int")
    first = F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.lit(1), words)
    whole = words == F.col("size")
    return rows.withColumn(text, F.when(whole, F.col(text)).otherwise(F.array_join(first, " ")))
