"""Chat formatting of reply trees.

Messages refer to the message they answer. Self-joins that double their reach first give every message the
sum of scores from the root down to it, so that branches are ranked by one row each; then they enumerate
the paths of the chosen leaves only, and each is written as one conversation with the spans that a loss
would cover. DataFrame functions only.

The template is `<turn role="ROLE">TEXT</turn>` and a line break per turn. In roles and texts a
backslash becomes `\\b`, `<` becomes `\\l` and `"` (in roles) becomes `\\q`, so that no text can look
like a mark, and everything can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.sources.tables import staged

LOSS_ROLE = "assistant"
_TURN = r'<turn role="([^"<]*)">([^<]*)</turn>\n'


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("\\q"), F.lit('"')), F.lit("\\l"), F.lit("<"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


def reply_chains(turns: DataFrame) -> DataFrame:
    """Messages of plain conversations (`conv_id, turn, role, text`): each answers the one before. Turns
    that tie are ordered by role and text; a null turn comes first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order).cast("long")
    numbered = turns.select("conv_id", "role", "text", place.alias("message_id"))
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return numbered.withColumns({"parent_id": parent, "score": F.lit(0.0)})


def _edges(messages: DataFrame) -> DataFrame:
    """`conv_id, node, up`: one row per message that answers another one of its conversation."""
    ids = messages.select("conv_id", F.col("message_id").alias("up"))
    answers = messages.filter("parent_id <> message_id").select(
        "conv_id", F.col("message_id").alias("node"), F.col("parent_id").alias("up")
    )
    return answers.join(ids, ["conv_id", "up"]).select("conv_id", "node", "up")


def _largest(messages: DataFrame) -> int:
    """Messages of the largest conversation; no path is longer."""
    return messages.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0


def branch_scores(messages: DataFrame, edges: DataFrame) -> DataFrame:
    """`conv_id, leaf, path_score` of every leaf that has a root: the sum of scores on its path.

    After round k a message knows the sum over 2 ** k messages upwards and the one above these. What runs
    into a circle of replies has no root and is left out.
    """
    state = staged(
        messages.select("conv_id", F.col("message_id").alias("node"), "score")
        .join(edges, ["conv_id", "node"], "left")
        .select("conv_id", "node", "up", F.col("score").alias("total")),
        "branch-sums",
    )
    # Sums that have come to their root rest; only the others are joined again.
    done, rising = state.filter("up IS NULL"), state.filter("up IS NOT NULL")
    reach, largest = 1, _largest(messages)
    while reach < largest and not rising.isEmpty():
        above = done.unionByName(rising).select(
            "conv_id", F.col("node").alias("up"), F.col("up").alias("top"), F.col("total").alias("more")
        )
        state = staged(
            rising.join(above, ["conv_id", "up"]).select(
                "conv_id", "node", F.col("top").alias("up"),
                (F.col("total") + F.col("more")).alias("total"),
            ),
            "branch-sums",
        )
        done = done.unionByName(state.filter("up IS NULL"))
        rising = state.filter("up IS NOT NULL")
        reach *= 2
    answered = edges.select("conv_id", F.col("up").alias("node")).distinct()
    rooted = done.join(answered, ["conv_id", "node"], "left_anti")
    return rooted.select("conv_id", F.col("node").alias("leaf"), F.col("total").alias("path_score"))


def root_to_leaf_paths(leaves: DataFrame, edges: DataFrame, largest: int) -> DataFrame:
    """`conv_id, leaf, node, distance` of every message on the path from each of `leaves` to its root.

    Round k joins the paths so far, which reach 2 ** k - 1 steps, with a table of 2 ** k steps up.
    """
    node, start = F.col("leaf").alias("node"), F.lit(0).cast("long").alias("distance")
    paths, ups = staged(leaves.select("conv_id", "leaf", node, start), "paths"), edges
    reach = 1
    while reach < largest:
        further = paths.join(ups, ["conv_id", "node"]).select(
            "conv_id", "leaf", F.col("up").alias("node"), (F.col("distance") + reach).alias("distance")
        )
        paths = staged(paths.unionByName(further), "paths")
        farther = ups.alias("one").join(
            ups.select("conv_id", F.col("node").alias("up"), F.col("up").alias("top")), ["conv_id", "up"]
        )
        ups = staged(farther.select("conv_id", "node", F.col("top").alias("up")), "ups")
        reach *= 2
        if ups.isEmpty():
            break
    return paths


def format_trees(
    messages: DataFrame, paths_per_tree: int | None = 1, loss_role: str = LOSS_ROLE
) -> DataFrame:
    """`conv_id, leaf, rank, path_score, formatted, loss_spans` of the best `paths_per_tree` paths of
    each conversation (all, if None).

    `messages` have `conv_id, message_id, parent_id, role, text, score`; other columns are ignored. A
    parent that is null, missing or the message itself makes a root. Null scores count as 0, null roles
    and texts as empty. Of rows that share conv_id and message_id the smallest counts; rows without
    either id are left out. Ties between paths go to the smaller leaf. `loss_spans` are (start, length)
    of the loss role's escaped texts in code points of `formatted`. An empty table gives an empty table.
    """
    known = messages.filter("conv_id IS NOT NULL AND message_id IS NOT NULL").select(
        "conv_id", "message_id", "parent_id",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    one = F.min(F.struct("parent_id", "role", "text", "score")).alias("m")
    known = staged(known.groupBy("conv_id", "message_id").agg(one).select("conv_id", "message_id", "m.*"), "messages")
    edges = staged(_edges(known), "replies")
    branches = branch_scores(known, edges)
    best = Window.partitionBy("conv_id").orderBy(F.desc("path_score"), "leaf")
    ranked = branches.withColumn("rank", F.row_number().over(best))
    if paths_per_tree is not None:
        ranked = ranked.filter(F.col("rank") <= paths_per_tree)
    ranked = staged(ranked, "ranked-branches")
    paths = root_to_leaf_paths(ranked.select("conv_id", "leaf"), edges, _largest(known))
    texts = known.select("conv_id", F.col("message_id").alias("node"), "role", "text")
    path = Window.partitionBy("conv_id", "leaf")
    role = F.replace(escaped(F.col("role")), F.lit('"'), F.lit("\\q"))
    head = F.concat(F.lit('<turn role="'), role, F.lit('">'))
    turns = ranked.join(paths, ["conv_id", "leaf"]).join(texts, ["conv_id", "node"])
    turns = turns.withColumns({"head": head, "body": escaped(F.col("text"))}).withColumn(
        "turn", F.concat("head", "body", F.lit("</turn>\n"))
    )
    earlier = path.orderBy(F.desc("distance")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(earlier), F.lit(0)) + F.length("head")
    span = F.when(
        F.col("role") == loss_role,
        F.struct(start.cast("long").alias("start"), F.length("body").cast("long").alias("length")),
    )
    placed = turns.withColumn("span", span)
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("distance")).alias("at"), "turn", "span")))
    made = placed.groupBy("conv_id", "leaf", "rank", "path_score").agg(ordered.alias("turns"))
    return made.select(
        "conv_id", "leaf", "rank", "path_score",
        F.array_join(F.col("turns")["turn"], "").alias("formatted"),
        F.filter(F.col("turns")["span"], lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parsed_turns(formatted: Column) -> Column:
    """Array of (role, text) that a formatted conversation holds."""
    roles, texts = (F.regexp_extract_all(formatted, F.lit(_TURN), i) for i in (1, 2))
    return F.zip_with(
        roles, texts, lambda r, t: F.struct(unescaped(r).alias("role"), unescaped(t).alias("text"))
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss spans, as it was before escaping."""
    parts = F.transform(
        spans, lambda s: unescaped(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))
    )
    return F.array_join(parts, "")
