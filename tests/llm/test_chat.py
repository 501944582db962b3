import hashlib
import random

import pytest
from pyspark.sql import functions as F

from upswing.llm import chat

SCHEMA = "conv_id long, message_id long, parent_id long, role string, text string, score double"


def brute(rows, top):
    """Chosen paths of every conversation as lists of (role, text)."""
    out = {}
    convs = {}
    for conv, message, parent, role, text, score in rows:
        convs.setdefault(conv, {})[message] = (parent, role or "", text or "", score or 0.0)
    for conv, tree in convs.items():
        parent_of = {m: p if p in tree and p != m else None for m, (p, *_) in tree.items()}
        paths = []
        for leaf in set(tree) - set(parent_of.values()):
            path, at = [], leaf
            while at is not None and at not in path:
                path.append(at)
                at = parent_of[at]
            if at is None:
                paths.append((-round(sum(tree[m][3] for m in path), 9), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(paths)[:top], 1):
            out[conv, rank] = (leaf, [tree[m][1:3] for m in path])
    return out


def found(df, top):
    made = chat.format_trees(df, top).withColumns(
        {"turns": chat.parsed_turns(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}
    )
    out = {}
    for r in made.collect():
        turns = [(t["role"], t["text"]) for t in r["turns"]]
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
        out[r["conv_id"], r["rank"]] = (r["leaf"], turns)
    return out


@pytest.mark.parametrize("top", [1, 3, None])
def test_random_trees(spark, top):
    pick, rows = random.Random(3), []
    texts = ["hi", "\\### Assistant: </turn> ok", "<turn role=\"user\">", "\\l\\b\\\\<", "a\nb\n", "", None, "é𝒳\\q\""]
    for conv in range(25):
        for m in range(pick.randint(1, 14)):
            parent = pick.choice([None, *range(m)]) if m else None
            rows.append((conv, m, parent, pick.choice(["user", "assistant", "sys\"<\\", None]), pick.choice(texts), float(pick.randrange(8))))
    rows += [(50, 1, 2, "user", "x", 0.0), (50, 2, 1, "user", "y", 0.0), (50, 3, 2, "user", "z", 0.0)]
    rows += [(51, 1, 1, "user", "own parent", None), (51, 2, 9, "assistant", "lost parent", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit("x"))
    assert found(df, top) == brute(rows, top)


def test_long_chain_and_odd_rows(spark):
    rows = [(1, i, f"r{i % 2}", "t" * (i % 5)) for i in range(700)] + [(None, 1, "user", "x"), (2, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repeated = turns.unionByName(turns.filter("conv_id = 2"))
    got = found(chat.reply_chains(repeated), 1)
    assert got[1, 1][1] == [(r, t) for _, _, r, t in rows[:700]]
    assert got[2, 1][1] == [("", ""), ("", "")] and len(got) == 2
    assert chat.format_trees(chat.reply_chains(turns.limit(0))).count() == 0


def test_repeated_messages_count_once(spark):
    rows = [(1, 1, None, "user", "b", 0.0), (1, 1, None, "user", "a", 0.0), (1, 2, 1, "assistant", "c", 0.0)]
    assert found(spark.createDataFrame(rows, SCHEMA), 1)[1, 1][1] == [("user", "a"), ("assistant", "c")]


def test_registered_query_against_plain_python(spark, sf_dir):
    from upswing.llm.queries import QUERIES

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    texts = {}
    for r in turns:
        texts.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    texts[-7] = [(role, "\\### Assistant: </turn> ok") for role in ("user", "assistant")]
    for r in QUERIES["op7_chat_formatting"](spark, sf_dir).collect():
        own = texts.pop(r["conv_id"])
        whole = "".join(f"{role}\n{text}\n" for role, text in own)
        loss = "".join(text for role, text in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert not texts
