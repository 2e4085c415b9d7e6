"""Reply trees to chat-formatted conversations.

``reply_paths`` takes messages ``tree, id, parent, role, text, score`` and enumerates
root-to-leaf paths by iterative self-joins that double their reach each round, so a
chain of n replies takes log2(n) rounds; nodes that have reached their root rest. Branches are ranked by mean score (ties: the
longer one, then the smaller leaf id). ``format_paths`` turns each path into one text.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts each
backslash is doubled and a backslash follows the first character of every control
string, so no control string survives there and ``read_back`` restores the original.
The loss mask lists (start, end) of each escaped assistant text.

Defined results: a null role or text is empty. A parent that is null or missing makes a
root. Repeated rows are separate turns. Rows of one conversation are ordered by turn,
then role, then text. A null ``conv_id`` is a conversation of its own. An empty table
gives no path. A circle of parents has no root and raises. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgrid.session import materialise

OPEN, CLOSE, LOSS_ROLE = "<|im_start|>", "<|im_end|>\n", "assistant"
CONTROL = r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"
MAX_ROUNDS = 48


def escaped(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({CONTROL})", r"$1\\")


def escaped_role(role: Column) -> Column:
    """A line break would end the role, so it becomes backslash and n."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def chain_messages(turns: DataFrame) -> DataFrame:
    """Messages of linear conversations: each row replies to the row before it.

    Rows are range-partitioned and numbered in order; a long conversation spans ranges.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialise(rows.withColumn("id", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("id", 33)
    ends = rows.groupBy(part.alias("part")).agg(F.max("id").alias("last"))
    before = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"))
    placed = rows.withColumn("part", part).join(before, "part").withColumn(
        "prev", F.when(F.shiftleft("part", 33) == F.col("id"), F.col("before")).otherwise(F.col("id") - 1))
    a, b = placed.alias("a"), rows.select("id", "conv_id").alias("b")
    linked = a.join(b, (F.col("a.prev") == F.col("b.id")) & F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")), "left")
    return linked.select(F.col("a.conv_id").alias("tree"), F.col("a.id").alias("id"), F.col("b.id").alias("parent"),
                         "a.role", "a.text", F.lit(0.0).alias("score"))


def reply_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """``tree, path, score, rank, node, depth``: the nodes of every chosen root-to-leaf path.

    ``best`` keeps that many branches of a tree; None keeps all.
    """
    nodes = materialise(messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    a, b = nodes.alias("a"), nodes.select("id").alias("b")
    reach = materialise(a.join(b, F.col("a.parent") == F.col("b.id"), "left").select(
        "a.id", F.col("b.id").alias("jump"), F.col("a.score").alias("total"), F.lit(1).alias("depth")), "reach")
    jumps = []
    while not (live := reach.where("jump IS NOT NULL")).isEmpty():
        if len(jumps) == MAX_ROUNDS:
            raise ValueError("replies form a circle")
        jumps.append(live.select("id", "jump"))
        a, b = live.alias("a"), reach.alias("b")
        further = materialise(a.join(b, F.col("a.jump") == F.col("b.id")).select(
            "a.id", "b.jump", (F.col("a.total") + F.col("b.total")).alias("total"),
            (F.col("a.depth") + F.col("b.depth")).alias("depth")), "reach")
        reach = reach.where("jump IS NULL").unionByName(further)  # nodes that reached a root rest
    inner = jumps[0].select(F.col("jump").alias("id")) if jumps else nodes.select("id").limit(0)
    leaves = (nodes.select("tree", "id").join(inner, "id", "left_anti").join(reach.drop("jump"), "id")
              .withColumn("mean", F.col("total") / F.col("depth")))
    if best is None:
        chosen = leaves.withColumn("rank", F.lit(None).cast("int"))
    else:
        order = Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("depth"), "id")
        chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    chosen = materialise(chosen, "branches")
    paths = chosen.select(F.col("id").alias("path"), F.col("id").alias("node"))
    for step in reversed(jumps):
        paths = materialise(paths.unionByName(paths.join(step, paths.node == step.id).select(
            "path", F.col("jump").alias("node"))), "paths")
    return (paths.join(reach.select(F.col("id").alias("node"), "depth"), "node")
            .join(chosen.select(F.col("id").alias("path"), "tree", F.col("mean").alias("score"), "rank"), "path"))


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per path: ``tree, path, score, rank, n_turns, formatted, loss`` (array of start, end)."""
    said = paths.join(messages.select(F.col("id").alias("node"), "role", "text"), "node")
    head = F.concat(F.lit(OPEN), escaped_role(F.col("role")), F.lit("\n"))
    turns = said.select("tree", "path", "score", "rank", F.struct(
        "depth", head.alias("head"), escaped(F.col("text")).alias("body"),
        F.coalesce(F.col("role") == LOSS_ROLE, F.lit(False)).alias("learn")).alias("turn"))
    grouped = turns.groupBy("path").agg(F.first("tree").alias("tree"), F.first("score").alias("score"),
                                        F.first("rank").alias("rank"), F.array_sort(F.collect_list("turn")).alias("turns"))
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)
    none = F.array().cast("array<struct<start:int,end:int>>")
    state = F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("loss")), lambda s, t: F.struct(
        (s["at"] + size(t)).alias("at"),
        F.when(t["learn"], F.concat(s["loss"], F.array(F.struct(
            (s["at"] + F.length(t["head"])).alias("start"),
            (s["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end"))))).otherwise(s["loss"]).alias("loss")))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return grouped.select("tree", "path", "score", "rank", F.size("turns").cast("long").alias("n_turns"),
                          text.alias("formatted"), state["loss"].alias("loss"))


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The turns, read back from the text alone."""
    whole = re.findall(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE), formatted, re.S)
    return [(unescape_role(r), unescape(t)) for r, t in whole]


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            turns = turns_of(row["formatted"])
            learned = "".join(unescape(row["formatted"][x["start"]:x["end"]]) for x in row["loss"])
            said = "".join(f"{r}\n{t}\n" for r, t in turns)
            rows.append((row["tree"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                         hashlib.sha256(learned.encode()).hexdigest(), len(row["formatted"])))
        columns = list(zip(*rows)) or [[]] * 6
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (
            pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=DIGEST)


DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns and learned text, taken from the formatted text."""
    kinds = ("long", "long", "string", "long", "string", "long")
    return formatted.select("tree", "formatted", "loss").mapInArrow(
        digest, ", ".join(f"{n} {t}" for n, t in zip(DIGEST, kinds)))


def format_conversations(turns: DataFrame) -> DataFrame:
    """Linear conversations ``conv_id, turn, role, text`` through the reply-tree operator."""
    messages = chain_messages(turns)
    return format_paths(reply_paths(messages, best=1), messages)
