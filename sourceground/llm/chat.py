"""Chat formatting of reply trees.

A tree's messages point at their parents. Root-to-leaf paths are enumerated by self-joins
that double their reach: after k rounds every leaf knows its 2^k nearest ancestors, so a
thread of thousands of turns takes a dozen joins. Branches of a tree are ranked by score
and each chosen path becomes one conversation: a string, and the spans of it that count
for the loss.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``, so no text can hold a control string, and
reading back restores every code point.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def render(turns: list[tuple[str | None, str | None]], target: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation and the [from, to) code points of it that hold the target's texts. Nulls are empty."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head = f"{START}{escape(role or '').replace(chr(10), chr(92) + 'n')}\n"
        body = escape(text or "")
        if role == target:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, unescaped; fails on what ``render`` did not write."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line + 1)
        turns.append((unescape(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END)
        if formatted[at : at + 1] != "\n":
            raise ValueError(f"no line ends at {at}")
        at += 1
    return turns


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, dist) for all nodes on the path from each leaf up to its root.

    ``messages`` has (tree, node, parent), node unique in its tree. A parent that is null or
    missing makes a root. Messages whose ancestors form a cycle lie on no path and are
    left out. No key is hot: joins are on single messages.
    """
    own = messages.select("tree", "node", "parent")
    up = own.where("parent is not null").join(own.select("tree", F.col("node").alias("parent")), ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("to"))
    leaves = own.join(up.select("tree", F.col("to").alias("node")), ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("dist"))
    up, reached = materialize(up, "chat-up"), materialize(leaves, "chat-paths")
    most = own.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    step, first = 1, up
    while step < most:
        further = reached.join(up, ["tree", "node"]).select("tree", "leaf", F.col("to").alias("node"), (F.col("dist") + step).alias("dist"))
        reached = materialize(reached.union(further), "chat-paths")
        step *= 2
        if step < most:
            over = up.select("tree", F.col("node").alias("to"), F.col("to").alias("next"))
            longer = up.join(over, ["tree", "to"]).select("tree", "node", F.col("next").alias("to"))
            up = materialize(longer, "chat-up")
    tops = reached.groupBy("tree", "leaf").agg(F.max("dist").alias("top"))
    ends = reached.join(tops, ["tree", "leaf"]).where("dist = top").join(first.select("tree", "node"), ["tree", "node"], "left_anti").select("tree", "leaf")
    return reached.join(ends, ["tree", "leaf"], "left_semi")


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, branch, formatted, spans) of the ``branches`` best paths of each tree.

    ``messages`` has (tree, node, parent, role, text, score), node unique in its tree; other
    columns are ignored. A path's score is the mean of its messages' (null counts as 0);
    ties go to the smaller leaf. Branches are ranked on scores alone, and only chosen paths
    meet their texts, so a text moves once for each chosen path that holds it, however many
    leaves lie below. Null roles and texts are empty; texts of any length are kept whole;
    rows with a null tree or node are on no path. An empty table gives an empty result.
    """
    score = messages.select("tree", "node", F.coalesce("score", F.lit(0.0)).alias("score"))
    walked = materialize(paths(messages).join(score, ["tree", "node"]), "chat-walked")
    rank = Window.partitionBy("tree").orderBy(F.col("path_score").desc(), "leaf")
    ranked = walked.groupBy("tree", "leaf").agg(F.avg("score").alias("path_score"))
    best = ranked.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= branches).select("tree", "leaf", "branch")
    said = walked.drop("score").join(best, ["tree", "leaf"]).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    turns = F.array_sort(F.collect_list(F.struct((-F.col("dist")).alias("at"), "role", "text")))
    chosen = said.groupBy("tree", "leaf", "branch").agg(turns.alias("turns"))

    def run(batches):
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        for batch in batches:
            made = [render([(t["role"], t["text"]) for t in turns]) for turns in batch.column("turns").to_pylist()]
            spans = [[{"from": a, "to": b} for a, b in m[1]] for m in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("leaf"), batch.column("branch"), pa.array([m[0] for m in made], pa.string()), pa.array(spans, span)],
                names=["tree", "leaf", "branch", "formatted", "spans"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}
    schema = f"tree {kinds['tree']}, leaf {kinds['leaf']}, branch int, formatted string, spans array<struct<from:bigint,to:bigint>>"
    return chosen.select("tree", "leaf", "branch", "turns").mapInArrow(run, schema)


def threads(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each turn answers the one before.

    Rows that share a turn follow each other by role and text; a null turn comes first. A
    longer text scores higher. Null conversations are one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("node"), "role", "text")
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("tree"), "node", parent.alias("parent"), "role", "text", F.log1p(F.length(F.coalesce("text", F.lit("")))).alias("score"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what reading the strings back gives: turns and text under the loss mask.

    The empty tree stands for the null conversation. Strings of any length are read whole;
    columns other than tree, formatted and spans are ignored; an empty table gives none.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for tree, text, spans in zip(*(batch.column(c).to_pylist() for c in ("tree", "formatted", "spans")), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[s["from"] : s["to"]]) for s in spans)
                whole = hashlib.sha256()
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                rows.append((int(tree) if tree else None, len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
