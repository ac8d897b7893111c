"""Chat formatting of reply trees.

Messages form trees (a message names the one it replies to). Every root-to-leaf path is a branch;
branches are ranked by the sum of their messages' scores and the chosen ones are formatted as one
conversation each, with the spans of the assistant's text as loss mask.

Paths are enumerated by iterative self-joins that double their reach: a message points to its
parent, then to its ancestor 2, 4, 8 ... steps up, with the scores in between added up. A tree of
depth d needs log2(d) joins up for depth and score, and as many down to list the members of a
chosen path: an ancestor's distance has one binary form, so each is reached once. Text joins only
at the end. A chosen path is one output record, which bounds what is gathered for it.

Template: ``<|im_start|>role\\n text <|im_end|>\\n`` per turn. Control strings of this and of other
common templates that occur in a role or text get a backslash after their first character, as do
control strings that already have some there, so removing one backslash restores the text.

Nulls, empties and ties: a null text or role counts as empty; a null conversation is one of its
own; a message without a parent, or whose parent is missing, is a root; rows of a conversation are
ordered by turn (nulls last), role and text; equal branches are ranked by their leaf's number.
Reply cycles have no root and thus no branch.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from starloom.session import stage

START, END = "<|im_start|>", "<|im_end|>"
# What follows the first character of a control string of common chat templates.
_TAIL = r"(?=\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|[a-z_]+\|>|/?s>|/?INST\]|/?SYS>>)"
_ESCAPE = re.compile(r"([<\[]\\*)" + _TAIL)
_UNESCAPE = re.compile(r"([<\[]\\*)\\" + _TAIL)
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)
ASSISTANT = "assistant"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[1] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted conversation and the spans (code points, end exclusive) that count for the loss."""
    out, spans, at = [], [], 0
    for role, text in turns:
        # A line feed ends the role, so one inside a role is written as an escape.
        head = START + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
        body = escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def _role(written: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(written), flags=re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Turns back from a formatted conversation."""
    return [(_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def from_turns(conversations: DataFrame) -> DataFrame:
    """Linear conversations (``conv_id``, ``turn``, ``role``, ``text``) as reply trees of one branch."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last())
    node = F.row_number().over(order).cast("long")
    rows = conversations.select(
        F.col("conv_id").alias("tree"), node.alias("node"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.length("text").cast("double"))


def _on(left: DataFrame, right: DataFrame, a: str, b: str):
    return left["tree"].eqNullSafe(right["tree"]) & (left[a] == right[b])


def branches(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves with depth and branch score, and the written jump tables (step 1, 2, 4, ...)."""
    known = messages.select("tree", "node")
    other = messages.select(F.col("tree").alias("t"), F.col("node").alias("p")).distinct()
    hop = messages.select("tree", "node", "parent", "score").alias("m").join(
        other, F.col("m.tree").eqNullSafe(F.col("t")) & (F.col("m.parent") == F.col("p")), "left"
    ).select("m.tree", "m.node", F.col("p").alias("up"), F.lit(1).alias("depth"), F.col("m.score").alias("sum"))
    hop = stage(hop, "reply_hops")
    jumps = []
    n = known.count()
    while not hop.where("up is not null").isEmpty():
        jumps.append(hop.where("up is not null").select("tree", "node", "up"))
        if 1 << (len(jumps) - 1) > n:
            break  # only a cycle is longer than all messages; what has no root is dropped below
        far = hop.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("u"), F.col("depth").alias("d"), F.col("sum").alias("s"))
        open_ = hop.where("up is not null")  # what has met its root is done
        met = open_.join(far, open_["tree"].eqNullSafe(far["t"]) & (open_["up"] == far["n"])).select(
            "tree", "node", F.col("u").alias("up"), (F.col("depth") + F.col("d")).alias("depth"), (F.col("sum") + F.col("s")).alias("sum")
        )
        hop = stage(hop.where("up is null").unionByName(met), "reply_hops")
    answered = messages.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    rooted = hop.where("up is null")
    leaves = rooted.join(answered, rooted["tree"].eqNullSafe(answered["t"]) & (rooted["node"] == answered["p"]), "left_anti")
    return leaves.select("tree", F.col("node").alias("leaf"), "depth", F.col("sum").alias("score")), jumps


def paths(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``tree``, ``leaf``, ``rank``, ``node``: the members of the ``best`` branches of each tree (None: all)."""
    leaves, jumps = branches(messages)
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf"))
    leaves = leaves.withColumn("rank", rank)
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    members = stage(leaves.select("tree", "leaf", "rank", "depth", F.col("leaf").alias("node"), F.lit(0).alias("back")), "reply_paths")
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        met = members.join(jump, members["tree"].eqNullSafe(jump["t"]) & (members["node"] == jump["n"]))
        further = met.select("tree", "leaf", "rank", "depth", F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        members = stage(members.unionByName(further), "reply_paths")
    return members.withColumn("place", F.col("depth") - F.col("back"))


def format_conversations(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """One row per chosen branch: ``tree``, ``leaf``, ``rank``, ``formatted``, ``loss_spans``.

    ``messages`` has ``tree``, ``node``, ``parent``, ``role``, ``text``, ``score``.
    """
    messages = stage(messages, "messages")
    member = paths(messages, best)
    texts = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    full = member.join(texts, member["tree"].eqNullSafe(texts["t"]) & (member["node"] == texts["n"]))
    grouped = full.groupBy("tree", "leaf", "rank").agg(
        F.sort_array(F.collect_list(F.struct("place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns")
    )

    @F.pandas_udf("formatted string, loss_spans array<struct<begin:int,end:int>>")
    def write(turns: pd.Series) -> pd.DataFrame:
        rows = [format_turns([(t["role"], t["text"]) for t in one]) for one in turns]
        return pd.DataFrame({"formatted": [r[0] for r in rows], "loss_spans": [[{"begin": a, "end": b} for a, b in r[1]] for r in rows]})

    return grouped.select("tree", "leaf", "rank", write("turns").alias("w")).select("tree", "leaf", "rank", "w.formatted", "w.loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, read from the written output alone."""

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digest(texts: pd.Series, masks: pd.Series) -> pd.DataFrame:
        out = []
        for text, mask in zip(texts, masks):
            turns = read_turns(text)
            whole = "".join(f"{role}\n{body}\n" for role, body in turns)
            loss = "".join(unescape(text[s["begin"]:s["end"]]) for s in mask)
            sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (whole, loss)]
            out.append((len(turns), sha[0], len(loss), sha[1], len(text)))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(F.col("tree").alias("conv_id"), digest("formatted", "loss_spans").alias("d")).select("conv_id", "d.*")
