"""Chat formatting from reply trees.

A message names the message it answers. Paths from the root to each leaf are found by iterated self-joins that
double their reach each time, so a thread of n messages takes log2(n) joins; branches are ranked by the sum of
their messages' scores, and each chosen path is formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each message. Inside roles and texts a backslash is doubled and
``<|`` becomes ``<\\|`` (in roles a line feed becomes ``\\n``), so no text can end its turn, and reading back is exact.
The loss mask lists the spans, in code points of the formatted string, of the texts of one role.

Defined results: null texts and roles are empty; a message whose parent is missing is a root; messages that reach
no root (cycles) are in no path; of branches with equal scores the longer, then the one with the smallest leaf
wins. Rows of one conversation with the same turn stand in order of role and text, null turns first; a
null conversation id is a conversation of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turns(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role).replace(chr(10), chr(92) + 'n')}\n", escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        part = f"{head}{body}{CLOSE}\n"
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


# --- reply trees ---------------------------------------------------------------------------


def _reach(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jump tables (node to its ancestor 1, 2, 4, ... steps up), and each node's depth and path score."""
    known = messages.select(F.col("tree").alias("t"), F.col("node").alias("known"))
    links = messages.select("tree", "node", F.col("parent").alias("up"), "score").join(
        known, (F.col("up") == F.col("known")) & F.col("tree").eqNullSafe(F.col("t")), "left"
    ).select("tree", "node", F.col("known").alias("up"), F.lit(1).cast("long").alias("depth"), "score")
    reached, jumps, open_before = cut(links), [], None
    while True:
        still_open = reached.where("up IS NOT NULL").count()
        if not still_open or still_open == open_before:
            break  # a row at any depth has ancestors at all smaller ones: if none arrives, the rest go round in cycles
        open_before = still_open
        jumps.append(reached.where("up IS NOT NULL").select("tree", "node", "up"))
        above = reached.select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"), F.col("depth").alias("d"), F.col("score").alias("s")
        )
        further = reached.where("up IS NOT NULL").join(
            above, (F.col("up") == F.col("n")) & F.col("tree").eqNullSafe(F.col("t")), "left"
        ).select(
            "tree", "node", F.col("next").alias("up"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"),
            (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"),
        )
        reached = cut(reached.where("up IS NULL").unionByName(further))
    return jumps, reached.where("up IS NULL").drop("up")


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best root-to-leaf paths of each tree: tree, branch (rank), leaf, node, depth.

    messages: tree, node, parent, score. Joins are on node and tree, so a large tree is spread over all tasks.
    """
    jumps, reached = _reach(messages)
    answered = messages.where("parent IS NOT NULL").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = reached.join(answered, (F.col("node") == F.col("p")) & F.col("tree").eqNullSafe(F.col("t")), "left_anti")
    rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "node"))
    leaves = leaves.withColumn("branch", rank).where(F.col("branch") <= branches)
    paths = leaves.select("tree", "branch", F.col("node").alias("leaf"), "node", "depth")
    for k in reversed(range(len(jumps))):
        step = jumps[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        higher = paths.join(step, (F.col("node") == F.col("n")) & F.col("tree").eqNullSafe(F.col("t"))).select(
            "tree", "branch", "leaf", F.col("up").alias("node"), (F.col("depth") - 2 ** k).alias("depth")
        )
        paths = cut(paths.unionByName(higher))
    return paths


def _format(loss_role: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [format_turns([(t["role"], t["text"]) for t in turns], loss_role) for turns in frame["turns"]]
            yield pd.DataFrame({
                "tree": frame["tree"], "branch": frame["branch"], "formatted": [m[0] for m in made],
                "loss_start": [[a for a, _ in m[1]] for m in made], "loss_end": [[b for _, b in m[1]] for m in made],
            })

    return run


def format_trees(messages: DataFrame, branches: int = 1, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Chosen paths as conversations: tree, branch, formatted, loss_start, loss_end (spans under the loss mask).

    messages: tree, node, parent, score, role, text.
    """
    paths = chosen_paths(messages, branches)
    said = messages.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = paths.join(said, (F.col("node") == F.col("n")) & F.col("tree").eqNullSafe(F.col("t")))
    turns = turns.groupBy("tree", "branch").agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    tree = messages.schema["tree"].dataType.simpleString()
    return turns.mapInPandas(
        _format(loss_role), f"tree {tree}, branch int, formatted string, loss_start array<long>, loss_end array<long>"
    )


def as_threads(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply trees with one branch: each row answers the one before."""
    place = F.row_number().over(W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")).cast("long")
    return conversations.select("conv_id", "turn", "role", "text").withColumn("node", place).select(
        F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text",
    )


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for formatted, starts, ends in zip(frame["formatted"], frame["loss_start"], frame["loss_end"]):
            turns = parse_turns(formatted)
            loss = "".join(unescape(formatted[a:b]) for a, b in zip(starts, ends))
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append((
                len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)
            ))
        made = pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
        made.insert(0, "conv_id", frame["tree"].to_numpy())
        yield made


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read from the strings and spans alone."""
    tree = formatted.schema["tree"].dataType.simpleString()
    return formatted.mapInPandas(
        _digest, f"conv_id {tree}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
