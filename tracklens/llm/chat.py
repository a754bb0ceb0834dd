"""Chat formatting of reply trees (operator 7).

Messages form trees: each names the message it replies to. Ancestors are found
by iterative self-joins that double the distance each round (a message learns
its 2^k-th ancestor, its depth and the sum of scores on the way), so a path of
length n takes log2(n) joins. Branches, that is leaves, are ranked by the mean
score of their path; the chosen leaves then mark their ancestors, again doubling,
and every chosen path becomes one conversation.

Template: ``<s>`` role ``\\n`` text ``</s>\\n`` per turn. Inside roles and texts
``&`` and ``<`` are written ``&amp;`` and ``&lt;`` and ``[`` and ``]`` as
``&#91;`` and ``&#93;``, so no control string of this or a bracket template can
occur, and unescaping gives the exact text back. The loss mask lists the spans
of escaped assistant texts.

Defined results
    null or empty text     an empty turn
    null role              an empty role
    null conversation      a conversation of its own (all such rows together)
    unknown parent         the message starts a tree of its own
    cycles                 messages that only reach a cycle are left out
    ties in rank           the leaf with the least message id
    repeated rows          in ``chain``, each row is a turn; equal rows in any order
    empty table            an empty result
    extra columns          ignored
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

OPEN, CLOSE = "<s>", "</s>\n"
LEARNED = "assistant"
# What is written for each character that control strings use.
ESCAPES = {"&": "&amp;", "<": "&lt;", "[": "&#91;", "]": "&#93;"}
_ESCAPE = re.compile(r"[&<\[\]]").sub
_BACK = {v: k for k, v in ESCAPES.items()}
_UNESCAPE = re.compile("|".join(map(re.escape, _BACK))).sub
_TURN = re.compile(r"<s>([^<\n]*)\n([^<]*)</s>\n")


def escape(text: str) -> str:
    return _ESCAPE(lambda m: ESCAPES[m.group()], text)


def unescape(text: str) -> str:
    return _UNESCAPE(lambda m: _BACK[m.group()], text)


def _role(role: str) -> str:
    return escape(role).replace("\n", "&#10;")


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted conversation and the starts and ends of its loss spans."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{_role(role)}\n", escape(text)
        if role == LEARNED:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), starts, ends


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, unescaped."""
    return [(unescape(m[1].replace("&#10;", "\n")), unescape(m[2])) for m in _TURN.finditer(formatted)]


def chain(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of linear conversations: each row replies to the one before it.

    A conversation is a sequence of turns, so its order takes a window over its
    own rows; ties in ``turn`` are ordered by role and text.
    """
    order = Window.partitionBy(conv_col).orderBy(F.col(turn_col).asc_nulls_first(), F.col(role_col).asc_nulls_first(), F.col(text_col).asc_nulls_first())
    number = F.row_number().over(order).cast("long")
    numbered = rows.select(F.col(conv_col).alias("conv_id"), number.alias("msg_id"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return numbered.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.length("text").cast("double").alias("score"))


def paths(messages: DataFrame, per_conversation: int | None = 1) -> DataFrame:
    """``conv_id, leaf_id, rank, msg_id, depth`` of the messages on the best root-to-leaf paths.

    ``messages`` has conv_id, msg_id, parent_id and score. All paths are kept
    where ``per_conversation`` is None.
    """
    nodes = messages.select("conv_id", "msg_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select("conv_id", F.col("msg_id").alias("parent_id"), F.lit(1).alias("found"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))

    def over(left: DataFrame, right: DataFrame, left_id: str, right_id: str, how: str) -> DataFrame:
        """Join on the conversation (null equals null) and an id."""
        right = right.withColumnRenamed("conv_id", "r_conv").withColumnRenamed(right_id, "r_id")
        return left.join(right, same("conv_id", "r_conv") & (F.col(left_id) == F.col("r_id")), how).drop("r_conv", "r_id")

    # up: the ancestor at the current distance; total and steps: score and length of the way there
    first = over(nodes, known, "parent_id", "parent_id", "left").select("conv_id", "msg_id", F.when(F.col("found") == 1, F.col("parent_id")).alias("up"), F.col("score").alias("total"), F.lit(1).alias("steps"))
    first = written(first, "chat-paths")
    # messages that have reached their root stay as they are; each round joins only the others
    ended, going = [first.where("up IS NULL")], first.where("up IS NOT NULL")
    jumps, limit, most = [], 1, first.count()
    while limit <= most and going.limit(1).count():  # only a cycle has more ancestors than there are messages
        jumps.append(going.select("conv_id", "msg_id", "up"))
        every = reduce(DataFrame.unionByName, [*ended, going])
        ahead = every.select("conv_id", F.col("msg_id").alias("a_id"), F.col("up").alias("a_up"), F.col("total").alias("a_total"), F.col("steps").alias("a_steps"))
        joined = over(going, ahead, "up", "a_id", "inner")
        after = written(joined.select("conv_id", "msg_id", F.col("a_up").alias("up"), (F.col("total") + F.col("a_total")).alias("total"), (F.col("steps") + F.col("a_steps")).alias("steps")), "chat-paths")
        ended.append(after.where("up IS NULL"))
        going = after.where("up IS NOT NULL")
        limit *= 2
    state = reduce(DataFrame.unionByName, ended)
    parents = nodes.select("conv_id", F.col("parent_id").alias("p")).where("p IS NOT NULL").distinct()
    leaves = over(state, parents, "msg_id", "p", "left_anti")
    if per_conversation is not None:
        rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc(F.col("total") / F.col("steps")), "msg_id"))
        leaves = leaves.withColumn("rank", rank).where(F.col("rank") <= per_conversation)
    else:
        leaves = leaves.withColumn("rank", F.lit(1))
    marked = leaves.select("conv_id", F.col("msg_id").alias("leaf_id"), "rank", "msg_id")
    for hop in reversed(jumps):
        far = over(marked, hop.withColumnRenamed("msg_id", "h_id"), "msg_id", "h_id", "inner").select("conv_id", "leaf_id", "rank", F.col("up").alias("msg_id"))
        marked = written(marked.unionByName(far), "chat-paths")
    return over(marked, state.select("conv_id", F.col("msg_id").alias("d_id"), F.col("steps").alias("depth")), "msg_id", "d_id", "inner")


def formatted(messages: DataFrame, per_conversation: int | None = 1) -> DataFrame:
    """``conv_id, leaf_id, rank, formatted, loss_starts, loss_ends`` of each chosen path."""
    chosen = paths(messages, per_conversation)
    texts = messages.select(F.col("conv_id").alias("t_conv"), F.col("msg_id").alias("t_id"), "role", "text")
    rows = chosen.join(texts, F.col("conv_id").eqNullSafe(F.col("t_conv")) & (F.col("msg_id") == F.col("t_id")))
    whole = rows.groupBy("conv_id", "leaf_id", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    keys = ["conv_id", "leaf_id", "rank"]
    schema = ", ".join(f"{c} {dict(whole.dtypes)[c]}" for c in keys) + ", formatted string, loss_starts array<int>, loss_ends array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in part.column(3).to_pylist()]
                lists = [pa.array([o[i] for o in out], pa.list_(pa.int32())) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([o[0] for o in out], pa.string()), *lists], names=[*keys, "formatted", "loss_starts", "loss_ends"])

    return whole.mapInArrow(run, schema)


def read_back(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` and ``loss_text`` as read from ``formatted`` conversations."""
    schema = f"conv_id {dict(conversations.dtypes)['conv_id']}, formatted_chars long, turns array<struct<role:string,text:string>>, loss_text string"
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            turns = [[{"role": r, "text": t} for r, t in read_turns(x["formatted"])] for x in rows]
            loss = ["".join(unescape(x["formatted"][a:b]) for a, b in zip(x["loss_starts"], x["loss_ends"], strict=True)) for x in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x["formatted"]) for x in rows], pa.int64()), pa.array(turns, turn), pa.array(loss, pa.string())], names=["conv_id", "formatted_chars", "turns", "loss_text"])

    return conversations.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(run, schema)
