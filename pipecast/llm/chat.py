"""Chat formatting of logged conversations, snapshots collapsed.

Logs keep snapshots: a conversation logged again after more turns, or logged twice. A rolling
hash of turns (two 64-bit halves) names every prefix of every conversation. A conversation
whose full hash names a proper prefix of another is a snapshot; an anti join drops it. Of
conversations with equal turns the smallest conv_id stays. What is left is rendered.

The rolling hash is the running exclusive-or of hashes of (place, role, text). Places and
running values are computed in chunks of CHUNK_TURNS turn numbers and then linked, so a very
long conversation is not one window; prefixes are made distinct before the join, so a very
common opening is not one hot key.

All work is built-in expressions. Rows without conv_id belong to no conversation and are left
out. Rows equal in conv_id, turn, role and text are one turn. Turns are ordered by turn (null
first), then role, then the text's hash. A null role is rendered ``unknown``, a null text as
empty; for the collapse a null differs from an empty text. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipecast.llm.store import keep

CHUNK_TURNS = 256
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def _turns(conversations: DataFrame) -> DataFrame:
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS).cast("long"), F.lit(-(1 << 40)))
    halves = [
        F.xxhash64(F.lit(k), F.col("role").isNull(), "role", F.col("text").isNull(), "text").alias(f"t{k}") for k in (1, 2)
    ]
    return conversations.where("conv_id is not null").select("conv_id", "turn", "role", "text", chunk.alias("chunk"), *halves)


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, n_turns, h1, h2): the rolling hash after each turn; ``n_turns`` is the conversation's length."""
    turns = _turns(conversations).select("conv_id", "turn", "role", "chunk", "t1", "t2").distinct()
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "t1", "t2")
    local = turns.select("conv_id", "chunk", "t1", "t2", F.row_number().over(inside).alias("local"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = local.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    offsets = chunks.select(
        "conv_id",
        "chunk",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    placed = local.join(offsets, ["conv_id", "chunk"]).withColumn("place", F.col("local") + F.col("offset"))
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select(
        "conv_id",
        "chunk",
        "place",
        "n_turns",
        F.bit_xor(F.xxhash64("place", "t1")).over(so_far).alias("r1"),
        F.bit_xor(F.xxhash64("place", "t2")).over(so_far).alias("r2"),
    )
    running = keep(running, "chat-running")
    totals = running.groupBy("conv_id", "chunk").agg(F.max_by(F.struct("r1", "r2"), "place").alias("x"))
    carried = totals.select(
        "conv_id",
        "chunk",
        F.coalesce(F.bit_xor("x.r1").over(earlier), F.lit(0)).alias("c1"),
        F.coalesce(F.bit_xor("x.r2").over(earlier), F.lit(0)).alias("c2"),
    )
    return running.join(carried, ["conv_id", "chunk"]).select(
        "conv_id",
        "place",
        "n_turns",
        F.col("r1").bitwiseXOR(F.col("c1")).alias("h1"),
        F.col("r2").bitwiseXOR(F.col("c2")).alias("h2"),
    )


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, kept): ``kept`` marks conversations that no other one continues or repeats."""
    rolled = keep(prefixes(conversations), "chat-prefixes")
    whole = rolled.where("place = n_turns").select("conv_id", "n_turns", "h1", "h2")
    classes = whole.groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    continued = rolled.where("place < n_turns").select(F.col("place").alias("n_turns"), "h1", "h2").distinct()
    maximal = classes.join(continued, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", F.lit(True).alias("kept"))
    marked = whole.select("conv_id", "n_turns").join(maximal, "conv_id", "left")
    return marked.select("conv_id", "n_turns", F.coalesce("kept", F.lit(False)).alias("kept"))


def render(conversations: DataFrame) -> DataFrame:
    """(conv_id, chat): the turns of each conversation in order, as text.

    Turn marks inside a text are broken up by a space, so that no text can begin or end a turn.
    """
    content = F.replace(F.coalesce("text", F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    role = F.coalesce("role", F.lit("unknown"))
    line = F.concat(F.lit(TURN_START), role, F.lit("\n"), content, F.lit(TURN_END + "\n"))
    turns = _turns(conversations).withColumn("line", line)
    entry = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "t1", "t2", "line")
    chunks = turns.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_set(entry)).alias("lines"))
    chunks = chunks.select("conv_id", "chunk", F.expr("concat_ws('', transform(lines, x -> x.line))").alias("part"))
    whole = chunks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "part"))).alias("parts"))
    return whole.select("conv_id", F.expr("concat_ws('', transform(parts, x -> x.part))").alias("chat"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, kept, chat): one row a conversation; ``chat`` is null where it was dropped."""
    marked = keep(maximal_conversations(conversations), "chat-marks")
    kept = marked.where("kept").select("conv_id")
    return marked.join(render(conversations.join(kept, "conv_id", "left_semi")), "conv_id", "left")
