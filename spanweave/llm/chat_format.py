"""Chat formatting: logs that are cumulative snapshots collapse to the longest, which are rendered.

A chat service that logs the whole conversation after every turn leaves conversations that are prefixes
of longer ones. Every turn gets a hash of the conversation up to it. A conversation whose last hash
is also the hash of an earlier turn of a longer one is a prefix of it, and an anti-join drops it. Of equal
conversations the one with the smallest id stays.

A prefix hash is the exclusive-or of hashes of (position, role, text) over the turns so far, 128 bits in
two words. Exclusive-or needs no order inside, so a conversation of any length is hashed in chunks: in
each chunk, and then over the chunks. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.operators.lineage import materialize

#: Fixed values of the template: a turn is <|role|>, a line break, its text and an end mark.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"
#: Turns rendered into one row; a longer conversation has several parts.
PART_TURNS = 1024


def _turn_hash(salt: int) -> Column:
    # xxhash64 passes nulls over, so that they need a mark.
    return F.xxhash64(F.lit(salt), F.col("position"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit("")))


def turn_positions(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, role, text, position, x, y``: turns numbered from 0, with their prefix hashes.

    Turns are ordered by number, then role and text, nulls first; equal rows of a conversation are one
    turn logged twice. Rows without a conversation id belong to none and are left out.
    """
    keys = ["conv_id", "turn", "role", "text"]
    rows = (
        df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
        .where("conv_id IS NOT NULL")
        .distinct()
    )
    # Ranges of the order, so that one conversation may be in many parts; they are written out because
    # the offsets below must see the same parts.
    placed = materialize(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "chat-turns"
    )
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    inside = Window.partitionBy("conv_id", "_part").orderBy("_at")
    local = placed.withColumn("_n", F.row_number().over(inside) - 1)
    sizes = placed.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "_part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_base"))
    numbered = local.join(offsets, ["conv_id", "_part"]).withColumn("position", F.col("_n") + F.col("_base"))
    numbered = materialize(numbered.withColumns({"_x": _turn_hash(0), "_y": _turn_hash(1)}), "chat-numbered")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    xor = lambda c, w: F.coalesce(F.expr(f"bit_xor({c})").over(w), F.lit(0).cast("long"))
    chunk = numbered.groupBy("conv_id", "_part").agg(F.expr("bit_xor(_x)").alias("cx"), F.expr("bit_xor(_y)").alias("cy"))
    carried = chunk.select("conv_id", "_part", xor("cx", before).alias("bx"), xor("cy", before).alias("by"))
    return (
        numbered.withColumns({"_rx": xor("_x", running), "_ry": xor("_y", running)})
        .join(carried, ["conv_id", "_part"])
        .select(
            "conv_id", "role", "text", "position",
            F.col("_rx").bitwiseXOR(F.col("bx")).alias("x"), F.col("_ry").bitwiseXOR(F.col("by")).alias("y"),
        )
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations that are no proper prefix of another."""
    last = turns.groupBy("conv_id").agg(F.max(F.struct("position", "x", "y")).alias("last"))
    # Equal conversations are one row here, whatever their number.
    whole = last.groupBy("last").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    whole = whole.select("conv_id", "n_copies", "last.position", "last.x", "last.y")
    # Hashes of turns that are followed by another turn of their conversation, each once.
    ends = last.select("conv_id", F.col("last.position").alias("end"))
    inner = turns.join(ends, "conv_id").where("position < end").select("position", "x", "y").distinct()
    return whole.join(inner, ["position", "x", "y"], "left_anti").select("conv_id", (F.col("position") + 1).alias("n_turns"), "n_copies")


def render(role: Column, text: Column) -> Column:
    """One turn in the template; a null role is called unknown, a null text is empty."""
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("unknown")), F.lit(CLOSE + "\n"), F.coalesce(text, F.lit("")), F.lit(END + "\n"))


def format_chats(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, part, n_turns, n_copies, text``: the maximal conversations, rendered.

    A part holds ``PART_TURNS`` turns, so most conversations have one part, numbered 0; the parts of a
    longer one give its text end to end. ``n_turns`` is of the whole conversation, ``n_copies`` the number
    of equal conversations it stands for. Other columns are left out. An empty table gives no rows.
    """
    turns = materialize(turn_positions(df, conv_id, turn, role, text), "chat-hashed")
    kept = maximal(turns)
    pieces = turns.select("conv_id", "position", render(F.col("role"), F.col("text")).alias("piece"))
    part = F.floor(F.col("position") / PART_TURNS)
    return (
        pieces.join(kept, "conv_id")
        .groupBy("conv_id", part.alias("part"), "n_turns", "n_copies")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "piece"))), lambda p: p["piece"]), "").alias("text"))
    )
