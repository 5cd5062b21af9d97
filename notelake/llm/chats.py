"""Chat formatting: collapse cumulative snapshots, then render what is left, in DataFrame functions.

Logs often hold a conversation several times: after each turn, with all turns so far. A conversation
is the sequence of its rows (turn, role, text), in that order; one that begins a longer one, row by
row, is a snapshot of it. The hash of a prefix is the exclusive-or of the hashes of its rows (two of
64 bits each), so it is rolled along by blocks of ``BLOCK`` turn numbers: within a block by a window,
between blocks from one aggregated row per block. No window holds a whole conversation. Full
conversations whose hash is the hash of a proper prefix go; an anti-join keeps the others, and of
equal ones the smallest id.

Each kept turn is rendered as a segment; the segments in order of ``position`` are the conversation.

Edge cases: exactly repeated rows count once. Rows without a turn number come first; rows of one turn
number are ordered by role, then text (nulls first). Rows without an id form one conversation. A
null role is rendered as ``unknown``, a null text as empty; both differ from the texts themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 256


def row_hash(seed: int) -> Column:
    """Nulls are told apart, which the hash function alone does not do."""
    parts = [F.lit(seed)]
    for name in ("turn", "role", "text"):
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Distinct rows with ``position`` (from 1), prefix hashes x, y, and n, full_x, full_y."""
    rows = turns.groupBy("conv_id", "turn", "role", "text").agg(F.lit(1).alias("_one")).drop("_one")
    rows = rows.withColumns({
        "_block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))),
        "_x": row_hash(1), "_y": row_hash(2)})
    blocks = rows.groupBy("conv_id", "_block").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_x").alias("x"), F.bit_xor("_y").alias("y"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)

    def zero(column: Column) -> Column:
        return F.coalesce(column, F.lit(0))

    offsets = blocks.select(
        F.col("conv_id").alias("_conv"), F.col("_block").alias("_of"),
        zero(F.sum("n").over(before)).alias("n_before"),
        zero(F.bit_xor("x").over(before)).alias("x_before"),
        zero(F.bit_xor("y").over(before)).alias("y_before"),
        F.sum("n").over(whole).alias("n_turns"), F.bit_xor("x").over(whole).alias("full_x"),
        F.bit_xor("y").over(whole).alias("full_y"))
    inside = Window.partitionBy("conv_id", "_block").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, 0)
    rolled = rows.withColumns({
        "_n": F.count(F.lit(1)).over(inside), "_px": F.bit_xor("_x").over(inside),
        "_py": F.bit_xor("_y").over(inside)})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_block") == F.col("_of"))
    return rolled.join(offsets, same).select(
        "conv_id", "turn", "role", "text", (F.col("n_before") + F.col("_n")).alias("position"),
        F.col("x_before").bitwiseXOR(F.col("_px")).alias("x"),
        F.col("y_before").bitwiseXOR(F.col("_py")).alias("y"), "n_turns", "full_x", "full_y")


def maximal(hashed: DataFrame) -> DataFrame:
    """(conv_id, copies) of the conversations that begin no longer one; of equal ones the first."""
    ends = hashed.where("position = n_turns")
    groups = ends.groupBy("n_turns", "full_x", "full_y").agg(
        F.min("conv_id").alias("kept_id"), F.count(F.lit(1)).alias("copies"))
    prefixes = hashed.where("position < n_turns").select(
        F.col("position").alias("n_turns"), F.col("x").alias("full_x"), F.col("y").alias("full_y")
    ).distinct()
    return groups.join(prefixes, ["n_turns", "full_x", "full_y"], "left_anti").select(
        "kept_id", "copies")


def segment() -> Column:
    return F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"),
                    F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv_id, position, n_turns, copies, rendered) of every turn of a maximal conversation."""
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                        F.col(role).cast("string").alias("role"),
                        F.col(text).cast("string").alias("text"))
    hashed = prefix_hashes(rows)
    kept = maximal(hashed)
    return hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id"))).select(
        F.col("conv_id").alias(conv), "position", "n_turns", "copies", segment().alias("rendered"))
