"""Chat formatting: cumulative snapshots collapse to maximal conversations, which are rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import written

#: Turns ranked and hashed together: a conversation of more turns is cut by turn number.
TURN_BLOCK = 1024
#: Turns of one rendered row: a longer conversation has several rows.
CHUNK_TURNS = 256

_KEY = ["_conv", "_none"]


def _before(order: str) -> Window:
    return Window.partitionBy(*_KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Every turn with its position (from 1) and the hash of its conversation up to there.

    Turns are ordered by (turn, role, text), nulls first. The hash is two running XORs of
    hashes of (position, role, text), so equal prefixes have equal hashes wherever they are.
    A conversation is cut into blocks of turn numbers; positions and hashes inside a block
    are carried on by the totals of the blocks before it, so that one long conversation is
    not one task. The turn numbers themselves only order the turns.
    """
    base = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("_conv"),
        F.col("conv_id").isNull().alias("_none"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.floor(F.col("turn") / TURN_BLOCK), F.lit(-(1 << 60))).alias("_block"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    inside = Window.partitionBy(*_KEY, "_block").orderBy(*order)
    sizes = base.groupBy(*_KEY, "_block").agg(F.count("*").alias("_n"))
    starts = sizes.select(*_KEY, "_block", F.coalesce(F.sum("_n").over(_before("_block")), F.lit(0)).alias("_start"))
    placed = (
        base.withColumn("_rank", F.row_number().over(inside))
        .join(starts, [*_KEY, "_block"])
        .withColumn("position", F.col("_start") + F.col("_rank"))
        .drop("_start")
    )

    def salted(seed: int) -> Column:
        absent = [F.col(c).isNull() for c in ("role", "text")]
        return F.xxhash64(F.lit(seed), "position", "role", "text", *absent)

    hashed = placed.withColumn("_a", salted(1)).withColumn("_b", salted(2))
    totals = hashed.groupBy(*_KEY, "_block").agg(F.expr("bit_xor(_a)").alias("_ta"), F.expr("bit_xor(_b)").alias("_tb"))
    earlier = totals.select(
        *_KEY,
        "_block",
        *(F.coalesce(F.expr(f"bit_xor(_t{x})").over(_before("_block")), F.lit(0)).alias(f"_e{x}") for x in "ab"),
    )
    running = Window.partitionBy(*_KEY, "_block").orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        hashed.select("*", *(F.expr(f"bit_xor(_{x})").over(running).alias(f"_r{x}") for x in "ab"))
        .join(earlier, [*_KEY, "_block"])
        .select(
            *_KEY,
            "position",
            "turn",
            "role",
            "text",
            F.col("_ra").bitwiseXOR(F.col("_ea")).alias("hash_a"),
            F.col("_rb").bitwiseXOR(F.col("_eb")).alias("hash_b"),
        )
    )


def maximal_conversations(hashes: DataFrame) -> DataFrame:
    """(_conv, _none, n_turns) of the conversations that no other one continues.

    A conversation whose hash is a proper prefix of another's goes; of equal ones the
    smallest conv_id stays (a null one last). `hashes` holds (_conv, _none, position,
    hash_a, hash_b).
    """
    ends = hashes.groupBy(*_KEY).agg(F.max("position").alias("position"))
    last = hashes.join(ends, [*_KEY, "position"])
    same = ["position", "hash_a", "hash_b"]
    # rows before the last one of their conversation, each distinct prefix once
    inner = hashes.join(ends.withColumnRenamed("position", "_last"), _KEY).where(F.col("position") < F.col("_last")).select(*same).distinct()
    first = last.groupBy(*same).agg(F.min(F.struct("_none", "_conv")).alias("_id"))
    return first.join(inner, same, "left_anti").select("_id._conv", "_id._none", F.col("position").alias("n_turns"))


def format_chats(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Maximal conversations as chat text: conv_id, chunk (from 0), n_turns, text.

    A turn is rendered as `<|role|>`, a line break, its text, `<|end|>` and a line break; a
    null role is `unknown`, a null text empty. n_turns counts the conversation; a row holds at
    most `chunk_turns` turns, and the chunks of a conversation put together are its whole text.
    Repeated rows are turns of their own. Turns with a null conv_id form one conversation. An
    empty table gives an empty result. Other columns of `turns` are not read.
    """
    hashes = written(prefix_hashes(turns), "chat-prefixes")
    kept = maximal_conversations(hashes.select(*_KEY, "position", "hash_a", "hash_b"))
    said = F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n")
    )
    return (
        hashes.join(kept, _KEY)
        .select(
            F.when(~F.col("_none"), F.col("_conv")).alias("conv_id"),
            F.floor((F.col("position") - 1) / chunk_turns).cast("int").alias("chunk"),
            "n_turns",
            F.struct("position", said.alias("said")).alias("_turn"),
        )
        .groupBy("conv_id", "chunk", "n_turns")
        .agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
        .select("conv_id", "chunk", "n_turns", F.array_join(F.col("_turns.said"), "").alias("text"))
    )


FORMAT_SQL = """
WITH numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    list({'role': role, 'text': text} ORDER BY pos) AS said,
    string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY pos) AS text
  FROM numbered GROUP BY conv_id
), prefixes AS (
  SELECT DISTINCT n.pos AS n_turns, list_slice(w.said, 1, n.pos) AS said
  FROM whole w JOIN numbered n USING (conv_id) WHERE n.pos < w.n_turns
), firsts AS (
  SELECT min(conv_id) AS conv_id, n_turns, said, any_value(text) AS text FROM whole GROUP BY n_turns, said
)
SELECT f.conv_id, CAST(0 AS INTEGER) AS chunk, f.n_turns, f.text
FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.n_turns = f.n_turns AND p.said = f.said)
"""
