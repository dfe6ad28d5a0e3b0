"""Chat formatting of the maximal logged conversations.

A conversation that was logged after each turn appears as many snapshots, each
a prefix of the next. Every turn gets an order-dependent hash; the running
combination of a conversation's turn hashes identifies each of its prefixes.
A conversation whose whole hash equals a proper prefix of another goes (an
anti-join), and of equal conversations the smallest ``conv_id`` stays. The
rest is rendered.

The turns are range-sorted into blocks first, and running counts and hashes
are computed per block and then over the blocks' totals, so that one
conversation with a third of all turns is still spread over many tasks.
Rendered text comes in parts of ``PART_TURNS`` turns. DataFrame functions only.

Defined results: turns are ordered by (turn, role, md5 of text), a null turn
first; a null role or text is empty; a repeated row counts once; rows with a
null ``conv_id`` are one conversation, which goes before an equal one; an empty
table gives an empty result; a conversation of any length is spread over ranges
and parts, a single text is one value; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitrend.llm.common import join_on, materialize

PART_TURNS = 64


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, place, p1, p2``: every distinct turn with
    its place in the conversation (from 1) and the hash of the prefix it ends."""
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("digest")).distinct()
    key = ["conv_id", "turn", "role", "digest"]
    rows = materialize(rows, "turns")
    # As many ranges as the session shuffles into.
    rows = materialize(rows.repartitionByRange(*key).withColumn("block", F.spark_partition_id()), "blocks")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "digest")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)

    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n")) \
        .withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = (join_on(rows, sizes, ["conv_id", "block"])
              .withColumn("place", F.col("skip") + F.row_number().over(inside)).drop("skip"))
    turn_hash = lambda seed: F.xxhash64(F.lit(seed), "place", "role", "digest")
    run = materialize(placed.withColumns({"e1": turn_hash(1), "e2": turn_hash(2)})
                      .withColumns({"r1": F.bit_xor("e1").over(upto), "r2": F.bit_xor("e2").over(upto)}), "running")
    totals = run.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("t1"), F.bit_xor("e2").alias("t2")) \
        .withColumns({"o1": F.coalesce(F.bit_xor("t1").over(before), F.lit(0)),
                      "o2": F.coalesce(F.bit_xor("t2").over(before), F.lit(0))})
    return join_on(run, totals, ["conv_id", "block"]).select(
        "conv_id", "turn", "role", "digest", "place",
        F.col("r1").bitwiseXOR(F.col("o1")).alias("p1"), F.col("r2").bitwiseXOR(F.col("o2")).alias("p2"))


def maximal(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The prefixes table, stored, and the ``conv_id`` of the conversations
    that are no prefix of another."""
    rows = materialize(prefixes(turns), "prefixes")
    length = rows.groupBy("conv_id").agg(F.max("place").alias("turns"))
    whole = join_on(rows, length, ["conv_id"])
    # min_by would keep a null id last; the least id, null first, is wanted.
    least = F.when(F.max(F.col("conv_id").isNull()), F.lit(None)).otherwise(F.min("conv_id"))
    last = whole.where("place = turns").groupBy("place", "p1", "p2").agg(least.alias("conv_id"))
    proper = whole.where("place < turns").select("place", "p1", "p2").distinct()
    return rows, last.join(proper, ["place", "p1", "p2"], "left_anti").select("conv_id")


def render(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, part, n_turns, chat`` of the maximal conversations."""
    rows, keep = maximal(turns)
    places = join_on(rows, keep, ["conv_id"]).select("conv_id", "turn", "role", "digest", "place")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         text.alias("text"), F.md5(text.cast("binary")).alias("digest"))
    both = join_on(texts, places, ["conv_id", "turn", "role", "digest"]).select("conv_id", "place", "role", "text")
    part = F.floor((F.col("place") - 1) / part_turns).cast("long").alias("part")
    turn_text = lambda t: F.concat(F.lit("<|im_start|>"), t["role"], F.lit("\n"), t["text"], F.lit("<|im_end|>\n"))
    return (both.groupBy("conv_id", part).agg(F.sort_array(F.collect_set(F.struct("place", "role", "text"))).alias("t"))
            .select("conv_id", "part", F.size("t").cast("long").alias("n_turns"),
                    F.array_join(F.transform("t", turn_text), "").alias("chat")))


RENDER_SQL = """
WITH d AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS place FROM d),
p AS (SELECT *, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY place) AS sig,
      count(*) OVER (PARTITION BY conv_id) AS turns FROM o),
last AS (SELECT sig, min(conv_id) AS conv_id FROM p WHERE place = turns GROUP BY sig),
keep AS (SELECT conv_id FROM last WHERE sig NOT IN (SELECT sig FROM p WHERE place < turns))
SELECT conv_id, CAST((place - 1) // 64 AS BIGINT) AS part, count(*) AS n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS chat
FROM o WHERE conv_id IN (SELECT conv_id FROM keep) GROUP BY 1, 2
"""
