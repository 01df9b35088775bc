"""Chat formatting over reply trees.

Messages point to their parent. Self-joins that double the reach of every pointer give each
message its depth and the summed score of its path from the root in log2(depth) rounds; leaves
are then ranked per tree, and the messages on the chosen root-to-leaf paths are marked by running
the saved pointers backwards. Every round is as large as the messages, never all (leaf, ancestor)
pairs, and is written to the shared folder.

Each path becomes one conversation. A turn is ``<s>[role]``, a line feed, the text and ``</s>``;
inside roles and texts the characters & < [ ] are written as references, so no text can hold
a control string, and unescaping restores it exactly. Paths are put together in pieces of
``PIECE`` turns, so no step groups more than that many rows of a path at once.

Defined results: a null text or role is empty; null trees are one tree; turns that tie are ordered
by role and text; a parent that does not exist makes a root; messages in a circle are on no path;
an empty table gives no conversation; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.llm.common import materialise

PIECE = 1000
LOSS_ROLE = "assistant"
_REFERENCES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("]", "&#93;"))


def escape(text: Column) -> Column:
    for plain, reference in _REFERENCES:
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def unescape(text: Column) -> Column:
    for plain, reference in reversed(_REFERENCES):
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def chain(turns: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Rows of ``turns`` as messages: each replies to the one before it in ``order``.

    Rows are dealt by range over (tree, first order column), so a long conversation spans
    partitions; the row before is found by its number, or as the last of the partition before.
    """
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartitionByRange(parts, F.col(tree), F.col(order[0])).sortWithinPartitions(tree, *order)
    rows = materialise(dealt.withColumn("node", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "turns")
    last = rows.groupBy("part").agg(F.max("node").alias("end"))
    last = last.select(F.col("part").alias("l_part"), F.lag("end").over(Window.orderBy("part")).alias("before"))  # one row per partition
    first = F.col("node").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows = rows.join(last, rows.part == last.l_part).withColumn("up", F.when(first, F.col("before")).otherwise(F.col("node") - 1))
    above = rows.select(F.col("node").alias("up_node"), F.col(tree).alias("up_tree"))
    joined = rows.join(above, (F.col("up") == F.col("up_node")) & F.col(tree).eqNullSafe(F.col("up_tree")), "left")
    return joined.withColumn("parent", F.col("up_node")).drop("up", "up_node", "up_tree", "before", "l_part", "part")


def best_paths(messages: DataFrame, tree: str = "tree", paths: int = 1) -> DataFrame:
    """``path, tree, depth, node`` for the ``paths`` best branches of each tree.

    ``messages``: tree, node, parent, score. Branches rank by summed score, then length, then leaf.
    """
    slim = materialise(messages.select(F.col(tree).alias("tree"), "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score")), "messages")
    known = slim.select(F.col("node").alias("known"))
    state = slim.join(known, F.col("parent") == F.col("known"), "left").select("tree", "node", F.col("known").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("sum"))
    state = materialise(state, "pointers")
    jumps, rounds = [], max(1, math.ceil(math.log2(max(2, slim.count())))) + 1
    for _ in range(rounds):
        if not state.where("up IS NOT NULL").take(1):
            break
        jumps.append(state.where("up IS NOT NULL").select(F.col("node").alias("j_node"), F.col("up").alias("j_up")))
        above = state.select(F.col("node").alias("a_node"), F.col("up").alias("a_up"), F.col("depth").alias("a_depth"), F.col("sum").alias("a_sum"))
        state = state.join(above, F.col("up") == F.col("a_node"), "left").select(
            "tree", "node", F.col("a_up").alias("up"), (F.col("depth") + F.coalesce("a_depth", F.lit(0))).alias("depth"), (F.col("sum") + F.coalesce("a_sum", F.lit(0.0))).alias("sum")
        )
        state = materialise(state, "pointers")
    parents = slim.select(F.col("parent").alias("p")).where("p IS NOT NULL").distinct()
    leaves = state.where("up IS NULL").join(parents, F.col("node") == F.col("p"), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("sum"), F.desc("depth"), "node"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= paths).select(F.col("node").alias("path"), "tree", "depth", "node")
    for k, jump in reversed(list(enumerate(jumps))):
        up = chosen.join(jump, F.col("node") == F.col("j_node")).select("path", "tree", (F.col("depth") - (1 << k)).alias("depth"), F.col("j_up").alias("node"))
        chosen = materialise(chosen.unionByName(up), "path-nodes")
    return chosen


def format_paths(chosen: DataFrame, messages: DataFrame) -> DataFrame:
    """``tree, path, formatted, loss``: one text per path and the code point ranges to train on."""
    said = messages.select(F.col("node").alias("m_node"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit("<s>["), escape(F.col("role")), F.lit("]\n"))
    turn = chosen.join(said, F.col("node") == F.col("m_node")).select(
        "tree", "path", "depth", F.expr(f"(depth - 1) div {PIECE}").alias("piece"),
        F.struct("depth", F.concat(head, escape(F.col("text")), F.lit("</s>")).alias("turn"), F.length(head).alias("at"), (F.col("role") == LOSS_ROLE).alias("trained")).alias("t"),
    )
    ranges = "array<struct<start:long,end:long>>"
    pieces = turn.groupBy("tree", "path", "piece").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    measured = f"""aggregate(ts, struct(0L AS at, cast(array() AS {ranges}) AS out), (acc, x) -> struct(
      acc.at + length(x.turn) AS at,
      CASE WHEN x.trained THEN concat(acc.out, array(struct(acc.at + x.at AS start, acc.at + length(x.turn) - 4 AS end))) ELSE acc.out END AS out), acc -> acc.out)"""
    pieces = pieces.select("tree", "path", F.struct("piece", F.array_join("ts.turn", "").alias("body"), F.expr(measured).alias("loss")).alias("p"))
    whole = pieces.groupBy("tree", "path").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    shifted = f"""aggregate(ps, struct(0L AS at, cast(array() AS {ranges}) AS out), (acc, p) -> struct(
      acc.at + length(p.body) AS at, concat(acc.out, transform(p.loss, s -> struct(acc.at + s.start AS start, acc.at + s.end AS end))) AS out), acc -> acc.out)"""
    return whole.select("tree", "path", F.array_join("ps.body", "").alias("formatted"), F.expr(shifted).alias("loss"))


def read_back(formatted: Column) -> Column:
    """Turns ``role, text`` of a formatted conversation."""
    turns = F.filter(F.split(formatted, "</s>", -1), lambda x: x != "")
    role = lambda x: F.substring_index(F.substring(x, F.lit(5), F.length(x)), "]\n", 1)
    return F.transform(turns, lambda x: F.struct(unescape(role(x)).alias("role"), unescape(F.substring(x, F.length(role(x)) + 7, F.length(x))).alias("text")))


def op3_chat(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], table.schema)
    messages = materialise(chain(table.unionByName(extra), "conv_id", ["turn", "role", "text"]), "reply-trees")
    chosen = best_paths(messages.withColumn("score", F.lit(0.0)), "conv_id")
    done = format_paths(chosen, messages).withColumn("turns", read_back(F.col("formatted")))
    trained = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    done = done.withColumn("trained", trained)
    return done.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escape_sql(name: str) -> str:
    for plain, reference in _REFERENCES:
        name = f"replace({name}, '{plain}', '{reference}')"
    return name


OP3_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  sum(length({_escape_sql("role")}) + length({_escape_sql("text")}) + 10)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
