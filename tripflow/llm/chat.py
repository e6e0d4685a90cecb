"""Chat formatting: cumulative snapshots of a conversation collapse into the longest one, which is rendered.

A conversation is logged again and again while it grows, each time under a new id. Every turn gets a hash of
role and text; along a conversation these roll into one hash per prefix. A conversation whose whole hash is the hash of
a proper prefix of another is a snapshot of it and goes (an anti-join on hashes); of equal conversations the
one with the smallest id stays. Only turn hashes are shuffled for this, and the texts of what stays once, to render them.

Turns are ordered by number. Under one number system comes before user, user before assistant, assistant before any
other role, and equal roles go by hash.

Defined results: null roles and texts count as empty; rows that agree in all columns are one turn; each row
without conv_id is a conversation of its own, which a copy with an id replaces; a turn marker inside a role or text is broken up by a
space, so that none can pass for a turn; an empty table gives an empty table; other columns are ignored, so no
name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import session, stored

ROLES = ("system", "user", "assistant")
# Lists of kept conversations up to so many rows are sent to all executors; longer ones are shuffled.
BROADCAST_ROWS = 1_000_000


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, rank, hash, role, text), with nulls as empty texts; `conv` is the id in a struct: never null."""
    # A row without conv_id has only itself to go with; its digest tells it from others, and copies of it are one.
    whole = F.concat_ws("|", F.col("turn").cast("string"), F.octet_length("role").cast("string"), "role", "text")
    given = conversations.select(
        F.struct("conv_id", F.when(F.col("conv_id").isNull(), F.md5(whole.cast("binary"))).alias("own")).alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")), F.lit(0))
    rank = F.when(rank > 0, rank).otherwise(len(ROLES) + 1).cast("int")
    # The role's length keeps role and text apart.
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return given.select("conv", "turn", rank.alias("rank"), F.md5(whole.cast("binary")).alias("hash"), "role", "text")


def prefix_hashes(turns: list[str]) -> list[str]:
    """The hash of each prefix, from the hash of the one before it and the next turn's."""
    out, last = [], ""
    for turn in turns:
        last = hashlib.md5((last + turn).encode()).hexdigest()
        out.append(last)
    return out


def chains(turns: DataFrame) -> DataFrame:
    """(conv, hash, whole): one row per turn with the hash of all up to it; `whole` marks the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, found, whole = [], [], []
            for k, hashes in enumerate(batch.column("hashes").to_pylist()):
                place += [k] * len(hashes)
                found += prefix_hashes(hashes)
                whole += [False] * (len(hashes) - 1) + [True]
            conv = batch.column("conv").take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [conv, pa.array(found, pa.string()), pa.array(whole, pa.bool_())], ["conv", "hash", "whole"]
            )

    # Rows that agree in all columns are one turn.
    lists = turns.groupBy("conv").agg(F.sort_array(F.collect_set(F.struct("turn", "rank", "hash"))).alias("t"))
    lists = lists.select("conv", F.transform("t", lambda x: x["hash"]).alias("hashes"))
    schema = T.StructType(
        [lists.schema["conv"], T.StructField("hash", T.StringType()), T.StructField("whole", T.BooleanType())]
    )
    return lists.mapInArrow(run, schema)


def longest(turns: DataFrame) -> DataFrame:
    """The `conv` of each conversation that no other continues, one for equal ones."""
    chained = stored(chains(turns), "chains")
    # A conversation without id gives way to an equal one that has an id.
    ranked = F.struct(F.col("conv.conv_id").isNull().alias("no_id"), "conv")
    whole = chained.where("whole").groupBy("hash").agg(F.min(ranked).alias("first"))
    inner = chained.where("not whole").select("hash").distinct()
    return whole.join(inner, "hash", "left_anti").select(F.col("first.conv").alias("conv"))


def rendered(role: F.Column, text: F.Column) -> F.Column:
    plain = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), plain(role), F.lit("\n"), plain(text), F.lit("<|im_end|>\n"))


def chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns and the rendered text of each conversation that stays."""
    turns = _turns(conversations)
    kept = stored(longest(turns), "kept")
    kept = F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept
    turn = F.struct("turn", "rank", "hash", rendered(F.col("role"), F.col("text")).alias("part"))
    whole = turns.join(kept, "conv", "left_semi").groupBy("conv").agg(F.sort_array(F.collect_set(turn)).alias("t"))
    return whole.select(
        F.col("conv.conv_id").alias("conv_id"),
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["part"]), "").alias("text"),
    )


# The result of `chats`, with sequences compared as lists of turn hashes. SQL's md5 is that of the UTF-8 bytes.
CHAT_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             CASE WHEN conv_id IS NULL THEN concat(CAST(turn AS VARCHAR), '|', strlen(role), '|', role, '|', text) END AS own FROM conversations),
h AS (SELECT *, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 WHEN 'assistant' THEN 3 ELSE 4 END AS k,
             md5(concat(CAST(strlen(role) AS VARCHAR), ':', role, text)) AS h,
             concat('<|im_start|>', replace(role, '<|', '< |'), chr(10), replace(text, '<|', '< |'), '<|im_end|>', chr(10)) AS r
      FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, list(h ORDER BY turn NULLS FIRST, k, h) AS hs,
             string_agg(r, '' ORDER BY turn NULLS FIRST, k, h) AS text FROM h GROUP BY conv_id, own),
p AS (SELECT DISTINCT array_to_string(hs[1:i], '') AS s FROM (SELECT hs, unnest(range(1, len(hs))) AS i FROM c)),
o AS (SELECT *, array_to_string(hs, '') AS s,
             row_number() OVER (PARTITION BY array_to_string(hs, '') ORDER BY conv_id NULLS LAST) AS place FROM c)
SELECT conv_id, n_turns, text, length(text) AS n_chars FROM o WHERE place = 1 AND s NOT IN (SELECT s FROM p)
"""


def op1(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    found = chats(spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet"))
    return found.select("conv_id", "n_turns", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op1_chat_format": op1}
ORACLES = {"op1_chat_format": CHAT_SQL}
