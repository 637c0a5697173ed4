"""Chat formatting with cumulative-snapshot collapse.

Loggers often store a conversation anew after each turn. Turns are hashed with their position, role
and text; the hashes of a conversation's first k turns, combined, are its prefix hash at k. A
conversation whose whole hash is the prefix hash of a longer one is a snapshot and goes, by anti-join
on hashes that were made distinct before. Of equal conversations the smallest id stays. What is left is rendered.

Turns are numbered by place, not by their own number, which may repeat or be null: equal turns of a
conversation are counted first, the distinct ones are dealt into ranges and numbered within each, and only
totals, one row per range and conversation, are ordered per conversation. Ranges are told apart by the first
``REACH`` characters of a text, as their bounds come from a sample that the driver holds.

Long conversations are handled in blocks of ``block`` places: prefix hashes run within a block and over
block totals, and a conversation is rendered as one row per block. So no task gets all turns of a
conversation that holds a large part of the rows, whatever its turn numbers are; only one row per block is
ordered per conversation.

Defined results: turns are ordered by number, then role, then text, nulls first; repeated rows are
turns of their own. A null role is rendered as ``unknown`` and a null text as empty, yet both differ
from those strings when compared. Turns without ``conv_id`` form one conversation whose id is null.
Further columns are ignored. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinflow.session import Rounds, cut

# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ORDER = ("turn", "role", "text")
REACH = 1024


def _key(conv: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("~"))


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.select(
        F.col(conv).alias("conv"), _key(F.col(conv)).alias("key"), F.isnull(F.col(turn)).alias("blank"),
        F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"),
    )


def placed(rows: DataFrame, block: int) -> DataFrame:
    """``key, conv, blank, blanks, block, since, copies, role, text``: equal turns in a block, their first
    place, from 0, and their number. Turns without number, ``blanks`` in all, have places of their own."""
    rounds, seq = Rounds(rows.sparkSession, "chat-turns"), ["key", "blank"]
    tied = rows.groupBy("key", "conv", "blank", *ORDER).agg(F.count("*").alias("n"))
    # Written once: the ranges are found by sampling, and all uses below must see the same ones.
    ranged = rounds.put(tied.repartitionByRange(
        "key", "blank", "turn", "role", F.substring("text", 1, REACH)
    ).withColumn("range", F.spark_partition_id()))
    totals = ranged.groupBy("range", *seq).agg(F.sum("n").alias("total"))
    before = Window.partitionBy(*seq).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("range", *seq, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    blanks = totals.filter("blank").groupBy("key").agg(F.sum("total").alias("blanks"))
    inner = Window.partitionBy("range", *seq).orderBy(*[F.col(c).asc_nulls_first() for c in ORDER])
    inner = inner.rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("at", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    at = within.join(starts, ["range", *seq]).withColumn("at", F.col("at") + F.col("start"))
    size, last = F.lit(block), F.col("at") + F.col("n") - 1
    cuts = at.join(blanks, "key", "left").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("at") / size), F.floor(last / size)))
    )
    since = F.greatest("at", F.col("block") * size)
    return rounds.put(cuts.select(
        *seq, "conv", F.coalesce("blanks", F.lit(0)).cast("long").alias("blanks"), F.col("block").cast("long").alias("block"),
        since.cast("long").alias("since"),
        (F.least(last, F.col("block") * size + size - 1) - since + 1).cast("int").alias("copies"), "role", "text",
    ))


def _earlier() -> Window:
    return Window.partitionBy("key").orderBy(F.desc("blank"), "block").rowsBetween(Window.unboundedPreceding, -1)


def prefix_hashes(rows: DataFrame) -> DataFrame:
    """``key, conv, pos, one, two``: per turn its position, from 1, and the two prefix hashes there."""
    block = ["key", "blank", "block"]
    hashed = rows.select(
        *block, "conv",
        F.xxhash64(F.lit(1), "role", F.isnull("role"), "text", F.isnull("text")).alias("a"),
        F.xxhash64("text", F.isnull("role"), F.lit(2), "role", F.isnull("text")).alias("b"),
        (F.col("since") + F.when(F.col("blank"), 1).otherwise(F.col("blanks") + 1)).alias("first"), "copies",
    )
    each = hashed.withColumn("pos", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)))
    turns = cut(each.select(
        *block, "conv", "pos", F.xxhash64("pos", "a").alias("a"), F.xxhash64("b", "pos").alias("b"),
    ), "chat-hashes")
    totals = turns.groupBy(*block).agg(F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))
    before = totals.select(
        *block, *[F.coalesce(F.bit_xor(x).over(_earlier()), F.lit(0)).alias(x) for x in ("xa", "xb")],
    )
    running = Window.partitionBy(*block).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    within = turns.select(
        *block, "conv", "pos", F.bit_xor("a").over(running).alias("a"), F.bit_xor("b").over(running).alias("b"),
    )
    return within.join(before, block).select(
        "key", "conv", "pos",
        F.col("a").bitwiseXOR(F.col("xa")).alias("one"), F.col("b").bitwiseXOR(F.col("xb")).alias("two"),
    )


def maximal(rows: DataFrame) -> DataFrame:
    """``key, n_turns, n_copies``: the conversations that no longer one starts with."""
    prefixes = cut(prefix_hashes(rows), "chat-prefixes")
    lengths = prefixes.groupBy("key").agg(F.max("pos").alias("last"))
    ends = prefixes.join(lengths, ["key"]).withColumn("is_end", F.col("pos") == F.col("last"))
    ends = cut(ends.groupBy("pos", "one", "two").agg(
        F.min(F.when(F.col("is_end"), F.struct("conv", "key"))).alias("least"),
        F.min(F.when(F.col("is_end") & F.col("conv").isNotNull(), F.struct("conv", "key"))).alias("named"),
        F.count_if("is_end").alias("n_copies"),
        F.count_if(~F.col("is_end")).alias("n_longer"),
    ), "chat-ends")
    snapshots = ends.filter("n_longer > 0").select("pos", "one", "two")
    whole = ends.filter("n_copies > 0").join(snapshots, ["pos", "one", "two"], "left_anti")
    return whole.select(
        F.coalesce(F.col("named.key"), F.col("least.key")).alias("key"),
        F.col("pos").alias("n_turns"), "n_copies",
    )


def render(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block: int = 256,
) -> DataFrame:
    """The kept conversations as training text: ``conv_id, part, n_turns, n_copies, text``.

    ``part`` is the block of places a row holds, ``n_turns`` the length of the whole conversation. Turns
    without number come first, in parts of their own: null, then the numbers below 0.
    """
    rows = placed(_turns(turns, conv, turn, role, text), block)
    kept = cut(maximal(rows), "chat-kept")
    parts = rows.join(kept, "key").groupBy("key", "blank", "blanks", "block", "conv", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(F.struct("since", "copies", "role", "text"))).alias("turns")
    )
    said = F.transform("turns", lambda t: F.repeat(F.concat(
        F.lit(OPEN), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"),
        F.coalesce(t["text"], F.lit("")), F.lit(CLOSE), F.lit("\n"),
    ), t["copies"]))
    below = F.when(F.col("block") > 0, F.col("block") - F.ceil(F.col("blanks") / block))
    return parts.select(
        F.col("conv").alias("conv_id"), F.when(F.col("blank"), below).otherwise(F.col("block")).alias("part"),
        "n_turns", "n_copies", F.array_join(said, "").alias("text"),
    )
