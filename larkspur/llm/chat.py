"""Chat formatting: collapse of cumulative snapshots and rendering, in DataFrame functions only.

A logging client that stores the conversation after every turn leaves many conversations that are prefixes of a longer one.
Each turn extends a rolling SHA-256 of the turns so far. A conversation is a snapshot if its last hash is an inner hash of
another conversation: an anti-join against the distinct inner hashes removes it. Conversations that are equal keep the one
with the smallest conv_id. Both sides of the anti-join have one row for each hash, so a first turn or a conversation that a
third of all logs share is one row, not a hot key.

One conversation is one row of the result, so its turns meet in one row by definition; conversations never meet. The list of hashes
is folded in two levels, runs of ``RUN`` turns and then a run's turns, so a conversation of n turns copies about n * sqrt(n) hashes at
the usual lengths and not n * n.

Edge cases: turns go by turn, then role, then text, nulls first; repeated rows are repeated turns. A null role or text hashes
apart from an empty one and renders empty. Marks inside a role or text are rendered as they stand, so texts that hold
``<|im_end|>`` must be cleaned before, if a reader takes marks for turn borders; the collapse does not look at them. Rows with a null
conv_id are one conversation of that id. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
RUN = 64  # turns of a run of the fold


def _field(value: Column) -> Column:
    return F.when(value.isNull(), "-").otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value))


def _turns(conversations: DataFrame) -> DataFrame:
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # Every step appends the hash of (hash before it, turn): the last element is the hash of the whole conversation.
    def follow(run: Column, turn: Column) -> Column:
        step = F.concat(_field(turn["role"]), F.lit("|"), _field(turn["text"]))
        return F.array_append(run, F.sha2(F.concat(F.element_at(run, -1), step), 256))

    def follow_run(runs: Column, k: Column) -> Column:
        """Appends a run that starts with the last hash of the one before (or the empty text)."""
        last = F.element_at(F.element_at(runs, -1), -1)
        return F.array_append(runs, F.aggregate(F.slice("turns", k * RUN + 1, RUN), F.array(last), follow))

    runs = F.sequence(F.lit(0), F.floor((F.size("turns") - 1) / RUN).cast("int"))
    rolled = F.aggregate(runs, F.array(F.array(F.lit(""))), follow_run)
    hashes = F.flatten(F.transform(rolled, lambda run: F.slice(run, 2, RUN)))
    return turns.withColumn("hashes", hashes)


def render(turns: Column) -> Column:
    """One line of role, then the text, between start and end marks, for each turn."""
    lines = F.transform(turns, lambda t: F.concat(F.lit(START), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(END + "\n")))
    return F.array_join(lines, "")


def collapse(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal (equal conversations it stands for, itself included) and rendered text of every maximal conversation."""
    found = _turns(conversations).select("conv_id", F.size("turns").cast("long").alias("n_turns"), "hashes", F.element_at("hashes", -1).alias("whole"))
    whole = found.groupBy("whole").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"), F.any_value("n_turns").alias("n_turns"))
    inner = found.select(F.explode(F.slice("hashes", 1, F.size("hashes") - 1)).alias("whole")).distinct()
    maximal = whole.join(inner, "whole", "left_anti")
    texts = _turns(conversations).select(F.col("conv_id").alias("id"), render(F.col("turns")).alias("rendered"))
    kept = maximal.join(texts, F.col("conv_id").eqNullSafe(F.col("id")))
    return kept.select("conv_id", "n_turns", "n_equal", "rendered")
