"""Preference formatting: the turns two conversations share are the prompt, what follows are the paired completions.

A turn's place in a conversation is its turn number and, where a number repeats, the order of (role, text) within it. Two
conversations share a prefix up to the first place where one of them has no turn or another one. Rows stay turns all the
way, so a conversation of any length is spread over the cluster: the prefix comes from one equi-join on (pair, place)
and a partial minimum, never from collected conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediacat.llm.common import written

# The template of a rendered turn.
HEAD, MIDDLE, TAIL = "<|", "|>\n", "<|end|>\n"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), F.coalesce(role, F.lit("")), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(TAIL))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, again (0, 1, ... among turns of one number), role, text. Rows without conv_id or turn are left out.

    A null role or text is kept and differs from the empty one only in order; both are rendered empty.
    """
    order = Window.partitionBy("conv_id", "turn").orderBy(F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    return (
        conversations.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
        .withColumn("again", F.row_number().over(order) - 1)
    )


def preference_turns(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Render pairs of conversations.

    chosen, rejected: pair_id, turn, again, role, text, with (turn, again) a key within a pair. Returns one row per rendered
    turn: pair_id, part ("prompt" once, "chosen", "rejected"), turn, again, role, text (rendered), trained (whether the
    loss counts this turn: assistant turns of a completion; prompts are masked).
    A pair whose sides are equal is all prompt; a side that ends first has no completion; a pair with one side only
    has an empty prompt. Empty tables give no rows.
    """
    place = F.struct("turn", "again")
    both = chosen.select("pair_id", "turn", "again", F.struct("role", "text").alias("a")).join(
        rejected.select("pair_id", "turn", "again", F.struct("role", "text").alias("b")), ["pair_id", "turn", "again"], "full"
    )
    differs = ~(F.col("a.role").eqNullSafe(F.col("b.role")) & F.col("a.text").eqNullSafe(F.col("b.text")))
    missing = F.col("a").isNull() | F.col("b").isNull()
    splits = both.where(missing | differs).groupBy("pair_id").agg(F.min(place).alias("split"))
    splits = written(splits, "preference-splits")

    def side(df: DataFrame, part: str) -> DataFrame:
        shared = F.col("split").isNull() | (place < F.col("split"))
        rows = df.join(splits, "pair_id", "left").withColumn("part", F.when(shared, F.lit("prompt")).otherwise(F.lit(part)))
        return rows if part == "chosen" else rows.where("part <> 'prompt'")  # the prompt is rendered once

    return side(chosen, "chosen").unionByName(side(rejected, "rejected")).select(
        "pair_id", "part", "turn", "again", "role",
        rendered(F.col("role"), F.col("text")).alias("text"),
        ((F.col("part") != "prompt") & (F.coalesce("role", F.lit("")) == "assistant")).alias("trained"),
    )


def next_ids(conversations: DataFrame) -> DataFrame:
    """conv_id, next_id: each id and the next higher one; the highest has none.

    Ids are dealt out by ranges, so none of the windows takes all of them; only one row per range is compared across ranges.
    """
    ranged = written(conversations.select("conv_id").distinct().repartitionByRange("conv_id").withColumn("slice", F.spark_partition_id()), "conversation-ids")
    slices = ranged.groupBy("slice").agg(F.min("conv_id").alias("first"))
    in_turn = Window.orderBy("slice")
    around = F.coalesce(F.lead("first").over(in_turn), F.min("first").over(in_turn))
    following = slices.select("slice", around.alias("following"))
    inside = F.lead("conv_id").over(Window.partitionBy("slice").orderBy("conv_id"))
    return (
        ranged.withColumn("inside", inside).join(F.broadcast(following), "slice")  # one row per range
        .select("conv_id", F.coalesce("inside", "following").alias("next_id")).where("next_id <> conv_id")
    )


def swapped_endings(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: a conversation as it is, and with the text of its last assistant turn replaced by
    the last assistant turn of the next conversation that has one: the next higher such id in the table, however far, and after
    the last the first again.

    A conversation without an assistant turn makes no pair, nor does one that is alone in having one.
    """
    rows = written(turns(conversations), "turns")
    last = (
        rows.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "again")).alias("at"))
        .select("conv_id", F.col("at.turn").alias("turn"), F.col("at.again").alias("again"))
    )
    answers = written(rows.join(last, ["conv_id", "turn", "again"]).select("conv_id", "turn", "again", F.col("text").alias("answer")), "answers")
    given = answers.join(next_ids(answers).select(F.col("conv_id").alias("pair_id"), F.col("next_id").alias("conv_id")), "conv_id").select("pair_id", "answer")
    swap = written(
        answers.select(F.col("conv_id").alias("pair_id"), F.col("turn").alias("last_turn"), F.col("again").alias("last_again")).join(given, "pair_id"),
        "swaps",
    )
    named = rows.withColumnRenamed("conv_id", "pair_id")
    paired = named.join(swap, "pair_id")
    is_last = (F.col("turn") == F.col("last_turn")) & (F.col("again") == F.col("last_again"))
    columns = ["pair_id", "turn", "again", "role"]
    return (
        paired.select(*columns, "text"),
        paired.where(place_before_or_at()).select(*columns, F.when(is_last, F.col("answer")).otherwise(F.col("text")).alias("text")),
    )


def place_before_or_at() -> Column:
    """Turns up to the last assistant turn."""
    return F.struct("turn", "again") <= F.struct("last_turn", "last_again")


def examples(segments: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen and rejected as texts, and the characters of each completion that are trained.

    For pairs that fit one row; `preference_turns` has no such bound.
    """
    ordered = F.sort_array(F.collect_list(F.struct("turn", "again", "text", "trained")))
    parts = segments.groupBy("pair_id", "part").agg(ordered.alias("turns"))
    parts = parts.select(
        "pair_id", "part", F.expr("array_join(transform(turns, t -> t.text), '')").alias("text"),
        F.expr(
            "filter(aggregate(turns, struct(0 as at, cast(array() as array<struct<start:int,stop:int>>) as spans), "
            "(a, t) -> struct(a.at + length(t.text) as at, if(t.trained, concat(a.spans, array(struct(a.at as start, a.at + length(t.text) as stop))), a.spans) as spans)).spans, x -> true)"
        ).alias("spans"),
    )
    return parts.groupBy("pair_id").pivot("part", ["prompt", "chosen", "rejected"]).agg(F.first("text").alias("text"), F.first("spans").alias("spans")).drop("prompt_spans")
