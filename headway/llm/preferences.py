"""Preference formatting: one prompt and two masked completions per pair of conversations.

The longest common turn prefix of the chosen and the rejected conversation is rendered once as the
prompt; the turns after it are rendered per side as completions, in which only assistant turns are
trained on.  The result has one row per rendered turn, with its place in the prompt or completion it
belongs to, so a conversation of any length is many rows, never one value; ``assemble`` joins the rows of
conversations that fit into a row.

Turns meet by grouping on (pair, turn); the first differing turn of a pair is a partially aggregated
minimum; places are two-level prefix sums over ranges of ``RANGE`` turns.  DataFrame functions only.

Defined cases: rows without pair or turn take no part; null role or text counts as empty; repeated
equal rows count once; different rows of one turn follow each other by role and text; a pair with one
side only has an empty prompt and the other completion empty (no rows); turn numbers are compared as
they are, so a gap on one side ends the prefix; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import prepare

TRAINED = "assistant"
RANGE = 1024


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def format_pairs(turns: DataFrame) -> DataFrame:
    """``turns(pair_id, chosen boolean, turn, role, text)`` -> pair_id, part (prompt, chosen, rejected),
    turn, nth, role, rendered, start, length, trained."""
    rows = (turns.where("pair_id is not null and turn is not null and chosen is not null")
            .select("pair_id", "chosen", F.col("turn").cast("long").alias("turn"),
                    F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .distinct())
    nth = F.row_number().over(Window.partitionBy("pair_id", "chosen", "turn").orderBy("role", "text"))
    rows = rows.withColumn("nth", nth)
    said = F.struct("role", "text")
    met = rows.groupBy("pair_id", "turn", "nth").agg(
        F.max(F.when(F.col("chosen"), said)).alias("c"), F.max(F.when(~F.col("chosen"), said)).alias("r"))
    same = F.coalesce(F.col("c") == F.col("r"), F.lit(False))
    met = met.withColumn("same", same)
    cut = met.groupBy("pair_id").agg(F.min(F.when(~F.col("same"), F.struct("turn", "nth"))).alias("cut"))
    place = F.struct("turn", "nth")
    both = met.join(cut, "pair_id").withColumn("common", F.col("cut").isNull() | (place < F.col("cut")))
    parts = F.when(F.col("common"), F.array(F.struct(F.lit("prompt").alias("part"), F.col("c").alias("said")))) \
        .otherwise(F.array(F.struct(F.lit("chosen").alias("part"), F.col("c").alias("said")),
                           F.struct(F.lit("rejected").alias("part"), F.col("r").alias("said"))))
    segments = (both.select("pair_id", "turn", "nth", F.explode(parts).alias("x")).where("x.said is not null")
                .select("pair_id", F.col("x.part").alias("part"), "turn", "nth", F.col("x.said.role").alias("role"),
                        rendered(F.col("x.said.role"), F.col("x.said.text")).alias("rendered"))
                .withColumn("length", F.length("rendered").cast("long"))
                .withColumn("range", F.floor(F.col("turn") / RANGE)))
    keys = ["pair_id", "part", "range"]
    before = Window.partitionBy("pair_id", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = (segments.groupBy(*keys).agg(F.sum("length").alias("s"))
            .select(*keys, F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base")))
    inner = Window.partitionBy(*keys).orderBy("turn", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return segments.join(base, keys).select(
        "pair_id", "part", "turn", "nth", "role", "rendered",
        (F.col("base") + F.coalesce(F.sum("length").over(inner), F.lit(0))).cast("long").alias("start"),
        "length", ((F.col("part") != "prompt") & (F.col("role") == TRAINED)).alias("trained"))


def neighbours_as_pairs(conversations: DataFrame) -> DataFrame:
    """Conversations 2p (chosen) and 2p + 1 (rejected) become pair p."""
    return conversations.select(
        F.shiftright(F.col("conv_id").cast("long"), 1).alias("pair_id"), (F.pmod(F.col("conv_id"), F.lit(2)) == 0).alias("chosen"),
        "turn", "role", "text")


def preference_report(conversations: DataFrame) -> DataFrame:
    prepare(conversations.sparkSession)
    return format_pairs(neighbours_as_pairs(conversations))


def assemble(segments: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected texts and the trained character spans of each completion.
    Only for conversations that fit into one row."""
    def text(part: str) -> Column:
        turns = F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct("start", "rendered"))))
        return F.array_join(F.transform(turns, lambda x: x["rendered"]), "")

    def spans(part: str) -> Column:
        return F.sort_array(F.collect_list(F.when((F.col("part") == part) & F.col("trained"), F.struct(
            F.col("start"), (F.col("start") + F.col("length")).alias("end")))))

    return segments.groupBy("pair_id").agg(
        text("prompt").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"),
        spans("chosen").alias("chosen_trained"), spans("rejected").alias("rejected_trained"))
