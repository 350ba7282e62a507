"""Chat formatting for preference training: one prompt, two masked completions.

For each pair of conversations the longest common prefix of turns is rendered once, as the prompt.  What each of the
two goes on with is its completion, with a mask that tells trained text (what the assistant says) from the rest (marks
and other roles).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.common import col, partitions, ranges, with_range

#: What stands before and after the text of a turn.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"
#: Documented order of turns that share a number: by role, system first, then user, then others.
ROLE_ORDER = ("system", "user", "assistant")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def numbered(turns: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(pair, place, role, text): the turns of each conversation, placed 0, 1, 2 ... by turn number.

    Turns with the same number come in :data:`ROLE_ORDER`, then by text.  Null numbers come first; null roles and texts
    are read as empty.  Turns without a conversation are left out.
    """
    given = turns.where(col(pair).isNotNull()).select(
        col(pair).alias("pair"), col(turn).alias("turn"), F.coalesce(col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )
    rank = F.array_position(F.array(*map(F.lit, ROLE_ORDER)), F.col("role"))
    order = Window.partitionBy("pair").orderBy("turn", F.when(rank == 0, 99).otherwise(rank), "role", "text")
    return given.select("pair", (F.row_number().over(order) - 1).alias("place"), "role", "text")


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair that both sides have turns of; each side is (pair, place, role, text) as :func:`numbered` gives.

    Columns: ``pair``; ``prompt_turns``, the turns in which the two agree from the start on; ``prompt``, these
    rendered; ``chosen`` and ``rejected``, the rest of each rendered; ``chosen_mask`` and ``rejected_mask``, arrays of
    (start, end) in code points, end exclusive, of the trained stretches of the completion.  Where the two are equal
    throughout, both completions are empty; where one ends first, its completion is.
    """
    a = chosen.select("pair", "place", F.col("role").alias("c_role"), F.col("text").alias("c_text"))
    b = rejected.select("pair", "place", F.col("role").alias("r_role"), F.col("text").alias("r_text"))
    both = a.join(b, ["pair", "place"], "full")
    same = F.coalesce((F.col("c_role") == F.col("r_role")) & (F.col("c_text") == F.col("r_text")), F.lit(False))
    # The first place where they part, or the end.
    marked = both.withColumn("parts", F.min(F.when(~same, F.col("place"))).over(Window.partitionBy("pair"))).withColumn("shared", F.col("parts").isNull() | (F.col("place") < F.col("parts")))

    def side(prefix: str) -> Column:
        there = F.col(f"{prefix}_role").isNotNull()
        return F.sort_array(F.collect_list(F.when(there, F.struct("place", "shared", F.col(f"{prefix}_role").alias("role"), F.col(f"{prefix}_text").alias("text")))))

    folded = marked.groupBy("pair").agg(side("c").alias("c"), side("r").alias("r")).where((F.size("c") > 0) & (F.size("r") > 0))

    def joined(turns: Column) -> Column:
        return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")

    def rest(turns: str) -> Column:
        return F.filter(turns, lambda t: ~t["shared"])

    def mask(turns: Column) -> Column:
        none = F.array().cast("array<struct<start:int,end:int>>")

        def step(so_far: Column, t: Column) -> Column:
            start = so_far["at"] + F.length(t["role"]) + len(OPEN) + len(MIDDLE)
            end = start + F.length(t["text"])
            span = F.when(t["role"] == TRAINED, F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(none)
            return F.struct((end + len(CLOSE)).alias("at"), F.concat(so_far["out"], span).alias("out"))

        return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda so_far: so_far["out"])

    prompt = F.filter("c", lambda t: t["shared"])
    return folded.select(
        "pair",
        F.size(prompt).alias("prompt_turns"),
        joined(prompt).alias("prompt"),
        joined(rest("c")).alias("chosen"),
        joined(rest("r")).alias("rejected"),
        mask(rest("c")).alias("chosen_mask"),
        mask(rest("r")).alias("rejected_mask"),
    )


def with_other_reply(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides made of plain conversations (pair, place, role, text), a whole number each.

    Chosen is the conversation up to its last assistant turn.  Rejected is the same with that turn's text taken from
    the last assistant turn of the conversation with the next larger number that has one; after the last comes the
    first.  Conversations without an assistant turn make no pair.
    """
    last = turns.where(F.col("role") == TRAINED).groupBy("pair").agg(F.max(F.struct("place", "text")).alias("reply")).select("pair", "reply.place", "reply.text")
    cuts = ranges(last, "pair", partitions(turns))
    placed = with_range(last, "pair", cuts, "part")
    following = F.lead("text").over(Window.partitionBy("part").orderBy("pair"))
    # The last of each range is followed by the first of the next: one row per range.
    heads = placed.groupBy("part").agg(F.min(F.struct("pair", "text")).alias("head"))
    ring = Window.orderBy("part")
    after = heads.select(F.col("part").alias("of"), F.coalesce(F.lead("head.text").over(ring), F.first("head.text").over(ring)).alias("opening"))
    replies = placed.withColumn("other", following).join(after, F.col("part") == F.col("of")).select("pair", F.col("place").alias("end"), F.coalesce("other", "opening").alias("other"))
    cut = turns.join(replies, "pair").where(F.col("place") <= F.col("end"))
    rejected = cut.withColumn("text", F.when(F.col("place") == F.col("end"), F.col("other")).otherwise(F.col("text")))
    return cut.select("pair", "place", "role", "text"), rejected.select("pair", "place", "role", "text")
