"""Multi-party dialogues, rendered once from every participant's point of view.

In the sample of a participant, that participant's turns are the assistant's, those of others are turns of named users, and system turns
stay. Only the assistant's words and the end mark after them are trained on. A sample comes as segments, one per
turn, in order: their texts joined are the sample, and each segment knows its code points in it and the part that is trained on.

No dialogue is gathered in a task, however long: places and offsets are running sums over blocks of turns, then over the turns of a block,
then over the rows of a turn.

Defined cases: rows equal in all columns are one turn; a null role speaks as ``unknown``; a null text is empty; null turns
come first, equal turns in the order of role and text; a null conv_id is a dialogue of its own; a dialogue with system turns
only has no participant, so no sample; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import match

# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
BLOCK = 1024


def running(df: DataFrame, group: list[str], levels: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add, for every entry of ``sums`` (result -> column), the sum over the rows before this one in its group.

    ``levels`` are columns from coarse to fine; sorting by them and then by ``order`` is the order of a group. A window
    only ever sees the blocks of a block one level up.
    """
    total = df.withColumns({f"_off_{r}": F.lit(0).cast("long") for r in sums})
    for depth, level in enumerate(levels):
        keys = [*group, *levels[:depth]]
        own = df.groupBy(*keys, level).agg(*[F.sum(c).alias(f"_sum_{r}") for r, c in sums.items()])
        before = Window.partitionBy(*keys).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        placed = own.select(*keys, level, *[F.coalesce(F.sum(f"_sum_{r}").over(before), F.lit(0)).alias(f"_add_{r}") for r in sums])
        total = match(total, placed, [*keys, level])
        total = total.withColumns({f"_off_{r}": F.col(f"_off_{r}") + F.col(f"_add_{r}") for r in sums})
        total = total.drop(*[f"_add_{r}" for r in sums])
    inside = Window.partitionBy(*group, *levels).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = {r: F.col(f"_off_{r}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for r, c in sums.items()}
    return total.withColumns(found).drop(*[f"_off_{r}" for r in sums])


def _header(role: Column, name: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise(""), F.lit("\n"))


def perspectives(turns: DataFrame) -> DataFrame:
    """One row per dialogue, participant and turn: the segment, its place and code points, and what is trained on."""
    said = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("body"),
    )
    said = said.groupBy("conv_id", "turn", "speaker", "body").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    present = said.where(F.col("speaker") != SYSTEM).groupBy("conv_id", "speaker").agg(F.count(F.lit(1)).alias("_n"))
    present = present.select("conv_id", F.col("speaker").alias("perspective"))
    rows = match(said, present, ["conv_id"])
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == SYSTEM
    role = F.when(own, "assistant").when(system, SYSTEM).otherwise("user")
    name = F.when(~own & ~system, F.col("speaker"))
    rows = rows.withColumn("role", role).withColumn("name", name)
    rows = rows.withColumn("segment", F.concat(_header(F.col("role"), F.col("name")), F.col("body"), F.lit(CLOSE)))
    rows = rows.withColumn("_chars", F.length("segment").cast("long")).withColumn("_one", F.lit(1).cast("long"))
    rows = rows.withColumn("_block", F.floor(F.col("turn") / BLOCK))
    placed = running(
        rows, ["conv_id", "perspective"], ["_block", "turn"], ["speaker", "body"], {"position": "_one", "start": "_chars"}
    )
    header = F.length("segment") - F.length("body") - len(CLOSE)
    trained = F.col("role") == "assistant"
    return placed.select(
        "conv_id",
        "perspective",
        "position",
        "turn",
        "speaker",
        "role",
        "segment",
        "start",
        (F.col("start") + F.col("_chars")).alias("end"),
        F.when(trained, F.col("start") + header).alias("train_start"),
        F.when(trained, F.col("start") + F.col("_chars") - 1).alias("train_end"),
    )


def samples(segments: DataFrame) -> DataFrame:
    """Whole samples: text and trained spans per dialogue and participant, for dialogues that fit into a row."""
    cells = F.sort_array(F.collect_list(F.struct("position", "segment", "train_start", "train_end")))
    one = segments.groupBy("conv_id", "perspective").agg(cells.alias("cells"))
    trained = F.filter("cells", lambda c: c["train_start"].isNotNull())
    return one.select(
        "conv_id",
        "perspective",
        F.array_join(F.transform("cells", lambda c: c["segment"]), "").alias("text"),
        F.transform(trained, lambda c: F.struct(c["train_start"].alias("start"), c["train_end"].alias("end"))).alias("trained"),
    )
