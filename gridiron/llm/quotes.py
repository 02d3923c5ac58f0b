"""Quotation linking of messages, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridiron.llm.common import hash128, others, unpack, written

#: Quote marks at the start of a line: one or more `>`, each after up to three blanks, and one blank.
#: The group is repeated possessively, which a line of any number of marks passes without a deeper stack.
MARKS = r"^((?: {0,3}+>)++) ?"
MESSAGE = ["conv", "turn", "m1", "m2"]
#: Sources are looked up within ranges of this many turns, and the last one of earlier ranges is carried in.
TURNS = 1024


def link_quotes(messages: DataFrame) -> DataFrame:
    """Finds whom each message answers from the passages it quotes, and orders conversations by replies.

    A line's quote level is its number of `>` marks.  A passage is a run of lines of one
    level, a blank own line ends it.  Passages and their single lines are hashed in
    lower case with white space collapsed and looked up among the messages' own passages
    and lines of the same conversation; of several sources the latest earlier turn
    counts.  A message answers the source of most quoted characters at its lowest quoted
    level that is found at all (ties: the later turn).  Roots and depths come from pointer
    doubling, whose tables are written each step.

    Returns the messages with `text` freed of quoted lines and these columns: n_quoted
    (quoted lines), n_found (passages and lines with a source), parent_turn (null if it
    answers none), root_turn, depth and place: the message's place in its conversation in
    reply order, from 0 without gaps.  Reply order is that of (root_turn, turn), nulls
    first: threads stay together and every message comes after the one it answers.  A
    null text is kept as null; messages of one conversation, turn, role and text are one
    message and share its place; rows with null conv_id or turn answer none and are their
    own root, and those with null conv_id count as one conversation; other columns are kept.
    """
    text = F.coalesce("text", F.lit(""))
    key = [
        F.col("conv_id").alias("conv"),
        F.col("turn").alias("turn"),
        *hash128(F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")), text), "m"),
    ]
    lines = F.split(text, "\n")
    quoted = F.filter(lines, lambda x: x.rlike(MARKS))
    own = F.filter(lines, lambda x: ~x.rlike(MARKS))
    known = messages.where("conv_id is not null and turn is not null").select(*key, lines.alias("lines"))
    known = known.dropDuplicates(MESSAGE)  # dealt as the windows over messages need it
    units = _units(known.select(*MESSAGE, F.posexplode("lines").alias("pos", "line")))
    parents = _parents(units)
    threads = _threads(parents)
    base = messages.select(
        others(messages, "conv_id", "turn", "text").alias("rest"),
        *key,
        F.when(F.col("text").isNotNull(), F.array_join(own, "\n")).alias("own"),
        F.size(quoted).alias("n_quoted"),
    )
    placed = _in_reply_order(base.select(*MESSAGE).distinct().join(threads.drop("p1", "p2", "r1", "r2"), MESSAGE, "left"))
    found = placed.select(*(F.col(c).alias(f"of_{c}") for c in MESSAGE), "n_found", "parent_turn", "root_turn", "depth", "place")
    joined = base.join(found, reduce(and_, (F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in MESSAGE)))
    return unpack(
        joined,
        messages.columns,
        {
            "conv_id": F.col("conv"),
            "turn": F.col("turn"),
            "text": F.col("own"),
            "n_quoted": F.col("n_quoted").cast("long"),
            "n_found": F.coalesce("n_found", F.lit(0)).cast("long"),
            "parent_turn": F.col("parent_turn"),
            "root_turn": F.col("root_turn"),
            "depth": F.coalesce("depth", F.lit(0)).cast("long"),
            "place": F.col("place"),
        },
    )


def _in_reply_order(messages: DataFrame) -> DataFrame:
    """Adds place to distinct messages.

    They are dealt to ranges of the order and counted within them, so a conversation may lie in many tasks.
    """
    order = ["root_turn", "turn", "m1", "m2"]
    rooted = messages.withColumn("root_turn", F.coalesce("root_turn", "turn"))
    dealt = written(rooted.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "ordered")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("conv", "part").agg(F.count("*").alias("n"))
    starts = counts.select(
        F.col("conv").alias("of_conv"), F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    at = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)) - 1
    same = F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("part") == F.col("of_part"))
    return dealt.withColumn("at", at).join(starts, same).withColumn("place", (F.col("at") + F.col("start")).cast("long"))


def _units(lines: DataFrame) -> DataFrame:
    """Passages and single lines that are not empty: the message, level, h1, h2 and size (characters)."""
    marks = F.regexp_extract("line", MARKS, 1)
    leveled = lines.select(
        *MESSAGE,
        "pos",
        F.length(F.regexp_replace(marks, " ", "")).alias("level"),
        F.lower(F.trim(F.regexp_replace(F.regexp_replace("line", MARKS, ""), r"\s+", " "))).alias("said"),
    )
    order = Window.partitionBy(*MESSAGE).orderBy("pos")
    starts = (F.lag("level").over(order).eqNullSafe(F.col("level")) & (F.lag("said").over(order) != "") & (F.col("said") != "")).cast("int")
    runs = leveled.withColumn("run", F.sum(1 - F.coalesce(starts, F.lit(0))).over(order)).where("said <> ''")
    passages = (
        runs.groupBy(*MESSAGE, "level", "run")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "said"))).alias("parts"))
        .select(*MESSAGE, "level", F.transform("parts", lambda p: p["said"]).alias("said"))
    )
    each = passages.select(
        *MESSAGE,
        "level",
        F.explode(F.array_distinct(F.concat(F.array(F.array_join("said", " ")), F.col("said")))).alias("said"),
    )
    return each.select(*MESSAGE, "level", *hash128(F.col("said"), "h"), F.length("said").alias("size"))


def _parents(units: DataFrame) -> DataFrame:
    """Each message that quotes with its parent: turn and hashes, n_found.

    A line may be quoted in most messages of a conversation; what is looked up together
    is only what is said and quoted of it within a range of turns.
    """
    place = ["conv", "h1", "h2"]
    asked = units.where("level > 0").select(*place, "turn", "m1", "m2", "level", "size", F.lit(0).alias("kind"))
    # only what is quoted needs a source; a source turn is told once for each unit
    sources = (
        units.where("level = 0")
        .join(asked.select(*place).distinct(), place, "left_semi")
        .groupBy(*place, "turn")
        .agg(F.max(F.struct("m1", "m2")).alias("m"))
        .select(*place, "turn", "m.m1", "m.m2", F.lit(0).alias("level"), F.lit(0).alias("size"), F.lit(1).alias("kind"))
    )
    both = asked.unionByName(sources).withColumn("range", F.floor(F.col("turn") / TURNS))
    both = written(both, "quoted")
    said = F.when(F.col("kind") == 1, F.struct("turn", "m1", "m2"))
    before = Window.partitionBy(*place).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(*place, "range")
        .agg(F.max(said).alias("latest"))
        .withColumn("carried", F.last("latest", ignorenulls=True).over(before))
        .drop("latest")
    )
    within = Window.partitionBy(*place, "range").orderBy("turn", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        both.withColumn("near", F.last(said, ignorenulls=True).over(within))
        .where("kind = 0")
        .join(carried, [*place, "range"])
        .withColumn("source", F.coalesce("near", "carried"))
        .where("source is not null")
    )
    by_source = found.groupBy(*MESSAGE, "source", "level").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    best = F.max(F.struct(-F.col("level"), "size", "source"))
    chosen = by_source.groupBy(*MESSAGE).agg(best.alias("best"), F.sum("n").alias("n_found"))
    return written(
        chosen.select(
            *MESSAGE,
            "n_found",
            F.col("best.source.turn").alias("parent_turn"),
            F.col("best.source.m1").alias("p1"),
            F.col("best.source.m2").alias("p2"),
        ),
        "parents",
    )


def _threads(parents: DataFrame) -> DataFrame:
    """Adds root_turn and depth: each step every message takes its target's target."""
    state = parents.select(
        "*", F.col("parent_turn").alias("root_turn"), F.col("p1").alias("r1"), F.col("p2").alias("r2"), F.lit(1).alias("depth")
    )
    while True:
        further = state.select(
            F.col("conv").alias("c"),
            F.col("turn").alias("t"),
            F.col("m1").alias("a"),
            F.col("m2").alias("b"),
            F.col("root_turn").alias("next_turn"),
            F.col("r1").alias("n1"),
            F.col("r2").alias("n2"),
            F.col("depth").alias("more"),
        )
        at = (F.col("conv") == F.col("c")) & (F.col("root_turn") == F.col("t")) & (F.col("r1") == F.col("a")) & (F.col("r2") == F.col("b"))
        new = written(
            state.join(further, at, "left").select(
                *parents.columns,
                F.coalesce("next_turn", "root_turn").alias("root_turn"),
                F.coalesce("n1", "r1").alias("r1"),
                F.coalesce("n2", "r2").alias("r2"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("more").isNotNull().alias("went"),
            ),
            "threads",
        )
        state = new.drop("went")
        if new.where("went").isEmpty():
            return state
