"""Sharding of documents by balanced label propagation, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridiron.llm.common import hash128, ranked, written


def assign_shards(docs: DataFrame, shards: int = 16, rounds: int = 8, seats: int = 0) -> DataFrame:
    """Puts documents into shards of equal row counts (at most one apart), linked ones together.

    Documents of equal text are linked.  Those with links start evenly dealt and then
    move in rounds: the members of a group are counted by shard, the group names the
    fullest as its home (several if it is larger than a shard, and then from the second
    round on), and its members elsewhere ask to move there.  From shard s to t as many may move as move back, and as t has free
    seats, shared out by demand.  Documents without links take the seats left over, so
    the counts come out exactly.  Rounds end
    when none moves or after `rounds`.  Groups are only ever aggregated, and joined as
    written tables, so the rows of a group of a third of all are split over tasks.

    Returns doc_id, size (bytes of the text plus 1), text_crc32, shard, slot (from 0
    within the shard), n_alike (documents of the same text) and moved (its round, 0:
    none).  A null text is a text of no bytes, alike to other nulls, not to empty ones;
    null and repeated doc_ids are rows like all others.
    """
    spark = docs.sparkSession
    rows = written(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            *hash128(F.struct("text"), "g"),
        ),
        "shard-rows",
    )
    groups = written(rows.groupBy("g1", "g2").agg(F.count("*").alias("n_alike")).where("n_alike > 1"), "shard-groups")
    order = ["doc_id", "g1", "g2", "size"]
    linked = written(
        ranked(rows.join(groups, ["g1", "g2"]), [], order)
        .withColumn("shard", F.pmod("rank", F.lit(shards)).cast("int"))
        .withColumn("moved", F.lit(0))
        .withColumnRenamed("rank", "nth"),
        "shard-linked",
    )
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    for turn in range(1, rounds + 1):
        held = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        room = {s: quota[s] - held.get(s, 0) for s in range(shards)}
        asking = _asking(spark, linked, room, quota[-1])
        if turn == 1:
            asking = asking.where(F.col("n_alike") <= quota[-1])
        asking = written(asking, "shard-moves")
        demand = {(r.shard, r.to): r.n for r in asking.groupBy("shard", "to").agg(F.count("*").alias("n")).collect()}
        allowed = _allowed(demand, room)
        if not any(allowed.values()):
            if turn == 1:
                continue
            break
        moves = spark.createDataFrame(
            [(s, t, n) for (s, t), n in allowed.items()], "shard int, to int, allowed long"
        )
        movers = ranked(asking, ["shard", "to"], order).join(F.broadcast(moves), ["shard", "to"])
        goes = F.col("rank") < F.col("allowed")
        columns = linked.columns
        gone = movers.where(goes).select("nth", "to")
        moved = F.col("to").isNotNull()
        linked = written(
            linked.join(gone, "nth", "left")
            .withColumn("moved", F.when(moved, F.lit(turn)).otherwise(F.col("moved")))
            .withColumn("shard", F.coalesce("to", "shard"))
            .select(columns),
            "shard-linked",
        )
    held = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    alone = rows.join(groups, ["g1", "g2"], "left_anti")
    seats_from, spans = 0, []
    for s in range(shards):
        free = quota[s] - held.get(s, 0)
        spans.append((s, seats_from, seats_from + free))
        seats_from += free
    seat = F.lit(None).cast("int")
    for s, first, past in spans:
        seat = F.when((F.col("rank") >= first) & (F.col("rank") < past), F.lit(s)).otherwise(seat)
    alone = (
        ranked(alone, [], order)
        .withColumn("shard", seat.cast("int"))
        .select(*rows.columns, F.lit(1).cast("long").alias("n_alike"), "shard", F.lit(0).alias("moved"))
    )
    placed = linked.select(*rows.columns, "n_alike", "shard", "moved").unionByName(alone)
    return ranked(placed, ["shard"], order, "slot").drop("g1", "g2")


def _asking(spark: SparkSession, linked: DataFrame, room: dict[int, int], quota: int) -> DataFrame:
    """Members that want to move, and where to.

    A group's homes are the fullest of its shards, as many as it needs.  Members elsewhere
    ask for one of the homes with room, shared out by a hash; if none has room, for the
    fullest of the group's shards that has, or else for a home, in exchange.
    """
    rooms = spark.createDataFrame(list(room.items()), "shard int, room long")
    votes = linked.groupBy("g1", "g2", "shard").agg(F.count("*").alias("n")).join(F.broadcast(rooms), "shard")
    ordered = F.sort_array(F.collect_list(F.struct("n", F.xxhash64("g1", "shard").alias("tie"), "shard", "room")), False)
    by_group = votes.groupBy("g1", "g2").agg(ordered.alias("held"), F.sum("n").alias("n"))  # at most a row per shard
    homes = F.slice("held", F.lit(1), F.ceil(F.col("n") / max(1, quota)).cast("int"))
    best = by_group.select("g1", "g2", homes.alias("homes"), F.filter("held", lambda x: x["room"] > 0).alias("open"))
    best = written(
        best.select(
            "g1",
            "g2",
            F.col("homes.shard").alias("homes"),
            F.when(F.exists("homes", lambda x: x["room"] > 0), F.filter("homes", lambda x: x["room"] > 0))
            .when(F.size("open") > 0, F.slice("open", 1, 1))
            .otherwise(F.col("homes"))["shard"]
            .alias("to"),
        ),
        "shard-votes",
    )
    choice = F.get("to", F.pmod(F.xxhash64("doc_id", "size"), F.size("to")).cast("int"))
    return (
        linked.join(best, ["g1", "g2"])
        .where(~F.array_contains("homes", F.col("shard")))
        .withColumn("to", choice)
        .where(F.col("shard") != F.col("to"))
        .drop("homes")
    )


def _allowed(demand: dict[tuple[int, int], int], room: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many may move from one shard to another: even exchanges first, then the free seats by demand."""
    out = {(s, t): min(n, demand.get((t, s), 0)) for (s, t), n in demand.items()}
    free = dict(room)
    for (s, t), n in sorted(demand.items(), key=lambda x: (-x[1], x[0])):
        more = max(0, min(n - out[s, t], free[t]))
        out[s, t] += more
        free[t] -= more
    return out
