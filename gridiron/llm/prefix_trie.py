"""Prefix trie of conversations: SQL ROLLUP over the positions of turns, block by block."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridiron.llm.common import hash128, written

#: Turns that one ROLLUP covers; longer conversations go on in further blocks.
BLOCK = 8
#: Blocks of a conversation that are added up in one window.
CHUNK = 1024
#: Width of the ranges of conversation ids that are joined to one text before they are hashed.
SPAN = 512
NODE = ["depth", "z1", "z2"]


def positioned(turns: DataFrame) -> DataFrame:
    """conv, pos (from 0, gapless), t1, t2 (the turn's id: hashes of role and text) and words of every turn.

    Turns are ordered by `turn`, null first, equal ones by the md5 of role and text.  The
    rows are dealt to ranges of this order, equal ones by chance, and counted per range,
    so a conversation that has most rows is ordered by many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.md5(said).alias("tie"),
        *hash128(said, "t"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    dealt = rows.withColumn("by_chance", F.rand(7)).repartitionByRange("conv", "turn", "tie", "by_chance")
    placed = written(dealt.drop("by_chance").withColumn("part", F.spark_partition_id()), "turns")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("conv", "part")
        .agg(F.count("*").alias("n"))
        .select(F.col("conv").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("conv", "part").orderBy(F.asc_nulls_first("turn"), "tie")
    return (
        placed.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, [F.col("conv") == F.col("c"), F.col("part") == F.col("p")])
        .select("conv", (F.col("at") + F.col("start")).alias("pos"), "t1", "t2", "words")
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations in `turns` (conv_id, turn, role, text).

    Each distinct sequence of first d turns is a node of depth d, from the root (d = 0);
    the conversations that start with it are its members.  Returns per node: conv_id (the
    smallest member), depth, parent_conv_id (the parent's conv_id; null for the root),
    n_convs (members), n_children, n_leaves (childless nodes of the subtree, the node
    itself included), saved_tokens (over the subtree, the node itself included: words of
    the last turn for each member but one) and ends_sha256 (SHA-256 of the ascending
    decimal ids, joined by commas, of the members that end here).  conv_id and depth name
    a node; `node_texts` adds its last turn.

    Rows without conv_id belong to no conversation; a null role or text is empty; a null
    turn comes first, equal turns are ordered by the md5 of role and text, so repeated rows
    are repeated turns; other columns are not read.  Without conversations there is no node.
    Turns and nodes are told apart by 128-bit hashes.
    """
    return trie(written(positioned(turns), "positions"))


def node_texts(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Adds role and text of each node's last turn, null for the root."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    texts = turns.groupBy(*hash128(said, "t")).agg(F.first(F.struct(role.alias("role"), text.alias("text"))).alias("said"))
    at = written(positioned(turns), "positions").select("conv", (F.col("pos") + 1).alias("at"), "t1", "t2")
    last = nodes.join(at, [F.col("conv_id") == F.col("conv"), F.col("depth") == F.col("at")], "left")
    return last.join(texts, ["t1", "t2"], "left").select(*nodes.columns, "said.role", "said.text")


def trie(turns: DataFrame, turnless: DataFrame | None = None) -> DataFrame:
    """`prefix_trie` of written rows as `positioned` returns them; `turnless` (conv) names conversations without any."""
    blocks = _blocks(turns, turnless)
    nodes = written(_rollup(blocks, {}).select(*NODE, "u1", "u2", "conv_id", "n_convs"), "nodes")
    family = written(_family(nodes), "family")
    valued = _valued(blocks, family)
    ends = _digests(valued.where("n_after = 0").select(
        (F.col("block") * BLOCK + F.col("n")).alias("depth"),
        F.col("p1").bitwiseXOR(F.col("x1")).alias("z1"),
        F.col("p2").bitwiseXOR(F.col("x2")).alias("z2"),
        "conv",
    ))
    sums = {f"saved{j}": f"sum(s{j})" for j in range(1, BLOCK + 1)} | {"n_leaves": "sum(leaves)"}
    saved = F.element_at(F.array(*(f"saved{j}" for j in range(1, BLOCK + 1))), F.greatest("level", F.lit(1)).cast("int"))
    totals = _rollup(valued, sums).select(*NODE, "n_leaves", saved.alias("saved_tokens"))
    return (
        family.join(totals, NODE)
        .join(ends, NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def _mix(a: Column, b: Column, pos: Column) -> list[Column]:
    """Two hashes of a turn at its position; a sequence of turns is told by their exclusive or."""
    return [F.xxhash64(a, b, pos), F.xxhash64(F.lit("z"), a, b, pos)]


def _blocks(turns: DataFrame, turnless: DataFrame | None) -> DataFrame:
    """A row per conversation and block: the turns' ids and words in columns by position, and p1, p2, the prior block's last node."""
    slot, (x1, x2) = F.col("pos") % BLOCK, _mix(F.col("t1"), F.col("t2"), F.col("pos"))
    names = [(c, f"{p}{j + 1}", j) for c, p in (("t1", "a"), ("t2", "b"), ("words", "w")) for j in range(BLOCK)]
    rows = turns.groupBy("conv", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        *(F.max(F.when(slot == j, F.col(c))).alias(name) for c, name, j in names),
        F.bit_xor(x1).alias("x1"),
        F.bit_xor(x2).alias("x2"),
        F.count("*").alias("n"),
    )
    if turnless is not None:
        none = [F.lit(None).cast("long").alias(name) for _, name, _ in names]
        zero = [F.lit(0).cast("long").alias(c) for c in ("x1", "x2", "n")]
        rows = rows.unionByName(turnless.select("conv", F.lit(0).cast("long").alias("block"), *none, *zero))
    return written(_running(written(rows, "blocks"), {"p1": "x1", "p2": "x2"}, F.bit_xor), "keyed-blocks")


def _running(blocks: DataFrame, out: dict[str, str], combine, later: bool = False) -> DataFrame:
    """Adds what the conversation's earlier (or later) blocks come to: each new column from one of `blocks`.

    Blocks are combined within chunks of CHUNK and the chunks within the conversation, so
    no window holds more than a chunk or the conversation's chunks.
    """
    both = (lambda a, b: a + b) if combine is F.sum else (lambda a, b: a.bitwiseXOR(b))
    way = F.desc if later else F.asc
    before = (Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv", "chunk").orderBy(way("block")).rowsBetween(*before)
    across = Window.partitionBy("conv").orderBy(way("chunk")).rowsBetween(*before)
    placed = blocks.withColumn("chunk", F.floor(F.col("block") / CHUNK))
    chunks = placed.groupBy("conv", "chunk").agg(*(combine(c).alias(c) for c in out.values()))
    starts = chunks.select(
        F.col("conv").alias("c"),
        F.col("chunk").alias("k"),
        *(combine(F.col(c)).over(across).alias(f"of_{name}") for name, c in out.items()),
    ).where(F.coalesce(*(F.col(f"of_{name}") for name in out)).isNotNull())  # only conversations of several chunks
    zero = F.lit(0).cast("long")
    here = placed.select("*", *(F.coalesce(combine(F.col(c)).over(within), zero).alias(name) for name, c in out.items()))
    joined = here.join(starts, [F.col("conv") == F.col("c"), F.col("chunk") == F.col("k")], "left")
    return joined.select(*blocks.columns, *(both(F.col(name), F.coalesce(f"of_{name}", zero)).alias(name) for name in out))


def _rollup(blocks: DataFrame, sums: dict[str, str]) -> DataFrame:
    """A row per node: depth, z1, z2 (its id), u1, u2 (its parent's), level, conv_id, n_convs and `sums`.

    All prefixes within a block come from one ROLLUP, keyed by the prior block's last
    node; grouping_id() tells how many of the block's turns a row covers.
    """
    pairs = ", ".join(f"(a{j}, b{j})" for j in range(1, BLOCK + 1))
    columns = pairs.replace("(", "").replace(")", "")
    more = "".join(f", {of} AS {name}" for name, of in sums.items())
    grouped = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, {columns}, {BLOCK} - bit_count(grouping_id()) / 2 AS level, "
        f"min(conv) AS conv_id, count(*) AS n_convs{more} FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({pairs})",
        blocks=blocks,
    ).withColumn("level", F.col("level").cast("long"))
    last = F.element_at(F.array(*(f"a{j}" for j in range(1, BLOCK + 1))), F.greatest("level", F.lit(1)).cast("int"))
    real = F.when(F.col("level") > 0, last.isNotNull()).otherwise(F.col("block") == 0)
    zero, z, u = F.lit(0).cast("long"), [F.col("p1"), F.col("p2")], [F.col("p1"), F.col("p2")]
    for j in range(1, BLOCK + 1):
        for k, x in enumerate(_mix(F.col(f"a{j}"), F.col(f"b{j}"), F.col("block") * BLOCK + F.lit(j - 1).cast("long"))):
            z[k] = z[k].bitwiseXOR(F.when(F.col("level") >= j, x).otherwise(zero))
            u[k] = u[k].bitwiseXOR(F.when(F.col("level") > j, x).otherwise(zero))
    return grouped.where(real).select(
        (F.col("block") * BLOCK + F.col("level")).alias("depth"),
        z[0].alias("z1"),
        z[1].alias("z2"),
        u[0].alias("u1"),
        u[1].alias("u2"),
        "level",
        "conv_id",
        "n_convs",
        *sums,
    )


def _family(nodes: DataFrame) -> DataFrame:
    """The nodes with parent_conv_id and n_children."""
    up = (F.col("depth") - 1).alias("d"), F.col("u1").alias("c1"), F.col("u2").alias("c2")
    kids = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    parents = nodes.select(*(F.col(c).alias(f"up_{c}") for c in NODE), F.col("conv_id").alias("parent_conv_id"))
    at = [F.col("depth") - 1 == F.col("up_depth"), F.col("u1") == F.col("up_z1"), F.col("u2") == F.col("up_z2")]
    with_kids = nodes.join(kids, [F.col("depth") == F.col("d"), F.col("z1") == F.col("c1"), F.col("z2") == F.col("c2")], "left")
    named = nodes.where("depth > 0").join(parents, at).select(*(F.col(c).alias(f"of_{c}") for c in NODE), "parent_conv_id")
    return with_kids.join(named, [F.col(c) == F.col(f"of_{c}") for c in NODE], "left").select(
        *NODE, "conv_id", "n_convs", "parent_conv_id", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")
    )


def _valued(blocks: DataFrame, family: DataFrame) -> DataFrame:
    """The blocks with what each member adds to the sums over subtrees.

    A node's own value and leaf are counted once, with its smallest member: s1 .. are the
    values from that position on to the conversation's end, leaves the leaves from this
    block on.  Then the sum over a subtree is the sum over the members.
    """
    slot = (F.col("depth") - 1) % BLOCK
    block = F.greatest(F.lit(0), F.floor((F.col("depth") - 1) / BLOCK))
    own = family.groupBy(F.col("conv_id").alias("c"), block.alias("k")).agg(
        *(F.max(F.when((F.col("depth") > 0) & (slot == j), F.col("n_convs"))).alias(f"m{j + 1}") for j in range(BLOCK)),
        F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    zero = F.lit(0).cast("long")
    value = [F.coalesce((F.col(f"m{j}") - 1) * F.col(f"w{j}"), zero) for j in range(1, BLOCK + 1)]
    joined = blocks.join(own, [F.col("conv") == F.col("c"), F.col("block") == F.col("k")], "left")
    here = joined.select(
        *blocks.columns,
        *(sum(value[j:], zero).alias(f"h{j + 1}") for j in range(BLOCK)),
        F.coalesce("leaf", zero).alias("leaf"),
    )
    after = _running(written(here, "values"), {"v_after": "h1", "leaf_after": "leaf", "n_after": "n"}, F.sum, later=True)
    return written(
        after.select(
            *(c for c in blocks.columns if c[0] != "w"),
            *((F.col(f"h{j}") + F.col("v_after")).alias(f"s{j}") for j in range(1, BLOCK + 1)),
            (F.col("leaf") + F.col("leaf_after")).alias("leaves"),
            "n_after",
        ),
        "valued-blocks",
    )


def _digests(ends: DataFrame) -> DataFrame:
    """The node's id and ends_sha256 of every node in which conversations (conv) end.

    Ids are first joined within ranges of SPAN, then a node's few texts are hashed one
    after the other, so that no list of all its ids is held.
    """
    spans = ends.groupBy(*NODE, F.floor(F.col("conv") / SPAN).alias("span")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = spans.repartition(*NODE).sortWithinPartitions(*NODE, "span").select(*NODE, "ids")

    def run(batches):
        node, digest = None, None

        def packed(rows):
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([r[3] for r in rows], pa.string())], [*NODE, "ends_sha256"])

        for batch in batches:
            done = []
            for *at, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if at != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = at, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield packed(done)
        if node is not None:
            yield packed([(*node, digest.hexdigest())])

    return ordered.mapInArrow(run, "depth long, z1 long, z2 long, ends_sha256 string")
