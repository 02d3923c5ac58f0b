"""Hard-negative mining: best-first descent of a cover tree over norm-augmented vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gridiron.llm.common import hash128, written

#: Components beyond this could make inner products that a long can't hold.
LARGEST = 1 << 24
FAR = (1 << 62) - 1


def _matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return values.reshape(len(flat), -1)


def _as_nullable(table: pa.Table, names: list[str]) -> dict[str, pa.ChunkedArray]:
    """Columns of `table` whose lists may hold nulls, as Spark expects them."""
    kinds = {"v": pa.list_(pa.int32()), "los": pa.list_(pa.int64()), "his": pa.list_(pa.int64())}
    return {k: table.column(k).cast(kinds[k]) if k in kinds else table.column(k) for k in names}


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: as doubles as long as these are exact, else as longs."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return a @ b.T
    return a.astype(np.int64) @ b.astype(np.int64).T


def points_of(rows: DataFrame, most: int) -> DataFrame:
    """The candidates: node (the root of their length), id, label, v, the coordinate `aug` that gives all the same norm, and `top`, its square.

    Of equal vectors of one label only the `most` smallest ids can come first, so the others stay out.
    """
    same = Window.partitionBy("label", "h1", "h2").orderBy("id")
    few = rows.select("id", "label", "v", *hash128(F.col("v"), "h")).withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= most)
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    few = written(few.select("id", "label", "v", F.size("v").alias("dim"), square.alias("sq")), "candidates")
    tops = few.groupBy("dim").agg(F.max("sq").alias("top")).withColumnRenamed("dim", "of_dim")
    joined = few.join(tops, F.col("dim") == F.col("of_dim"))
    aug = F.sqrt((F.col("top") - F.col("sq")).cast("double"))
    return written(
        joined.select(F.col("dim").cast("string").alias("node"), "id", "label", "v", aug.alias("aug"), F.col("top").cast("double").alias("top")),
        "points",
    )


def _meet(rows: DataFrame, items: DataFrame, block: int, run, schema: str) -> DataFrame:
    """`run` on rows and items of the same node, about `block` rows at a time; a node of any size is many groups."""
    parts = rows.groupBy(F.col("node").alias("of")).agg(F.ceil(F.count("*") / block).alias("parts"))
    left = rows.join(parts, F.col("node") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    right = items.join(parts, F.col("node") == F.col("of")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    left, right = left.select(*rows.columns, "part"), right.select(*items.columns, "part")
    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def met(rows, items):
        return run(rows, items) if rows.num_rows and items.num_rows else empty

    return left.groupBy("node", "part").cogroup(right.groupBy("node", "part")).applyInArrow(met, schema)


def _centres(open_points: DataFrame, level: int, fan: int) -> DataFrame:
    """node, i, c: up to `fan` centres of each node, spread by farthest-first choice among 4 * fan points by hash and the farthest one."""
    place, point = F.xxhash64("id", F.lit(level)), F.struct("v", "aug")
    seeds = open_points.groupBy("node", F.pmod(place, F.lit(4 * fan)).alias("k")).agg(F.min_by(point, F.struct(place, "id")).alias("p"))
    farthest = open_points.groupBy("node").agg(F.max_by(point, F.struct("dist", "id")).alias("p"))
    seeds = seeds.select("node", "p.*").unionByName(farthest.select("node", "p.*"))

    def choose(key, table):
        x = np.column_stack([_matrix(table.column("v")), table.column("aug").to_numpy()])
        x = x[np.lexsort(x.T)]  # the same on each run
        chosen, gap = [0], np.linalg.norm(x - x[0], axis=1)
        while len(chosen) < fan and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, np.linalg.norm(x - x[chosen[-1]], axis=1))
        rows = pa.array(list(x[chosen]), pa.list_(pa.float64()))
        return pa.table({"node": [key[0].as_py()] * len(chosen), "i": np.arange(len(chosen)), "c": rows})

    return seeds.groupBy("node").applyInArrow(choose, "node string, i long, c array<double>")


def cover_tree(points: DataFrame, leaf: int = 1024, fan: int = 16) -> tuple[DataFrame, DataFrame]:
    """The tree's nodes (parent, node, c, radius, top, is_leaf) and its points with their leaf as `node`.

    Built level by level: the points of a node go to the nearest of its centres, and a
    child's covering radius is the largest distance of its points.  Nodes of more than
    `leaf` points are split again; one of equal points, which no centres tell apart, is
    cut by hashes of the ids.
    """

    def assign(rows, centres):
        x = np.column_stack([_matrix(rows.column("v")), rows.column("aug").to_numpy()])
        c = _matrix(centres.column("c"))
        near = (x @ c.T).argmax(axis=1)  # all have the same norm
        names = centres.column("i").to_numpy()[near]
        dist = np.linalg.norm(x - c[near], axis=1)
        return pa.table(
            {"parent": rows.column("node"), "i": names, "dist": dist, **_as_nullable(rows, ["id", "label", "v", "aug", "top"])}
        )

    schema = "parent string, i long, dist double, id long, label long, v array<int>, aug double, top double"
    open_points, level, nodes, closed = points.withColumn("dist", F.lit(0.0)), 0, [], []
    while True:
        centres = written(_centres(open_points, level, fan), "centres")
        placed = written(_meet(open_points, centres, 4096, assign, schema), "placed")
        stats = placed.groupBy("parent", "i").agg(F.max("dist").alias("radius"), F.count("*").alias("n"), F.max("top").alias("top"))
        named = stats.select(
            F.col("parent").alias("p"), F.col("i").alias("k"), F.concat_ws("/", "parent", "i").alias("node"), "radius", "n", "top"
        )
        made = named.join(centres.select(F.col("node").alias("of"), "i", "c"), (F.col("p") == F.col("of")) & (F.col("k") == F.col("i")))
        alike = (F.col("radius") == 0) & (F.col("n") > leaf)
        cuts = F.when(alike, F.ceil(F.col("n") / leaf)).otherwise(1)
        made = written(made.select(F.col("p").alias("parent"), "k", "node", "c", "radius", "top", cuts.alias("cuts"), ((F.col("n") <= leaf) | alike).alias("is_leaf")), "nodes")
        own = placed.join(made.select(F.col("parent").alias("p"), "k", "node", "cuts", "is_leaf"), (F.col("parent") == F.col("p")) & (F.col("i") == F.col("k")))
        cut = F.when(F.col("cuts") > 1, F.concat_ws(":", "node", F.pmod(F.xxhash64("id"), "cuts"))).otherwise(F.col("node"))
        own = own.select(cut.alias("node"), "id", "label", "v", "aug", "top", "dist", "is_leaf")
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
        cut = F.when(F.col("cuts") > 1, F.concat_ws(":", "node", "cut")).otherwise(F.col("node"))
        nodes.append(made.withColumn("cut", parts).select("parent", cut.alias("node"), "c", "radius", "top", "is_leaf"))
        closed.append(own.where("is_leaf").select("node", "id", "label", "v"))
        if made.where("not is_leaf").isEmpty():
            break
        open_points, level = written(own.where("not is_leaf").drop("is_leaf"), "open"), level + 1
    every, points = nodes[0], closed[0]
    for n, p in zip(nodes[1:], closed[1:]):
        every, points = every.unionByName(n), points.unionByName(p)
    return written(every, "tree"), written(points, "leaves")


def _bounds(q: np.ndarray, c: np.ndarray, radius: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest inner product of each query with a point of each node.

    A query has no augmented coordinate, so a point's distance tells its inner product;
    both the distances and the products with the centre bound it.
    """
    product, norm = q @ c[:, :-1].T, np.linalg.norm(q, axis=1)[:, None]
    both = norm**2 + top
    away = np.sqrt(np.maximum(0, both - 2 * product))
    high = np.minimum(product + norm * radius, (both - np.maximum(0, away - radius) ** 2) / 2)
    low = np.maximum(product - norm * radius, (both - (away + radius) ** 2) / 2)
    slack = 1e-9 * both + 1e-6
    return low - slack, high + slack


QUERY = "id long, label long, v array<int>, los array<long>, his array<long>"


def _descend(queries: DataFrame, tree: DataFrame, first: bool) -> DataFrame:
    """node and the query for every leaf that may hold a wanted point, or for the `first` leaf a best-first search opens."""
    children = tree.select(F.col("parent").alias("node"), F.col("node").alias("child"), "c", "radius", "top", "is_leaf")

    def step(rows, nodes):
        q = _matrix(rows.column("v"))
        low, high = _bounds(q, _matrix(nodes.column("c")), nodes.column("radius").to_numpy(), nodes.column("top").to_numpy())
        los, his = rows.column("los").to_pylist(), rows.column("his").to_pylist()
        reach = np.zeros(low.shape, bool)
        for k in range(max(map(len, los), default=0)):  # a window at a time
            has = np.array([len(x) > k for x in los])
            lo = np.array([x[k] if len(x) > k else 0 for x in los], float)[:, None]
            hi = np.array([x[k] if len(x) > k else 0 for x in his], float)[:, None]
            reach |= (high >= lo) & (low <= hi) & has[:, None]
        if first:
            most = np.array([max(x, default=0) for x in his], float)[:, None]
            best = np.where(reach, np.minimum(high, most), -np.inf)
            best = np.where(best == best.max(axis=1, keepdims=True), low, -np.inf)  # ties: the node whose points are surely near
            only = np.zeros(reach.shape, bool)
            only[np.arange(len(best)), best.argmax(axis=1)] = True
            reach &= only
        i, j = np.nonzero(reach)
        out = rows.select(["id", "label", "v", "los", "his"]).take(pa.array(i))
        names = nodes.select(["child", "is_leaf"]).take(pa.array(j))
        return pa.table({"node": names.column("child"), "is_leaf": names.column("is_leaf"), **_as_nullable(out, out.column_names)})

    found, frontier = None, queries.select(F.size("v").cast("string").alias("node"), "id", "label", "v", "los", "his")
    while True:
        went = written(_meet(frontier, children, 2048, step, f"node string, is_leaf boolean, {QUERY}"), "frontier")
        at_leaf = went.where("is_leaf").drop("is_leaf")
        found = at_leaf if found is None else found.unionByName(at_leaf)
        frontier = went.where("not is_leaf").drop("is_leaf")
        if frontier.isEmpty():
            return found


def _verify(pairs: DataFrame, leaves: DataFrame, same: bool, k: int) -> DataFrame:
    """id, w (the window), found, score: the first k points in each window of each query, by the exact products of the leaves in `pairs`."""

    def compare(rows, points):
        order = np.argsort(points.column("id").to_numpy(), kind="stable")
        points = points.take(pa.array(order))
        ids, label, x = points.column("id").to_numpy(), points.column("label").to_numpy(), _matrix(points.column("v"))
        out = []
        for at in range(0, rows.num_rows, 256):
            part = rows.slice(at, 256)
            qid, q = part.column("id").to_numpy(), _matrix(part.column("v"))
            score = _products(q, x)
            own = (part.column("label").to_numpy()[:, None] == label) == same
            own &= qid[:, None] != ids
            los, his = part.column("los").to_pylist(), part.column("his").to_pylist()
            for w in range(max(map(len, los), default=0)):
                lo = np.array([y[w] if len(y) > w else FAR for y in los])[:, None]
                hi = np.array([y[w] if len(y) > w else -FAR for y in his])[:, None]
                wanted = own & (score >= lo) & (score <= hi)
                if len(ids) > k:
                    least = np.where(wanted, score, -FAR)
                    least = np.partition(least, len(ids) - k, axis=1)[:, len(ids) - k]
                    wanted &= score >= least[:, None]
                i, j = np.nonzero(wanted)
                order = np.lexsort((j, -score[i, j], i))
                i, j = i[order], j[order]
                first = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j = i[first], j[first]
                out.append(pa.table({"id": qid[i], "w": np.full(len(i), w), "found": ids[j], "score": score[i, j].astype(np.int64)}))
        return pa.concat_tables(out)

    each = _meet(pairs, leaves, 2048, compare, "id long, w long, found long, score long")
    rank = F.row_number().over(Window.partitionBy("id", "w").orderBy(F.desc("score"), "found"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k)


def search(queries: DataFrame, tree: DataFrame, leaves: DataFrame, same: bool, k: int) -> DataFrame:
    """id, w, found, score, rank: for each query (id, label, v, los, his) and window the first k points of the same (or another) label.

    The first leaf each query opens gives its k-th best score so far, which narrows its
    windows; then all leaves are opened whose bounds meet a narrowed window.
    """
    dive = _verify(_descend(queries, tree, first=True), leaves, same, k)
    least = dive.where(F.col("rank") == k).select("id", F.struct("w", "score").alias("s")).groupBy("id")
    least = written(least.agg(F.map_from_entries(F.collect_list("s")).alias("least")).withColumnRenamed("id", "of"), "least")
    narrowed = F.transform("los", lambda lo, w: F.greatest(lo, F.coalesce(F.element_at("least", w.cast("long")), lo)))
    narrow = queries.join(least, F.col("id") == F.col("of"), "left")
    narrow = narrow.select("id", "label", "v", F.when(F.col("of").isNull(), F.col("los")).otherwise(narrowed).alias("los"), "his")
    return written(_verify(_descend(written(narrow, "narrowed"), tree, first=False), leaves, same, k), "found")


def usable(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, label, v (floor(scale * x) of each component): the rows that take part, one for each id.

    Out are rows without id or label, without vector or with an empty one, with a null or
    non-finite component, or with a scaled one beyond LARGEST.  Of several rows of an id,
    the first in order of vector and label takes part.
    """
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall("x", lambda c: F.coalesce(F.abs(c * scale) <= LARGEST, F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & sound)
    whole = rows.select("id", "label", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v"))
    first = whole.groupBy("id").agg(F.min(F.struct("v", "label")).alias("row"))
    return first.select("id", "row.label", "row.v")


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, leaf: int = 1024
) -> DataFrame:
    """Hard negatives of each anchor and positive, by inner products of whole numbers.

    `rows` and `anchors` have id, label and v as `usable` returns them; ids are distinct.
    An anchor's positives are the `positives` best rows of its label, itself apart;
    its negatives for a positive are the `negatives` best rows of other labels whose
    score is between `low` and `high` per cent of the positive's.  Best is the larger
    score, then the smaller id.  Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score; an anchor without positives, and a positive without
    negatives (as one with a negative score), have no rows.  Vectors of different
    lengths are not compared.
    """
    rows = written(rows, "rows")
    tree, leaves = cover_tree(points_of(rows, max(positives + 1, negatives)), leaf)
    anchors = written(anchors, "anchors")
    whole = anchors.select("*", F.array(F.lit(-FAR)).alias("los"), F.array(F.lit(FAR)).alias("his"))
    best = search(whole, tree, leaves, True, positives).select("id", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    best = written(best.where("positive_score >= 0"), "positives")
    windows = best.groupBy(F.col("id").alias("of")).agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))
    asked = anchors.join(windows, F.col("id") == F.col("of")).select(
        "id",
        "label",
        "v",
        F.expr(f"transform(scores, s -> (s * {low} + 99) div 100)").alias("los"),
        F.expr(f"transform(scores, s -> (s * {high}) div 100)").alias("his"),
    )
    found = search(written(asked, "asked"), tree, leaves, False, negatives)
    numbered = best.join(windows, F.col("id") == F.col("of")).select(
        F.col("id").alias("anchor_id"), "positive_id", "positive_score", (F.array_position("scores", F.col("positive_score")) - 1).alias("at")
    )
    return numbered.join(found, (F.col("anchor_id") == F.col("id")) & (F.col("at") == F.col("w"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
