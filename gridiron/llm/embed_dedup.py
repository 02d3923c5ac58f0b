"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridiron.llm.common import hash128, written
from gridiron.llm.graph import components


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (doubles) of the rows that may link: an id, and a vector of finite components that isn't zero."""
    v = F.col(vector_col).cast("array<double>")
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
        .where(F.coalesce(sound, F.lit(False)) & F.exists("v", lambda x: x != 0))
    )


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that squares neither overflow nor vanish."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _slices(batch: pa.RecordBatch, cells: int):
    """Parts of a batch whose products with all centres take at most 32 MB."""
    step = max(1, min(2048, (1 << 22) // cells))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def fit_cells(vectors: DataFrame, dim: int, n: int, rounds: int = 4) -> np.ndarray:
    """Centres of about sqrt(n) cells by spherical k-means over all vectors.

    The start is the vectors with the smallest hashes of their ids.  A round adds up
    each cell's unit vectors per task, so only sums reach the driver's plan.
    """
    k = max(1, math.isqrt(n))
    seeds = vectors.orderBy(F.xxhash64("id"), "id").limit(k).toArrow()
    centres = _rows(seeds.column("v").combine_chunks(), dim)
    for _ in range(rounds):

        def sums(batches, centres=centres):
            total, count = np.zeros_like(centres), np.zeros(len(centres), np.int64)
            for part in (part for batch in batches for part in _slices(batch, len(centres))):
                x = _rows(part.column(0), dim)
                cell = (x @ centres.T).argmax(axis=1)
                np.add.at(total, cell, x)
                count += np.bincount(cell, minlength=len(centres))
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(list(total[used]), pa.list_(pa.float64()))], ["cell", "total"]
            )

        parts = vectors.select("v").mapInArrow(sums, "cell long, total array<double>")
        added = parts.select("cell", F.posexplode("total").alias("at", "x")).groupBy("cell", "at").agg(F.sum("x").alias("x"))
        for r in added.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("s")).collect():  # a row per cell, in one job
            total = np.array([p.x for p in r.s])
            if np.linalg.norm(total) > 0:
                centres[r.cell] = total / np.linalg.norm(total)
    return centres


def _placed(vectors: DataFrame, centres: np.ndarray, cosine: float) -> DataFrame:
    """id, v, w, cells: the nearest cell, its home, and later cells that may hold a partner.

    A vector at home in cell j lies on its side of the plane between the two centres, so
    one within the distance of the cosine is at most that far from the plane.  That holds
    from both sides; only the vector of the earlier cell looks.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    square = (centres**2).sum(axis=1)

    def run(batches):
        for batch in batches:
            for part in _slices(batch, len(centres)):
                near = _rows(part.column(1), centres.shape[1]) @ centres.T
                home = near.argmax(axis=1)
                apart = square[home][:, None] + square - 2 * (centres[home] @ centres.T)
                beyond = near[np.arange(len(home)), home][:, None] - near
                look = beyond <= reach * np.sqrt(np.maximum(0, apart)) + 1e-9
                look &= np.arange(len(centres)) > home[:, None]
                cells = pa.array([[h, *np.flatnonzero(m)] for h, m in zip(home, look)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, cells], ["id", "v", "w", "cells"])

    return vectors.select("id", "v", "w").mapInArrow(run, "id long, v array<double>, w long, cells array<long>")


def _near_first(centres: np.ndarray, size: int) -> np.ndarray:
    """An order of the centres in which every run of `size` lies close together: halved across the widest direction."""
    if len(centres) <= size:
        return np.arange(len(centres))
    x = centres - centres.mean(axis=0)
    order = np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")
    cut = -(-len(centres) // (2 * size)) * size
    return np.concatenate([half[_near_first(centres[half], size)] for half in (order[:cut], order[cut:])])


def _blocks(placed: DataFrame, block: int, size: int) -> DataFrame:
    """Rows dealt to the blocks of their groups of `size` cells: g, h, p, at_home, home, cells, id, v, w.

    Cells that together fill a block travel together, so a vector is sent once to a group
    of cells however many of them it looks into (`cells`).  A group's own vectors are cut
    into parts of about `block` rows by a hash of the id, and so are those that look into
    it; a block is a pair of parts.  So a cell of any size is many tasks.
    """
    group = F.transform("cells", lambda c: F.floor(c / size))
    looks = placed.select("id", "v", "w", F.col("cells")[0].alias("home"), "cells", F.explode(F.array_distinct(group)).alias("g"))
    counts = looks.groupBy("g").agg(
        F.ceil(F.sum((F.floor(F.col("home") / size) == F.col("g")).cast("int")) / block).alias("hs"), F.ceil(F.count("*") / block).alias("ps")
    )
    dealt = looks.join(F.broadcast(counts), "g").where("hs > 0")  # sqrt(n) rows
    salt = F.xxhash64("id")
    look = dealt.select(
        "g",
        F.explode(F.sequence(F.lit(0), F.col("hs") - 1)).alias("h"),
        F.pmod(salt, "ps").alias("p"),
        F.lit(False).alias("at_home"),
        "home",
        F.filter("cells", lambda c: F.floor(c / size) == F.col("g")).alias("cells"),
        "id",
        "v",
        "w",
    )
    home = dealt.where(F.floor(F.col("home") / size) == F.col("g")).select(
        "g",
        F.pmod(salt, "hs").alias("h"),
        F.explode(F.sequence(F.lit(0), F.col("ps") - 1)).alias("p"),
        F.lit(True).alias("at_home"),
        "home",
        F.array().cast("array<long>").alias("cells"),
        "id",
        "v",
        "w",
    )
    return look.unionByName(home)


def _compare(blocks: DataFrame, dim: int, cosine: float) -> DataFrame:
    """Per vector and block: n (the weight of its links found there) and least, the smallest id of its block's component."""

    def run(key, table):
        table = table.combine_chunks()
        at_home = table.column("at_home").to_numpy(zero_copy_only=False).astype(bool)
        ids, weight, home = (table.column(c).to_numpy() for c in ("id", "w", "home"))
        x = _rows(table.column("v").combine_chunks(), dim)
        cells = table.column("cells").combine_chunks()
        looker, cell = pc.list_parent_indices(cells).to_numpy(), cells.flatten().to_numpy()
        by_cell = np.argsort(cell, kind="stable")
        looker, cell = looker[by_cell], cell[by_cell]
        count, left, right = np.zeros(len(ids), np.int64), [], []
        for c in np.unique(home[at_home]):
            hi = np.flatnonzero(at_home & (home == c))
            pi = looker[np.searchsorted(cell, c) : np.searchsorted(cell, c, "right")]
            for at in range(0, len(pi), 512):
                rows = pi[at : at + 512]
                i, j = np.nonzero(x[rows] @ x[hi].T >= cosine)
                i, j = rows[i], hi[j]
                other = ids[i] != ids[j]
                i, j = i[other], j[other]
                # a pair of one cell is seen from both sides and counts once for each; one of two cells counts here for both
                back = home[i] == c
                np.add.at(count, i, weight[j])
                np.add.at(count, j[~back], weight[i[~back]])
                left.append(i)
                right.append(j)
        i, j = (np.concatenate(x) if x else np.zeros(0, int) for x in (left, right))
        least = ids.copy()
        while len(i):
            low = np.minimum(least[i], least[j])
            new = least.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            if (new == least).all():
                break
            least = new
        found = (count > 0) | (least != ids)
        return pa.table({"id": ids[found], "n": count[found], "least": least[found]})

    return blocks.groupBy("g", "h", "p").applyInArrow(run, "id long, n long, least long")


def embedding_duplicates(
    vectors: DataFrame,
    cosine: float = 0.95,
    block: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every_length: bool = True,
) -> DataFrame:
    """Links vectors of at least this cosine, in double precision.

    Equal vectors are one class, compared once with its number of members as weight, so
    a group of copies costs no more than one vector.  The classes are clustered into about
    sqrt(n) cells; each is compared with those at home in its own cell and in every later
    one that may hold a partner, block by block, so no link is lost.  Pairs are only counted inside a block, and a block
    hands on one row per linked class.

    Returns a row per input row: the id, n_links, component_id, kept.  Vectors that are
    null, empty, zero or not finite and rows without an id link with nothing and are
    kept.  Vectors of each length are compared among themselves; without `every_length`
    only those of the most frequent length are.  Rows of one id are one
    vector, the first in order of its components.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"))
    sound = usable(vectors, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    sound = written(sound, "vectors")
    lengths = sound.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim")
    dims = [r.dim for r in (lengths if every_length else lengths.limit(1)).collect()]  # a row per length
    if not dims:
        return _result(rows, None, id_col)
    if not every_length:
        sound = sound.where(F.size("v") == dims[0])
    sound = sound.select("id", "v", *hash128(F.col("v"), "h"))
    classes = sound.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("v").alias("v"), F.count("*").alias("w"))
    classes = written(classes, "vector-classes")
    sizes = {r.dim: r["count"] for r in classes.groupBy(F.size("v").alias("dim")).count().collect()}
    found = None
    for dim in dims:
        if found is not None and sizes[dim] < 2:
            continue  # one class has no other to be compared with
        own = classes.where(F.size("v") == dim)
        rows_a_block = min(block, max(256, (1 << 22) // dim))  # 32 MB of doubles at most, or 256 rows
        centres = fit_cells(own, dim, sizes[dim])
        together = max(1, rows_a_block * len(centres) // sizes[dim])
        placed = written(_placed(own, centres[_near_first(centres, together)], cosine), "cells")
        part = written(_compare(_blocks(placed, rows_a_block, together), dim, cosine), "found")
        found = part if found is None else found.unionByName(part)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(found.where("least <> id").select(F.col("id").alias("a"), F.col("least").alias("b")))
    linked = counts.join(labels, counts.id == labels.node, "left").select("id", "n", "label")
    known = classes.join(linked, "id", "left").select(
        "h1",
        "h2",
        (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
        F.coalesce("label", "id").alias("label"),
    )
    known = written(known, "class-links")
    return _result(rows, sound.select("id", "h1", "h2").join(known, ["h1", "h2"]).drop("h1", "h2"), id_col)


def _result(rows: DataFrame, found: DataFrame | None, id_col: str) -> DataFrame:
    if found is None:
        found = rows.limit(0).select("id", F.lit(0).alias("n_links"), F.lit(0).alias("label"))
    found = found.select(F.col("id").alias("_id"), "n_links", "label")
    component = F.coalesce("label", "id")
    return rows.join(found, F.col("id") == F.col("_id"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
