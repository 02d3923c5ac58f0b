"""Near-duplicate documents: one-permutation MinHash, banded buckets, stars of candidates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridiron.llm.common import others, written
from gridiron.llm.graph import components

SEGMENT = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    """Shingles of `words` words, links at `percent` similarity, `bands` of `rows` bins each.

    A pair at 80 % shares a band with probability 1 - (1 - 0.8^6)^40, all but 5 in a million.
    """

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer, so that every bit of the result hangs on every bit given."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word shingles, computed over bytes in numpy."""

    def __init__(self, words: int):
        random = np.random.default_rng(17)
        self.words = words
        self.odd = random.integers(0, 2**63, words, np.uint64) * np.uint64(2) + np.uint64(1)
        self.byte = random.integers(0, 2**64, 256, np.uint64)
        self.space = np.zeros(256, bool)
        self.space[list(SPACES)] = True
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            p = 0x9E3779B97F4A7C15
            for name, base in (("power", p), ("inverse", pow(p, -1, 2**64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.power, self.inverse

    def word_hashes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word of ASCII-lower-cased bytes."""
        codes = np.frombuffer(b" " + data + b" ", np.uint8)
        blank = self.space[codes]
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        power, inverse = self._powers(len(codes) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.byte[codes] * power[: len(codes)])])
        return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts - 1

    def _long(self, data: bytes) -> np.ndarray:
        """Words of one text, in segments that end at white space."""
        out, at = [], 0
        while at < len(data):
            cut = re.compile(rb"[\x20\x09-\x0D]").search(data, at + SEGMENT) if at + SEGMENT < len(data) else None
            past = cut.start() if cut else len(data)
            out.append(self.word_hashes(data[at:past])[0])
            at = past
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def _of_words(self, w: np.ndarray) -> np.ndarray:
        k = min(self.words, len(w))
        if not k:
            return np.zeros(0, np.uint64)
        total = np.full(len(w) - k + 1, k, np.uint64)
        for j in range(k):
            total += w[j : len(w) - k + 1 + j] * self.odd[j]
        return np.unique(mixed(total))

    def of(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        run: list[bytes] = []
        held = 0
        for t in texts:
            data = (t or "").encode().lower()
            if len(data) > SEGMENT or held + len(data) > SEGMENT:
                yield from self._run(run)
                run, held = [], 0
            if len(data) > SEGMENT:
                yield self._of_words(self._long(data))
            else:
                run.append(data)
                held += len(data) + 1
        yield from self._run(run)

    def _run(self, run: list[bytes]) -> Iterator[np.ndarray]:
        if run:
            w, starts = self.word_hashes(b" ".join(run))
            first = np.cumsum([0] + [len(x) + 1 for x in run])
            for part in np.split(w, np.searchsorted(starts, first[1:-1])):
                yield self._of_words(part)


class Sketch:
    """Band keys of a set: one hash per shingle, its smallest value in each bin, and empty bins lent a filled one.

    Each empty bin goes through the bins in a random order of its own and takes the
    first that is filled, the same for every set.
    """

    def __init__(self, bands: int, rows: int):
        random = np.random.default_rng(29)
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.turn = random.permuted(np.tile(np.arange(self.bins), (self.bins, 1)), axis=1)
        edges = [(i << 64) // self.bins for i in range(self.bins)]
        self.edges = np.array(edges, np.uint64)
        self.odd = random.integers(0, 2**63, rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(hashes, self.edges)
        filled = np.flatnonzero(np.diff(np.append(at, len(hashes))))
        signature = hashes[np.minimum(at, len(hashes) - 1)]
        if len(filled) < self.bins:
            empty = np.setdiff1d(np.arange(self.bins), filled)
            lender = filled[np.argmin(self.turn[np.ix_(empty, filled)], axis=1)]
            signature[empty] = signature[lender]
        return mixed((signature.reshape(self.bands, self.rows) * self.odd).sum(axis=1, dtype=np.uint64)).view(np.int64)


def _sketches(docs: DataFrame, s: Settings) -> DataFrame:
    """Per row: id, n (its shingles), d1 and d2 (digest of the set), bands."""

    def run(batches):
        shingles, sketch = Shingles(s.words), Sketch(s.bands, s.rows)
        for batch in batches:
            n, digest, bands = [], [], []
            for hashes in shingles.of(batch.column(1).to_pylist()):
                n.append(len(hashes))
                digest.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                bands.append(sketch.of(hashes) if len(hashes) else np.zeros(0, np.int64))
            d = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1])]
            columns.append(pa.array(bands, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "d1", "d2", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return rows.mapInArrow(run, "id long, n long, d1 long, d2 long, bands array<long>")


def _sets(docs: DataFrame, s: Settings) -> DataFrame:
    def run(batches):
        shingles = Shingles(s.words)
        for batch in batches:
            ids, first, held = batch.column(0), 0, []
            for hashes in shingles.of(batch.column(1).to_pylist()):
                held.append(hashes.view(np.int64))
                if sum(map(len, held[-64:])) > 1 << 17 or len(held) == 512:
                    yield _named(ids, first, held)
                    first, held = first + len(held), []
            if held:
                yield _named(ids, first, held)

    def _named(ids, first, held):
        return pa.RecordBatch.from_arrays(
            [ids.slice(first, len(held)), pa.array(held, pa.list_(pa.int64()))], ["id", "hashes"]
        )

    return docs.mapInArrow(run, "id long, hashes array<long>")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Groups documents linked by a Jaccard similarity of `percent` or more of their shingle sets.

    Rows with the same set are one class, found by grouping a 128-bit digest.  A class
    is sketched into bands; classes that share a band are a bucket.  In each bucket one
    centre, the member with the fullest buckets, is a candidate for all others, which
    bounds the pairs to the members.  Candidates are confirmed on their full sets.  The
    rest are buckets whose other members are not all linked together: among their members
    an exact prefix filter over the rarest shingles finds the pairs that may be links
    and are not yet connected, so no link is lost to the star shape.

    Returns a row per input row: doc_id, n_shingles, component_id (the smallest doc_id
    reachable), kept.  Null, empty and blank texts have no shingles and link with
    nothing; texts of fewer words than a shingle are one shingle; rows without doc_id are
    kept and link with nothing; repeated rows share a component and are all kept or none.
    """
    s = settings
    sketches = written(_sketches(docs, s), "sketches")
    real = sketches.where("id is not null and n > 0")
    classes = written(real.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "classes")
    members = _bucket_members(real, classes)
    wanted = members.select(F.col("rep").alias("wanted")).distinct()
    sets = written(
        _sets(
            docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(
                wanted, F.col("id") == F.col("wanted"), "left_semi"
            ),
            s,
        ),
        "shingle-sets",
    )
    labels = _linked(members, sets, s)
    mine = sketches.join(classes, ["d1", "d2"], "left")
    mine = mine.join(labels, mine.rep == labels.node, "left")
    linked = F.col("id").isNotNull() & (F.col("n") > 0)
    component = F.when(linked, F.coalesce("label", "rep")).otherwise(F.col("id"))
    return mine.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _bucket_members(real: DataFrame, classes: DataFrame) -> DataFrame:
    """Buckets of two classes or more: key, rep, n, centre (the member whose buckets hold most classes)."""
    reps = real.join(classes, ["d1", "d2"]).where("id = rep").select("rep", "n", "bands").dropDuplicates(["rep", "bands"])
    rows = reps.select("rep", "n", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("key"), "rep", "n"
    )
    full = written(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    kept = written(rows.join(full, "key"), "bucket-members")
    score = kept.groupBy("rep").agg(F.sum("size").alias("score"))
    kept = kept.join(score, "rep")
    centre = kept.groupBy("key").agg(F.max(F.struct("score", (-F.col("rep")).alias("back"))).alias("top"))
    centre = written(centre.select("key", (-F.col("top.back")).alias("centre")), "centres")
    return written(
        kept.join(centre, "key").select("key", "rep", "n", "centre"), "bucket-members"
    )


def _linked(members: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """node, label of the classes with links."""
    of_centre = members.where("rep = centre").select("key", F.col("rep").alias("a"), F.col("n").alias("na"))
    star = of_centre.join(members.select("key", F.col("rep").alias("b"), F.col("n").alias("nb")), "key").where("a <> b")
    star = star.where(100 * F.least("na", "nb") >= s.percent * F.greatest("na", "nb")).select("a", "b").distinct()
    links = _confirmed(star, sets, s)
    labels = components(links)
    open_ = _open_members(members, labels)
    if open_.isEmpty():
        return labels
    return components(links.unionByName(_confirmed(_rest(open_, sets, s), sets, s)))


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """rep, label and whether it is outside its first centre's component, of buckets with unconnected members besides their centre."""
    state = _labelled(_labelled(members, labels, "rep", "label"), labels, "centre", "home")
    ends = state.where("rep <> centre").groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    open_ = written(ends.where("lo < hi").select("key"), "buckets")
    open_ = state.join(open_, "key", "left_semi").groupBy("rep").agg(
        F.first("label").alias("label"), F.max(F.col("label") != F.col("home")).alias("outside")
    )
    return written(open_, "open-members")


def _rest(open_: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Candidates (a, b) among open members of different components, by an exact prefix filter.

    Each set is ordered by how rare its shingles are.  With the rarest ones a pair shares
    first, at positions i and j, it shares no more than what follows; so a longer set need
    only show as many as it may miss from the shortest partner, a shorter one as many as
    it may miss from an equal one, and a pair needs enough left behind its first match.
    """
    p = s.percent
    own = sets.join(open_, sets.id == open_.rep).select(
        "id", F.xxhash64("id", "hashes").alias("of_set"), F.size("hashes").alias("n"), "label", "outside", "hashes"
    )
    each = own.select("id", "of_set", "n", "label", "outside", F.explode("hashes").alias("hash"))
    often = written(each.groupBy("hash").agg(F.count("*").alias("often")).where("often > 1"), "often")
    rarest = Window.partitionBy("id", "of_set").orderBy(F.coalesce("often", F.lit(1)), "hash")
    placed = each.join(often, "hash", "left").withColumn("at", F.row_number().over(rarest) - 1)
    to_longer = F.col("n") - F.ceil(F.lit(2 * p) * F.col("n") / (100 + p)) + 1
    to_shorter = F.col("n") - F.ceil(F.lit(p) * F.col("n") / 100) + 1
    # a shingle of one set only can't match
    shown = written(placed.where((F.col("at") < to_shorter) & F.col("often").isNotNull()), "prefixes")
    long = shown.select("hash", *(F.col(c).alias(f"x_{c}") for c in ("id", "n", "label", "outside", "at")))
    short = shown.where(F.col("at") < to_longer)
    short = short.select("hash", *(F.col(c).alias(f"y_{c}") for c in ("id", "n", "label", "outside", "at")))
    left = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    fits = (
        (F.col("x_label") != F.col("y_label"))
        & (F.col("x_n") >= F.col("y_n"))
        & ((100 + p) * left >= p * (F.col("x_n") + F.col("y_n")))
    )
    # one of a pair is outside its home; pairs of two that are not are never made, however many there are
    looking = long.where("x_outside").join(short, "hash").where(fits)
    looked_at = long.where("not x_outside").join(short.where("y_outside"), "hash").where(fits)
    return looking.unionByName(looked_at).select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()


def _labelled(state: DataFrame, labels: DataFrame, of: str, name: str) -> DataFrame:
    labels = labels.select(F.col("node").alias(of), F.col("label").alias(name))
    return state.join(labels, of, "left").withColumn(name, F.coalesce(name, of))


def _confirmed(near: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Those of the candidates (a, b) that are links on their full sets."""
    both = near.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a"
    )
    shared = F.size(F.array_intersect("ha", "hb"))
    checked = both.select("a", "b", shared.alias("shared"), (F.size("ha") + F.size("hb")).alias("sum"))
    return written(
        checked.where(100 * F.col("shared") >= s.percent * (F.col("sum") - F.col("shared"))).select("a", "b"), "links"
    )


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents without those that are not the smallest doc_id of their component.

    A doc_id with several texts goes only if none of its rows is kept.
    """
    of_id = near_duplicates(docs, settings).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    gone = of_id.where("not kept").select("doc_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), others(docs).alias("doc"))
    return rows.join(gone, "doc_id", "left_anti").select("doc.*")
