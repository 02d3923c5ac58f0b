"""Language identification with bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridiron.llm.common import written

UNKNOWN = "und"
SEGMENT = 1 << 20
HASHES = 4


class Grams:
    """Three code points of the lower-cased text around each letter, as one integer; all but letters are blanks."""

    def __init__(self) -> None:
        self.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def of(self, text: str) -> Iterator[np.ndarray]:
        text = f" {text.lower()} "
        for at in range(0, len(text), SEGMENT):
            codes = np.frombuffer(text[at : at + SEGMENT + 2].encode("utf-32-le"), np.uint32)
            letter = self.letter[codes]
            codes = np.where(letter, codes, 32).astype(np.int64)
            grams = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
            yield grams[letter[1:-1]]


def slots(grams: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The filter's rows of each n-gram, one array per hash function; size is a power of two."""
    x = grams.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x = x ^ (x >> np.uint64(31))
    step = (x >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((x + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """`rows` of the filter hold a bit per language, `false` is each language's rate of false positives."""

    languages: list[str]
    rows: np.ndarray
    false: np.ndarray
    usual: str

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """How many of the n-grams each language's filter holds."""
        found = None
        for at in slots(grams, len(self.rows)):
            found = self.rows[at] if found is None else found & self.rows[at]
        return np.unpackbits(found, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)[: len(self.languages)]

    def evidence(self, grams: Iterator[np.ndarray]) -> tuple[int, np.ndarray]:
        """The number of n-grams, and each language's hits less its expected false ones."""
        total, hits = 0, np.zeros(len(self.languages))
        for part in grams:
            if len(part):
                total += len(part)
                hits += self.counts(part)
        return total, np.maximum(0, hits - total * self.false) / (1 - self.false)

    def decide(self, grams: Iterator[np.ndarray]) -> tuple[str, float]:
        total, true = self.evidence(grams)
        if not total or not self.languages:
            return UNKNOWN, 0.0
        if not true.any():
            return self.usual, 0.0
        best = int(true.argmax())
        return self.languages[best], float(true[best] / true.sum())

    def share(self, grams: Iterator[np.ndarray]) -> float:
        """The share of the n-grams that the best language holds; 0 without n-grams or languages."""
        total, true = self.evidence(grams)
        return float(true.max() / total) if total and self.languages else 0.0


def document_counts(labelled: DataFrame) -> DataFrame:
    """lang, gram, n: the documents of a language that have the n-gram; all of them under the n-gram -1."""

    def count(batches):
        grams = Grams()
        held: dict[str, list[np.ndarray]] = {}
        docs: dict[str, int] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), keys, n], ["lang", "gram", "n"])
            for lang, n in docs.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([-1]), pa.array([n])], ["lang", "gram", "n"])
            held.clear()
            docs.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1))):
                parts = [np.unique(g) for g in grams.of(text)]
                own = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
                held.setdefault(lang, []).append(own)
                docs[lang] = docs.get(lang, 0) + 1
                size += len(own)
                if size > 4_000_000:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = labelled.where("text is not null and lang is not null").select(F.col("lang").cast("string"), "text")
    counted = rows.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, least_share: float = 0.02, least_ratio: float = 0.5, most_languages: int = 1000) -> Model:
    """Fills the filters from all rows of `labelled` (text, lang).

    An n-gram is in a language's filter if at least `least_share` of the language's
    documents have it, and it is at least `least_ratio` as common there as where it is
    most common.  The first bound also bounds the model: a language has at most its mean
    number of distinct n-grams per document divided by the share, whatever the input.
    The `most_languages` with most documents are learned (ties: first by name), so that a
    column full of stray labels, each of a document or two, can't make the model grow.
    """
    sums = written(document_counts(labelled), "gram-counts")
    totals = sums.where("gram = -1").select("lang", F.col("n").alias("docs")).orderBy(F.desc("docs"), "lang").limit(most_languages)
    docs = {r.lang: r.docs for r in totals.collect()}  # a row per learned language
    shares = sums.where("gram >= 0").join(F.broadcast(totals), "lang").select(
        "lang", "gram", (F.col("n") / F.col("docs")).alias("share")
    )
    common = shares.where(F.col("share") >= least_share)
    most = common.groupBy("gram").agg(F.max("share").alias("most"))
    kept = common.join(most, "gram").where(F.col("share") >= least_ratio * F.col("most")).select("lang", "gram")
    table = kept.toArrow()
    languages = sorted(docs)
    number = {x: i for i, x in enumerate(languages)}
    grams = table.column("gram").to_numpy()
    lang = np.array([number[x] for x in table.column("lang").to_pylist()], int)
    size = 1 << max(10, int(16 * max(1, len(grams)) - 1).bit_length())
    rows = np.zeros((size, (len(languages) + 7) // 8 or 1), np.uint8)
    for at in slots(grams, size):
        np.bitwise_or.at(rows, (at, lang // 8), (1 << (lang % 8)).astype(np.uint8))
    filled = np.unpackbits(rows, axis=1, bitorder="little").mean(axis=0)[: len(languages)]
    usual = min(docs, key=lambda x: (-docs[x], x)) if docs else UNKNOWN
    return Model(languages, rows, filled**HASHES, usual)


def _shared(docs: DataFrame, model: Model):
    """The model's parts as a broadcast value; its size is bounded, see `train`."""
    return docs.sparkSession.sparkContext.broadcast((model.languages, model.rows, model.false, model.usual))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (the language's share of all languages' hits) of each row, from its text alone.

    Every letter of the whole text gives an n-gram; one look-up tells all languages that
    have it, and each language's hits less its expected false ones decide; ties go to
    the first language by name.  A text without n-grams of any language gets the most
    frequent one with score 0.  Null, and texts without letters, are `und` with score 0,
    as is all if nothing was learned.  Null and repeated doc_ids are rows like others.
    """
    shared = _shared(docs, model)

    def run(batches):
        grams, model = Grams(), Model(*shared.value)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))  # one at a time
            said = [(UNKNOWN, 0.0) if t is None else model.decide(grams.of(t)) for t in texts]
            columns = [batch.column(0), pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def in_training(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def keep_identified(docs: DataFrame, model: Model, least: float = 0.1) -> DataFrame:
    """The documents in a learned language: the best one holds at least `least` of the n-grams of the whole text.

    So texts in no learned language go, as do null ones and those without letters; if no
    language was learned, all go.  `least` is far below what texts of a learned language
    reach (a third at the very least in the test tables, nearly all of them over 0.9).
    Only the text is sent to Python; all rows and columns of kept documents stay as they are.
    """
    shared = _shared(docs, model)

    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grams, model = Grams(), Model(*shared.value)
        for column in texts:
            kept = (t.as_py() for t in column)
            yield pa.array([t is not None and model.share(grams.of(t)) >= least for t in kept], pa.bool_())

    return docs.where(F.arrow_udf(known, "boolean")(F.col("text")))
