"""Packing of tokenized documents into sequences: best-two-fit over a histogram of lengths."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain, count, filterfalse, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridiron.llm.common import ranked, written

#: Surely one word of the tokenizer: letters of Latin-1 that are what they are when lower-cased and composed.
PLAIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Punctuation between a letter and white space, which the tokenizer parts from the word before it (no apostrophes, no marks of special tokens).
TAIL = r"([a-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([!-&(-/:;=?@\[-`{}~]+)([ \n\t\r\v\f]|$)"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Token ids of texts by a tokenizer that lower-cases and for which white space always ends a token.

    Texts are cut at ASCII white space and each different part of a portion is looked up
    once among the parts this task knows, so the tokenizer only sees new ones; punctuation
    after a word is a part of its own.  New parts that are surely one word are encoded
    together in lines, told apart by the ids that end a word; others are told apart by a
    special token between them.  Texts that hold the name of a special token are encoded whole.
    The store is emptied when it is full, which changes no result.
    """

    def __init__(self, path: str, most: int = 400_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.names = list(special.values())
        self.between = min(special, default=None)
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.count, self.flat = [np.zeros(0, int)], [np.zeros(0, np.uint32)]

    def learn(self, parts: list[str]) -> None:
        plain = list(filter(PLAIN.fullmatch, parts))
        odd = list(filterfalse(PLAIN.fullmatch, parts))
        flat, _ = self._encoded([" ".join(plain[i : i + 256]) for i in range(0, len(plain), 256)])
        past = np.flatnonzero(self.ends[flat]) + 1
        more, each = self._apart(odd)
        self.index.update(zip(chain(plain, odd), count(len(self.index))))
        self.count = [np.concatenate([*self.count, np.diff(past, prepend=0), each])]
        self.flat = [np.concatenate([*self.flat, flat, more])]

    def _apart(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.between is None:
            return self._encoded(parts)
        mark = f" {self.tokenizer.id_to_token(self.between)} "
        ids, _ = self._encoded([mark.join(parts[i : i + 256]) + mark for i in range(0, len(parts), 256)])
        last = np.flatnonzero(ids == self.between)
        return ids[ids != self.between], np.diff(last, prepend=-1) - 1

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), int, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has; null is empty."""
        texts = texts.fill_null("")
        named = np.zeros(len(texts), bool)
        for name in self.names:
            named |= pc.match_substring(texts, name, ignore_case=True).to_numpy(zero_copy_only=False)
        if not named.any():
            return self._of_parts(texts)
        each = [self._encoded([t.as_py()]) if whole else self._of_parts(texts.slice(i, 1)) for i, (t, whole) in enumerate(zip(texts, named))]
        return np.concatenate([ids for ids, _ in each]), np.concatenate([n for _, n in each])

    def _of_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), TAIL, r"\1 \2\3"))
        coded = split.flatten().dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.index.get, parts, repeat(-1)), int, len(parts))
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.index) + len(new) > self.most:
                self.clear()
                new = np.arange(len(parts))
            missing = list(map(parts.__getitem__, new.tolist()))
            self.learn(missing)
            at[new] = np.fromiter(map(self.index.__getitem__, missing), int, len(missing))
        known, flat = self.count[0], self.flat[0]
        first = (np.cumsum(known) - known)[at]
        code = coded.indices.to_numpy()
        counts = known[at][code]
        ends = np.cumsum(counts)
        ids = flat[np.repeat(first[code] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return ids, np.diff(upto)


def cut(text: str, most: int) -> Iterator[str]:
    """The text in runs of about `most` characters, each but the last ending at a blank or line end."""
    at = 0
    while len(text) - at > most:
        ends = [e for e in (text.find(c, at + most) for c in " \n") if e >= 0]
        if not ends:
            break
        yield text[at : min(ends) + 1]
        at = min(ends) + 1
    if at < len(text):
        yield text[at:]


def in_portions(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about `most` bytes, with the place of the first."""
    size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = size[first - 1] if first else 0
        past = max(first + 1, int(np.searchsorted(size, before + most, "right")))
        yield first, texts.slice(first, past - first)
        first = past


def tokenized(docs: DataFrame, tokenizer: str, size: int, with_ids: bool, longest: int = 1 << 20) -> DataFrame:
    """A row per piece of at most `size` ids of each document: its ids, then 0.

    Texts are encoded in portions of about `longest` bytes; longer ones are cut at white space.
    """

    def pieces(batches):
        yield from cut_up(batches, WordIds(tokenizer))
        pa.default_memory_pool().release_unused()  # the worker lives on

    def cut_up(batches, words):
        for batch in batches:
            for first, run in in_portions(batch.column(1), longest):
                if len(run) == 1 and len(text := run[0].as_py() or "") > longest:
                    ids = np.concatenate([words.of(pa.array([part]))[0] for part in cut(text, longest)])
                    counts = np.array([len(ids)])
                else:
                    ids, counts = words.of(run)
                ids = np.insert(ids, np.cumsum(counts), 0).astype("<u4")
                counts = counts + 1
                n = -(-counts // size)
                row = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum(size, counts[row] - start)
                place = (np.cumsum(counts) - counts)[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(place.tolist(), length.tolist())]
                out = [batch.column(0).take(pa.array(first + row)), pa.array(piece, pa.int32())]
                out += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(place, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(out, names[: len(out)])

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, schema)


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns of lengths and how many sequences follow each, from the number of pieces of each length.

    A sequence starts with the longest piece left and takes the longest that fits until
    none does.  Then its smallest piece makes way for the two left over that fill its
    place and the gap best, as long as that leaves less of a gap.  The pattern is used
    as often as the counts allow, so the plan has a bounded number of patterns however
    many pieces there are.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    plan = []
    while lengths:
        bin_: list[int] = []
        gap = size

        def free(n: int) -> bool:
            return left[n] > bin_.count(n)

        def longest(most: int) -> int:
            at = bisect_right(lengths, most) - 1
            while at >= 0 and not free(lengths[at]):
                at -= 1
            return lengths[at] if at >= 0 else 0

        while gap and (n := longest(gap)):
            times = min(gap // n, left[n] - bin_.count(n))
            bin_ += [n] * times
            gap -= n * times
        while gap and len(bin_) > 1:
            small = min(bin_)
            bin_.remove(small)
            pair = _best_pair(np.array([n for n in lengths if free(n)]), left, bin_, gap + small)
            if sum(pair) <= small:
                bin_.append(small)
                break
            bin_ += pair
            gap += small - sum(pair)
        pattern = {n: bin_.count(n) for n in sorted(set(bin_), reverse=True)}
        times = min(left[n] // c for n, c in pattern.items())
        for n, c in pattern.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
                lengths.remove(n)
        plan.append((pattern, times))
    return plan


def _best_pair(lengths: np.ndarray, left: dict[int, int], held: list[int], room: int) -> list[int]:
    """Two lengths still free with the largest sum of at most `room`."""
    first = lengths[lengths < room]
    if not len(first):
        return []
    second = np.searchsorted(lengths, np.minimum(first, room - first), "right") - 1
    sums = np.where(second >= 0, first + lengths[second], 0)
    for i in np.argsort(-sums, kind="stable")[:16]:  # only a single piece of a length can't be its own partner
        a, b = int(first[i]), int(lengths[second[i]])
        if sums[i] and (a != b or left[a] - held.count(a) > 1):
            return [a, b]
        if sums[i] and second[i] > 0:
            return [a, int(lengths[second[i] - 1])]
    return []


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, with_ids: bool = True) -> DataFrame:
    """Packs documents into sequences of at most `size` token ids.

    A document is its ids followed by 0; only longer ones are cut, into pieces of
    `size`, the last one shorter.  The plan is made from the number of pieces of each
    length, at most `size` numbers whatever the input; pieces are ranked within their
    length in hash buckets, so a length that most pieces have is spread over tasks, and
    a broadcast table of the plan's slots gives each rank its sequence and offset.

    `tokenizer` is a tokenizer file on every executor.  Returns doc_id, piece, start,
    length, ids_crc32, ids (unless `with_ids` is false), sequence_id, offset.  A null or
    empty text is the single id 0; the name of a special token in a text is that token, as
    the tokenizer has it; null and repeated doc_ids are packed like all others.
    """
    spark = docs.sparkSession
    pieces = written(tokenized(docs, tokenizer, size, with_ids), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, sequence, taken = [], 0, dict.fromkeys(counts, 0)
    for pattern, times in best_two_fit(counts, size):
        offset = 0
        for n, c in pattern.items():
            slots.append((n, taken[n], taken[n] + c * times, c, sequence, offset))
            taken[n] += c * times
            offset += n * c
        sequence += times
    plan = spark.createDataFrame(slots, "of long, first long, past long, each long, sequence long, place long")
    order = ["doc_id", "piece", "ids_crc32"]
    within = F.col("rank") - F.col("first")
    return (
        ranked(pieces, ["length"], order)
        .join(F.broadcast(plan), [F.col("length") == F.col("of"), F.col("rank") >= F.col("first"), F.col("rank") < F.col("past")])
        .select(
            *pieces.columns,
            (F.col("sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("place") + (within % F.col("each")) * F.col("length")).cast("long").alias("offset"),
        )
    )
