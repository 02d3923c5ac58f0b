"""Prefix trie, exact dedup and hard negatives against brute force on rows with nulls, ties, copies and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from gridiron.llm import exact_dedup, hard_negatives, prefix_trie

# ----------------------------------------------------------------- prefix trie

TURNS = "conv_id long, turn long, role string, text string, n_convs string"


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text, _ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append(((t is not None, t or 0), tie, role, text))
    said = {c: tuple(x[2:] for x in sorted(v)) for c, v in turns.items()}
    members, kids, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, s in said.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            kids[s[:-1]] += 1
    for s, m in members.items():
        value = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            saved[s[:d]] += value
            leaves[s[:d]] += not kids[s]
    return {
        (min(m), len(s)): (
            min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if said[c] == s).encode()).hexdigest(),
        )
        for s, m in members.items()
    }


def trie_rows(df):
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in df.collect()}


def some_turns(seed=5):
    rng, rows = random.Random(seed), []
    for c in range(-20, 60):
        length = rng.choice([1, 2, 3, 8, 9, 17, 30])
        start = rng.choice(["a b", "a b", "hello there you", "x"])
        texts = [start] + [rng.choice(["yes", "no no", " wide\x0bblank ", ""]) for _ in range(length - 1)]
        rows += [(c * 10**6, t, "user" if t % 2 else "assistant", text, "clash") for t, text in enumerate(texts)]
    rows += [(7, None, None, "first", "c"), (7, 1, "user", None, "c"), (7, 1, "user", None, "c"), (7, 1, "user", "tie", "c")]
    return rows + [(None, 0, "user", "no conversation", "c"), (8, 0, "user", "w " * 50_000, "c"), (9, None, None, None, "c")]


def test_trie_equals_brute_force(spark, monkeypatch):
    rows = some_turns() + [(10, t, "user", f"turn {t % 7}", "c") for t in range(150)]
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)  # long conversations have many chunks of blocks
    frame = spark.createDataFrame(rows, TURNS)
    nodes = prefix_trie.prefix_trie(frame)
    expected = brute_trie(rows)
    assert trie_rows(nodes) == expected
    texts = {(r.conv_id, r.depth): (r.role, r.text) for r in prefix_trie.node_texts(nodes, frame).collect()}
    assert texts.keys() == expected.keys() and texts[10, 150] == ("user", "turn 2") and texts[8, 1][1].startswith("w w")
    assert all((role, text) == (None, None) for (_, d), (role, text) in texts.items() if d == 0)


def test_trie_members_in_many_spans(spark):
    rows = [(c * 37, 0, "user", "the same", None) for c in range(-3000, 3000)]
    assert trie_rows(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == brute_trie(rows)


def test_empty_trie(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "c")], TURNS)).count() == 0


# ----------------------------------------------------------------- exact dedup

TEXTS = "doc_id long, text string, first string, bucket int"


def said(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[said(text)].append(i)
    out = Counter()
    for s, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, sha = (min(known) if known else None), hashlib.sha256(s.encode()).hexdigest()
        ids.sort(key=lambda i: (i is None, i))
        out.update((i, keep, len(ids), k == 0, sha) for k, i in enumerate(ids))
    return out


def some_texts(seed=3):
    rng = random.Random(seed)
    words = ["a", "b", "é", "\xa0", "日本"]
    rows = [(i, rng.choice([" ", "\n", "\t \x0b"]).join(rng.choice(words) for _ in range(rng.randrange(4))), "f", i) for i in range(400)]
    rows += [(None, "no id", "f", 1), (None, "no  id", "f", 2), (500, None, "f", 3), (501, "", None, None), (502, " ", "f", 4)]
    rows += [(503, "twice", "f", 5), (503, "twice", "f", 5), (504, "long " * 40_000, "f", 6), (505, "long\n" * 40_000, "f", 7)]
    return rows + [(None, "hot  text", "f", 8)] * 30 + [(600 + i, "hot text", "f", 9) for i in range(300)]


def test_exact_duplicates_equal_brute_force(spark, monkeypatch):
    rows = some_texts()
    frame = spark.createDataFrame(rows, TEXTS)
    assert Counter(tuple(r) for r in exact_dedup.exact_duplicates(frame).collect()) == brute_exact(rows)
    monkeypatch.setattr(exact_dedup, "LEAST", 1)  # many buckets; frequent texts overflow
    for bits in (64, 3, 1):  # few bits: chains of different texts with one key
        assert Counter(tuple(r) for r in exact_dedup.exact_duplicates(frame, key_bits=bits).collect()) == brute_exact(rows), bits


def test_dropping_exact_duplicates_keeps_columns(spark):
    rows = some_texts()
    frame = spark.createDataFrame(rows, TEXTS)
    out = exact_dedup.drop_exact_duplicates(frame)
    kept = [tuple(r) for r in out.collect()]
    assert out.columns == frame.columns and set(kept) <= set(rows)
    assert Counter(i for i, *_ in kept) == Counter(i for (i, _, _, k, _), n in brute_exact(rows).items() if k for _ in range(n))
    assert Counter(said(t) for _, t, *_ in kept) == Counter({said(t): 1 for _, t, *_ in rows})
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], TEXTS)).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    top = -(1 << 63)
    keys = [(top + (i << 50), 10) for i in range(64)] + [(1 << 61, 10), (1 << 62, 10_000)]  # crowded at one end; one key too large
    rows = exact_dedup.directory(spark.createDataFrame(keys, "h long, bytes long"), 100, 12).collect()
    load = Counter()
    for h, n in keys:
        slot = (h % 2**64) >> 52
        row = next(r for r in rows if r.slot == slot)
        assert row.bucket <= slot < row.bucket + 2 ** (12 - row.depth)
        load[row.bucket, row.depth] += n if n <= 100 else 0
    assert all(n <= 100 or d == 12 for (_, d), n in load.items())
    assert len({d for _, d in load}) > 1


# -------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, node string"


def brute_negatives(rows, positives=5, negatives=5):
    first = {}
    for i, x, label, _ in rows:
        if i is None or label is None or not x or any(c is None or not abs(c * 256) <= 1 << 24 for c in x):
            continue
        row = ([math.floor(256 * c) for c in x], label)
        first[i] = min(first.get(i, row), row)
    out = set()
    for a, (v, label) in first.items():
        if a % 10:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), i, other == label) for i, (w, other) in first.items() if i != a and len(w) == len(v)]
        scored.sort()
        for score, i, _ in [s for s in scored if s[2]][:positives]:
            hard = [s for s in scored if not s[2] and 80 * -score <= 100 * -s[0] <= 100 * -score][:negatives]
            out |= {(a, i, rank + 1, n, -score, -s) for rank, (s, n, _) in enumerate(hard)}
    return out


def mined(spark, rows, leaf=1024):
    usable = hard_negatives.usable(spark.createDataFrame(rows, VECTORS))
    found = hard_negatives.hard_negatives(usable, usable.where("id % 10 = 0"), leaf=leaf).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=12)).tolist(), int(rng.integers(3)), "clash") for i in range(300)]
    rows += [(300 + i, rows[4][1], i % 3, "copy") for i in range(120)]  # equal vectors, ties
    rows += [(500 + i, [float(i % 4), 1.0], i % 2, "short") for i in range(40)] + [(600, [5.0], 1, "alone"), (610, [0.0] * 12, 1, "zero")]
    rows += [(620, None, 1, ""), (630, [], 1, ""), (640, [1.0] * 12, None, ""), (650, [None] + [1.0] * 11, 1, "")]
    rows += [(660, [math.nan] * 12, 1, ""), (670, [math.inf] * 12, 1, ""), (680, [1e300] * 12, 1, ""), (None, [1.0] * 12, 1, "")]
    rows += [(0, rows[1][1], 2, "the id again"), (1, rows[1][1], rows[1][2], "the row again")]
    expected = brute_negatives(rows)
    assert len(expected) > 100
    assert mined(spark, rows) == expected
    assert mined(spark, rows, leaf=16) == expected  # several levels


def test_cover_tree_covers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).tolist(), 0, "") for i in range(400)] + [(400 + i, [1.0] * 5, i, "many labels") for i in range(50)]
    points = hard_negatives.points_of(hard_negatives.usable(spark.createDataFrame(rows, VECTORS)), 6)
    tree, leaves = hard_negatives.cover_tree(points, leaf=20, fan=4)
    nodes = {r.node: r for r in tree.collect()}
    held = {r.id: r for r in leaves.collect()}
    assert held.keys() == set(range(450)) and max(Counter(r.node for r in held.values()).values()) <= 40
    for r in held.values():
        x, node = np.array(r.v), nodes[r.node]
        assert node.is_leaf
        while node:
            away = np.append(x, np.sqrt(node.top - x @ x)) - np.array(node.c)
            assert np.linalg.norm(away) <= node.radius + 1e-6
            node = nodes.get(node.parent)


def test_no_vectors(spark):
    assert mined(spark, []) == set() and mined(spark, [(1, [1.0], 1, ""), (2, [1.0], 2, "")]) == set()
    large = [(i, [65000.0 + i] * 300, i % 2, "") for i in range(12)]  # inner products beyond what doubles hold exactly
    assert mined(spark, large) == brute_negatives(large)
