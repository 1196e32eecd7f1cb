import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import codes


def brute_force(rows, entries, rounds=4):
    """(vec_id, code, error) of the kept rows, and the codebooks, spelled out."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not [i for i, _ in kept if i is not None]:
        return [], []
    w = len(min((r for r in kept if r[0] is not None), key=lambda r: (r[0], len(r[1])))[1]) // 4
    kept = [(i, q) for i, q in kept if len(q) == 4 * w]
    first = {}
    for i, q in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(i, q)
    start = [first[i] for i in sorted(first)[:entries]]
    books = [[q[p * w:p * w + w] for q in start] for p in range(4)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            members = {}
            for _, q in kept:
                part = q[p * w:p * w + w]
                members.setdefault(best(part, books[p])[1], []).append(part)
            for k, found in members.items():
                books[p][k] = [sum(x) // len(found) for x in zip(*found)]
    out = []
    for i, q in kept:
        b = [best(q[p * w:p * w + w], books[p]) for p in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in b), sum(d for d, _ in b)))
    return sorted(out, key=repr), books


def vectors(seed, n, dim, levels):
    rnd = random.Random(seed)
    rows = [(i, [rnd.randint(-levels, levels) / 16 for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 2)]                      # one vector holds a third of all rows
    rows += [(7, rows[3][1]), (None, rows[4][1]), (900, None), (901, []), (902, [None] * dim), (903, [math.nan] * dim),
             (904, [math.inf] * dim), (905, [0.5] * (dim + 4))]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, dim, levels, entries", [(1, 8, 1, 5), (2, 16, 3, 16), (3, 4, 40, 256), (4, 12, 2, 1)])
def test_matches_brute_force(spark, seed, dim, levels, entries):
    rows = vectors(seed, 120, dim, levels)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).withColumn("code", F.lit(1)).withColumn("q", F.lit(2))
    coded, books = codes.codes(df, entries=entries)
    expected, expected_books = brute_force(rows, entries)
    assert coded.columns == ["vec_id", "embedding", "q", "code", "error"]
    assert sorted(map(tuple, coded.select("vec_id", "code", "error").collect()), key=repr) == expected
    assert books.tolist() == expected_books
    assert codes.codebooks_digest(books)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [1.0] * 8)], [(1, [1.0, 2.0, 3.0])], [(1, [1e30] * 4)]])
def test_nothing_to_code(spark, rows):
    coded, _ = codes.codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert coded.count() == 0


def test_trie_walk_is_the_nearest_entry():
    rng = np.random.default_rng(3)
    for n, levels in ((5000, 2), (3000, 400), (1, 5), (2000, 1)):
        parts, where, counts = codes.distinct_rows(rng.integers(-levels, levels + 1, (n, 6)))
        assert counts.sum() == n and (parts[where] == parts[where]).all()
        entries = rng.integers(-levels, levels + 1, (17, 6))
        squared = ((parts[:, None] - entries) ** 2).sum(axis=2)
        index, distance = codes.nearest(parts, entries)
        assert (index == squared.argmin(axis=1)).all() and (distance == squared.min(axis=1)).all()
