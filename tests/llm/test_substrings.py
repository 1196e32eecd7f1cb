import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import common, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, window):
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    starts = Counter(tuple(w[k:k + window]) for _, w in docs for k in range(len(w) - window + 1))
    out = []
    for i, w in docs:
        gone = {k + j for k in range(len(w) - window + 1) if starts[tuple(w[k:k + window])] > 1 for j in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def found(docs, window, **options):
    rows = substrings.without_repeats(docs, window=window, **options).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    return sorted(map(tuple, rows), key=repr)


def corpus(seed, n=120):
    """Random prose of few words, with shared passages, copies, edited copies and periods."""
    rnd = random.Random(seed)
    prose = lambda k: [rnd.choice("abcdefghijkl") + rnd.choice("xyz") for _ in range(k)]
    common, texts = [prose(k) for k in (9, 12, 20, 45)], []
    for i in range(n):
        words = prose(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            words += rnd.choice(common) + prose(rnd.randint(0, 8))
        if texts and i % 5 == 0:
            words = list(rnd.choice(texts))
            if words and i % 2:
                words[rnd.randrange(len(words))] = "edit"
        if i % 17 == 3:
            words += ["p", "q", "r"] * rnd.randint(1, 40)
        if i % 11 == 4:
            words += ["z"] * rnd.randint(1, 60)
        texts.append(words)
    return [(i, rnd.choice([" ", "\n", "\t ", "  "]).join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("seed, window, gram, hot", [(1, 12, 5, 1000), (2, 12, 5, 3), (3, 20, 6, 5), (4, 8, 8, 2), (5, 70, 5, 4)])
def test_matches_brute_force(spark, seed, window, gram, hot):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = found(docs, window, gram=gram, hot=hot)
    assert got == brute_force(rows, window)
    assert any(r[2] for r in got) and any(not r[2] for r in got)


def test_odd_rows_clashing_columns_and_empty_table(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("n_words", F.lit("x")).withColumn("doc_a", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("row", F.lit(0))
    got = substrings.without_repeats(docs, window=3, gram=2)
    assert got.columns == [c for c in docs.columns if c != "n_words"] + ["n_words", "n_removed", "kept_text"]
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=repr) == brute_force(rows, 3)
    assert substrings.without_repeats(no_docs).count() == 0


def test_copies_repeat_each_other(spark):
    text = " ".join(f"w{i}" for i in range(500))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text + " tail"), (3, " ".join(text.split()[:34]))],
                                 "doc_id long, text string")
    assert [r[2] for r in found(docs, 35)] == [500, 500, 500, 0, 500]


@pytest.mark.parametrize("seed", range(20))
def test_automaton_counts_every_window(seed):
    rnd = random.Random(seed)
    members = [([rnd.randrange(3) for _ in range(rnd.randint(4, 20))], rnd.randint(1, 2)) for _ in range(rnd.randint(1, 6))]
    counts = Counter()
    automaton = substrings.SuffixAutomaton()
    for seq, n in members:
        automaton.add(seq, n)
        for k in range(len(seq) - 3):
            counts[tuple(seq[k:k + 4])] += n
    automaton.finish()
    for seq, _ in members:
        bits = automaton.repeated(seq, 4)
        assert [bits >> k & 1 for k in range(len(seq) - 3)] == [int(counts[tuple(seq[k:k + 4])] > 1) for k in range(len(seq) - 3)]


@pytest.mark.parametrize("bits", [16, 22, 24])
def test_bitmap_reaches_the_driver_in_pieces(spark, bits):
    """262,144 words at most (2 MB); a row for each of them took 115 MB of the driver in a
    session without Arrow."""
    keys = spark.range(400_000).select(F.xxhash64("id").alias("key"))
    hashes = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    want = np.zeros(1 << bits, bool)
    want[hashes >> np.uint64(64 - bits)] = True
    arrow = "spark.sql.execution.arrow.pyspark.enabled"
    old = spark.conf.get(arrow)
    spark.conf.set(arrow, "false")
    tracemalloc.start()
    try:
        bitmap = common.hash_bitmap(keys, "key", bits).value
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
        spark.conf.set(arrow, old)
    assert (np.unpackbits(bitmap.view(np.uint8), bitorder="little").astype(bool) == want).all()
    assert common.in_bitmap(bitmap, hashes).all()
    assert peak < 20, peak


def test_bitmap_of_no_rows(spark):
    assert not common.hash_bitmap(spark.range(0).select(F.col("id").alias("key")), "key", 24).value.any()
