import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_force(rows, top, min_docs=3):
    docs = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        groups, holders = defaultdict(Counter), Counter()
        for _, source, words in (d for d in docs if d[0] == lang):
            groups[source].update(words)
            holders.update(set(words))
        kept = [t for t, n in holders.items() if n >= min_docs]

        def shares(n):
            total = sum(n[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (n[t] + 1) // total for t in kept}

        q = shares(sum(groups.values(), Counter()))
        p = {s: shares(n) for s, n in groups.items()}
        for s in groups:
            parts = {"pair": [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s],
                     "term": [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, divergence.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus(seed, n=90):
    rnd = random.Random(seed)
    vocabulary = [a + b for a in "abcdeÄß日z" for b in ("", "x", "Y", "é", "zz")]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rnd.choice(["s1", "s2", "s3", None])
        words = [rnd.choice(vocabulary[: rnd.randint(2, len(vocabulary))]) for _ in range(rnd.randint(0, 60))]
        rows.append((rnd.choice([" ", "1", "-", "\n"]).join(words), rnd.choice(["en", "en", "de", None]), source))
    return rows + rows[:10] + [(None, "xx", "empty"), ("", "xx", "other"), ("only here", "yy", None), ("123 ...", None, "odd")]


@pytest.mark.parametrize("seed, top, blocks", [(1, 5, 128), (2, 200, 1), (3, 1, 2)])
def test_matches_brute_force(spark, monkeypatch, seed, top, blocks):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", blocks)           # with few: several blocks of sources meet
    monkeypatch.setattr(divergence, "BUCKET_ROWS", 30)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    got = found(docs.withColumn("term", F.lit("x")).withColumn("n", F.lit(1)).withColumn("part", F.lit("y")), top=top)
    assert got == brute_force(rows, top)
    assert any(r[2] == "term" for r in got)


def test_odd_texts_and_empty_table(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("lang", F.lit("en")).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a"))
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert found(docs) == brute_force(rows, 200)
    assert found(no_docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))) == []


@pytest.mark.parametrize("seed", range(10))
def test_skyband_keeps_what_fewer_than_k_dominate(seed):
    rng = np.random.default_rng(seed)
    n, lang_n, place = rng.integers(1, 9, 1500), rng.integers(1, 12, 1500), rng.permutation(1500)
    k = int(rng.integers(1, 30))
    dominated = ((n >= n[:, None]) & (lang_n <= lang_n[:, None]) & (place < place[:, None])).sum(axis=1)
    assert (divergence.skyband(n, lang_n, place, k) == (dominated < k)).all()


def test_shares_in_two_steps_are_exact():
    rnd = random.Random(5)
    for _ in range(1000):
        of = rnd.randint(1, 9 * 10 ** 13)
        n = rnd.randrange(of)
        assert divergence._shares(np.array([n]), np.array([of]))[0] == 1 + 10 ** 9 * (n + 1) // of
