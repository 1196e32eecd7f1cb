import random
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import ODD_TEXTS

from tallyforge.llm import graph, neardup, queries


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute_force(rows):
    """{id: least reachable id} by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    seen = set()
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
    return {d: find(d) for d in sets}


def _words(r, n, vocabulary=400):
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def _edited(r, words, share):
    return [w if r.random() > share else f"e{r.randrange(10**6)}" for w in words]


def corpus(seed=1):
    """Copies, near copies around the threshold, chains, and passages that many texts share."""
    r = random.Random(seed)
    texts, passage = [], _words(r, 40)
    for _ in range(60):
        texts.append(_words(r, r.randint(3, 150)))
    for _ in range(25):
        base = _words(r, r.randint(30, 120))
        texts += [_edited(r, base, r.choice([0, 0.01, 0.02, 0.03, 0.05])) for _ in range(r.randint(2, 8))]
    chain = _words(r, 200)
    for k in range(12):                       # every link near the threshold, ends far apart
        chain = chain[6:] + _words(r, 6)
        texts.append(list(chain))
    texts += [_words(r, r.randint(5, 60)) + passage + _words(r, r.randint(5, 60)) for _ in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    r.shuffle(rows)
    return rows


def _check(spark, rows):
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_force(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(shingles(dict(rows)[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in got)
    return want


def test_matches_brute_force(spark):
    want = _check(spark, corpus())
    assert len(set(want.values())) < len(want) - 50


@pytest.mark.parametrize("node_docs", [16])
def test_large_nodes_lose_no_link(spark, monkeypatch, node_docs):
    """Nodes far above the limit: one dense group of near copies with a loose tail, and a
    passage that many texts share."""
    monkeypatch.setattr(neardup, "NODE_DOCS", node_docs)
    monkeypatch.setattr(neardup, "LANDMARKS", 4)
    r = random.Random(5)
    base, passage = _words(r, 120), _words(r, 60)
    texts = [_edited(r, base, r.choice([0.005, 0.01, 0.02, 0.025])) for _ in range(150)]
    far = _edited(r, base, 0.02)
    for _ in range(10):                       # reachable only through the copy before
        far = far[5:] + _words(r, 5)
        texts.append(far)
    texts += [passage + _words(r, r.randint(4, 60)) for _ in range(150)]
    rows = [(1000 - i, " ".join(t)) for i, t in enumerate(texts)]
    r.shuffle(rows)
    _check(spark, rows)


def test_query_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.queries()["op2_chosen_path_neardup"](spark, sf).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_force(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    got = neardup.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(ODD_TEXTS):
        assert by_id[i].n_shingles == len(shingles(t)) and by_id[i].component_id == i
    assert neardup.near_duplicates(no_docs).collect() == []


def test_without_duplicates_keeps_columns_and_one_of_each(spark, odd_docs, no_docs):
    kept = neardup.without_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == list(range(len(ODD_TEXTS)))
    assert sum(r.doc_id is None for r in rows) == 2
    assert neardup.without_duplicates(no_docs).collect() == []
    docs = spark.createDataFrame([(5, "a b c d e f g h"), (2, "A b C d e f g h"), (9, "other words in this one")], "doc_id long, text string")
    assert sorted(r.doc_id for r in neardup.without_duplicates(docs).collect()) == [2, 9]


def test_components_of_long_chains(spark):
    n = 70
    order = list(range(n))
    random.Random(2).shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1002, 1001), (7, 7)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000, 1002: 1000}


def test_shared_counts_are_exact():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 300, r.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    got = neardup.shared_counts(sets, columns=37)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))
