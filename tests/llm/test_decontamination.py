import random

from llm_cases import ODD_TEXTS

from tallyforge.llm import decontamination as dc
from tallyforge.llm import queries


def templates(text):
    """Tokens of a text spelled out: (literal value or kind, placeholder value)."""
    out, inside = [], False
    for word in text.split():
        kind, value, title, ends = dc.token(word)
        if kind == dc.LITERAL and title and inside:
            kind = dc.NAME
        if kind != dc.SKIP:
            out.append((value if kind == dc.LITERAL else kind, value))
        inside = not ends
    return out


def windows(text):
    """Usable windows, each where it first stands."""
    t, seen = templates(text or ""), set()
    for i in range(len(t) - dc.WINDOW + 1):
        own = t[i:i + dc.WINDOW]
        key, slots = tuple(a for a, _ in own), [(a, v) for a, v in own if not isinstance(a, str)]
        if sum(isinstance(a, str) for a in key) >= dc.MIN_LITERALS and (key, *slots) not in seen:
            seen.add((key, *slots))
            yield i, key, slots


def brute_force(docs, items):
    """{(doc_id, item_id): matched windows} of the leaks, comparing all windows."""
    out = {}
    for doc, text in docs:
        for item in {i for i, _ in items}:
            wanted = [w for i, t in items if i == item for w in windows(t)]
            shifts = {}
            for p, key, values in windows(text):
                for q, other, slots in wanted:
                    if key == other:
                        places, pairs = shifts.setdefault(p - q, (set(), set()))
                        places.add(q)
                        pairs.update(zip(values, slots, strict=True))
            matched = set()
            for places, pairs in shifts.values():
                if len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                    matched |= places
            n = len({q for q, _, _ in wanted})
            if matched and len(matched) >= dc.MIN_COVERAGE * n:
                out[doc, item] = (len(matched), n)
    return out


QUESTION = ("If a train leaves the station at 40 kilometers per hour and a boy called Peter runs after it with 12 apples "
            "in his bag how many apples will Peter have left after 3 hours of running through the dark forest")


def test_reparameterised_questions(spark):
    r = random.Random(3)
    filler = " ".join(f"word{chr(97 + r.randrange(26))}x" for _ in range(30))
    changed = QUESTION.replace("40", "95").replace("Peter", "Maria").replace("12", "7").replace("kilometers", "miles")
    mixed = QUESTION.replace("Peter", "Maria", 1)      # one name became two: not the same question
    docs = [(1, f"{filler} {QUESTION} {filler}"), (2, f"{filler}. {changed}! {filler}"), (3, filler), (4, None), (5, ""),
            (6, mixed), (7, QUESTION.upper()), (8, " | ".join(QUESTION.split())), (9, QUESTION[:60]), (None, QUESTION), (1, f"{filler} {QUESTION} {filler}")]
    items = [(10, QUESTION), (11, "too short to tell"), (12, None), (13, filler + " other " + filler)]
    got = {(x.doc_id, x.item_id): (x.matched, x.item_windows) for x in dc.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_force(docs, items)
    assert {(1, 10), (2, 10), (8, 10), (None, 10)} <= got.keys() and (3, 10) not in got


def test_query_matches_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.queries()["op10_template_decontamination"](spark, sf).collect()
    assert {(r.doc_id, r.item_id): (r.matched, r.item_windows) for r in got} == brute_force(docs, items)
    assert got


def test_odd_rows_and_filter(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, ODD_TEXTS[6]), (None, ODD_TEXTS[5]), (2, "one two " * 8)], "item_id long, text string")
    found = dc.leaks(odd_docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(6, 1), (6, 2)}
    kept = dc.without_leaks(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert dc.leaks(no_docs, items).collect() == [] and dc.leaks(odd_docs, items.limit(0)).collect() == []
    docs = spark.createDataFrame([(None, QUESTION), (None, "something else")], "doc_id long, text string")
    kept = dc.without_leaks(docs, spark.createDataFrame([(1, QUESTION)], "item_id long, text string")).collect()
    assert [r.text for r in kept] == ["something else"]


def test_inconsistent_values_drop_only_their_windows(spark):
    item = ("Every morning a farmer picks 3 apples from the old tree behind the barn and then walks for 3 hours to the market "
            "where all the people wait for fresh fruit and pay in small coins before they go home again")
    docs = [(1, item.replace("3 apples", "5 apples").replace("3 hours", "7 hours")),       # one value became two
            (2, item.replace("3 apples", "5 apples")),                                     # one of two equal values edited
            (3, QUESTION.replace("40", "7").replace("12", "7")),                           # two values became one
            (4, QUESTION.replace("Peter", "Maria", 1)), (5, "nothing of the kind " * 20)]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item), (2, QUESTION)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in dc.leaks(docs, items, strict=False).collect()}
    assert found.keys() == {(1, 1), (2, 1), (3, 2), (4, 2)}
    assert all(0.3 <= r.coverage < 1 for r in found.values())
    assert [r.doc_id for r in dc.without_leaks(docs, items, strict=False).collect()] == [5]


def test_majority_mapping():
    windows = [(0, []), (1, [("1:5", "1:3")]), (2, [("1:5", "1:3")]), (3, [("1:7", "1:3")]), (4, [("1:3", "1:3")]), (5, [("1:7", "1:9")])]
    assert dc.consistent_places(windows) == [0, 1, 2, 4, 5]
