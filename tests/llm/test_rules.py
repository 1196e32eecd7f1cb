import re
from collections import Counter, defaultdict

from tallyforge.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The base counts spelled out."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def brute_force(rows, min_docs, max_percent):
    def norm(x):
        return " ".join(WORD.findall(re.sub("[1-9]", "0", x.lower())))

    holders, hosts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        hosts[host].add(text or "")
        for x in (text or "").split("\n"):
            if WORD.search(x):
                holders[host, norm(x)].add(text)
    out = []
    for doc, text, host in rows:
        b = base(text)
        gone = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x)
                   and len(holders[host, norm(x)]) > min_docs
                   and 100 * len(holders[host, norm(x)]) > max_percent * len(hosts[host]))
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        kept = not failed and b[0] - gone >= 10 and 100 * gone <= 50 * b[0]
        out.append((doc, *b, failed, kept, gone))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                               "base_failed", "kept", "removed_words").collect()), key=repr)


def test_line_rule_matches_brute_force(spark):
    rows = []
    for i in range(40):
        own = [f"text {i} has words of its own number {k} alpha beta gamma" for k in range(i % 4)]
        common = ["Share THIS page 2024", "share this   page 1999 ", "  ", "All rights reserved by the site owner in all lands"][: i % 5]
        rows.append((i, "\n".join(own + common), "hot" if i % 3 else None))
    rows += [(i, rows[i][1], rows[i][2]) for i in range(10)] + [(100 + i, rows[7][1], "hot") for i in range(20)]
    rows += [(None, "null id " * 4, "cold"), (201, None, "cold"), (202, "", None), (203, "a b c d e " * 9, "cold"),
             (204, "one two three four five six one two three four five eight nine ten", "cold")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = _got(rules.line_rules(docs, min_docs=3, max_percent=5.0))
    assert got == brute_force(rows, 3, 5.0)
    assert any(r[-1] for r in got) and any(not r[-2] and not r[-3] for r in got)
    # copies of one text are one document of the count
    copies = spark.createDataFrame([(i, rows[7][1] + " and enough further words to pass", "hot") for i in range(50)],
                                   "doc_id long, text string, source string")
    assert all(r.removed_words == 0 for r in rules.line_rules(copies, min_docs=3, max_percent=5.0).collect())


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("piece", "source")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert _got(rules.line_rules(docs)) == brute_force(rows, rules.MIN_LINE_DOCS, rules.MAX_LINE_PERCENT)
    assert rules.line_rules(no_docs.withColumnRenamed("kept", "source")).collect() == []


def test_plan_is_native(spark, sf):
    plan = queries.queries()["op4_line_frequency_rules"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def clean(text, gone):
    """A text without the lines whose normal form is in ``gone``."""
    return "\n".join(x for x in text.split("\n") if " ".join(WORD.findall(re.sub("[1-9]", "0", x.lower()))) not in gone)


def test_cleaned_texts(spark):
    common = ["Share THIS page 2024", "share this   page 1999 "]
    texts = [f"  own line {chr(97 + i)}\n\n{common[i % 2]}\n \nlast {chr(97 + i)}  " for i in range(8)]
    rows = [(i, t, None if i > 3 else "hot", "mine") for i, t in enumerate(texts)] + [(i, texts[0], "hot", "mine") for i in range(20)]
    rows += [(None, None, "hot", "x"), (50, "", "hot", "x"), (51, common[0], "hot", None), (52, texts[0], "cold", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, gone string")
    got = rules.cleaned(docs, min_docs=3, max_percent=5.0)
    assert got.columns == docs.columns
    want = [(d, t if t is None or h == "cold" else clean(t, {"share this page 0000"}), h, x) for d, t, h, x in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert (51, "", "hot", None) in want and (0, "  own line a\n\n \nlast a  ", "hot", "mine") in want
    # the verdict's figure is what the cleaned text lacks
    words = sorted(((r.doc_id, r.removed_words) for r in rules.line_rules(docs, min_docs=3, max_percent=5.0).collect()), key=repr)
    assert words == sorted(((d, len(WORD.findall(t or "")) - len(WORD.findall(c or ""))) for (d, t, *_), (_, c, *_) in zip(rows, want)), key=repr)


def test_long_lines_have_a_limit_of_texts_only(spark, sf):
    long, short = "all rights reserved by the owner of this site in all lands", "read more"
    letters = "abcdefghij"
    rows = [(i, f"own words {letters[i // 10]} {letters[i % 10]}" + (f"\n{long}\n{short}" if i < 6 else ""), "hot") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for words, gone in ((None, set()), (10, {long})):
        got = rules.cleaned(docs, min_docs=3, max_percent=10.0, long_words=words)
        assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted((d, clean(t, gone)) for d, t, _ in rows)
        verdicts = rules.line_rules(docs, min_docs=3, max_percent=10.0, long_words=words).collect()
        assert sum(r.removed_words for r in verdicts) == (72 if gone else 0)
    plan = queries.queries()["op4_cleaned_documents"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
