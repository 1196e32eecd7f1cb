import random

from tallyforge.operators import sentence_graph
from tallyforge.sources import layout


def laid_out(spark, *pages):
    rows = layout.blocks(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")).orderBy("page_id", "block").collect()
    return [[(r.kind, r.level, r.path, r.table_no, r.row_no, r.cell_no, r.text) for r in rows if r.page_id == i] for i in range(len(pages))]


def test_blocks_of_a_page(spark):
    page = """<html><head><title>T &amp; U</title><style>p{}</style></head><body>lead<h1>One</h1><p>a <b>bold</b>\n word<p>unclosed
      <h2>Two</h2><ul><li>x<li>y</ul>tail<table><tr><th>h<td>1</td></tr><tr><td>2</td><td></td><td>3</td></tr></table><table><tr><td>z</td></tr></table>
      <h3>Deep</h3>under<h2>Three</h2><p>c</p><h1>Next</h1>end<script>var p = "<p>no";</script><!-- <p>no --></body>"""
    got = laid_out(spark, page)[0]
    none = (None, None, None)
    assert got == [
        ("title", None, "", *none, "T & U"), ("paragraph", None, "", *none, "lead"), ("heading", 1, "", *none, "One"),
        ("paragraph", None, "One", *none, "a bold word"), ("paragraph", None, "One", *none, "unclosed"), ("heading", 2, "One", *none, "Two"),
        ("list_item", None, "One > Two", *none, "x"), ("list_item", None, "One > Two", *none, "y"), ("paragraph", None, "One > Two", *none, "tail"),
        ("cell", None, "One > Two", 1, 1, 1, "h"), ("cell", None, "One > Two", 1, 1, 2, "1"), ("cell", None, "One > Two", 1, 2, 1, "2"),
        ("cell", None, "One > Two", 1, 2, 3, "3"), ("cell", None, "One > Two", 2, 1, 1, "z"), ("heading", 3, "One > Two", *none, "Deep"),
        ("paragraph", None, "One > Two > Deep", *none, "under"), ("heading", 2, "One", *none, "Three"), ("paragraph", None, "One > Three", *none, "c"),
        ("heading", 1, "", *none, "Next"), ("paragraph", None, "Next", *none, "end")]


def test_malformed_and_odd_pages(spark):
    got = laid_out(spark, None, "", "no tags", "a < b and <p", "</p></h1>text</div>more", "<p>" * 3 + "x", "<P CLASS='a'>up</P>", "<script>never closed", "<td>loose")
    text = [[(b[0], b[-1]) for b in page] for page in got]
    assert text == [[], [], [("paragraph", "no tags")], [("paragraph", "a b and p")], [("paragraph", "text"), ("paragraph", "more")], [("paragraph", "x")],
                    [("paragraph", "up")], [("paragraph", "never closed")], [("cell", "loose")]]


def plain_ranks(sentences):
    """The same ranks over all pairs of sentences."""
    sets, unit = [set(s) for s in sentences], 10 ** 6
    w = [[len(a & b) if i != j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    rank = [unit] * len(sets)
    for _ in range(10):
        x = [unit * r // sum(row) if sum(row) else 0 for r, row in zip(rank, w)]
        rank = [150_000 + 85 * sum(w[i][j] * x[j] for j in range(len(sets))) // (100 * unit) for i in range(len(sets))]
    return rank


def test_ranks_by_words_equal_ranks_over_pairs():
    rnd = random.Random(3)
    for n in (1, 2, 7, 30):
        sentences = [[rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 6))] for _ in range(n)]
        assert sentence_graph.ranks(sentences).tolist() == plain_ranks(sentences)
    assert sentence_graph.ranks([]).tolist() == []


def test_central_sentences_ties_and_missing(spark):
    texts = ["Growth will come. Costs will come. Growth and costs will come!", "Same words here. Same words here.", None, "", "...", "nothing to see",
             "will. " * 500]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id long, parsed_text string, summary int")
    got = {r.id: r.summary for r in sentence_graph.central_sentences(df).collect()}
    assert got == {0: "Growth and costs will come!", 1: None, 2: None, 3: None, 4: None, 5: None, 6: "will."}
    any_word = {r.id: r.summary for r in sentence_graph.central_sentences(df, terms=None).collect()}
    assert any_word[1] == "Same words here." and any_word[5] == "nothing to see" and any_word[4] is None
