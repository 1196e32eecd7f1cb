from pyspark.sql import functions as F

from tallyforge.functions.text import initcap_words
from tallyforge.operators import signals
from tallyforge.sources import documents


def test_initcap_splits_on_punctuation(spark):
    df = spark.createDataFrame([("mary-jane o'neil",), ("FIRST12",), (None,), ("a.b c",)], "s string")
    got = [r[0] for r in df.select(initcap_words("s")).collect()]
    assert got == ["Mary-Jane O'neil", "First12", None, "A.B C"]


def test_file_name_keys_and_pdf_filter(spark):
    stage = spark.createDataFrame([("EARNINGS_SYM023_2026Q1.pdf", "x"), ("x.pdf", "y"), ("y.txt", "z"),
                                   ("EARNINGS_SYM001_2025Q4_d1.PDF", "w")], "file_name string, content string")
    out = {r["file_name"]: (r["symbol"], r["fiscal_period"]) for r in documents.transcripts_raw(stage).collect()}
    assert out == {"EARNINGS_SYM023_2026Q1.pdf": ("SYM023", "2026Q1"), "x.pdf": (None, None),
                   "EARNINGS_SYM001_2025Q4_d1.PDF": ("SYM001", "2025Q4")}


TEXTS = {
    "pos": "A record quarter with strong growth. Revenue grew and margins improved. We are raising guidance "
           "and remain confident and optimistic about robust momentum.",
    "neg": "A very challenging quarter. Sales declined amid weak demand and pressure on margins. We are "
           "lowering our outlook and cutting costs given uncertain conditions and losses.",
    "neutral": "Results were broadly in line. We hold our posture.",
    "mixed": "The quarter was mixed: strong production and solid cash flow, but an impairment and "
             "volatility weighed on margins; conditions are uncertain.",
}


def test_sentiment_labels(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "file_name string, parsed_text string")
    got = {r["file_name"]: r["sentiment"] for r in signals.with_sentiment(df).collect()}
    assert got == {"pos": "positive", "neg": "negative", "neutral": "neutral", "mixed": "mixed"}


def test_sentiment_rule_thresholds(spark):
    df = spark.createDataFrame([(0, 0), (2, 1), (9, 1), (8, 2), (0, 5), (3, 3)], "p int, n int")
    got = [r[0] for r in df.select(signals.sentiment_label(F.col("p"), F.col("n"))).collect()]
    assert got == ["neutral", "neutral", "positive", "mixed", "negative", "mixed"]


def test_outlook_sentence_picks_most_forward_looking_earliest(spark):
    text = ("Revenue rose. We expect growth next year and will raise guidance.\n"
            "Costs fell. We expect more next quarter and plan ahead.")
    df = spark.createDataFrame([(text,), ("No statement here.",)], "t string")
    got = [r[0] for r in df.select(signals.outlook_sentence("t")).collect()]
    assert got == ["We expect growth next year and will raise guidance.", None]


def test_html_to_text(spark):
    html = ("<html><head><style>p{x}</style><script>var a='<p>';</script></head>"
            "<body><!-- c --><h1>Title &amp; more</h1>\n<p>Para&nbsp;one</p></body></html>")
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(documents.html_to_text("h")).first()[0] == "Title & more Para one"


def test_read_documents_from_folder(spark, scratch):
    import os
    for name, body in (("A_SYM001_2026Q1.pdf", "alpha"), ("b.PDF", "beta"), ("c.txt", "gamma")):
        with open(os.path.join(scratch, name), "w") as fh:
            fh.write(body)
    df = documents.read_documents(spark, scratch)
    assert sorted((r["file_name"], r["content"]) for r in df.collect()) == [
        ("A_SYM001_2026Q1.pdf", "alpha"), ("b.PDF", "beta")]


def test_extract_text_by_file_type(spark):
    df = spark.createDataFrame([("a.HTML", "<p>Hi&amp;bye</p>"), ("b.txt", "<p>kept</p>")], "file_name string, content string")
    got = dict(df.select("file_name", documents.extract_text().alias("t")).collect())
    assert got == {"a.HTML": "Hi&bye", "b.txt": "<p>kept</p>"}


def test_folder_scan_reads_only_matching_files_and_reports_binary_ones(spark, scratch):
    import os

    from tallyforge.sources import documents
    root = f"{scratch}/stage"
    os.makedirs(f"{root}/sub")
    for name, data in (("a.PDF", b"plain text"), ("sub/b.pdf", b"%PDF-1.7 \xff\xfe\x00binary"), ("c.txt", b"other"), ("d[1].Pdf", "é".encode())):
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    rows = {r.file_name: (r.content, r.error) for r in documents.read_documents(spark, root).collect()}
    assert rows == {"a.PDF": ("plain text", None), "b.pdf": (None, "not UTF-8 text"), "d[1].Pdf": ("é", None)}
    assert {r.file_name for r in documents.read_documents(spark, root, "c.%").collect()} == {"c.txt"}
